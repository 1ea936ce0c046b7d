"""Text codes: padding, slicing, pasting, recoding and number parsing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

CIRCUIT_WIDTH = 6


def paste(*parts: Column) -> Column:
    """Concatenate; a missing part becomes the text ``NA``."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def slice_text(text: Column, start: int, end: int) -> Column:
    """Characters ``start`` to ``end``, 1-based and both included."""
    return F.substring(text, start, end - start + 1)


def circuit_zeroes(code: Column) -> Column:
    """Zeroes that pad a circuit code of 2 to 6 characters to 6; NULL for any other length."""
    size = F.length(code)
    return F.when(size.between(2, CIRCUIT_WIDTH), F.repeat(F.lit("0"), F.lit(CIRCUIT_WIDTH) - size))


def section_code(district: Column, section: Column) -> Column:
    """Five digits: two of the district, three of the section."""
    number = F.lit(100000) + district.cast("bigint") * 1000 + section.cast("bigint")
    return slice_text(number.cast("string"), 2, 6)


def recode(value: Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Replace known values; others become ``default`` (or stay); NULL stays NULL."""
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for old, new in labels.items():
        chain = chain.when(value == old, F.lit(new))
    return chain.otherwise(value if default is None else F.lit(default))


def as_integer(text: Column) -> Column:
    """Whole number by truncation; NULL for text that is not a number."""
    return text.try_cast("double").try_cast("bigint")


def decimal_comma_text(text: Column) -> Column:
    """Number written with a decimal comma and optional grouping dots."""
    ungrouped = F.regexp_replace(text, r"\.(?=\d{3}(\D|$))", "")
    return F.replace(ungrouped, F.lit(","), F.lit(".")).try_cast("double")


def format_decimal_comma(number: Column) -> Column:
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))
