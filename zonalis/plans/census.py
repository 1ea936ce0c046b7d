"""Census files, one variable each, as one long or wide table per tract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalis.operators.reshape import stack, sum_to_wide, to_long
from zonalis.sources.text import read_category_file, read_total_file

# The files that carry the denominator of each family of variables.
DENOMINATORS = {
    "vi_": "VIVIENDA-INCALCONS.csv",
    "vi_urban_": "VIVIENDA-URP.csv",
    "ho_": "HOGAR-ALGUNBI.csv",
    "per_": "PERSONA-P02.csv",
}


def category_files(spark: SparkSession, folder: str, prefixes: Mapping[str, str]) -> list[DataFrame]:
    """One table per file; ``prefixes`` maps file names to prefixes, so no order is relied on."""
    return [read_category_file(spark, f"{folder}/{name}", prefix) for name, prefix in prefixes.items()]


def total_files(spark: SparkSession, folder: str, files: Mapping[str, str] = DENOMINATORS) -> list[DataFrame]:
    return [read_total_file(spark, f"{folder}/{name}", prefix) for prefix, name in files.items()]


def value_names(tables: Sequence[DataFrame]) -> list[str]:
    return [c for t in tables for c in t.columns[1:]]


def fan_in(tables: Sequence[DataFrame]) -> DataFrame:
    """All files stacked as ``(radio, var, value)``; the first column of each is the key."""
    return stack(
        [to_long(t.withColumnRenamed(t.columns[0], "radio"), ["radio"], t.columns[1:], "var", "value") for t in tables]
    )


def within_first(tables: Sequence[DataFrame]) -> DataFrame:
    """:func:`fan_in` for the tracts of the first file; a tract that it lacks is left out of all."""
    first = tables[0].select(F.col(f"`{tables[0].columns[0]}`").alias("radio")).distinct()
    return fan_in(tables).join(first, "radio", "left_semi")


def census_wide(tables: Sequence[DataFrame]) -> DataFrame:
    """One row per tract of the first file, one column per category of every file.

    One shuffle on the key, where a chain of joins would need one per file. A tract occurs once per
    file, so the sum per tract and column is the value itself.
    """
    names = value_names(tables)
    first = "__in_first"
    keys = tables[0].selectExpr(f"`{tables[0].columns[0]}` AS radio", f"'{first}' AS var", "1L AS value")
    stacked = stack([fan_in(tables), keys])
    table = sum_to_wide(stacked, ["radio"], "var", F.col("value"), [first, *names])
    return table.filter(F.col(f"`{first}`").isNotNull()).drop(first)
