"""Column selection by name pattern, range or dictionary.

Helpers return column names in table order, ready for ``select``, ``drop`` or a comprehension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def starts_with(df: DataFrame, *prefixes: str) -> list[str]:
    """Names with one of the prefixes; case is ignored."""
    lowered = tuple(p.lower() for p in prefixes)
    return [c for c in df.columns if c.lower().startswith(lowered)]


def ends_with(df: DataFrame, *suffixes: str) -> list[str]:
    """Names with one of the suffixes; case is ignored."""
    lowered = tuple(s.lower() for s in suffixes)
    return [c for c in df.columns if c.lower().endswith(lowered)]


def without(names: Iterable[str], dropped: Iterable[str]) -> list[str]:
    gone = set(dropped)
    return [n for n in names if n not in gone]


def one_of(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given names in the given order; a name the table lacks is an error."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not in table: {absent}")
    return list(names)


def between(df: DataFrame, first: str, last: str) -> list[str]:
    """All columns from ``first`` to ``last``, both included."""
    lo, hi = (df.columns.index(one_of(df, [c])[0]) for c in (first, last))
    return df.columns[lo : hi + 1]


def everything(df: DataFrame, *leading: str) -> list[str]:
    """All columns, the leading ones first."""
    return [*one_of(df, leading), *without(df.columns, leading)]


def across(df: DataFrame, names: Sequence[str], expr: Callable[[Column], Column]) -> DataFrame:
    """Replace each named column by ``expr`` of it, in one projection."""
    chosen = set(names)
    return df.select(*[expr(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def lower_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def category_names(headers: Sequence[str], prefix: str) -> list[str]:
    """Names for category headers such as ``1 Own home``.

    The text after the first space of the *first* header gives the cut position, which then holds
    for all headers of the file. Spaces in the label become underscores.
    """
    cut = headers[0].index(" ") + 1
    return [prefix + h[cut:].replace(" ", "_") for h in headers]


def dictionary_projection(df: DataFrame, dictionary: Sequence[tuple[str, int, str]]) -> DataFrame:
    """Keep and rename the columns whose dictionary row ``(name, flag, new_name)`` has flag 1."""
    kept = [(old, new) for old, flag, new in dictionary if flag == 1]
    one_of(df, [old for old, _ in kept])
    return df.selectExpr(*[f"`{old}` AS `{new}`" for old, new in kept])
