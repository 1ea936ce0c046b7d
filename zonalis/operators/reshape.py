"""Long to wide, wide to long and stacking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def to_wide(df: DataFrame, keys: Sequence[str], name: str, value: str, labels: Sequence[str]) -> DataFrame:
    """One column per label. Labels are given, so no job is needed to find them; a NULL label gets no column.

    A second row for one key and label is an error.
    """
    again = F.count(F.when(F.col(f"`{name}`").isin(list(labels)), F.lit(1))) > 1
    only = F.first(F.col(f"`{value}`"), ignorenulls=True)
    error = F.raise_error(F.lit(f"more than one row for a key and a label of {name}"))
    return df.groupBy(*keys).pivot(name, list(labels)).agg(F.when(again, error).otherwise(only))


def sum_to_wide(df: DataFrame, keys: Sequence[str], name: str, value: Column, labels: Sequence[str]) -> DataFrame:
    """Sum per key and label, one column per label."""
    return df.groupBy(*keys).pivot(name, list(labels)).agg(F.sum(value))


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per value column; NULL values are kept."""
    return df.unpivot(list(ids), list(values), name, value)


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Append by column name; a column that a table lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
