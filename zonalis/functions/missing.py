"""Aggregates with explicit missing-value rules.

A missing number is NULL; NaN is turned into NULL on the way in with :func:`null_if_nan`.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strict_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one row of the group is NULL."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def strict_sum_where(condition: Column, value: Column) -> Column:
    """:func:`strict_sum` over the rows that meet ``condition``; NULL if there are none."""
    rows = F.count(F.when(condition, F.lit(1)))
    filled = F.count(F.when(condition, value))
    return F.when((rows > 0) & (rows == filled), F.sum(F.when(condition, value)))


def skipna_sum(value: Column) -> Column:
    """Sum of the non-NULL rows; 0 if there are none."""
    return F.coalesce(F.sum(value), F.lit(0))


def first_by(value: Column, ordinal: Column) -> Column:
    """Value of the row with the smallest ordinal, NULL included."""
    return F.min_by(value, ordinal)


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)
