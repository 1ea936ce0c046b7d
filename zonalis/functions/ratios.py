"""Rounding and percentages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_even(value: Column, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(value, digits)


def exact(column: str, precision: int, digits: int) -> Column:
    """A number as a decimal; NULL where it is missing, NaN or infinite. A number that does not fit is an error."""
    value = F.col(f"`{column}`")
    real = F.abs(value.cast("double")) < float("inf")
    return F.when(real, value.cast(f"decimal({precision},{digits})"))


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; NULL when the whole is 0 or missing."""
    return F.try_divide(part, whole) * 100
