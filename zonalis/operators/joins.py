"""Left joins, folds of them, and group values on each row.

A hot key needs no plan of its own: both sides of a join are shuffled for it, so adaptive
execution sees the sizes of all partitions and splits the large ones by the map tasks that wrote them, whatever the
number of hot keys. ``session.SETTINGS`` turns that on. Sizes are bytes after compression, so a key whose rows are all
equal is split later than its number of rows suggests.

Two things do not wait for that: a join with a table of few keys deals the rows of each key to salts (:func:`salted`), and a
shuffle whose tasks must stay small gets partitions by the number of its rows (:func:`spread`).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

SALT = "__salt"
# Parts into which the rows of one key of a small table are dealt; the small table is listed once for each.
SALTS = 64
# Rows of a partition, where the memory of a task grows with them.
ROWS_PER_TASK = 250_000


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which a missing key matches a missing key."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    match = F.expr(" AND ".join(f"`{k}` <=> `__r_{k}`" for k in keys))
    return left.join(renamed, match, "left").drop(*[f"__r_{k}" for k in keys])


def spread_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`left_join` with an aggregate over the same keys.

    An aggregate is partitioned by its keys already. With their hash as one key more both sides get a shuffle
    of the join's own, which is what adaptive execution can split, however few keys there are.
    """
    mark = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    return left_join(left.withColumn("__h", mark), right.withColumn("__h", mark), [*keys, "__h"]).drop("__h")


def salted(left: DataFrame, right: DataFrame, salts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """Both tables with the key SALT for a join with few keys, each of which holds a large share of ``left``.

    A row of ``left`` has a salt by a hash of all its columns, a row of ``right``, the small table, is listed with every salt.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    return left.withColumn(SALT, salt), right.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], salts: int = SALTS) -> DataFrame:
    """:func:`left_join` with a small table of few keys: no task gets all rows of a key, also without a broadcast."""
    return left_join(*salted(left, right, salts), [*keys, SALT]).drop(SALT)


def spread(df: DataFrame, keys: Sequence[str], rows: int, per_task: int | None = None) -> DataFrame:
    """``df`` by ``keys``, in as many partitions as ``rows`` rows ask for (ROWS_PER_TASK each); adaptive execution does not merge them."""
    return df.repartition(max(1, math.ceil(rows / (per_task or ROWS_PER_TASK))), *keys)


def join_fold(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left-join every further table to the first on the same keys; a missing key matches a missing key."""
    return reduce(lambda a, b: left_join(a, b, keys), tables)


def fan_out(right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``right`` that occur more than once, with their number of rows."""
    return right.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def attach_group_values(
    df: DataFrame, keys: Sequence[str], values: Mapping[str, Column], also: DataFrame | None = None
) -> DataFrame:
    """Aggregates of the group on each of its rows, without gathering the group in one task.

    A window over the whole partition would do that; here partial aggregation shrinks each group to
    one row first, and that row is joined back. A table ``also`` with the same keys is joined to the
    groups before, so that the rows of ``df`` are shuffled once for both.
    """
    groups = df.groupBy(*keys).agg(*[v.alias(name) for name, v in values.items()])
    if also is not None:
        groups = left_join(groups, also, keys)
    return spread_left_join(df, groups, keys)
