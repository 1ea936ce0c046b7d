"""Shards by a Feistel permutation of global row numbers.

A row's number is its place in the stored table: files in path order, rows in file order. Four keyed Feistel rounds
permute the smallest power-of-four domain that holds all numbers, and a number that leaves the table is permuted again
until it is back (cycle walking), so the rows themselves are permuted. Row number p after the permutation goes
to shard p mod n, slot p div n: shard sizes differ by one at most, slots have no gaps, and both can be computed
for any row, and undone, without looking at another row. Nothing is sorted or shuffled.

The law is ``rows``. A table that was not read from files is first written to the shared folder. The same files and
the same seed give the same shards; equal rows are different rows with slots of their own. NULL texts have size 1
and checksum 0. Empty tables give no rows. Columns of the input are kept; one with the name of a result is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, fresh, with_fields
from zonalis.sources.stage import staged

ROUNDS = 4
BROADCAST_FILES = 50_000  # up to here the list of files is sent to all tasks, beyond it is joined


def round_keys(seed: int) -> list[int]:
    """32-bit keys of the rounds, from a linear congruential generator."""
    keys, state = [], seed & 0xFFFFFFFF
    for _ in range(ROUNDS):
        state = (state * 1664525 + 1013904223) & 0xFFFFFFFF
        keys.append(state)
    return keys


def half_bits(size: int) -> int:
    return max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)


def _mixed(x: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    low = np.uint64(0xFFFFFFFF)
    t = (x * np.uint64(0x9E3779B1) + np.uint64(key)) & low
    t = ((t ^ (t >> np.uint64(15))) * np.uint64(0x2C1B3C6D)) & low
    t ^= t >> np.uint64(13)
    return (t * np.uint64(0x297A2D39) >> np.uint64(7)) & mask


def permuted(numbers: np.ndarray, size: int, seed: int, inverse: bool = False) -> np.ndarray:
    """The permutation of 0 .. size - 1 at these numbers, or its inverse."""
    half = half_bits(size)
    if half > 31:
        raise ValueError("more than 2 ** 62 rows")
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = round_keys(seed)
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ _mixed(left, key, mask), left
            else:
                left, right = right, left ^ _mixed(right, key, mask)
        out[walking] = left << shift | right
        walking = walking[out[walking] >= np.uint64(size)]
    return out.astype(np.int64)


def shard(df: DataFrame, n_shards: int = 16, seed: int = 42, text: str = "text") -> DataFrame:
    """``df`` with ``size``, ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard``."""
    spark = df.sparkSession
    inner = fresh(df.columns, "place")
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias(f"{inner}_file"), F.col("_metadata.row_index").alias(f"{inner}_row"))
    except AnalysisException:
        placed = staged(df, "unsharded").select(
            "*", F.col("_metadata.file_path").alias(f"{inner}_file"), F.col("_metadata.row_index").alias(f"{inner}_row")
        )
    # one line for each file, a list that the driver has anyway, as it plans the scan from it
    counts = placed.groupBy(f"{inner}_file").agg(F.count("*").alias("n")).collect()
    lines, total = [], 0
    for r in sorted(counts, key=lambda r: r[0]):
        lines.append((r[0], total))
        total += r["n"]
    schema = T.StructType([T.StructField(f"{inner}_of", T.StringType()), T.StructField(f"{inner}_first", T.LongType())])
    files = spark.createDataFrame(lines, schema)
    if len(lines) <= BROADCAST_FILES:
        files = F.broadcast(files)

    @arrow_udf("long")
    def place(numbers: pa.Array) -> pa.Array:
        return pa.array(permuted(numbers.to_numpy(zero_copy_only=False), total, seed))

    numbered = placed.join(files, F.col(f"{inner}_file") == F.col(f"{inner}_of"))
    numbered = numbered.withColumn(inner, place(F.col(f"{inner}_first") + F.col(f"{inner}_row")))
    content = F.coalesce(col(text), F.lit(""))
    out = with_fields(
        numbered,
        F.struct(
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
            F.lit("rows").alias("law"),
            (F.col(inner) % n_shards).cast("int").alias("shard"),
            F.expr(f"`{inner}` div {n_shards}").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        ),
        ["size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    )
    return out.drop(inner, f"{inner}_file", f"{inner}_row", f"{inner}_of", f"{inner}_first")
