"""Helpers the operators share: words, fresh column names, Arrow batches cut by bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a word is a run of anything but the six ASCII white-space characters; bytes.split() cuts at the same six
WORD = r"[^\x20\x09-\x0D]+"

# texts are taken from an Arrow batch in portions of about this many bytes, so that work arrays stay small
PORTION = 4 << 20


def fresh(taken: list[str], name: str) -> str:
    """A name that no column of the input has or begins with, whatever its case."""
    while any(c.lower().startswith(name.lower()) for c in taken):
        name = "_" + name
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(quoted(name))


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join of rows with an aggregate over the same keys, in which a hot key can be split.

    An aggregate is partitioned by its keys already, and a side that is joined without a shuffle of its own cannot be
    split by adaptive execution. With a hash of the keys as one key more, both sides get one.
    """
    mark = fresh([*left.columns, *right.columns], "mark")
    value = F.xxhash64(*[col(k) for k in keys])
    return left.withColumn(mark, value).join(right.withColumn(mark, value), [*keys, mark], how).drop(mark)


def with_fields(df: DataFrame, result: Column, names: list[str]) -> DataFrame:
    """``df`` with the fields of a struct as columns. A column of the input with one of these names is replaced."""
    inner = fresh(df.columns, "result")
    new = {n.lower() for n in names}
    kept = [col(c) for c in df.columns if c.lower() not in new]
    return df.withColumn(inner, result).select(*kept, *[F.col(f"{inner}.{n}").alias(n) for n in names])


def portions(texts: pa.Array, limit: int = PORTION) -> Iterator[list[bytes | None]]:
    """The texts of a batch as UTF-8 bytes, in order, in lists of about ``limit`` bytes; a longer text is alone."""
    found: list[bytes | None] = []
    size = 0
    for value in texts:
        raw = value.as_buffer()
        text = None if raw is None else raw.to_pybytes()
        if found and size + len(text or b"") > limit:
            yield found
            found, size = [], 0
        found.append(text)
        size += len(text or b"")
    if found:
        yield found


def words(text: Column) -> Column:
    """The words of a text as an array; none for NULL and for empty texts."""
    plain = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(plain, " "), "")
