"""SimHash near-duplicates with covering locality-sensitive hashing.

A document's fingerprint has a bit where more than half of its shingle hashes have one. Two fingerprints are linked
if they differ in at most ``radius`` bits; linked documents form components.

Tables: every bit position gets a vector of radius + 1 bits, and every non-zero vector v of that length is a table
whose mask keeps the positions with an odd inner product with v. Any ``radius`` positions leave at least one v that
is orthogonal to all of their vectors, and its mask hides them all: every pair within the radius agrees on the
kept bits of some table. With a radius of 4 there are 31 tables, and each keeps about half of the bits.

Rows that agree in a table form a bucket. Equal fingerprints are one row before that, so a large group of copies
is one row. A bucket is compared in blocks inside a task, and only a spanning forest of its links leaves the task:
one row less than the bucket has, never its pairs. Buckets over ``bucket_limit`` are dealt again by the same
tables over the bits that the first table hides (a pair that agrees on the kept bits differs in the hidden ones
only). About 15 bits are free after that, so such a bucket has at most some 2 ** 15 members.

NULL and empty texts have the fingerprint 0 and are linked like any other. A text with fewer words than a shingle is
one shingle; its words are joined by one space. Repeated rows are nodes of their own with equal results. The
component of documents whose ids are all NULL is NULL. Columns of the input are kept; one with the name of a result
is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, fresh, portions, spread_join
from zonalis.llm.components import components
from zonalis.sources.stage import staged

SEED = 42
BITS = 64
BUCKET_LIMIT = 4096
BLOCK = 1024


def _fingerprint(shingles: list[bytes]) -> int:
    if not shingles:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(shingles))
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):  # one byte for each bit, a bounded number of rows at a time
        part = hashes[start : start + (1 << 16)].astype("<u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    on = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(on.view("<u8")[0])


def fingerprint_of(text: bytes, size: int) -> int:
    """Fingerprint of one UTF-8 text: A-Z in lower case, shingles of ``size`` words, repeats counted."""
    words = text.lower().split()  # of bytes: only A-Z change, and the six ASCII white-space characters cut
    if len(words) <= size:
        return _fingerprint([b" ".join(words)] if words else [])
    return _fingerprint([b" ".join(w) for w in zip(*(words[i:] for i in range(size)), strict=False)])


def _fingerprints(size: int) -> Callable[[Column], Column]:
    @arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [fingerprint_of(t or b"", size) for portion in portions(texts) for t in portion]
            yield pa.array(np.array(found, np.uint64).view(np.int64))

    return run


def covering_masks(radius: int, positions: list[int]) -> list[int]:
    """Masks over the given bit positions, such that any ``radius`` of them are hidden by at least one mask.

    Vectors are dealt out in turn, so that every mask keeps about half of the positions.
    """
    vectors = (1 << (radius + 1)) - 1
    own = {p: 1 + i * 11 % vectors for i, p in enumerate(positions)}
    masks = []
    for v in range(1, vectors + 1):
        masks.append(sum(1 << p for p in positions if (own[p] & v).bit_count() % 2))
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(radius: int) -> Callable[[Column], Column]:
    """Links that connect what is linked within each array of fingerprints, one less than the members at most."""

    @arrow_udf("array<struct<a:long,b:long>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for buckets in batches:
            a: list[int] = []
            b: list[int] = []
            ends = [0]
            for bucket in buckets:
                members = np.unique(bucket.values.to_numpy(zero_copy_only=False))
                for x, y in forest(members, radius):
                    a.append(x)
                    b.append(y)
                ends.append(len(a))
            pairs = pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    return run


def forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Breadth-first search from each member that is not yet reached; a member is compared with the unreached only."""
    bits = members.view(np.uint64)
    waiting = np.arange(len(members))
    links: list[tuple[int, int]] = []
    while len(waiting) > 1:
        front, waiting = waiting[:1], waiting[1:]
        while len(front) and len(waiting):
            reached = np.full(len(waiting), -1)
            for start in range(0, len(front), BLOCK):
                part = front[start : start + BLOCK]
                open_ = np.flatnonzero(reached < 0)
                for begin in range(0, len(open_), BLOCK):
                    these = open_[begin : begin + BLOCK]
                    near = np.bitwise_count(bits[part][:, None] ^ bits[waiting[these]][None, :]) <= radius
                    hit = near.any(0)
                    reached[these[hit]] = part[near[:, hit].argmax(0)]
            new = reached >= 0
            links += zip(members[reached[new]].tolist(), members[waiting[new]].tolist(), strict=True)
            front, waiting = waiting[new], waiting[~new]
    return links


def _dealt(rows: DataFrame, radius: int, positions: list[int], where: list[str]) -> DataFrame:
    """Each row once for each table over ``positions``: table number and kept bits."""
    masks = [_signed(m) for m in covering_masks(radius, positions)]
    tables = F.array(*[F.struct(F.lit(i).alias("table"), F.lit(m).cast("long").alias("mask")) for i, m in enumerate(masks)])
    wide = rows.select(*where, "fp", F.explode(tables).alias("t"))
    return wide.select(*where, "fp", F.col("t.table").alias("table"), F.col("fp").bitwiseAND(F.col("t.mask")).alias("kept"))


def links(fingerprints: DataFrame, radius: int, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links (``a``, ``b``) that connect all distinct fingerprints (column ``fp``) within the radius of each other."""
    rows = _dealt(fingerprints, radius, list(range(BITS)), [])
    masks = covering_masks(radius, list(range(BITS)))
    hidden = {i: [p for p in range(BITS) if not m >> p & 1] for i, m in enumerate(masks)}
    return _bucket_links(rows, ["table", "kept"], radius, bucket_limit, hidden)


def _bucket_links(rows: DataFrame, keys: list[str], radius: int, limit: int, hidden: dict[int, list[int]]) -> DataFrame:
    link = _forest(radius)
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("members")).where("members > 1")
    sizes = staged(sizes, "bucket_sizes")
    member = rows.join(sizes, keys)
    small = member.where(F.col("members") <= limit).groupBy(*keys).agg(F.collect_list("fp").alias("fps"))
    out = small.select(F.explode(link(F.col("fps"))).alias("l")).select("l.a", "l.b")
    if sizes.where(F.col("members") > limit).isEmpty():
        return out
    # the second dealing: within a bucket the kept bits are equal, so the tables run over the hidden ones
    second = None
    for table, positions in hidden.items():
        part = member.where((F.col("members") > limit) & (F.col("table") == table)).select(
            F.col("table").alias("table1"), F.col("kept").alias("kept1"), "fp"
        )
        part = _dealt(part, radius, positions, ["table1", "kept1"])
        second = part if second is None else second.union(part)
    # half of the hidden half is kept now: a bucket has at most 2 ** (number of bits still hidden) members
    deep = second.groupBy("table1", "kept1", "table", "kept").agg(F.collect_list("fp").alias("fps"))
    deep = deep.where(F.size("fps") > 1)
    return out.union(deep.select(F.explode(link(F.col("fps"))).alias("l")).select("l.a", "l.b"))


def classes(df: DataFrame, size: int, radius: int, text: str, key: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of each row with ``fp`` (signed), ``root`` (fingerprint that names the component) and ``component_id``."""
    fp = fresh(df.columns, "fp")
    coded = df.withColumn(fp, _fingerprints(size)(F.coalesce(col(text), F.lit("")))).select(*[col(c) for c in dict.fromkeys([*keep, key])], F.col(fp))
    if text not in coded.columns:
        coded = staged(coded, "coded")  # narrow: computed once. With the text in it, computing twice is cheaper than a copy
    alike = staged(coded.groupBy(F.col(fp).alias("fp")).agg(F.min(col(key)).alias("least")), "fingerprints")
    member = components(links(alike.select("fp"), radius))
    rooted = alike.join(member, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = spread_join(rooted, least, ["root"]).select("fp", "root", "component_id")
    named = named.select(*[F.col(c).alias(f"{fp}_{c}") for c in named.columns])
    return coded.join(named, F.col(fp) == F.col(f"{fp}_fp")).select(
        *[col(c) for c in keep], *[F.col(f"{fp}_{c}") for c in ("fp", "root", "component_id")]
    )


def near_duplicates(
    df: DataFrame, size: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id", keep: list[str] | None = None
) -> DataFrame:
    """Rows of ``df`` with ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the smallest id that links lead to.

    ``keep`` names the columns to return, all by default; without the text among them the work is done once.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("fingerprint", "component_id")]
    out = classes(df, size, radius, text, key, kept)
    fp, _, component = out.columns[-3:]
    return out.select(
        *[col(c) for c in kept], F.lower(F.lpad(F.hex(F.col(fp)), 16, "0")).alias("fingerprint"), F.col(component).alias("component_id")
    )


def one_of_each(df: DataFrame, size: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each component: that of the smallest id, NULL first; of equal ids that with the smallest row hash.

    Rows equal in all columns are one row then.
    """
    row = fresh(df.columns, "row")
    marked = df.withColumn(row, F.xxhash64(*[col(c) for c in df.columns]))
    out = classes(marked, size, radius, text, key, [key, row])
    _, root, _ = out.columns[-3:]
    first = out.groupBy(F.col(root).alias("root")).agg(F.min(F.struct(col(key).alias("key"), F.col(row).alias("row"))).alias("f"))
    first = first.select(F.col("f.key").alias(f"{row}_key"), F.col("f.row").alias(f"{row}_row"))
    chosen = marked.join(first, col(key).eqNullSafe(F.col(f"{row}_key")) & (F.col(row) == F.col(f"{row}_row")), "left_semi")
    # chosen rows with the same id and the same hash are equal, so any of them may stay
    return chosen.dropDuplicates([key, row]).drop(row)
