"""Removal of byte strings that occur more than once, by suffixes sorted column by column.

Texts are UTF-8 bytes; a window is ``size`` consecutive bytes of one text. A window is repeated if its bytes also start anywhere
else: in another row, or elsewhere in the same text, overlapping or not. Every byte that a repeated window covers is removed;
windows are judged on the input.

1. *Documents of a collection.* The anchor of a window is its ``gram``-byte string with the least hash, the first one of equal
   ones. Neighbouring windows with the same anchor are one fragment, of 2 * size bytes at most. Equal windows have equal anchors at
   equal distances, so only fragments around equal anchors are ever compared, and an anchor that occurs once is done with. Equal
   fragments enter a collection once (twice, if they occur more than once).
2. *Columns.* The fragments of a collection are lined up at the anchor. Rounds go from the last column to the first, and each inserts one
   symbol of every fragment: the suffixes that start at the column are sorted by their symbol and then as they were before, and
   the common prefix of two neighbours is one longer than the least that lay between them. A round reads its
   symbols (the Burrows-Wheeler column: what precedes each suffix, in suffix order), fragments and common prefixes from a
   file from front to back, and writes those of the next round to another. Suffixes of different columns start
   at different distances from the anchor, cannot be equal windows, and need not be merged. A window is
   repeated if the common prefix with a neighbour is ``size`` or longer.
3. *Anchors with more than ``PART`` distinct fragments* get longer ones: their fragments are texts themselves, cut again around the
   next of ``grams``. Fragments that share a longer anchor are more alike and fewer, and most of them are equal or alone. The last
   anchors are whole windows, of which no two fragments of one anchor differ, so no collection is larger than that.
4. The places of repeated windows go to their texts, which drop the bytes they cover.

A task works on ``FRAGMENTS`` fragments at a time and keeps its files in a temporary folder that goes with the task. A long text is cut into fragments in pieces of ``CHUNK`` bytes that overlap by a window, so memory
does not grow with it beyond the text itself, its fragments that are wanted, and its places. Texts are told apart by two hashes of 64 bits, equal
fragments by another two; common prefixes compare the bytes themselves.

NULL and empty texts have no bytes and lose none; nor do texts shorter than a window, or the rows of an empty table. Two equal rows
are two places, so all their windows are repeated. Other columns are kept; one with the name of a result is replaced. ``kept``
is binary, as a cut may go through a character.
"""

from __future__ import annotations

import contextlib
import functools
import os
import tempfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, fresh, portions, spread_join, with_fields
from zonalis.sources.stage import staged

SIZE = 400
GRAMS = (64, 300, 384)  # lengths of anchors; whole windows come last
CHUNK = 1 << 20  # bytes of text whose windows are cut into fragments at a time
INDEX_BITS = 23  # places within such a piece; the other bits of a word are the hash that is compared
PART = 512  # distinct fragments of one anchor in a collection, at most
FRAGMENTS = 8192  # fragments a task works on at a time
BROADCAST_ROWS = 300_000  # up to so many pairs of numbers are sent to all tasks instead of being joined by a shuffle
U = np.uint64
MODULUS = 1 << 64
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
STIRS = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB))


def stirred(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> U(30))) * STIRS[0]
    x = (x ^ (x >> U(27))) * STIRS[1]
    return x ^ (x >> U(31))


@functools.cache
def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64."""
    both = []
    for b in (base, pow(base, -1, MODULUS)):
        steps = np.full(count, b, U)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


class Prints:
    """Hashes of any stretch of some bytes, from sums over their beginnings."""

    def __init__(self, data: np.ndarray, turn: int) -> None:
        room = 1 << max(16, len(data).bit_length())
        self.powers, inverse = _powers(BASES[turn], room)
        values = stirred(np.arange(1 + 256 * turn, 257 + 256 * turn, dtype=U))
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(values[data] * inverse[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        plain = (self.sums[stop] - self.sums[start]) * self.powers[start]
        return stirred(plain + (stop - start).astype(U) * STIRS[0])

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all stretches of one length."""
        count = len(self.sums) - size
        return stirred((self.sums[size:] - self.sums[:count]) * self.powers[:count])


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbouring values, by doubling."""
    count, done = len(values) - width + 1, 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:count], values[width - done : width - done + count])


def cut(texts: list[bytes], size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Fragments of some texts: number of the text, first byte, windows, bytes before the anchor, hash of the anchor, two of the bytes."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([0, *map(len, texts)])
    if len(data) < size:
        return (np.zeros(0, np.int64),) * 7
    if len(data) >= 1 << INDEX_BITS:
        raise ValueError("too many bytes at a time")
    first, second = Prints(data, 0), Prints(data, 1)
    hashes = first.grams(gram)
    rank = U((1 << INDEX_BITS) - 1)
    at = (least(hashes & ~rank | np.arange(len(hashes), dtype=U), size - gram + 1) & rank).astype(np.int64)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    whole = np.flatnonzero(np.repeat(ends[1:], sizes)[: len(at)] - np.arange(len(at)) >= size)  # starts of windows of one text
    at = at[whole]
    new = np.ones(len(whole), bool)
    new[1:] = (np.diff(at) != 0) | (np.diff(whole) != 1) | (np.diff(owner[whole]) != 0)
    begin = np.flatnonzero(new)
    start, anchor, count = whole[begin], at[begin], np.diff(begin, append=len(whole))
    stop = start + count - 1 + size
    mine = owner[start]
    return mine, start - ends[mine], count, anchor - start, hashes[anchor], first.of(start, stop), second.of(start, stop)


CUTS = "k1 long, k2 long, n long, start long, count int, lead int, anchor long, f1 long, f2 long"


def _cutter(size: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [field.split()[0] for field in CUTS.split(", ")]

    def pieces(texts: list[bytes | None], at: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
        """Bytes to cut, the rows they come from and where in their text they begin; long texts in parts that share size - 1 bytes."""
        if len(texts) > 1 or len(texts[0] or b"") <= CHUNK:
            yield [t or b"" for t in texts], np.arange(at, at + len(texts)), np.zeros(len(texts), np.int64)
        else:
            for low in range(0, len(texts[0]) - size + 1, CHUNK):
                yield [texts[0][low : low + CHUNK + size - 1]], np.array([at]), np.array([low])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(i).to_numpy() for i in (1, 2, 3)]
            row = 0
            for portion in portions(batch.column(0), CHUNK):
                for data, rows, offset in pieces(portion, row):
                    mine, start, count, lead, *hashes = cut(data, size, gram)
                    if len(mine):
                        own = [k[rows[mine]] for k in keys]
                        columns = [*own, start + offset[mine], count.astype(np.int32), lead.astype(np.int32), *[h.view(np.int64) for h in hashes]]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                row += len(portion)

    return run


class Rounds:
    """The files between rounds: what is to be inserted next, in suffix order, with fragments and common prefixes."""

    def __init__(self, folder: str, count: int) -> None:
        self.files = [open(os.path.join(folder, name), "w+b", buffering=0) for name in ("even", "odd")]  # noqa: SIM115
        self.count = count

    def write(self, turn: int, symbols: np.ndarray, order: np.ndarray, common: np.ndarray) -> None:
        file = self.files[turn % 2]
        file.seek(0)
        for values, kind in ((symbols, np.uint16), (order, np.int32), (common, np.int32)):
            file.write(values.astype(kind, copy=False).tobytes())

    def read(self, turn: int) -> list[np.ndarray]:
        file = self.files[turn % 2]
        file.seek(0)
        return [np.frombuffer(file.read(self.count * np.dtype(kind).itemsize), kind) for kind in (np.uint16, np.int32, np.int32)]

    def close(self) -> None:
        for file in self.files:
            file.close()


def repeated(fragments: list[bytes], lead: np.ndarray, group: np.ndarray, twice: np.ndarray, size: int, reach: int, folder: str) -> np.ndarray:
    """Which windows of each fragment are repeated in its group: a row for each fragment, a column for each distance from the anchor.

    ``group`` rises. The anchor stands in column ``reach``; a window of the fragment starts at column reach - lead or behind it.
    """
    lengths = np.fromiter(map(len, fragments), np.int64, len(fragments))
    copies = np.repeat(np.arange(len(fragments)), 1 + twice)
    width, total = int((reach - lead + lengths).max()), len(fragments)
    # columns one after the other in a file; 0 stands for no symbol
    symbols = np.zeros((width, total), np.uint16)
    place = np.repeat(reach - lead - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    symbols[place, np.repeat(np.arange(total), lengths)] = np.frombuffer(b"".join(fragments), np.uint8).astype(np.uint16) + 1
    path = os.path.join(folder, "columns")
    with open(path, "wb") as file:
        symbols[::-1].tofile(file)
    del symbols
    found = np.zeros((total, reach + 1), bool)
    own = group[copies].astype(np.int64) * 257
    rounds = Rounds(folder, len(copies))
    with open(path, "rb") as file, contextlib.closing(rounds):
        column = lambda: np.frombuffer(file.read(2 * total), np.uint16)[copies]
        rounds.write(0, column(), np.arange(len(copies)), np.zeros(len(copies)))
        for turn in range(width):
            inserted, order, common = rounds.read(turn)
            key = own[order] + inserted
            new = np.argsort(key, kind="stable")
            key = key[new]
            alike = np.flatnonzero((key[1:] == key[:-1]) & (inserted[new[1:]] > 0))
            longer = np.zeros(len(new), np.int32)
            if len(alike):
                between = np.column_stack([new[alike] + 1, new[alike + 1] + 1]).ravel()
                longer[alike + 1] = np.minimum.reduceat(np.append(common, np.int32(0)), between)[::2] + 1
            order = order[new]
            at = width - 1 - turn
            if at <= reach:
                near = np.flatnonzero(longer >= size)
                found[copies[order[near]], at] = True
                found[copies[order[near - 1]], at] = True
            if at:
                rounds.write(turn + 1, column()[order], order, longer)
    return found


def _spans(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last column of every stretch of set cells."""
    edges = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edges == 1)
    return row, first, np.nonzero(edges == -1)[1] - 1


def _judge(size: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From fragments, those of an anchor one after the other, to stretches of repeated windows."""
    reach = size - gram

    def judged(table: pa.Table) -> pa.RecordBatch:
        anchor, f1, f2, lead, twice = (table.column(c).to_numpy() for c in ("anchor", "f1", "f2", "lead", "twice"))
        group = np.cumsum(np.append(False, np.diff(anchor) != 0))
        with tempfile.TemporaryDirectory() as folder:
            row, first, last = _spans(repeated(table.column("bytes").to_pylist(), lead, group, twice, size, reach, folder))
        # as bytes of the fragment
        begin = first - reach + lead[row]
        columns = [f1[row], f2[row], begin, begin + last - first + size]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["f1", "f2", "first", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            while held.num_rows > FRAGMENTS:
                ends = np.flatnonzero(np.diff(held.column("anchor").to_numpy())) + 1
                ends = ends[ends <= max(FRAGMENTS, ends[0] if len(ends) else 0)]
                if not len(ends):
                    break  # one collection fills all of it; its end is yet to come
                yield judged(held.slice(0, int(ends[-1])))
                held = held.slice(int(ends[-1]))
        if held is not None and held.num_rows:
            yield judged(held)

    return run


def _remover() -> Callable[[Column, Column], Column]:
    @arrow_udf("struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            counts: list[tuple[int, int, int]] = []
            kept: list[bytes] = []
            for portion in portions(texts):
                for text in portion:
                    raw = text or b""
                    own = ranges[len(kept)].values
                    spans = []
                    if own is not None:
                        first, stop = (own.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                        order = np.argsort(first, kind="stable")
                        first, reach = first[order], np.maximum.accumulate(stop[order])
                        new = np.append(True, first[1:] > reach[:-1])
                        spans = list(zip(first[new].tolist(), reach[np.append(new[1:], True)].tolist(), strict=True))
                    edges = [0, *[x for span in spans for x in span], len(raw)]
                    kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                    counts.append((len(raw), len(raw) - len(kept[-1]), len(spans)))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(3)]
            yield pa.StructArray.from_arrays([*columns, pa.array(kept, pa.binary())], ["n_bytes", "n_removed", "n_spans", "kept"])

    return run


def repeated_ranges(texts: DataFrame, size: int, grams: Sequence[int]) -> DataFrame:
    """``k1, k2, ranges``: the bytes that repeated windows cover, as ranges that may overlap, of each text that has any.

    ``texts`` has a key of two numbers ``k1`` and ``k2``, equal for equal texts, ``n``, how often a row counts, and ``raw``, the bytes.
    """
    gram, later = grams[0], grams[1:]
    cuts = texts.where(F.octet_length("raw") >= size).select("raw", "k1", "k2", "n").mapInArrow(_cutter(size, gram), CUTS)
    cuts = staged(cuts, "fragments")
    shared = cuts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    # copies of a text have the same fragments at the same places: one row for all
    same = [c for c in cuts.columns if c != "n"]
    places = staged(spread_join(cuts, shared, ["anchor"]).groupBy(*same).agg(F.sum("n").alias("n")), "places")

    distinct = places.groupBy("anchor", "f1", "f2", "count", "lead").agg(
        (F.sum("n") > 1).alias("twice"), F.min(F.struct("k1", "k2", "start")).alias("from")
    )
    distinct = staged(distinct, "distinct_fragments")
    crowded = distinct.groupBy("anchor").agg((F.count("*") > PART).alias("crowded"))
    item = F.struct("anchor", "crowded", "f1", "f2", "lead", "twice", F.col("from.start").alias("start"), "count")
    wanted = spread_join(distinct, crowded, ["anchor"])
    wanted = wanted.groupBy(F.col("from.k1").alias("k1"), F.col("from.k2").alias("k2")).agg(F.collect_list(item).alias("items"))
    wanted = staged(wanted, "wanted")
    keys = wanted.select("k1", "k2")
    holding = texts.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, ["k1", "k2"], "left_semi")
    # one of equal texts; the bytes are a column of the aggregate, so that they are not made anew for each fragment
    holding = holding.groupBy("k1", "k2").agg(F.first("raw").alias("raw"))
    part = lambda i: F.substring(F.col("raw"), (i["start"] + 1).cast("int"), i["count"] + (size - 1))
    taken = holding.join(wanted, ["k1", "k2"]).select(F.explode(F.transform("items", lambda i: i.withField("bytes", part(i)))).alias("i"))
    taken = taken.select(*[f"i.{c}" for c in ("anchor", "crowded", "f1", "f2", "lead", "twice", "bytes")])
    if later and not wanted.where(F.exists("items", lambda i: i["crowded"])).isEmpty():
        taken = staged(taken, "taken")
        again = taken.where("crowded").select(F.col("f1").alias("k1"), F.col("f2").alias("k2"), F.col("bytes").alias("raw"), F.expr("IF(twice, 2L, 1L)").alias("n"))
        longer = repeated_ranges(again, size, later).select(F.col("k1").alias("f1"), F.col("k2").alias("f2"), F.inline("ranges"))
        taken = taken.where("NOT crowded")
    else:
        longer = None
    stretches = taken.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_judge(size, gram), "f1 long, f2 long, first long, stop long")
    stretches = stretches if longer is None else stretches.unionByName(longer)
    stretches = stretches.groupBy("f1", "f2").agg(F.collect_list(F.struct("first", "stop")).alias("stretches"))
    hit = spread_join(places.select("k1", "k2", "start", "f1", "f2"), stretches, ["f1", "f2"])
    moved = F.transform("stretches", lambda s: F.struct((F.col("start") + s["first"]).alias("first"), (F.col("start") + s["stop"]).alias("stop")))
    return staged(hit.groupBy("k1", "k2").agg(F.flatten(F.collect_list(moved)).alias("ranges")), "ranges")


def remove_repeats(df: DataFrame, text: str = "text", size: int = SIZE, grams: Sequence[int] = GRAMS) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``, the bytes that stay."""
    grams = [*grams, size]
    if grams != sorted(set(grams)) or grams[0] < 1:
        raise ValueError("anchors must grow, and the last must be shorter than a window")
    k1, k2, ranges = (fresh(df.columns, n) for n in ("k1", "k2", "ranges"))
    keyed = df.withColumns({k1: F.xxhash64(col(text)), k2: F.xxhash64(F.lit(1), col(text))})
    texts = keyed.select(col(text).cast("binary").alias("raw"), F.col(k1).alias("k1"), F.col(k2).alias("k2"), F.lit(1).cast("long").alias("n"))
    gone = repeated_ranges(texts, size, grams).withColumnsRenamed({"k1": k1, "k2": k2, "ranges": ranges})
    count = gone.agg(F.sum(F.size(ranges) + 1)).first()[0] or 0
    joined = keyed.join(F.broadcast(gone), [k1, k2], "left") if count <= BROADCAST_ROWS else spread_join(keyed, gone, [k1, k2], "left")
    out = with_fields(joined, _remover()(col(text), F.col(ranges)), ["n_bytes", "n_removed", "n_spans", "kept"])
    return out.drop(k1, k2, ranges)
