"""Removal of word sequences that occur more than once, with a count-min prefilter.

Words are runs of anything but ASCII white space; a window is ``size`` consecutive words of one text. A window is
repeated if its word sequence also starts anywhere else: in another row, or elsewhere in the same text. Every word
that a repeated window covers is removed; windows are judged on the input.

Equal windows have their least gram (a quarter as many words, the leftmost of least hash) at equal places. Neighbouring windows with the
same least gram are one segment, some 14 windows of 35 words, and its key is the hash of the gram. A window whose gram occurs once occurs once.

1. Every task counts its segments by key in a count-min sketch of ``depth`` rows. Counts are kept up to two ("once", "more"),
   so a row is two sets of cells, sent in blocks of 2 ** 20 cells as gaps and merged block by block. A cell never
   holds less than the segments that fall into it. A segment whose cells all say "more" may be repeated; all others are
   not. A second sketch, with other hashes, counts only what the first lets through, and lists crowded keys.
2. The segments that both let through meet by key, each as one row with six bytes a window, equal ones of a task as one row.
   Windows of a key are equal if their 48 bits are, so 112 bits decide. Windows of a crowded key are dealt one by one, each
   with a key of its own. A window that is alone is a false alarm of the sketches or of its gram, and its only place is known.
3. Each text takes the segments that may be repeated, without its false alarms, and drops the words their windows cover.

The merged sketches are the only thing that goes through the driver, with the crowded keys (one for ``CROWD`` segments at most). The size of
the sketches is fixed by ``depth`` and ``width_bits`` (3 * 2 ** 27 bits or 48 MB, and half of that for the second) and does not depend on the data.
When there are many more segments than cells the sketches let more through, up to everything. Even then, and where everything
is repeated, a window costs some eight bytes of shuffle, and texts are shuffled once if there are many false alarms. No repeat is lost at any size.

NULL and empty texts have no words. Texts with fewer words than a window lose none. Two equal rows are two places, so
their windows are repeated. Other columns are kept; one with the name of a result is replaced.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, fresh, portions, with_fields
from zonalis.sources.stage import staged

SIZE = 35
DEPTH, WIDTH_BITS = 3, 27
BLOCK_BITS = 20
TEXT_BYTES = 1 << 20  # texts are worked on in portions of this size
FLUSH = 1 << 21  # segments a task holds before it sends a part of its sketch, and windows before it sends their segments
RUN = 28  # windows in a segment; false alarms among them are the bits of a number
SENT = 1 << 16  # segments in a batch
BITS = 48  # of a window's hash, beside the key
CROWD_PART, CROWD = 64, 20_000  # a key of more segments than CROWD is dealt by window, if some part had CROWD_PART of them
BROADCAST_ALARMS = 1_000_000  # up to so many segments with false alarms (8 MB) are sent to all tasks, beyond that they are joined
U = np.uint64
MODULUS = 1 << 64
BASES = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))
STIRS = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53))


def stirred(x: np.ndarray, turn: int) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit; ``turn`` chooses one of several."""
    x = (x ^ (x >> U(30 + turn))) * STIRS[turn % 4]
    x = (x ^ (x >> U(27 + turn))) * STIRS[(turn + 1) % 4]
    return x ^ (x >> U(31))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one after the other, and where each text begins (and the last ends)."""
    split = [(t or b"").split() for t in texts]
    ends = np.cumsum([0, *map(len, split)])
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for ws in split for w in ws), U, int(ends[-1])), ends


def rolled(values: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every ``size`` consecutive values, by doubling: blocks of 1, 2, 4, ... are put together."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    block, width, factor, done, scale = values, 1, int(base), 0, 1
    while True:
        if size & width:
            out += U(scale) * block[done : done + n]
            scale = scale * factor % MODULUS
            done += width
        if done == size:
            return out
        block = block[:-width] + U(factor) * block[width:]
        factor = factor * factor % MODULUS
        width *= 2


def gram_size(size: int) -> int:
    return max(1, size // 4)


def least_grams(grams: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` consecutive grams the place of the one with the least hash, the leftmost of equal ones."""
    least = (grams & U(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=U)
    done = 1
    while done < width:
        step = min(done, width - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return (least & U(0xFFFFFFFF)).astype(np.int64)


@dataclass
class Segments:
    """Runs of windows of one text with the same least gram: key, word of the first window and number of windows.

    ``hashes`` are those of the words, ``ends`` tell where each text begins among them (and the last ends).
    """

    hashes: np.ndarray
    ends: np.ndarray
    key: np.ndarray
    begin: np.ndarray
    count: np.ndarray

    @staticmethod
    def of(texts: list[bytes | None], size: int) -> Segments:
        hashes, ends = word_hashes(texts)
        none = np.zeros(0, np.int64)
        n = len(hashes) - size + 1
        if n <= 0:
            return Segments(hashes, ends, np.zeros(0, U), none, none)
        gram = gram_size(size)
        grams = stirred(rolled(hashes, gram, BASES[0]), 0)
        left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(hashes))  # words from here to the end of the text
        inside = np.flatnonzero(left[:n] >= size)
        at = least_grams(grams, size - gram + 1)[inside]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        count = np.diff(first, append=len(at))
        if count.max(initial=0) > RUN:
            pieces = -(-count // RUN)
            piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, count = np.repeat(first, pieces) + RUN * piece, np.minimum(np.repeat(count, pieces) - RUN * piece, RUN)
        return Segments(hashes, ends, grams[at[first]], inside[first], count)

    def windows(self, which: np.ndarray) -> np.ndarray:
        """The words at which the windows of some segments begin."""
        return runs(self.begin[which], self.count[which])


def runs(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` rising numbers from each ``begin`` on, one after the other."""
    return np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)


def _cells(hashes: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    return (stirred(hashes, 3 + row) >> U(64 - width_bits)).astype(np.int64)


def packed(cells: np.ndarray) -> bytes:
    """Rising numbers as the gaps between them, a byte each; 255 adds 255 to the gap that the next byte ends."""
    gaps = np.diff(cells, prepend=0)
    ends = np.cumsum(gaps // 255 + 1) - 1
    out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 255, np.uint8)
    out[ends] = gaps % 255
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps < 255]


def _sketch_parts(hashes: np.ndarray, depth: int, width_bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Blocks of a sketch of these windows: number, cells counted, cells counted more than once."""
    block_bits = min(BLOCK_BITS, width_bits)
    cells = 1 << block_bits
    edges = np.arange(0, (1 << width_bits) + 1, cells)
    for row in range(depth):
        found = np.sort(_cells(hashes, row, width_bits))
        again = found[1:] == found[:-1]
        more = np.unique(found[1:][again])
        once = found[np.concatenate([[True], ~again])] if len(found) else found
        cuts, cuts_more = np.searchsorted(once, edges), np.searchsorted(more, edges)
        for b in np.flatnonzero(np.diff(cuts)):
            own = once[cuts[b] : cuts[b + 1]] - b * cells, more[cuts_more[b] : cuts_more[b + 1]] - b * cells
            yield (row << (width_bits - block_bits)) + int(b), *map(packed, own)


def _crowds(hashes: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Hashes that are many in this part and how many, in blocks below 0."""
    value, count = np.unique(hashes, return_counts=True)
    value, count = value[count >= CROWD_PART], count[count >= CROWD_PART]
    block = (value & U(63)).astype(np.int64)
    for b in np.unique(block).tolist():
        yield -1 - b, value[block == b].tobytes(), count[block == b].tobytes()


def _partial_sketches(size: int, sieve: Sieve) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        count = 0

        def part() -> Iterator[pa.RecordBatch]:
            hashes = np.concatenate(held)
            crowds = [] if sieve.before is None else _crowds(hashes)
            for number, once, more in itertools.chain(crowds, _sketch_parts(hashes, sieve.depth, sieve.width_bits)):
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([once]), pa.array([more])], ["block", "once", "more"])

        for batch in batches:
            for portion in portions(batch.column(0), TEXT_BYTES):
                key = Segments.of(portion, size).key
                held.append(key if sieve.before is None else other(key[sieve.before.suspects(key)]))
                count += len(held[-1])
                if count >= FLUSH:
                    yield from part()
                    held, count = [], 0
        if count:
            yield from part()

    return run


def _merge(width_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Parts of a block come one after the other; one block is held at a time. Blocks below 0 are counts of crowded hashes."""
    cells = 1 << min(BLOCK_BITS, width_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, more = None, np.zeros(cells, bool), np.zeros(cells, bool)
        crowds: Counter[int] = Counter()

        def out() -> pa.RecordBatch:
            bits = np.packbits(more, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([zlib.compress(bits, 1)])], ["block", "more"])

        for batch in batches:
            for number, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if number < 0:
                    for value, n in zip(np.frombuffer(a, U).tolist(), np.frombuffer(b, np.int64).tolist(), strict=True):
                        crowds[value] += n
                    continue
                if number != current:
                    if more.any():
                        yield out()
                    current = number
                    once[:], more[:] = False, False
                counted = unpacked(a)
                more[counted[once[counted]]] = True
                more[unpacked(b)] = True
                once[counted] = True
        if more.any():
            yield out()
        if crowded := [value for value, n in crowds.items() if n >= CROWD]:
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([np.array(crowded, U).tobytes()])], ["block", "more"])

    return run


@dataclass
class Sieve:
    """A merged sketch as the tasks see it: bit maps of the cells counted more than once, after an earlier sieve if any."""

    depth: int
    width_bits: int
    before: Sieve | None = None
    blocks: Broadcast | None = None

    def fill(self, df: DataFrame, text: str, size: int) -> Sieve:
        """Count the segments of all rows (that the earlier sieve lets through) and send the result to all tasks."""
        parts = df.select(col(text)).mapInArrow(_partial_sketches(size, self), "block long, once binary, more binary")
        merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(_merge(self.width_bits), "block long, more binary")
        # at most depth * 2 ** (width_bits - BLOCK_BITS) rows of 128 KB, whatever the input, and 8 bytes for CROWD segments
        table = np.zeros(max(1, self.depth << self.width_bits >> 3), np.uint8)
        crowded = np.zeros(0, U)
        for block, more in merged.collect():
            if block < 0:
                crowded = np.sort(np.concatenate([crowded, np.frombuffer(more, U)]))
            else:
                bits = np.frombuffer(zlib.decompress(more), np.uint8)
                table[block * len(bits) : (block + 1) * len(bits)] = bits
        # as tasks use them: no second copy in a worker
        return Sieve(self.depth, self.width_bits, self.before, df.sparkSession.sparkContext.broadcast((table, crowded)))

    def suspects(self, key: np.ndarray) -> np.ndarray:
        """Which segments all sketches count more than once."""
        which = np.arange(len(key)) if self.before is None else self.before.suspects(key)
        hashes = key if self.before is None else other(key)
        table = self.blocks.value[0]
        for row in range(self.depth):
            cell = _cells(hashes[which], row, self.width_bits) + (row << self.width_bits)
            which = which[(table[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1]
        return which

    def crowded(self, key: np.ndarray) -> np.ndarray:
        """Whether the second sketch met a key in very many segments."""
        return np.isin(other(key), self.blocks.value[1])


def other(key: np.ndarray) -> np.ndarray:
    """The keys as the second sketch hashes them."""
    return stirred(key, 7)


def _candidates(size: int, sieve: Sieve) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Segments that may be repeated, with 48 bits of each window; ``start`` is -1 where the task met an equal one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def part() -> Iterator[pa.RecordBatch]:
            key, place, check, start, counts, window = (np.concatenate(x) for x in zip(*held, strict=True))
            ends = np.cumsum(counts)
            # the first and the last window have all words of a segment
            whole = stirred(window[ends - counts], 1) + stirred(window[ends - 1], 3) + counts.astype(U)
            order = np.lexsort((whole, key))
            new = np.flatnonzero(np.concatenate([[True], (np.diff(key[order]) != 0) | (np.diff(whole[order]) != 0)]))
            one, several = order[new], np.diff(new, append=len(order)) > 1
            sizes = counts[one]
            data = window[runs((ends - counts)[one], sizes)].view(np.uint8).reshape(-1, 8)[:, : BITS // 8]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32) * (BITS // 8)
            packs = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
            columns = [pa.array(key[one].view(np.int64)), pa.array(place[one]), pa.array(check[one]), pa.array(np.where(several, -1, start[one]).astype(np.int32))]
            rows = pa.RecordBatch.from_arrays([*columns, packs], ["key", "place", "check", "start", "windows"])
            yield from (rows.slice(i, SENT) for i in range(0, len(one), SENT))

        for batch in batches:
            places, checks = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            row = 0
            for portion in portions(batch.column(0), TEXT_BYTES):
                found = Segments.of(portion, size)
                which = sieve.suspects(found.key)
                if len(which):
                    hashes = stirred(rolled(stirred(found.hashes, 1), size, BASES[1]), 2)
                    key, begin, counts = found.key[which], found.begin[which], found.count[which]
                    crowded = sieve.crowded(key)
                    pieces = np.where(crowded, counts, 1)
                    key, begin, counts, crowded = np.repeat(key, pieces), runs(begin, pieces), np.repeat(np.where(crowded, 1, counts), pieces), np.repeat(crowded, pieces)
                    key[crowded] = stirred(key[crowded] ^ hashes[begin[crowded]], 2)
                    owner = np.searchsorted(found.ends, begin, "right") - 1
                    held.append((key, places[owner + row], checks[owner + row], begin - found.ends[owner], counts, hashes[runs(begin, counts)]))
                    count += int(counts.sum())
                row += len(portion)
                if count >= FLUSH:
                    yield from part()
                    held, count = [], 0
        if count:
            yield from part()

    return run


def false_alarms(key: np.ndarray, start: np.ndarray, ends: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which segments have windows that no other segment of their key has, and the code of these: first word and bits.

    The rows of a key are one after the other; ``ends`` tells where the windows of each segment begin (and the last ends).
    """
    count = np.diff(ends)
    row = np.repeat(np.arange(len(key)), count)
    group = np.cumsum(np.diff(key, prepend=key[:1]) != 0)[row]
    order = np.lexsort((window, group))
    new = np.concatenate([[True], (np.diff(group[order]) != 0) | (np.diff(window[order]) != 0)])
    last = np.concatenate([new[1:], [True]])
    alone = order[new & last]
    alone = alone[start[row[alone]] >= 0]
    bits = np.bincount(row[alone], 2.0 ** (alone - ends[row[alone]]), len(key)).astype(np.int64)
    which = np.flatnonzero(bits)
    return which, start[which].astype(np.int64) << RUN | bits[which]


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments come key by key; of those with false alarms the place and the code go on."""
    held: list[pa.RecordBatch] = []

    def judged() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        key, place, check, start = (rows.column(c).to_numpy() for c in ("key", "place", "check", "start"))
        packs = rows.column("windows").cast(pa.binary()).chunk(0)
        bounds = np.frombuffer(packs.buffers()[1], np.int32)[packs.offset : packs.offset + len(packs) + 1].astype(np.int64)
        ends = (bounds - bounds[0]) // (BITS // 8)
        window = np.zeros((int(ends[-1]), 8), np.uint8)
        window[:, : BITS // 8] = np.frombuffer(packs.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].reshape(-1, BITS // 8)
        which, code = false_alarms(key, start, ends, window.view(U)[:, 0])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (place[which], check[which], code)], ["place", "check", "code"])

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        # the last key of a batch may go on in the next
        cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if cut:
            held.append(batch.slice(0, cut))
        if cut or (held and held[-1].column("key")[-1].as_py() != key[0]):
            yield judged()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield judged()


def _gone(found: Segments, which: np.ndarray, codes: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Which words are covered by the windows of some segments, without those that codes of some texts call false."""
    words = len(found.hashes)
    begins = np.zeros(words, bool)
    begins[found.windows(which)] = True
    code, bit = np.nonzero((codes[:, None] >> np.arange(RUN)) & 1)
    begins[found.ends[owner[code]] + (codes[code] >> RUN) + bit] = False
    before = np.concatenate([np.zeros(size, np.int64), np.cumsum(begins)])
    return before[size:] > before[:-size]


def _remover(size: int, sieve: Sieve) -> Callable[[Column, Column], Column]:
    @arrow_udf("struct<n_words:long,n_removed:long,kept:string>")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, alarms in batches:
            rows: list[tuple[int, int, str]] = []
            for portion in portions(texts, TEXT_BYTES):
                own = alarms.slice(len(rows), len(portion))
                owner = np.repeat(np.arange(len(portion)), pc.fill_null(pc.list_value_length(own), 0).to_numpy(zero_copy_only=False))
                found = Segments.of(portion, size)
                gone = _gone(found, sieve.suspects(found.key), own.flatten().to_numpy(zero_copy_only=False), owner, size)
                for text, a, b in zip(portion, found.ends[:-1].tolist(), found.ends[1:].tolist(), strict=True):
                    words = (text or b"").split()
                    removed = int(gone[a:b].sum())
                    kept = [w for w, g in zip(words, gone[a:b].tolist(), strict=True) if not g] if removed else words
                    rows.append((len(words), removed, b" ".join(kept).decode()))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            types = (pa.int64(), pa.int64(), pa.string())
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["n_words", "n_removed", "kept"])

    return run


def remove_repeats(df: DataFrame, text: str = "text", size: int = SIZE, depth: int = DEPTH, width_bits: int = WIDTH_BITS) -> DataFrame:
    """``df`` with ``n_words``, ``n_removed`` and ``kept``, the words that stay, joined by one space."""
    place = fresh(df.columns, "place")
    # a window that occurs once has one place, and equal texts have none, so 96 bits of the text name the place
    names = [place, f"{place}_check"]
    rows = df.withColumns({names[0]: F.xxhash64(col(text)), names[1]: F.hash(col(text))})
    sieve = Sieve(depth, width_bits).fill(df, text, size)
    sieve = Sieve(depth, width_bits - 1, sieve).fill(df, text, size)
    found = rows.select(col(text), *names).mapInArrow(_candidates(size, sieve), "key long, place long, check int, start int, windows binary")
    alarms = found.repartition("key").sortWithinPartitions("key").mapInArrow(_judge, "place long, check int, code long")
    of = [f"{place}_of", f"{place}_of_check"]
    false = alarms.groupBy(F.col("place").alias(of[0]), F.col("check").alias(of[1])).agg(F.collect_list("code").alias(f"{place}_false"))
    false = staged(false, "false_alarms")
    if (false.agg(F.sum(F.size(f"{place}_false"))).first()[0] or 0) <= BROADCAST_ALARMS:
        false = F.broadcast(false)
    joined = rows.join(false, [F.col(a) == F.col(b) for a, b in zip(names, of, strict=True)], "left")
    out = with_fields(joined, _remover(size, sieve)(col(text), F.col(f"{place}_false")), ["n_words", "n_removed", "kept"])
    return out.drop(*names, *of, f"{place}_false")
