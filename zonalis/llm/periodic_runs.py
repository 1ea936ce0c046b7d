"""Runs of words that repeat with a period, by seed and extend on diagonals.

Words are runs of anything but ASCII white space, numbered from 0. A run is a stretch of words with smallest period q
(words q apart are equal) that no neighbouring word extends, at least ``min_length`` words and ``exponent`` periods long.
Words q apart lie on the diagonal of lag q; a run is a stretch of matches there.

1. *Seeds.* A run of period q has max(min_length - q, (exponent - 1) * q) matches in a row. Lags are taken in classes
   [k / 2, k), the first one [1, k), where k is a power of two that this never falls below: k-grams of words are the index.
   Of the places of a k-gram in one text only neighbouring ones are paired. As k is larger than the lag, the next place of a
   gram inside a run is exactly one smallest period away, so no run loses its seed and none is found at a multiple of its
   period. A gram of 2k words can only recur where its first k do, so each class looks at what the last one left.
2. *Extension.* Seeds of a text are taken from left to right. A table holds, for each lag, how far matches have been
   followed; a seed before that place is known already. Others are extended both ways, word by word and in growing blocks.
   That also verifies them: ids of words, not hashes, are compared.

Every run costs its own length, so the work is n log n for n words, whatever the number of repetitions.

A word is dropped from ``collapsed`` if any run contains it after that run's first period. NULL and empty texts have no
words, no runs and an empty ``collapsed``; so has an empty table no rows. Overlapping runs are all returned, by start and then period.
Repeated rows are treated alike, each by itself. Other columns are kept; one with the name of a result is replaced. Texts
are worked on whole, in portions of about ``TEXT_BYTES``; a longer one is a portion of its own and takes some 40 bytes of
memory for each of its bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, portions, with_fields

MIN_LENGTH, EXPONENT = 24, 3
TEXT_BYTES = 1 << 20
FIRST_BLOCK = 64  # matches compared at once when a seed is extended; doubled from block to block
U = np.uint64
STIRS = (U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB))

Run = tuple[int, int, int]


def stirred(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = (x ^ (x >> U(30))) * STIRS[0]
    x = (x ^ (x >> U(27))) * STIRS[1]
    return x ^ (x >> U(31))


def first_gram(min_length: int, exponent: int) -> int:
    """Largest power of two that no run's number of matches falls below; lags up to it are one class."""
    overlap = min(max(min_length - q, (exponent - 1) * q) for q in range(1, min_length + 1))
    return 1 << overlap.bit_length() - 1


def word_numbers(texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, a number for each word (equal words, equal numbers), and where each text begins and the last ends."""
    split = [(t or b"").split() for t in texts]
    ends = np.cumsum([0, *map(len, split)])
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for ws in split for w in ws), np.int64, int(ends[-1]))
    return split, numbers, ends


def seeds(numbers: np.ndarray, ends: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags at which a gram recurs for the first time in its text, by class of lags."""
    n = len(numbers)
    sizes = np.diff(ends)
    owner = np.repeat(np.arange(len(sizes), dtype=U), sizes)
    left = np.repeat(ends[1:], sizes) - np.arange(n)
    # grams of 1, 2, 4, ... words; those of different texts differ
    named = stirred(stirred(numbers.astype(U) + U(1)) + stirred(owner + U(0x9E3779B97F4A7C15)))
    width = 1
    while width < min(gram, n):
        named[: n - width] = stirred(named[: n - width] * U(0xD6E8FEB86659FD93) + named[width:])
        width *= 2
    places, lags = [], []
    at = np.flatnonzero(left >= gram)
    low = 1
    while len(at):
        order = at[np.argsort(named[at], kind="stable")]
        same = named[order[1:]] == named[order[:-1]]
        lag = order[1:] - order[:-1]
        chosen = same & (lag >= low) & (lag < gram)
        places.append(order[:-1][chosen])
        lags.append(lag[chosen])
        again = np.zeros(len(order), bool)
        again[1:] |= same
        again[:-1] |= same
        at = np.sort(order[again])
        at = at[left[at] >= 2 * gram]
        named = named.copy()
        named[at] = stirred(named[at] * U(0xD6E8FEB86659FD93) + named[at + gram])
        low, gram = gram, 2 * gram
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(lags)


def matches_from(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal values from the front of two arrays of one length."""
    done, block = 0, FIRST_BLOCK
    while done < len(a):
        differ = a[done : done + block] != b[done : done + block]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done += len(differ)
        block *= 2
    return done


def runs_of(numbers: np.ndarray, ends: np.ndarray, min_length: int, exponent: int) -> list[list[Run]]:
    """``(start, length, period)`` of all runs of each text, by start and then period."""
    found: list[list[Run]] = [[] for _ in range(len(ends) - 1)]
    places, lags = seeds(numbers, ends, first_gram(min_length, exponent))
    # of seeds one after the other on a diagonal the first is enough
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    head = np.ones(len(places), bool)
    head[1:] = (np.diff(places) != 1) | (np.diff(lags) != 0)
    places, lags = places[head], lags[head]
    order = np.argsort(places, kind="stable")
    owners = np.searchsorted(ends, places[order], "right") - 1
    covered: dict[int, int] = {}  # lag to the place up to which its matches are known, in the text at hand
    text = -1
    for place, lag, owner in zip(places[order].tolist(), lags[order].tolist(), owners.tolist(), strict=True):
        if owner != text:
            text = owner
            covered.clear()
        if place < covered.get(lag, -1):
            continue
        begin, end = int(ends[owner]), int(ends[owner + 1])
        stop = place + matches_from(numbers[place : end - lag], numbers[place + lag : end])
        start = place - matches_from(numbers[begin:place][::-1], numbers[begin + lag : place + lag][::-1])
        covered[lag] = stop
        length = stop - start + lag
        if stop > start and length >= max(min_length, exponent * lag):
            found[owner].append((start - begin, length, lag))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without the repetitions of any run, joined by one space."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    gone = np.cumsum(steps[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def _finder(min_length: int, exponent: int) -> Callable[[Column], Column]:
    @arrow_udf("struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            counts: list[int] = []
            every: list[list[Run]] = []
            kept: list[str] = []
            for portion in portions(texts, TEXT_BYTES):
                split, numbers, ends = word_numbers(portion)
                runs = runs_of(numbers, ends, min_length, exponent)
                counts += map(len, split)
                every += runs
                kept += [collapsed(w, r).decode() for w, r in zip(split, runs, strict=True)]
            flat = np.array([r for runs in every for r in runs], np.int64).reshape(-1, 3)
            fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            offsets = pa.array(np.cumsum([0, *map(len, every)]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, fields)
            columns = [pa.array(counts, pa.int64()), lists, pa.array(kept, pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_words", "runs", "collapsed"])

    return run


def find_runs(df: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, exponent: int = EXPONENT) -> DataFrame:
    """``df`` with ``n_words``, ``runs`` (array of start, length, period, by start and period) and ``collapsed``."""
    if exponent < 3 or min_length < 2:
        raise ValueError("runs of three periods or more, and of two words or more, can be found")
    return with_fields(df, _finder(min_length, exponent)(col(text)), ["n_words", "runs", "collapsed"])


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first, then that of the smaller period."""
    empty = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    better = lambda a, r: a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"])
    return F.aggregate(runs, empty, lambda a, r: F.when(better(a, r), r).otherwise(a))
