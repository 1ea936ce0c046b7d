"""Operator 7: what its exact pass shuffles, its segments, and the ways windows meet. Results are compared in test_edges and test_contracts, too."""

from __future__ import annotations

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

from tests.llm import brute
from zonalis.llm import substring_dedup
from zonalis.llm.substring_dedup import Segments

SCHEMA = "doc_id long, text string"


def texts_of(rng: random.Random, count: int, most: int, letters: str = "abcdefgh") -> list[str]:
    passages = [" ".join(rng.choices(letters, k=120)) for _ in range(3)]
    out = []
    for _ in range(count):
        text = " ".join(rng.choices(letters, k=rng.randint(0, most)))
        out.append(" ".join([text, rng.choice(passages), text[:7]]) if rng.random() < 0.4 else text)
    return out


def removed(spark: SparkSession, rows: brute.Docs, **more: int) -> list[tuple]:
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), **more)
    return sorted(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept").collect())


def test_windows_that_pass_the_sketches_are_sent_together() -> None:
    rng = random.Random(1)
    texts = [" ".join(str(rng.getrandbits(40)) for _ in range(534)) for _ in range(200)]
    given = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(200), pa.int64()), pa.array(range(200), pa.int32())], ["text", "place", "check"])
    # full sketches, as over many more segments than cells: they let everything through
    full = SimpleNamespace(suspects=lambda key, *_: np.arange(len(key)), crowded=lambda key: np.zeros(len(key), bool))
    sent = sum(b.nbytes for b in substring_dedup._candidates(35, full)(iter([given])))
    assert 6 * 100_000 < sent < 9 * 100_000


@pytest.mark.parametrize("size", [1, 2, 35, 90])
@pytest.mark.parametrize("alarms", [0, 1_000_000])
def test_as_a_counter(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, size: int, alarms: int) -> None:
    monkeypatch.setattr(substring_dedup, "BROADCAST_ALARMS", alarms)
    rng = random.Random(size)
    rows: brute.Docs = list(enumerate(texts_of(rng, 60, 200) + ["w " * 300, "v " * (size - 1) + "v", None, ""]))
    rows += [(100, rows[0][1]), (None, rows[1][1]), (101, "one " + " ".join(map(str, range(200)))), (102, "two " + " ".join(map(str, range(200))))]
    expected = sorted(((-1 if k is None else k), n, g, t) for k, n, g, t in brute.without_repeats(rows, size))
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA), size=size, width_bits=12)
    found = sorted(((-1 if r[0] is None else r[0]), *r[1:]) for r in out.select("doc_id", "n_words", "n_removed", "kept").collect())
    assert found == expected and any(r[2] for r in found)


def test_equal_windows_have_equal_segments_keys() -> None:
    rng = random.Random(3)
    texts = [t.encode() for t in texts_of(rng, 40, 80, "abc")]
    for size in (1, 4, 9, 35, 90):
        found = Segments.of(texts, size)
        split = [t.split() for t in texts]
        assert found.windows(np.arange(len(found.key))).tolist() == [found.ends[i] + j for i, w in enumerate(split) for j in range(len(w) - size + 1)]
        assert found.count.max() <= substring_dedup.RUN
        every = [w for words in split for w in words]
        keys: dict[tuple, int] = {}
        for key, begin, count in zip(found.key.tolist(), found.begin.tolist(), found.count.tolist(), strict=True):
            for i in range(begin, begin + count):
                assert keys.setdefault(tuple(every[i : i + size]), key) == key


@pytest.mark.parametrize("crowded", [False, True])
@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_false_alarms_are_the_windows_that_occur_once(crowded: bool, batch: int) -> None:
    """Also with crowded keys, whose windows are dealt one by one, and with keys that go on over several batches."""
    rng = random.Random(4)
    texts, size = texts_of(rng, 30, 60, "ab") + ["x y z", None], 8
    sieve = SimpleNamespace(suspects=lambda key: np.arange(len(key)), crowded=lambda key: np.full(len(key), crowded))
    tasks = [texts[:12], texts[12:]]
    rows = []
    for t, task in enumerate(tasks):
        places = pa.array(range(12 * t, 12 * t + len(task)), pa.int64())
        given = pa.RecordBatch.from_arrays([pa.array(task), places, places.cast(pa.int32())], ["text", "place", "check"])
        rows += list(substring_dedup._candidates(size, sieve)(iter([given])))
    if crowded:
        assert {len(w) for b in rows for w in b.column("windows").to_pylist()} == {substring_dedup.BITS // 8}
    together = pa.Table.from_batches(rows).sort_by("key")
    judged = substring_dedup._judge(iter(together.to_batches(max_chunksize=batch)))
    found = Counter()
    for r in (r for b in judged for r in b.to_pylist()):
        assert r["place"] == r["check"]
        found.update((r["place"], (r["code"] >> substring_dedup.RUN) + i) for i in range(substring_dedup.RUN) if r["code"] >> i & 1)
    words = [brute.words(t) for t in texts]
    times = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    assert found == Counter((p, i) for p, w in enumerate(words) for i in range(len(w) - size + 1) if times[tuple(w[i : i + size])] == 1)


def test_crowded_keys_are_those_of_many_segments() -> None:
    many, few = 2**63 + 5, 7
    part = np.array([many] * 300 + [few] * 70 + list(range(1000, 1100)), np.uint64)
    parts = list(substring_dedup._crowds(part))
    assert {v for _, a, _ in parts for v in np.frombuffer(a, np.uint64).tolist()} == {many, few}
    rows = sorted(parts * (1 + substring_dedup.CROWD // 300), key=lambda r: r[0])
    given = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["block", "once", "more"])
    (out,) = substring_dedup._merge(10)(iter([given]))
    assert out.column("block").to_pylist() == [-1] and np.frombuffer(out.column("more")[0].as_py(), np.uint64).tolist() == [many]


def test_a_line_that_most_texts_hold(spark: SparkSession) -> None:
    """Its grams are crowded keys; around it texts differ, but for some that come twice."""
    rng = random.Random(5)
    line = " ".join(f"line{i}" for i in range(12))
    rest = lambda: " ".join(str(rng.getrandbits(30)) for _ in range(12))
    rows: brute.Docs = [(i, f"{rest()} {line} {rest()}") for i in range(40_000)]
    rows += [(50_000 + i, text if i % 2 else f"{text} {rest()}") for i, (_, text) in enumerate(rows[:300])]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8).localCheckpoint()
    sieve = substring_dedup.Sieve(3, 22).fill(docs, "text", 16)
    sieve = substring_dedup.Sieve(3, 21, sieve).fill(docs, "text", 16)
    assert len(sieve.blocks.value[1])
    out = substring_dedup.remove_repeats(docs, size=16, width_bits=22)
    assert sorted(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept").collect()) == brute.without_repeats(rows, 16)
