"""Operator 13 against a counter of all windows: collections by themselves, random tables, and the query over the smallest tables."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import SparkSession

from zonalis.llm import suffix_dedup
from zonalis.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plain(texts: list[bytes], size: int) -> list[tuple[int, int, int, bytes]]:
    """(bytes, removed, spans, kept) after removal of repeated windows."""
    times = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t) + 1)
        for i in range(len(t) - size + 1):
            if times[t[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = sum(gone[i] and not gone[i - 1] for i in range(len(t)))
        out.append((len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone, strict=False) if not g)))
    return out


def made_texts(rng: random.Random, count: int, letters: str) -> list[str]:
    shared = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(4)]
    texts = []
    for _ in range(count):
        parts = [rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 5))]
        texts.append("".join(parts))
    return texts


def test_collections_as_all_pairs(tmp_path: object) -> None:
    rng = random.Random(1)
    size, reach = 6, 4
    for _ in range(100):
        group = np.sort([rng.randint(0, 3) for _ in range(rng.randint(1, 12))])
        lead = np.array([rng.randint(0, reach) for _ in group])
        fragments = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, d) + size)) for d in lead.tolist()]
        twice = np.array([rng.random() < 0.2 for _ in group])
        found = suffix_dedup.repeated(fragments, lead, group, twice, size, reach, str(tmp_path))
        windows = Counter()
        for f, d, g, t in zip(fragments, lead.tolist(), group.tolist(), twice.tolist(), strict=True):
            windows.update({(g, reach - d + i, f[i : i + size]): 1 + t for i in range(len(f) - size + 1)})
        for row, (f, d, g) in enumerate(zip(fragments, lead.tolist(), group.tolist(), strict=True)):
            expected = {reach - d + i for i in range(len(f) - size + 1) if windows[g, reach - d + i, f[i : i + size]] > 1}
            assert set(np.flatnonzero(found[row]).tolist()) == expected


@pytest.mark.parametrize(("part", "rows"), [(512, 300_000), (1, 0)])
def test_random_tables(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, part: int, rows: int) -> None:
    """With one length of anchors or all of them, and with joins by broadcast or by shuffle."""
    monkeypatch.setattr(suffix_dedup, "PART", part)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", rows)
    rng = random.Random(part)
    for letters, size, grams in (("ab", 12, (3, 8)), ("abcdeé", 20, (5, 15, 19)), ("a", 5, ()), ("abcdefgh", 9, (1, 6))):
        texts = made_texts(rng, 40, letters)
        texts += texts[:5]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
        found = sorted(tuple(r) for r in suffix_dedup.remove_repeats(df, size=size, grams=grams).drop("text").collect())
        expected = [(i, *e) for i, e in enumerate(plain([t.encode() for t in texts], size))]
        assert [(*r[:4], bytes(r[4])) for r in found] == expected
        assert any(r[2] for r in found)


def test_long_texts_are_cut_in_parts_without_a_gap(monkeypatch: pytest.MonkeyPatch) -> None:
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "CHUNK", 50)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc") for _ in range(n)) for n in (400, 3, 55, 0, 49, 20, 50)]
    columns = [pa.array([t.encode() for t in texts]), *[pa.array(range(7), pa.int64())] * 3]
    batch = pa.RecordBatch.from_arrays(columns, ["raw", "k1", "k2", "n"])
    seen = Counter()
    by_print: dict[tuple, bytes] = {}
    for out in suffix_dedup._cutter(20, 5)(iter([batch])):
        for r in out.to_pylist():
            raw = texts[r["k1"]].encode()[r["start"] : r["start"] + r["count"] - 1 + 20]
            assert len(raw) == r["count"] + 19 and r["lead"] <= 15
            assert by_print.setdefault((r["f1"], r["f2"]), raw) == raw
            seen.update((r["k1"], r["start"] + i) for i in range(r["count"]))
    assert seen == Counter((k, i) for k, t in enumerate(texts) for i in range(len(t) - 19))


def test_tasks_that_hold_few_fragments_at_a_time(monkeypatch: pytest.MonkeyPatch) -> None:
    import pyarrow as pa

    rng = random.Random(5)
    rows = []
    for anchor in range(30):
        for _ in range(rng.randint(1, 7)):
            lead = rng.randint(0, 3)
            raw = bytes(rng.choice(b"ab") for _ in range(lead + 5))
            rows.append({"anchor": anchor, "f1": len(rows), "f2": 0, "lead": lead, "twice": False, "bytes": raw})
    types = [("anchor", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("lead", pa.int32()), ("twice", pa.bool_()), ("bytes", pa.binary())]
    batches = [pa.RecordBatch.from_pylist(rows[i : i + 4], pa.schema(types)) for i in range(0, len(rows), 4)]

    def result() -> list:
        return sorted((tuple(r.values()) for b in suffix_dedup._judge(5, 2)(iter(batches)) for r in b.to_pylist()), key=str)

    whole = result()
    monkeypatch.setattr(suffix_dedup, "FRAGMENTS", 3)
    assert result() == whole and len(whole) > 10


def test_query_against_a_counter(spark: SparkSession) -> None:
    docs = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    expected = plain([(t or "").encode() for _, t in docs], 400)
    wanted = sorted((k, n, g, s, hashlib.sha256(t).hexdigest()) for (k, _), (n, g, s, t) in zip(docs, expected, strict=True))
    found = sorted(tuple(r) for r in QUERIES["op13_suffix_dedup"](spark, SMALL).collect())
    assert found == wanted and sum(r[2] > 0 for r in found) > 10


def test_nulls_repeats_clashes_and_empty_tables(spark: SparkSession) -> None:
    rows = [(1, None, 1), (None, "", 2), (2, "short", 3), (3, "x" * 12, 4), (4, "abcdefghijkl", 5), (4, "abcdefghijkl", 5), (5, "éabcdefghij", None)]
    df = spark.createDataFrame(rows, "doc_id int, text string, k1 int")
    out = suffix_dedup.remove_repeats(df, size=10, grams=(3,))
    assert out.columns == ["doc_id", "text", "k1", "n_bytes", "n_removed", "n_spans", "kept"]
    found = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()), key=str)
    expected = [(1, 0, 0, 0, b""), (None, 0, 0, 0, b""), (2, 5, 0, 0, b"short"), (3, 12, 12, 1, b""), (4, 12, 12, 1, b""), (4, 12, 12, 1, b""), (5, 12, 10, 1, "é".encode())]
    assert found == sorted(expected, key=str)
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []
    clash = df.withColumnRenamed("k1", "n_bytes").withColumnRenamed("doc_id", "anchor")
    assert suffix_dedup.remove_repeats(clash, size=10, grams=(3,)).columns == ["anchor", "text", "n_bytes", "n_removed", "n_spans", "kept"]
