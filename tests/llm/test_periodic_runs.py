"""Runs of operator 11 against a plain search of every lag, and the query over the smallest tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from zonalis.llm import periodic_runs
from zonalis.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
Run = tuple[int, int, int]


def plain_runs(words: list, least: int = 24, exponent: int = 3) -> list[Run]:
    found = []
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            own = words[i : i + length]
            if j > i and length >= max(least, exponent * q) and not any(own[d:] == own[:-d] for d in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def without(words: list, runs: list[Run]) -> list:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def made_text(rng: random.Random) -> str:
    out: list[str] = []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.5:
            block = [rng.choice("ab" if rng.random() < 0.5 else "abcdefgh") for _ in range(rng.randint(1, 30))]
            if rng.random() < 0.3:
                block = block * rng.randint(1, 3) + ["z"]
            out += block * rng.randint(1, 9)
        else:
            out += [rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 40))]
    return " ".join(out)


@pytest.mark.parametrize(("least", "exponent"), [(24, 3), (6, 3), (10, 4), (2, 3)])
def test_runs_as_every_lag(least: int, exponent: int) -> None:
    rng = random.Random(least)
    some = 0
    for _ in range(150):
        texts = [made_text(rng).encode() for _ in range(rng.randint(0, 4))]
        split, numbers, ends = periodic_runs.word_numbers(texts)
        found = periodic_runs.runs_of(numbers, ends, least, exponent)
        assert found == [plain_runs(w, least, exponent) for w in split]
        some += sum(map(len, found))
    assert some > 50


def test_a_word_repeated_very_often_is_one_extension(monkeypatch: pytest.MonkeyPatch) -> None:
    calls: list[int] = []
    plain = periodic_runs.matches_from
    monkeypatch.setattr(periodic_runs, "matches_from", lambda a, b: calls.append(len(a)) or plain(a, b))
    _, numbers, ends = periodic_runs.word_numbers([b"x " * 200_000 + b"y " + b"a b c " * 100_000])
    assert periodic_runs.runs_of(numbers, ends, 24, 3) == [[(0, 200_000, 1), (200_001, 300_000, 3)]]
    assert len(calls) == 4


def test_query_against_plain_search(spark: SparkSession) -> None:
    expected = []
    for key, text in duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall():
        words = (text or "").encode().split()
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        _, numbers, ends = periodic_runs.word_numbers([b" ".join(words)])
        runs = plain_runs(numbers.tolist()) if n < 4000 else periodic_runs.runs_of(numbers, ends, 24, 3)[0]
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        kept = b" ".join(without(words, runs))
        strong = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        expected.append((key, len(runs), *strong, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    found = sorted(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect())
    assert found == sorted(expected)
    assert sum(r[1] > 0 for r in found) > 10


def test_nulls_ties_repeats_clashes_and_empty_tables(spark: SparkSession) -> None:
    rows = [
        (1, None, "a"),
        (None, "", "b"),
        (2, " \t\n\x0b\x0c\r ", "c"),
        (3, "x " * 24, "d"),
        (3, "x " * 24, "d"),
        (4, "x " * 23, "e"),
        (5, "u v " * 12 + "end " + "p q " * 12, None),
        (6, "ä\xa0b c " * 8, "f"),
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string, Runs string").withColumn("result.x", F.lit(1))
    out = periodic_runs.find_runs(df)
    assert out.columns == ["doc_id", "text", "result.x", "n_words", "runs", "collapsed"]
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()]
    two = (5, 49, [(0, 24, 2), (25, 24, 2)], "u v end p q")
    assert found == [
        (1, 0, [], ""),
        (None, 0, [], ""),
        (2, 0, [], ""),
        (3, 24, [(0, 24, 1)], "x"),
        (3, 24, [(0, 24, 1)], "x"),
        (4, 23, [], " ".join("x" * 23)),
        two,
        (6, 16, [], " ".join(["ä\xa0b", "c"] * 8)),
    ]
    best = out.where("doc_id = 5").select(periodic_runs.strongest(F.col("runs")).alias("r")).first()["r"]
    assert tuple(best) == (0, 24, 2)
    assert periodic_runs.find_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.find_runs(df, exponent=2)
