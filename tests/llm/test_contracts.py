"""The ten queries and the pipeline over the smallest tables, against plain versions, SQL or held-out labels."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import SparkSession

import corpus_pipeline
from tests.compare import _rows, connection
from tests.llm import brute
from zonalis.llm import simhash
from zonalis.llm.queries import ORACLES, QUERIES, tokenizer

os.environ["TOKENIZERS_PARALLELISM"] = "false"
SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def table(name: str, folder: str = SMALL) -> list[tuple]:
    return duckdb.sql(f"select * from read_parquet('{folder}/{name}.parquet')").fetchall()


@pytest.fixture(scope="module")
def docs() -> brute.Docs:
    return [(r[0], r[1]) for r in table("documents")]


def result(spark: SparkSession, name: str, folder: str = SMALL) -> list[tuple]:
    return sorted(tuple(r) for r in QUERIES[name](spark, folder).collect())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark: SparkSession, name: str) -> None:
    df = QUERIES[name](spark, SMALL)
    sql = connection(SMALL).execute(ORACLES[name])
    names = [d[0] for d in sql.description]
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, sql.fetchall())


def test_toxicity_on_held_out_labels(spark: SparkSession) -> None:
    rows = {r[0]: r for r in result(spark, "op1_toxicity", MIDDLE)}
    assert len(rows) == len(table("documents", MIDDLE))
    held = [(bool(t), rows[k]) for k, _, t in table("labels", MIDDLE) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(r[1] for _, r in held) and all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in rows.values())
    assert sum(t == bool(r[3]) for t, r in held) >= 0.95 * len(held)


def test_quality_base_rules_and_held_out_labels(spark: SparkSession) -> None:
    rows = result(spark, "op2_quality_rules", MIDDLE)
    assert [r[:7] for r in rows] == sorted(brute.base_rules([(r[0], r[1]) for r in table("documents", MIDDLE)]))
    kept = {r[0]: r[7] for r in rows}
    assert not any(r[6] and r[7] for r in rows)
    failed = {r[0] for r in rows if r[6]}
    held = [(q, kept[k]) for k, q, _ in table("labels", MIDDLE) if zlib.crc32(str(k).encode()) % 5 == 0 and k not in failed]
    assert sum(q == k for q, k in held) >= 0.9 * len(held)


def test_bpe_and_counts_as_the_library(spark: SparkSession, docs: brute.Docs) -> None:
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer())
    coded = [(k, t or "", library.encode(t or "", add_special_tokens=False).ids) for k, t in docs]
    pack = lambda ids: hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
    expected = sorted((k, len(ids), pack(ids), brute.sha(library.decode(ids, skip_special_tokens=False))) for k, _, ids in coded)
    assert result(spark, "op3_bpe") == expected
    assert result(spark, "op9_token_counts") == sorted((k, len(t.encode()), len(ids), len(ids) > 1024) for k, t, ids in coded)


def test_leaks_as_all_windows(spark: SparkSession, docs: brute.Docs) -> None:
    expected = brute.leaks(docs, [(r[0], r[1]) for r in table("benchmark")])
    found = {(r[0], r[1]): r[2] for r in result(spark, "op5_decontamination")}
    assert expected and found == pytest.approx(expected)


def test_repeats_as_a_counter(spark: SparkSession, docs: brute.Docs) -> None:
    expected = sorted((k, n, g, brute.sha(t)) for k, n, g, t in brute.without_repeats(docs, 35))
    assert result(spark, "op7_substring_dedup") == expected


def test_shards_are_even_and_gapless(spark: SparkSession, docs: brute.Docs) -> None:
    rows = result(spark, "op8_sharding")
    raw = {k: (t or "").encode() for k, t in docs}
    assert [(r[0], r[1], r[2]) for r in rows] == sorted((k, len(t) + 1, zlib.crc32(t)) for k, t in raw.items())
    sizes = Counter(r[4] for r in rows)
    assert max(sizes.values()) - min(sizes[s] for s in range(16)) <= 1
    assert all(sorted(r[5] for r in rows if r[4] == s) == list(range(n)) for s, n in sizes.items())
    assert rows == result(spark, "op8_sharding")
    assert {r[3] for r in rows} == {"rows"} and {r[6] for r in rows} == {None}


def test_fingerprints_and_components(spark: SparkSession, docs: brute.Docs) -> None:
    ordered = sorted(docs)
    prints = [brute.fingerprint(t, 4) for _, t in ordered]
    first = brute.linked(prints, 4)
    expected = sorted((k, f"{p:016x}", ordered[i][0]) for (k, _), p, i in zip(ordered, prints, first, strict=True))
    assert result(spark, "op10_simhash") == expected


def test_pipeline_against_plain_stages(spark: SparkSession) -> None:
    """Each stage's decisions, from its own input; the digests of the last one from the library."""
    from tokenizers import Tokenizer

    kept = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = kept.columns
    before = {r["doc_id"]: r["text"] for r in kept.collect()}

    def apply(name: str) -> dict[int, str]:
        nonlocal kept
        kept = spark.createDataFrame(stages[name](spark, kept, SMALL).toPandas(), kept.schema)
        assert kept.columns == columns
        return {r["doc_id"]: r["text"] for r in kept.collect()}

    after = apply("toxicity")
    assert after.keys() < before.keys() and all(before[k] == t for k, t in after.items())
    toxic = {k for k, _, t in table("labels") if t}
    assert len(toxic & after.keys()) <= 0.2 * len(toxic)
    assert len({k for k, _, t in table("labels") if not t} & after.keys()) >= 0.98 * len({k for k, _, t in table("labels") if not t})

    before, after = after, apply("line_dedup")
    assert sorted(after.items()) == [(k, t) for k, _, _, t in brute.runs_removed(sorted(before.items()))]

    before, after = after, apply("simhash_near_dedup")
    ordered = sorted(before.items())
    first = brute.linked([brute.fingerprint(t, 4) for _, t in ordered], 4)
    assert after == {ordered[i][0]: ordered[i][1] for i in set(first)}

    before, after = after, apply("benchmark_decontamination")
    bad = {k for k, _ in brute.leaks(list(before.items()), [(r[0], r[1]) for r in table("benchmark")])}
    assert bad and after == {k: t for k, t in before.items() if k not in bad}

    library = Tokenizer.from_str(tokenizer())
    rows = {r["doc_id"]: r for r in stages["bpe"](spark, kept, SMALL).collect()}
    assert rows.keys() == after.keys()
    for k, t in after.items():
        assert rows[k]["ids"] == library.encode(t, add_special_tokens=False).ids and rows[k]["decoded_sha256"] == brute.sha(t)
    whole = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"]: r["ids_sha256"] for r in whole.collect()} == {k: r["ids_sha256"] for k, r in rows.items()}


def test_no_operator_needs_python_where_none_is_wanted(spark: SparkSession) -> None:
    for name in ("op4_chat_perspectives", "op5_decontamination", "op6_line_dedup"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin")), name


def test_simhash_defaults_are_the_contract() -> None:
    assert simhash.near_duplicates.__defaults__[:2] == (4, 4)
