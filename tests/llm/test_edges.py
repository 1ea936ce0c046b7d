"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from zonalis.llm import bpe, chat, decontamination, line_dedup, quality_rules, sharding, simhash, substring_dedup, token_counts, toxicity
from zonalis.llm.queries import tokenizer

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, result string, fp long, place long, "
    "ids string, id long, row long, gone int, n_words int, n_lines string, kept int, window int, root int, `a.b` string, "
    "component_id string, slot string, _id int, _toxic int, label int, shingles int, row_key int, leak_id int"
)
LONG = " ".join(random.Random(1).choices(["alpha", "beta", "gamma", "delta", "εψιλον", "<|endoftext|>", "it's", "2024", "\n", "\t \n"], k=12_000))
PASSAGE = " ".join(f"unique{i}" for i in range(60))
LINES = "\n".join(f"line number {i} of a shared run" for i in range(5))
TEXTS = [
    (None, None),
    (None, "no id here at all"),
    (1, None),
    (2, ""),
    (3, " \t\n\r\x0b\x0c "),
    (4, "One"),
    (4, "One"),
    (5, "one"),
    (5, "another text with the same id"),
    (6, LONG),
    (7, "x" * 100_000),
    (8, "before " + PASSAGE + " after"),
    (9, PASSAGE),
    (10, PASSAGE + " " + PASSAGE),
    (11, LINES + "\n\nend"),
    (12, "start\n" + LINES),
    (12, "start\n" + LINES),
    (13, "a b c \U0001f600 <|endoftext|> \u0000 \x1c\x85 é"),
    (14, "!!! ### $$$ %%% &&& ||| <<< >>> " * 20),
]


@pytest.fixture(scope="module")
def docs(spark: SparkSession) -> DataFrame:
    rows = [(k, t, None, "s", len(t or ""), *[None] * 22) for k, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).checkpoint()


@pytest.fixture(scope="module")
def none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession, rows: list[tuple] = ()) -> DataFrame:
    return spark.createDataFrame([(None, None, None), (4, None, None), (4, 1, 0), (4, 1, 0), (99, 0, 1), *rows], "doc_id long, quality int, toxic int")


def pairs(df: DataFrame, *names: str) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def ordered(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_toxicity(spark: SparkSession, docs: DataFrame, none: DataFrame) -> None:
    model = toxicity.train(docs, labels(spark))
    out = toxicity.score(docs, model)
    assert out.count() == len(TEXTS) and out.where("score is null or predicted is null").isEmpty()
    assert {r["score"] for r in out.collect()} == {0.0}  # no labels of both kinds
    real = toxicity.score(docs, toxicity.Model({"scum": 5.0}, (-3.0, *[1.0] * toxicity.FEATURES)))
    assert real.where("score is null").isEmpty() and real.count() == len(TEXTS)
    assert toxicity.score(none, toxicity.train(none, labels(spark).limit(0))).isEmpty()


def test_quality_rules(spark: SparkSession, docs: DataFrame, none: DataFrame) -> None:
    rules = quality_rules.fit(quality_rules.with_counts(docs), labels(spark))
    out = quality_rules.judge(docs, rules)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert pairs(out, *names) == ordered(brute.base_rules(TEXTS))
    assert out.where("kept is null").isEmpty() and rules == []
    assert quality_rules.judge(none, quality_rules.fit(quality_rules.with_counts(none), labels(spark))).isEmpty()


def test_bpe_and_counts(spark: SparkSession, docs: DataFrame, none: DataFrame) -> None:
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(tokenizer())
    out = bpe.decode(bpe.encode(docs, tokenizer()), tokenizer())
    expected = [(k, library.encode(t or "", add_special_tokens=False).ids, t or "") for k, t in TEXTS]
    assert pairs(out, "doc_id", "ids", "decoded") == ordered(expected)
    counts = token_counts.token_counts(docs, tokenizer())
    assert pairs(counts, "doc_id", "n_bytes", "n_tokens") == ordered([(k, len(t.encode()), len(ids)) for k, ids, t in expected])
    assert bpe.decode(bpe.encode(none, tokenizer()), tokenizer()).isEmpty() and token_counts.token_counts(none, tokenizer()).isEmpty()
    null = spark.createDataFrame([(None,)], "ids array<int>")
    assert bpe.decode(null, tokenizer()).first()["decoded"] == ""
    both = bpe.round_trip(docs.withColumn("IDS", F.lit("taken")), tokenizer())
    new = ["ids", "ids_sha256", "decoded"]
    assert both.columns == [*(c for c in docs.columns if c.lower() not in new), *new]
    together = [(r["ids"], r["decoded"], r["ids_sha256"]) for r in both.collect()]
    apart = out.withColumn("digest", bpe.ids_sha256(F.col("ids"))).collect()
    assert sorted(together) == sorted((r["ids"], r["decoded"], r["digest"]) for r in apart)
    assert bpe.round_trip(none, tokenizer()).isEmpty()


def test_chat(spark: SparkSession) -> None:
    schema = "conv_id long, turn long, role string, text string, speaker string, part int, said string, n int"
    rows = [
        (1, 0, "system", "Be kind."),
        (1, 1, "ann", "Hi <|assistant|>"),
        (1, 2, "bob", None),
        (1, 2, "bob", None),
        (1, 3, None, "who?"),
        (None, None, "ann", "lost"),
        (2, 0, "system", "alone"),
        *[(3, 5, "ann", f"same turn {i}") for i in range(200)],
        *[(3, 100 + i, "bob", "x" * 50) for i in range(100)],
    ]
    df = spark.createDataFrame([(*r, "a", 1, "b", 2) for r in rows], schema)
    out = [r.asDict() for r in chat.rotate(df).collect()]
    assert {r["conv_id"] for r in out} == {None, 1, 3}
    one = {r["speaker"]: r for r in out if r["conv_id"] == 1}
    assert one.keys() == {"ann", "bob", "unknown"}
    assert one["ann"]["text"] == "<|system|>\nBe kind.\n<|assistant|>\nHi < |assistant|>\n<|user:bob|>\n\n<|user:unknown|>\nwho?\n"
    for r in out:
        said = [r["text"][m["start"] : m["stop"]] for m in r["mask"]]
        assert all(r["text"][: m["start"]].endswith("<|assistant|>\n") for m in r["mask"])
        assert said.count("lost") == (r["conv_id"] is None)
    three = [r for r in out if r["conv_id"] == 3 and r["speaker"] == "ann"]
    assert sum(r["n_turns"] for r in three) == 300 and sum(len(r["mask"]) for r in three) == 200
    assert max(r["n_turns"] for r in three) < 200  # a crowded turn is dealt to several parts
    assert chat.rotate(df.limit(0)).isEmpty()


def test_decontamination(spark: SparkSession, docs: DataFrame, none: DataFrame) -> None:
    items = [(1, PASSAGE), (1, PASSAGE), (2, None), (3, ""), (4, "one"), (None, "another TEXT with the same id"), (5, " ".join(PASSAGE.split()[:40] + ["new"] * 3))]
    bench = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, row int, length int")
    found = {(r["id"], r["item"]): r["similarity"] for r in decontamination.matches(docs, bench).collect()}
    assert found == pytest.approx(brute.leaks(TEXTS, items)) and len(found) >= 7
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert pairs(kept, "doc_id", "text") == ordered([(k, t) for k, t in TEXTS if not brute.leaks([(k, t)], items)])
    assert decontamination.decontaminate(docs, bench.limit(0)).count() == len(TEXTS)
    assert decontamination.matches(none, bench).isEmpty()


def test_line_dedup(spark: SparkSession, docs: DataFrame, none: DataFrame) -> None:
    out = line_dedup.dedup_lines(docs)
    first = {r["doc_id"]: r["text"] for r in out.where("doc_id > 10 and doc_id < 13").collect()}
    assert first == {11: LINES + "\n\nend", 12: "start"}
    assert out.count() == len(TEXTS)
    assert {r["doc_id"] for r in out.where("n_removed > 0").collect()} <= {6, 12}  # the long text repeats itself
    texts = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert {(k, t) for k, t in TEXTS if k not in (6, 12)} <= texts
    assert line_dedup.dedup_lines(none).isEmpty()


@pytest.mark.parametrize("lines,words", [(1, 99), (3, 99), (6, 99), (3, 2), (3, 3), (5, 4), (4, 1)])
def test_line_dedup_on_random_lines(spark: SparkSession, lines: int, words: int) -> None:
    rng = random.Random(lines * 100 + words)
    rows = [(i, "\n".join(rng.choices(["a", "b", "c", "d d", "e e e", "f f f f", " ", ""], k=rng.randint(0, 25)))) for i in range(60)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), lines=lines, words=words)
    expected = brute.runs_removed(rows, lines, words)
    assert sorted(tuple(r) for r in out.select("doc_id", "n_lines", "n_removed", "text").collect()) == expected


def test_long_repeated_lines_and_maximal_matches(spark: SparkSession) -> None:
    long = " ".join(f"w{i}" for i in range(50))
    short = " ".join(f"s{i}" for i in range(49))
    both = [" ".join(f"{c}{i}" for i in range(25)) for c in "xy"]
    tail = [f"line {i}" for i in range(7)]
    first = [long, "own", short, "more", *both, "tiny", "between", *tail]
    texts = ["\n".join(first), "\n".join(["new", long, "text", short, "and", *both, "tiny", "other", "", *tail, "end"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert out == {0: texts[0], 1: "\n".join(["new", "text", short, "and", "other", "", "end"])}
    found = line_dedup.matches(df).collect()
    assert [r["id"] for r in found] == [1]
    assert [(m["start"], m["stop"], m["of_id"], m["lag"]) for m in found[0]["matches"]] == [(1, 1, 0, 1), (5, 7, 0, 1), (9, 15, 0, 1)]


def test_substring_dedup(docs: DataFrame, none: DataFrame) -> None:
    out = substring_dedup.remove_repeats(docs, size=6, width_bits=10)
    assert pairs(out, "doc_id", "n_words", "n_removed", "kept") == ordered(brute.without_repeats(TEXTS, 6))
    assert substring_dedup.remove_repeats(none).isEmpty()


@pytest.mark.parametrize("width_bits,depth", [(4, 1), (8, 2), (14, 3)])
def test_a_small_sketch_loses_nothing(spark: SparkSession, width_bits: int, depth: int) -> None:
    rng = random.Random(width_bits)
    rows = [(i, " ".join(rng.choices("abcd", k=rng.randint(0, 60)))) for i in range(150)]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), size=7, depth=depth, width_bits=width_bits)
    assert sorted(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept").collect()) == brute.without_repeats(rows, 7)


def test_sharding(spark: SparkSession, docs: DataFrame, none: DataFrame) -> None:
    out = sharding.shard(docs, n_shards=4)
    rows = out.collect()
    assert len(rows) == len(TEXTS)
    assert ordered([(r["doc_id"], r["size"]) for r in rows]) == ordered([(k, len((t or "").encode()) + 1) for k, t in TEXTS])
    assert sorted((r["shard"], r["slot"]) for r in rows) == sorted((i % 4, i // 4) for i in range(len(TEXTS)))
    assert sharding.shard(none).isEmpty()


def test_simhash(spark: SparkSession, docs: DataFrame, none: DataFrame) -> None:
    out = simhash.near_duplicates(docs)
    prints = [brute.fingerprint(t, 4) for _, t in TEXTS]
    roots = brute.linked(prints, 4)
    least = {r: min((TEXTS[i][0] for i in range(len(TEXTS)) if roots[i] == r and TEXTS[i][0] is not None), default=None) for r in roots}
    expected = [(k, f"{p:016x}", least[r]) for (k, _), p, r in zip(TEXTS, prints, roots, strict=True)]
    assert pairs(out, "doc_id", "fingerprint", "component_id") == ordered(expected)
    assert simhash.near_duplicates(none).isEmpty()
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns and one.count() == len(set(roots))
    assert simhash.one_of_each(none).isEmpty()


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_and_empty_tables(spark: SparkSession, docs: DataFrame, none: DataFrame, name: str, tmp_path) -> None:
    folder = str(tmp_path)
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, folder)
    left = {"simhash_near_dedup": len(set(brute.linked([brute.fingerprint(t, 4) for _, t in TEXTS], 4))), "benchmark_decontamination": len(TEXTS) - 3}
    assert out.count() == left.get(name, len(TEXTS))
    if name != "bpe":
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        # what other columns hold is left alone
        assert out.where(F.col("source") != "s").isEmpty() and out.where("score is not null").isEmpty()
    assert stage(spark, none, folder).isEmpty()
