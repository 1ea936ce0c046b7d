"""Corpus pipeline: from documents to token ids, in five stages that are written and reread.

Each stage works on all that its predecessor kept. Toxic documents go, later repeated runs of lines are cut out of the
texts, one document of each near-duplicate group stays, documents that hold benchmark items go, and what is left is
encoded (and decoded again, as a check that the ids are the text).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import bpe, decontamination, line_dedup, simhash, toxicity
from zonalis.llm.common import fresh
from zonalis.llm.queries import tokenizer
from zonalis.sources.stage import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones, does not call toxic."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    score, predicted = fresh(docs.columns, "score"), fresh(docs.columns, "predicted")
    rated = toxicity.score(docs, model, score=score, predicted=predicted)
    return rated.where(F.col(predicted) == 0).drop(score, predicted)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without later repeated runs of lines; ``n_chars`` follows the text."""
    n_lines, n_removed = fresh(docs.columns, "n_lines"), fresh(docs.columns, "n_removed")
    cut = line_dedup.dedup_lines(docs, n_lines=n_lines, n_removed=n_removed)
    length = F.when(F.col(n_removed) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).drop(n_lines, n_removed)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked: shingles of four words, four bits."""
    return simhash.one_of_each(docs, size=4, radius=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and digests of the ids and of the text that they decode to."""
    both = bpe.round_trip(docs, tokenizer())
    return both.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids_sha256",
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", decontaminate),
    ("bpe", encode),
]

# SimHash fingerprints, learned scores and BPE merges are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
