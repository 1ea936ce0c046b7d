"""The operators over their tables, with SQL where SQL can express the result."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import bpe, chat, decontamination, hard_negatives, line_dedup, periodic_runs, quality_rules, sharding, simhash, substring_dedup, suffix_dedup, token_counts, toxicity
from zonalis.llm.common import words

TOKENIZER = "byte_bpe_50k.json"


@functools.cache
def tokenizer() -> str:
    return bpe.definition_of(public_tokenizers.path(TOKENIZER))


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, folder, "labels"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    counted = quality_rules.with_counts(docs)
    rules = quality_rules.fit(counted, _table(spark, folder, "labels"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return quality_rules.judge(docs, rules).select(*base, "rule")


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokenizer(), fields=("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


def op4_chat_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["stop"].cast("string"))), ",")
    return chat.rotate(_table(spark, folder, "conversations")).select("conv_id", "speaker", "part", "n_turns", "text", spans.alias("mask"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.matches(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "similarity", "start")


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    names = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    return sharding.shard(_table(spark, folder, "documents")).select(*names)


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer()).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, keep=["doc_id"])


def _planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document by hash, made periodic from a word on, as the contract of operator 11 wants it."""
    h = F.crc32(F.col("doc_id").cast("string"))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words(F.col("text"))).alias("w"))
    cut = cut.withColumn("n", F.size("w")).withColumn("a", F.expr("CAST(g % nullif(n, 0) AS INT)"))
    cut = cut.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    repeated = "slice(flatten(array_repeat(slice(w, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a)"
    return cut.selectExpr("doc_id", f"coalesce(array_join(concat(slice(w, 1, a), {repeated}), ' '), text) AS text")


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _planted_runs(_table(spark, folder, "documents"))
    found = periodic_runs.find_runs(docs)
    best = periodic_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("id") % 50 == 0)


def op13_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


# words by white space, as the operators cut them
_LINES = """
lines as (
  select doc_id, i - 1 as line, string_split(text, chr(10))[i] as l
  from documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) as r(i)
),
full_lines as (
  select *, row_number() over (partition by doc_id order by line) as k
  from lines where regexp_matches(l, '[^\\x20\\x09-\\x0D]')
)"""

ORACLES = {
    "op4_chat_perspectives": """
with said as (
  select distinct conv_id, turn, coalesce(role, 'unknown') as role, replace(coalesce(text, ''), '<|', '< |') as said from conversations
),
speakers as (select distinct conv_id, role as speaker from said where role <> 'system'),
seen as (
  select s.conv_id, speaker, turn, role, said, role = speaker as own, turn // 64 as part,
    case when role = speaker then '<|assistant|>' when role = 'system' then '<|system|>' else '<|user:' || role || '|>' end || chr(10) as marker
  from said s join speakers p on s.conv_id = p.conv_id
),
placed as (
  select *, coalesce(sum(length(marker) + length(said) + 1) over (
    partition by conv_id, speaker, part order by turn, role, said rows between unbounded preceding and 1 preceding), 0) + length(marker) as start
  from seen
)
select conv_id, speaker, part, count(*) as n_turns,
  string_agg(marker || said || chr(10), '' order by turn, role, said) as text,
  coalesce(string_agg(case when own then start::bigint || '-' || (start + length(said))::bigint end, ',' order by turn, role, said), '') as mask
from placed group by conv_id, speaker, part
""",
    "op6_line_dedup": f"""
with {_LINES},
counted as (
  select *, len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) as w, lead(l) over d as l1, lead(l, 2) over d as l2, lead(w) over d as w1
  from full_lines window d as (partition by doc_id order by line)
),
runs as (
  select doc_id, k, 1 as n, l as run from counted where w >= 50
  union all select doc_id, k, 2, l || chr(10) || l1 from counted where w + w1 >= 50
  union all select doc_id, k, 3, l || chr(10) || l1 || chr(10) || l2 from counted where l2 is not null
),
later as (
  select doc_id, k, n from (select *, row_number() over (partition by run order by doc_id, k) as place from runs) where place > 1
),
gone as (select distinct doc_id, k + d as k from later, unnest(range(0, n)) as u(d)),
gone_lines as (select f.doc_id, f.line from full_lines f join gone g on f.doc_id = g.doc_id and f.k = g.k),
kept as (
  select l.doc_id, string_agg(l.l, chr(10) order by l.line) as text
  from lines l left join gone_lines g on l.doc_id = g.doc_id and l.line = g.line where g.doc_id is null group by l.doc_id
)
select d.doc_id,
  coalesce((select count(*) from full_lines f where f.doc_id = d.doc_id), 0) as n_lines,
  coalesce((select count(*) from gone g where g.doc_id = d.doc_id), 0) as n_removed,
  case when d.text is null then null else sha256(coalesce(k.text, '')) end as kept_sha256
from documents d left join kept k on d.doc_id = k.doc_id
""",
    "op12_hard_negatives": """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
pairs as (
  select a.vec_id as anchor_id, a.label as own, b.vec_id as id, b.label, list_dot_product(a.e, b.e)::bigint as score
  from vectors a join vectors b on len(a.e) = len(b.e) where a.vec_id % 50 = 0
),
positives as (
  select anchor_id, id, score from (
    select *, row_number() over (partition by anchor_id order by score desc, id) as n from pairs where own = label and anchor_id <> id
  ) where n <= 5
),
found as (
  select p.anchor_id, p.id as positive_id, p.score as positive_score, s.id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.id order by s.score desc, s.id) as rank
  from positives p join pairs s on p.anchor_id = s.anchor_id and s.own <> s.label
  where 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from found where rank <= 3
""",
    "op7_substring_dedup": """
with words as (select doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
windows as (
  select doc_id, i, array_to_string(w[i : i + 34], ' ') as s from words, unnest(range(1, len(w) - 33)) as r(i) where len(w) >= 35
),
repeated as (select doc_id, i from (select doc_id, i, count(*) over (partition by s) as n from windows) where n > 1),
gone as (select distinct doc_id, i + d as i from repeated, unnest(range(0, 35)) as r(d)),
kept as (
  select w.doc_id, string_agg(w.w[i], ' ' order by i) as text
  from words w, unnest(range(1, len(w.w) + 1)) as r(i)
  where not exists (select 1 from gone g where g.doc_id = w.doc_id and g.i = r.i)
  group by w.doc_id
)
select w.doc_id, len(w.w) as n_words, coalesce((select count(*) from gone g where g.doc_id = w.doc_id), 0) as n_removed,
  sha256(coalesce(k.text, '')) as kept_sha256
from words w left join kept k on w.doc_id = k.doc_id
""",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_quality_rules,
        op3_bpe,
        op4_chat_perspectives,
        op5_decontamination,
        op6_line_dedup,
        op7_substring_dedup,
        op8_sharding,
        op9_token_counts,
        op10_simhash,
        op11_periodic_runs,
        op12_hard_negatives,
        op13_suffix_dedup,
    )
}
