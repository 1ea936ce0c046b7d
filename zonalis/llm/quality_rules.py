"""Quality filter: fixed base rules, then a decision list that is learned from labelled documents.

Statistics of each text are counted in one pass over its words and lines. The decision list is grown by sequential
covering: on the grow part of the labelled rows a rule starts empty and takes the threshold condition with the best
information gain until it covers no good document, or no condition helps; on the prune part conditions are dropped
from its end while that does not lower its worth. Rows that the rule covers leave the data, and the next rule is
grown, until a rule is worth nothing. What comes out is an ordered list of conjunctions of thresholds over ratios,
as Spark conditional expressions; the scoring pass needs nothing else.

Statistics are counted for all rows. Thresholds and list come from labelled rows that are not held out, at most
``max_rows`` of them, chosen by the hash of the id; candidate thresholds are quantiles of the grow part. A document with several labels is good if one says so;
labels that are NULL are ignored. Without labels of both kinds the list is empty and its verdict is "keep".

NULL and empty texts have no words, fail the base rules and are not kept. Repeated rows get equal results. Columns of
the input are kept; one with the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from zonalis.llm.common import col, portions, with_fields

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
THRESHOLDS = 24  # candidate thresholds of each ratio: quantiles of the grow part
MAX_ROWS = 50_000


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more in the text."""
    grams = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(grams)) == len(grams):
        return 0
    times: dict[tuple[bytes, ...], int] = {}
    for g in grams:
        times[g] = times.get(g, 0) + 1
    covered = end = 0
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def counts_of(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_dup_lines, n_repeat_words and n_lines (lines with a word)."""
    words = text.split()
    chars = len(b"".join(words).decode())
    seen: set[bytes] = set()
    lines = repeated = 0
    for line in text.split(b"\n"):
        if not line or line.isspace():
            continue
        lines += 1
        repeated += line in seen
        seen.add(line)
    return len(words), chars, repeated, _repeat_words(words), lines


TEXT_COUNTS = ["n_words", "word_chars", "n_dup_lines", "n_repeat_words", "n_lines"]


@arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in TEXT_COUNTS]))
def _text_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = [counts_of(t or b"") for portion in portions(texts) for t in portion]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.StructArray.from_arrays([pa.array(list(c), pa.int64()) for c in columns], TEXT_COUNTS)


def _characters(text: Column, keep: str) -> Column:
    """Number of characters of the given regular-expression class."""
    return F.char_length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the statistics of its texts (``COUNTS``)."""
    content = F.coalesce(col(text), F.lit(""))
    plain = ["n_symbols", "n_upper", "n_marks"]
    counted = with_fields(df, _text_counts(content), TEXT_COUNTS)
    classes = {"n_symbols": r"#*$%&|<>", "n_upper": r"\p{Lu}", "n_marks": "!?"}
    kept = [c for c in counted.columns if c.lower() not in plain]
    return counted.select(*[col(c) for c in kept], *[_characters(content, classes[c]).alias(c) for c in plain])


def ratios() -> dict[str, Column]:
    """What the learned conditions compare: counts set against the length of the text."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_words": F.col("n_repeat_words") / words,
        "words_per_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
        "upper": F.col("n_upper") / chars,
        "marks_per_word": F.col("n_marks") / words,
    }


@dataclass(frozen=True)
class Condition:
    """``name`` at most (or above) ``bound``."""

    name: str
    above: bool
    bound: float

    def column(self, values: dict[str, Column]) -> Column:
        return values[self.name] > F.lit(self.bound) if self.above else values[self.name] <= F.lit(self.bound)

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.name] > self.bound if self.above else values[self.name] <= self.bound


Rule = tuple[Condition, ...]


def covers(rule: Rule, values: dict[str, np.ndarray]) -> np.ndarray:
    return reduce(and_, (c.holds(values) for c in rule))


def _gain(bad: np.ndarray, good: np.ndarray, bad0: int, good0: int) -> np.ndarray:
    """Information won for the bad documents that stay covered."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(bad > 0, bad * (np.log2(bad / (bad + good)) - np.log2(bad0 / (bad0 + good0))), -np.inf)


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    held = np.ones(len(bad), bool)
    while held.any():
        bad0, good0 = int(bad[held].sum()), int((~bad[held]).sum())
        if not bad0 or not good0:
            break
        best, best_gain = None, 1e-9
        for name, v in values.items():
            own = v[held]
            for bound in np.unique(np.quantile(own, np.linspace(0, 1, THRESHOLDS + 1), method="lower")):
                high = own > bound
                for above, inside in ((True, high), (False, ~high)):
                    b = int(bad[held][inside].sum())
                    gain = float(_gain(np.array(b), np.array(int(inside.sum()) - b), bad0, good0))
                    if gain > best_gain:
                        best, best_gain = Condition(name, above, float(bound)), gain
        if best is None:
            break
        rule = (*rule, best)
        held &= best.holds(values)
    return rule


def _worth(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> float:
    inside = covers(rule, values)
    b, g = int((bad & inside).sum()), int((~bad & inside).sum())
    return (b - g) / (b + g) if b + g else -1.0


def learn(values: dict[str, np.ndarray], bad: np.ndarray, order: np.ndarray) -> list[Rule]:
    """Rules for bad documents, in order. ``order`` is a number in [0, 1) that splits rows in grow (2/3) and prune."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while True:
        grow, prune = left & (order < 2 / 3), left & (order >= 2 / 3)
        if not bad[grow].any() or bad[grow].all():
            break
        part = {k: v[grow] for k, v in values.items()}
        rule = _grow(part, bad[grow])
        if not rule:
            break
        test = {k: v[prune] for k, v in values.items()}
        while len(rule) > 1 and _worth(rule[:-1], test, bad[prune]) >= _worth(rule, test, bad[prune]):
            rule = rule[:-1]
        check = (test, bad[prune]) if covers(rule, test).any() else (part, bad[grow])
        if _worth(rule, *check) < 0.5:  # three of four covered documents are bad, or the list ends
            break
        rules.append(rule)
        left &= ~covers(rule, values)
    return rules


def fit(counted: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_rows: int = MAX_ROWS) -> list[Rule]:
    """The decision list for documents labelled 0 among rows with statistics (see :func:`with_counts`)."""
    truth = labels.where(col(label).isNotNull() & col(key).isNotNull())
    truth = truth.groupBy(col(key).alias("_id")).agg(F.max(col(label)).alias("_good"))
    truth = truth.where(F.pmod(F.crc32(F.col("_id").cast("string")), F.lit(5)) != 0)
    values = ratios()
    rows = (
        counted.select(col(key).alias("_key"), *COUNTS)
        .join(truth, F.col("_key") == F.col("_id"))
        .select("_id", "_good", *[c.alias(n) for n, c in values.items()])
        .orderBy(F.xxhash64("_id"), *values)
        .limit(max_rows)
        .select("_good", (F.pmod(F.xxhash64(F.lit(7), F.col("_id")), F.lit(3000)) / 3000).alias("_order"), *values)
        .toPandas()
    )
    arrays = {n: rows[n].to_numpy(float) for n in values}
    return learn(arrays, rows["_good"].to_numpy() == 0, rows["_order"].to_numpy(float))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one conditional expression: true keeps the document. The first rule that holds decides."""
    values = ratios()
    found = F.lit(True)
    for rule in reversed(rules):
        found = F.when(reduce(and_, [c.column(values) for c in rule]), F.lit(False)).otherwise(found)
    return found


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(df: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``df`` with the statistics, ``base_failed``, ``rule`` (number of the first learned rule that holds) and ``kept``."""
    values = ratios()
    number = F.lit(None).cast("int")
    for k in reversed(range(len(rules))):
        number = F.when(reduce(and_, [c.column(values) for c in rules[k]]), F.lit(k)).otherwise(number)
    out = with_counts(df, text).withColumn("base_failed", base_failed()).withColumn("rule", number)
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules))
