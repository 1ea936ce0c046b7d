"""Removal of repeated runs of lines, with winnowing. DataFrame functions only.

Lines are cut at ``\\n``; lines without a word are no lines here and stay where they are. A run of lines counts if it has
``lines`` lines or, with fewer, ``words`` words, so a long line is a run of its own.

Windows are the shortest runs that count: one from each line on and one up to each line. The smallest line hash of
a window (the last one of equals) is its fingerprint. Every run that counts is covered by windows, and equal runs have equal
windows with their fingerprints at the same places, so a run that occurs twice has a fingerprint in common. Fingerprints
that occur once are dropped. Around each of the others the match is extended both ways within the windows that hold it, which
must be equal whole (by a hash of 64 bits of the line hashes and a second one of 32), and then from window to window as far
as they overlap or follow each other at one distance from one earlier place: these are the ``matches``, maximal for their
source. What is matched with the first of its kind is deleted, whatever the number of copies, so the lines that go are those of
all runs that count and also begin at an earlier place. Places are ordered by document id (NULL first), then a hash of the row,
then the line.

No pairs are made: each fingerprint and each window is grouped with partial aggregates, and joined back with the few
groups that matter, by shuffles that can be split where a line is in very many documents. Only matches of one text are gathered,
two windows a line at most, so a very long text needs room for its own lines. Rows with equal ids and texts are one place; of
such rows the first run stays in each of them. NULL texts stay NULL and have no lines; documents never disappear, a text whose lines
all go is empty. Empty tables give empty results. Columns of the input are kept; a column with the name of a result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm import common
from zonalis.llm.common import col, fresh, spread_join, with_fields
from zonalis.sources.stage import staged

LINES, WORDS = 3, 50


def _has_word(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\n\x0b\x0c\r", "     ")) != ""


def _numbered(text: Column) -> Column:
    """Two hashes and the number of words of each line with a word."""
    lines = F.split(text, "\n", -1)
    coded = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("g"), F.size(common.words(x)).alias("w")))
    return F.filter(coded, lambda p: p["w"] > 0)


def _length(at: Callable[[int], Column], lines: int, words: int) -> Column:
    """Lines of the shortest run that counts, with the words of its k-th line by ``at``; ``lines`` if too few are left."""
    total, found = at(0), F.when(at(0) >= words, 1)
    for k in range(1, lines - 1):
        total = total + at(k)
        found = found.when(total >= words, k + 1)
    return found.otherwise(lines) if lines > 1 else F.lit(1)


def _windows(lines: int, words: int) -> Column:
    """Start and length of the windows: one from each line on, and of those up to each line the ones that are not among them."""
    n = F.size("h")
    to = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda j: F.struct((j + 1 - _length(lambda k: F.get("w", j - k), lines, words)).alias("start"), (j + 1).alias("stop")),
    )
    to = F.filter(to, lambda r: (r["start"] >= 0) & (F.get("ahead", r["start"]) != r["stop"] - r["start"]))
    to = F.transform(to, lambda r: F.struct(r["start"].alias("start"), (r["stop"] - r["start"]).alias("n")))
    on = F.transform("ahead", lambda length, i: F.struct(i.alias("start"), length.alias("n")))
    return F.concat(F.filter(on, lambda r: r["start"] + r["n"] <= n), to)


def _coded(run: Column, lines: int) -> Column:
    """A window with its fingerprint, the line where that is, and its two hashes."""
    start, n = run["start"], run["n"]
    h = [F.when(n > k, F.get("h", start + k)) if k else F.get("h", start) for k in range(lines)]
    g = [F.when(n > k, F.get("g", start + k)) if k else F.get("g", start) for k in range(lines)]
    least = F.least(*h) if lines > 1 else h[0]
    last = F.greatest(F.lit(0), *[F.when(x == least, k) for k, x in enumerate(h)])
    return F.struct(
        start.alias("start"), n.alias("n"), least.alias("print"), (start + last).alias("at"), F.xxhash64(n, *h).alias("run"), F.hash(n, *g).alias("other")
    )


def matches(df: DataFrame, text: str = "text", key: str = "doc_id", lines: int = LINES, words: int = WORDS) -> DataFrame:
    """The texts with later runs: ``id``, ``row`` (hash of the text) and ``matches``, an array of maximal matches.

    A match has ``start`` and ``stop``, the first and last of its lines (from 0, lines with a word only), ``of_id`` and
    ``of_row``, the earlier text, and ``lag``, what to take from a line's number for the line of the earlier text.
    """
    rows = df.select(col(key).alias("id"), F.xxhash64(col(text)).alias("row"), _numbered(col(text)).alias("lines"))
    rows = rows.where(F.size("lines") > 0)
    rows = rows.select("id", "row", F.col("lines.h").alias("h"), F.col("lines.g").alias("g"), F.col("lines.w").alias("w"))
    ahead = F.transform("w", lambda _, i: _length(lambda k: F.get("w", i + k), lines, words))
    runs = rows.withColumn("ahead", ahead).select("id", "row", "h", "g", F.explode(_windows(lines, words)).alias("r"))
    coded = runs.select("id", "row", _coded(F.col("r"), lines).alias("r")).select("id", "row", "r.*")
    # the texts are read once for both uses
    coded = staged(coded, "line_prints")
    # equal rows are one place, so a fingerprint is repeated if it has two places
    mark = F.xxhash64("id", "row", "at")
    common_prints = coded.groupBy("print").agg(F.min(mark).alias("a"), F.max(mark).alias("b")).where("a != b").select("print")
    near = spread_join(coded, common_prints, ["print"], "left_semi")
    place = F.struct("id", "row", "start")
    first = near.groupBy("run", "other").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where(~F.col("first").eqNullSafe(F.col("last"))).select("run", "other", "first")
    later = spread_join(near, first, ["run", "other"]).where(~F.col("first").eqNullSafe(place))
    piece = F.struct(
        F.col("first.id").alias("of_id"),
        F.col("first.row").alias("of_row"),
        (F.col("start") - F.col("first.start")).alias("lag"),
        "start",
        (F.col("start") + F.col("n") - 1).alias("stop"),
    )
    pieces = later.groupBy("id", "row").agg(F.sort_array(F.collect_set(piece)).alias("pieces"))

    def new(p: Column, i: Column) -> Column:
        """Whether a match begins with this piece. Of one source and lag, pieces are in order of start and of stop."""
        before = F.get("pieces", i - 1)
        same = before["of_id"].eqNullSafe(p["of_id"]) & (before["of_row"] == p["of_row"]) & (before["lag"] == p["lag"])
        return (i == 0) | ~(same & (p["start"] <= before["stop"] + 1))

    begins = F.filter(F.transform("pieces", lambda p, i: F.when(new(p, i), i)), lambda i: i.isNotNull())
    found = pieces.withColumn("begins", begins)

    def whole(i: Column, m: Column) -> Column:
        p, end = F.get("pieces", i), F.coalesce(F.get("begins", m + 1), F.size("pieces")) - 1
        return F.struct(p["start"].alias("start"), F.get("pieces", end)["stop"].alias("stop"), *[p[c].alias(c) for c in ("of_id", "of_row", "lag")])

    return found.select("id", "row", F.transform("begins", whole).alias("matches"))


def dedup_lines(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    lines: int = LINES,
    words: int = WORDS,
    n_lines: str = "n_lines",
    n_removed: str = "n_removed",
) -> DataFrame:
    """``df`` with the text without later repeated runs of lines, the number of lines with a word and of those removed."""
    inner = fresh(df.columns, "gone")
    gone = F.array_distinct(F.flatten(F.transform("matches", lambda m: F.sequence(m["start"], m["stop"]))))
    found = matches(df, text, key, lines, words)
    found = found.select(F.col("id").alias(f"{inner}_id"), F.col("row").alias(f"{inner}_row"), gone.alias(inner))
    joined = df.join(found, col(key).eqNullSafe(F.col(f"{inner}_id")) & (F.xxhash64(col(text)) == F.col(f"{inner}_row")), "left")
    cut = F.split(col(text), "\n", -1)
    full = F.filter(F.transform(cut, lambda x, i: F.when(_has_word(x), i)), lambda i: i.isNotNull())
    joined = joined.withColumn(f"{inner}_full", full)
    full = F.col(f"{inner}_full")
    numbers = F.array_except(F.sequence(F.lit(0), F.size(cut) - 1), F.transform(F.col(inner), lambda k: F.get(full, k)))
    kept = F.array_join(F.transform(numbers, lambda i: F.get(cut, i)), "\n")
    own = F.coalesce(F.size(full), F.lit(0)).cast("long")
    removed = F.coalesce(F.size(F.col(inner)), F.lit(0)).cast("long")
    order = df.columns
    out = with_fields(
        joined,
        F.struct(
            F.when(F.col(inner).isNull(), col(text)).otherwise(kept).alias(text),
            F.when(col(text).isNull(), F.lit(0).cast("long")).otherwise(own).alias(n_lines),
            F.when(F.col(inner).isNull(), F.lit(0).cast("long")).otherwise(removed).alias(n_removed),
        ),
        [text, n_lines, n_removed],
    )
    return out.select(*[col(c) for c in order if c.lower() not in (n_lines, n_removed)], n_lines, n_removed)
