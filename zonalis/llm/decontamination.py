"""Benchmark decontamination with SimHash windows. DataFrame functions only.

Texts are lower-cased and cut into words and shingles of five words; a text of fewer words is one shingle. For an item
of L shingles, windows of L shingles are laid over a document; a document shorter than the item is one window. In a
window of W shingles that is similar to an item, at least 4 / 9 * (W + L) are the item's (a similarity of 0.8 as a
share of both), in whatever order. Every window in which so many are shingles of items of that length is laid, so none
is missed; they are counted over the places of such shingles in the document. Equal windows are one row from there on.

Each window and each item has a SimHash of 64 bits, where every occurrence of a shingle votes, so that counts are
weights. Fingerprints within ``radius`` (15) bits of each other differ in at most 3 bits in one of four blocks of 16.
For each block, windows are entered with all blocks one bit away and items with all blocks two bits away, so every pair
within the radius meets in an equi join on item size, block and value; no pair beyond the radius passes.
Pairs are verified by their exact weighted similarity: shingle counts, sum of minima over sum of maxima, at least 0.8.
(A pair of exactly 0.8 differs in 10 bits on average, with a deviation of 3.)

Items are few next to the documents. Their shingles are sent to all tasks if there are at most ``BROADCAST_ROWS`` of
them, which is counted first; otherwise Spark joins by its own size checks. Items and documents without words match
nothing; NULL texts have no words. Items with equal texts match alike; of rows equal in item id and text one counts.
Documents equal in id and text are one document in the matches, and are removed together.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import col, fresh, words
from zonalis.sources.stage import staged

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCK, BLOCKS = 16, 4
BROADCAST_ROWS = 1_000_000


def _shingles(text: Column) -> Column:
    own = words(F.lower(text))
    # as the variable of a transform the words are computed once, not at each use
    return F.transform(F.array(own), _shingles_of)[0]


def _shingles_of(w: Column) -> Column:
    starts = F.sequence(F.lit(0), F.size(w) - SHINGLE)
    return (
        F.when(F.size(w) >= SHINGLE, F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)])))
        .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
        .otherwise(F.array().cast("array<long>"))
    )


def _simhash(shingles: Column) -> Column:
    """Bit b is 1 if more than half of the shingle hashes have it."""
    half = F.size(shingles) / 2
    bits = F.sequence(F.lit(0), F.lit(63))
    one = F.lit(1).cast("long")

    def on(b: Column) -> Column:
        votes = F.aggregate(shingles, F.lit(0), lambda n, h: n + F.getbit(h, b).cast("int"))
        return F.when(votes > half, F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.transform(bits, on), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def _near_blocks(fingerprint: Column, distance: int) -> Column:
    """(block, value) of all values within ``distance`` bits of the blocks of a fingerprint."""
    masks = [sum(1 << b for b in chosen) for n in range(distance + 1) for chosen in combinations(range(BLOCK), n)]
    flips = F.array(*map(F.lit, masks))
    blocks = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    low = F.lit((1 << BLOCK) - 1).cast("long")

    def values(b: Column) -> Column:
        own = F.call_function("shiftrightunsigned", fingerprint, b * BLOCK).bitwiseAND(low).cast("int")
        return F.transform(flips, lambda m: F.struct(b.alias("block"), own.bitwiseXOR(m).alias("value")))

    return F.flatten(F.transform(blocks, values))


def _starts(places: Column, length: Column, n: Column) -> Column:
    """Starts of all windows over ``n`` shingles that hold enough of the sorted places for a similarity of 0.8."""
    span = F.least(length, n)
    need = F.ceil((span + length) * SIMILARITY / (1 + SIMILARITY) - 1e-9).cast("int")
    # so many places in a row are in the windows from the one that ends with the last to the one that begins with the first
    firsts = F.sequence(F.lit(0), F.size(places) - need)

    def windows(j: Column) -> Column:
        low = F.greatest(F.get(places, j + need - 1) - span + 1, F.lit(0))
        high = F.least(F.get(places, j), n - span)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    return F.when(F.size(places) >= need, F.array_distinct(F.flatten(F.transform(firsts, windows)))).otherwise(F.array().cast("array<int>"))


def matches(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``id``, ``row`` (hash of the text), ``item``, ``similarity`` and ``start`` (first word of the best window) of all leaks."""
    items = benchmark.select(col(item_key).alias("item"), _shingles(col(item_text)).alias("shingles")).where(F.size("shingles") > 0).distinct()
    # an item is named by its shingles, so that equal items are compared once
    items = items.withColumn("content", F.xxhash64("shingles", F.hash("shingles")))
    named = staged(items, "items")
    items = named.groupBy("content").agg(F.first("shingles").alias("shingles"))
    items = staged(items.select("content", "shingles", F.size("shingles").alias("length"), _simhash(F.col("shingles")).alias("fp")), "item_prints")

    anchors = staged(items.select("length", F.explode("shingles").alias("s")).distinct(), "anchors")
    if anchors.count() <= BROADCAST_ROWS:
        anchors = F.broadcast(anchors)

    rows = docs.select(col(key).alias("id"), F.xxhash64(col(text)).alias("row"), col(text).alias("text"))
    cut = rows.select("id", "row", _shingles(F.col("text")).alias("shingles"))
    at = cut.select("id", "row", F.size("shingles").alias("n"), F.posexplode("shingles").alias("place", "s"))
    hits = at.join(anchors, "s").groupBy("id", "row", "n", "length").agg(F.collect_set("place").alias("places"))
    span = F.least("length", "n")
    laid = hits.select("id", "row", "length", span.alias("span"), F.explode(_starts(F.array_sort("places"), F.col("length"), F.col("n"))).alias("start"))
    laid = laid.groupBy("id", "row").agg(F.collect_list(F.struct("length", "start", "span")).alias("laid"))
    laid = staged(laid, "laid")
    found = rows.join(laid.select(F.col("id").alias("id2"), F.col("row").alias("row2"), "laid"), F.col("id").eqNullSafe(F.col("id2")) & (F.col("row") == F.col("row2")))
    found = found.select("id", "row", _shingles(F.col("text")).alias("shingles"), F.explode("laid").alias("w"))
    found = found.select(
        "id", "row", F.col("w.start").alias("start"), F.col("w.length").alias("length"), F.slice("shingles", F.col("w.start") + 1, F.col("w.span")).alias("shingles")
    )
    found = staged(found.withColumn("window", F.xxhash64("length", "shingles", F.hash("shingles"))).distinct(), "windows")

    windows = found.groupBy("window", "length").agg(F.first("shingles").alias("shingles"))
    windows = staged(windows.withColumn("fp", _simhash(F.col("shingles"))), "window_prints")
    left = windows.select("window", "length", "fp", F.explode(_near_blocks(F.col("fp"), 1)).alias("b"))
    left = left.select("window", "length", F.col("fp").alias("window_fp"), "b.block", "b.value")
    right = items.select("content", "length", "fp", F.explode(_near_blocks(F.col("fp"), 2)).alias("b"))
    right = right.select("content", "length", F.col("fp").alias("item_fp"), "b.block", "b.value")
    near = left.join(right, ["length", "block", "value"]).where(F.bit_count(F.col("window_fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    pairs = staged(near.select("window", "content").distinct(), "near_pairs")

    ours = pairs.join(windows.select("window", "shingles"), "window").select("window", "content", F.explode("shingles").alias("s"), F.lit(1).alias("x"), F.lit(0).alias("y"))
    theirs = pairs.join(items.select("content", "shingles"), "content").select("window", "content", F.explode("shingles").alias("s"), F.lit(0).alias("x"), F.lit(1).alias("y"))
    counted = ours.union(theirs).groupBy("window", "content", "s").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    alike = counted.groupBy("window", "content").agg((F.sum(F.least("x", "y")) / F.sum(F.greatest("x", "y"))).alias("similarity"))
    alike = alike.where(F.col("similarity") >= SIMILARITY)

    leaks = found.join(alike, "window").join(named.select("item", "content"), "content")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("start")))
    return leaks.groupBy("id", "row", "item").agg(best.alias("b")).select(
        "id", "row", "item", F.col("b.similarity").alias("similarity"), (-F.col("b.start")).cast("long").alias("start")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **names: str) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    inner = fresh(docs.columns, "leak")
    leaks = matches(docs, benchmark, text, key, **names).select(F.col("id").alias(f"{inner}_id"), F.col("row").alias(f"{inner}_row")).distinct()
    same = col(key).eqNullSafe(F.col(f"{inner}_id")) & (F.xxhash64(col(text)) == F.col(f"{inner}_row"))
    return docs.join(leaks, same, "left_anti")
