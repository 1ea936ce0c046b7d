"""Connected components of links, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import spread_join
from zonalis.sources.stage import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    linked = spread_join(both.where("b > a"), least, ["a"])
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them. Edges go from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    over = spread_join(edges, least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return over.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node of its component) of every node of ``links`` but the roots themselves.

    ``links`` has the columns ``a`` and ``b``, in any order, repeated or not; links with a NULL and links of a node
    to itself are ignored. Large and small stars take turns until nothing changes; every round is a written table in
    the shared folder, so a lost executor repeats one round at most. A hub with any number of neighbours is one
    row of an aggregate and the skewed side of a join that can be split.
    """
    edges = staged(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        count, total = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if (count, total) == before or not count:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = (count, total)
        edges = staged(_small_star(_large_star(edges)), "links")
