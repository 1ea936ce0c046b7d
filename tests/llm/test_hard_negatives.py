"""Operator 12 against all inner products, the bounds of its trees, and inputs that are no plain vectors. Its SQL is run with the others."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalis.llm import hard_negatives
from zonalis.llm.hard_negatives import Best, CoverTree, search

Rows = list[tuple]


def plain(rows: Rows, every: int, positives: int = 5, negatives: int = 3) -> Rows:
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    own = {(i, y, tuple(math.floor(256 * float(x)) for x in v)) for i, v, y in rows if i is not None and y is not None and ok(v)}
    dot = lambda a, b: max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(a, b, strict=True))))
    out = []
    for i, y, v in own:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, z) for j, z, w in own if len(w) == len(v))
        for minus, j, _ in [s for s in scored if s[2] == y and s[1] != i][:positives]:
            hard = [(n, k) for n, k, z in scored if z != y and 50 * -minus <= 100 * -n <= 95 * -minus][:negatives]
            out += [(i, j, r, k, -minus, -n) for r, (n, k) in enumerate(hard, 1)]
    return sorted(out)


def table(spark: SparkSession, rows: Rows) -> DataFrame:
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def mined(spark: SparkSession, rows: Rows, every: int, **more: int) -> Rows:
    return sorted(tuple(r) for r in hard_negatives.mine(table(spark, rows), F.col("id") % every == 0, **more).collect())


def clustered(rng: np.random.Generator, count: int, size: int, labels: int = 4) -> Rows:
    centres = rng.normal(size=(labels, size))
    return [(i, (centres[(y := int(rng.integers(labels)))] + 0.3 * rng.normal(size=size)).tolist(), y if i % 7 else (y + 1) % labels) for i in range(count)]


def test_as_all_products(spark: SparkSession) -> None:
    rng = np.random.default_rng(1)
    rows = clustered(rng, 600, 6)
    # coarse components give many equal scores
    rows += [(i, (rng.integers(-2, 3, 6) / 256).tolist(), int(rng.integers(3))) for i in range(1000, 1200)]
    found = mined(spark, rows, 9)
    assert found == plain(rows, 9) and len(found) > 200
    assert mined(spark, rows, 9, positives=2, negatives=1) == plain(rows, 9, 2, 1)


def test_several_shards_and_slices(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    rows = clustered(np.random.default_rng(2), 300, 5)
    monkeypatch.setattr(hard_negatives, "SHARD_BYTES", 1000)
    assert mined(spark, rows, 10) == plain(rows, 10)


def test_nulls_repeats_sizes_and_large_numbers(spark: SparkSession) -> None:
    rng = np.random.default_rng(3)
    rows: Rows = [(i, v, y) for i, v, y in clustered(rng, 60, 3)]
    rows += rows[:20]  # repeated rows
    rows += [(i, v, (y or 0) + 1) for i, v, y in rows[:5]]  # ids with two labels
    rows += [(None, [1.0, 1.0, 1.0], 1), (100, None, 1), (105, [1.0, 1.0, 1.0], None), (110, [1.0, None, 1.0], 1)]
    rows += [(115, [1.0, math.nan, 1.0], 1), (120, [math.inf, 1.0, 1.0], 1), (125, [], 1), (130, [], 1), (135, [], 2)]
    rows += [(i, rng.normal(size=2).tolist(), i % 2) for i in range(200, 230)]  # vectors of another length
    found = mined(spark, rows, 5)
    assert found == plain(rows, 5)
    assert (125, 130, 1, 135, 0, 0) in found
    large: Rows = [(i, (rng.normal(size=3) * 1e6).tolist(), i % 3) for i in range(60)]
    large += [(i, (rng.normal(size=3) * 1e14).tolist(), i % 3) for i in range(60, 80)]
    # beyond 2 ** 53, and beyond 64 bits
    kept = mined(spark, large[:60], 5)
    assert kept == plain(large[:60], 5) and any(abs(r[4]) > 1 << 53 for r in kept)
    assert all(-(1 << 63) <= x < 1 << 63 for r in mined(spark, large, 5) for x in r)


def test_empty_and_other_columns(spark: SparkSession) -> None:
    rows = clustered(np.random.default_rng(4), 80, 4)
    df = table(spark, rows)
    assert hard_negatives.mine(df.limit(0), F.col("id") % 5 == 0).collect() == []
    assert hard_negatives.mine(df, F.col("id") < 0).collect() == []
    named = df.withColumns({"id": F.lit("x"), "v": F.lit(1), "shard": F.lit(2), "rank": F.lit(3)})
    found = hard_negatives.mine(named, F.col("id") % 5 == 0)
    assert sorted(map(tuple, found.collect())) == plain(rows, 5)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_bounds_hold_and_radii_cover() -> None:
    rng = np.random.default_rng(5)
    points = np.floor(np.concatenate([rng.normal(c, 5, size=(150, 8)) for c in (0, 60, -90, 200)]))
    tree = CoverTree(points, leaf=10)
    queries = np.floor(rng.normal(size=(40, 8)) * 50)
    lengths = np.linalg.norm(queries, axis=1)
    nodes = np.arange(len(tree.centre))
    low, high = tree.bounds(queries, lengths, nodes)
    assert sum(map(len, tree.children)) == len(nodes) - 1 > 20
    for n in nodes:
        inner = queries @ points[tree.members[n]].T
        assert (inner >= low[:, [n]]).all() and (inner <= high[:, [n]]).all()
        if len(tree.children[n]):
            assert sorted(np.concatenate([tree.members[c] for c in tree.children[n]]).tolist()) == sorted(tree.members[n].tolist())
            centres = tree.points[[tree.centre[c] for c in tree.children[n]]]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
            radius = max(np.linalg.norm(tree.points[tree.members[n]] - tree.points[tree.centre[n]], axis=1))
            assert apart[~np.eye(len(centres), dtype=bool)].min() > radius / 4


def test_descent_scores_few_candidates_of_clusters() -> None:
    rng = np.random.default_rng(6)
    points = np.floor(np.concatenate([rng.normal(size=8) * 200 + rng.normal(size=(100, 8)) for _ in range(50)]))
    queries = points[::100]
    scored = []

    def fits(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        scored.append(len(rows) * len(places))
        return np.ones((len(rows), len(places)), bool)

    best = Best(np.full((50, 1), -np.inf), np.full((50, 1), np.inf), 3, float)
    search(CoverTree(points), points, queries, best, fits)
    everything = queries @ points.T
    expected = np.sort(everything, axis=1)[:, ::-1][:, :3]
    assert (best.score[:, 0] == expected).all()
    assert sum(scored) < 0.25 * everything.size


@pytest.mark.parametrize("alike", [False, True])
def test_a_large_leaf_is_scored_in_tiles(alike: bool) -> None:
    """Vectors that do not cluster, or are all the same, are one leaf."""
    rng = np.random.default_rng(7)
    points = rng.normal(size=(6000, 64))
    points = np.floor(256 * points / np.linalg.norm(points, axis=1)[:, None])
    if alike:
        points[:] = points[0]
    queries, held = points[::12] + 1, []

    def fits(rows: np.ndarray, places: np.ndarray) -> np.ndarray:
        held.append(len(rows) * len(places))
        return (rows[:, None] + places[None]) % 3 > 0

    tree = CoverTree(points)
    assert len(tree.centre) == 1
    best = Best(np.full((500, 2), -np.inf), np.tile([np.inf, 0.0], (500, 1)), 4, float)
    search(tree, points, queries, best, fits)
    assert sum(held) == 500 * 6000 and max(held) <= 1 << 20
    scores = np.where((np.arange(500)[:, None] + np.arange(6000)[None]) % 3 > 0, queries @ points.T, -np.inf)
    for w, inside in enumerate((scores, np.where(scores <= 0, scores, -np.inf))):
        first = np.argsort(-inside, axis=1, kind="stable")[:, :4]
        expected = np.take_along_axis(inside, first, 1)
        assert (best.score[:, w] == expected).all() and (best.place[:, w] == np.where(expected > -np.inf, first, -1)).all()


@pytest.mark.parametrize("length", [1.0, 15.9, 16.1, 1e5])
def test_unit_vectors_and_longer_ones(spark: SparkSession, length: float) -> None:
    """Scores on either side of 2 ** 24, up to where single floats are exact."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(400, 16))
    vectors *= length / np.linalg.norm(vectors, axis=1)[:, None]
    rows = [(i, v.tolist(), i % 5) for i, v in enumerate(vectors)] + [(1000 + i, vectors[7].tolist(), i % 5) for i in range(60)]
    rows += [(2000 + i, (-vectors[7]).tolist(), i % 3) for i in range(10)] + [(3000, [0.0] * 16, 1), (3005, [-0.0] * 16, 1)]
    found = mined(spark, rows, 5)
    assert found == plain(rows, 5) and found


def test_packed_vectors_come_back() -> None:
    rows = [[0.0, 5.0], [-32767.0, 32767.0], [32768.0, 1.0], [-(2.0**80), 3.0], [-32768.0, 0.0]]
    for some in (rows, rows[:2], rows[2:4], []):
        packs = hard_negatives._packed(np.array(some).reshape(-1), np.full(len(some), 2))
        assert [len(p) for p in packs.to_pylist()] == [4 if max(map(abs, r)) < 1 << 15 else 16 for r in some]
        assert hard_negatives._matrix(pa.chunked_array([packs.slice(0, 1), packs.slice(1)]), 2).tolist() == some
