from __future__ import annotations

import math
import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import DataFrame, SparkSession, functions as F

from zonalis.operators import spatial, validity
from zonalis.operators.geometry import RINGS_TYPE, box_ring, shoelace
from zonalis.operators.projection import AIRY1830, CENSUS_ZONE, WGS84, TransverseMercator, equal_area, map_vertices, move
from zonalis.operators.validity import check, repair
from zonalis.plans.geography import (
    best_matches,
    circuit_ids,
    overlay_shares,
    prepare_circuits,
    prepare_tracts,
    section_matches,
)

Ring = list[tuple[float, float]]


def box(x0: float, y0: float, x1: float, y1: float) -> Ring:
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def polygons(spark: SparkSession, shapes: dict[int, list[Ring]]) -> DataFrame:
    rows = [(k, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in rings]) for k, rings in shapes.items()]
    return spark.createDataFrame(rows, f"id bigint, rings {RINGS_TYPE}")


def areas(df: DataFrame) -> dict[tuple[int, int], float]:
    return {(r.a, r.b): r.area for r in df.collect()}


L_SHAPE = [(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3), (0, 0)]
C_SHAPE = [(0, 0), (3, 0), (3, 1), (1, 1), (1, 2), (3, 2), (3, 3), (0, 3), (0, 0)]
SQUARE_WITH_HOLE = [box(0, 0, 4, 4), box(1, 1, 3, 3)[::-1]]


@pytest.mark.parametrize(
    ("a", "b", "area"),
    [
        ([box(0, 0, 2, 2)], [box(1, 1, 3, 3)], 1.0),
        ([box(0, 0, 2, 2)], [box(0, 0, 2, 2)], 4.0),
        ([L_SHAPE], [box(0.5, 0.5, 1.5, 1.5)], 0.75),
        ([L_SHAPE], [L_SHAPE], 5.0),
        (SQUARE_WITH_HOLE, [box(0.5, 0.5, 2, 2)], 1.25),
        ([C_SHAPE], [box(2, 0, 3, 3)], 2.0),
        ([[(0, 0), (4, 0), (0, 4), (0, 0)]], [box(1, 1, 3, 3)], 2.0),
        (SQUARE_WITH_HOLE, [box(1.5, 1.5, 2.5, 2.5)], None),
        ([box(0, 0, 1, 1)], [box(1, 0, 2, 1)], None),
        ([box(0, 0, 1, 1)], [box(5, 5, 6, 6)], None),
    ],
)
def test_known_areas(spark: SparkSession, a: list[Ring], b: list[Ring], area: float | None) -> None:
    got = areas(spatial.overlay(polygons(spark, {1: a}), polygons(spark, {2: b})))
    assert got == ({} if area is None else pytest.approx({(1, 2): area}))


def star(rng: random.Random, reach: float) -> Ring:
    """A star-shaped ring, counter-clockwise, not convex in general."""
    cx, cy, size = rng.uniform(-reach, reach), rng.uniform(-reach, reach), 2 ** rng.uniform(-3, 3)
    n = rng.randint(3, 12)
    ring = []
    for k in range(n):
        angle, r = 2 * math.pi * (k + rng.uniform(0, 0.8)) / n, size * rng.uniform(0.4, 1)
        ring.append((cx + r * math.cos(angle), cy + r * math.sin(angle)))
    return [*ring, ring[0]]


def inside(ring: Ring, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    odd = np.zeros(len(x), bool)
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if y1 != y2:
            odd ^= ((y1 > y) != (y2 > y)) & (x < x1 + (x2 - x1) * (y - y1) / (y2 - y1))
    return odd


def plane(ring: Ring) -> float:
    return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False)) / 2


def clipped_area(a: Ring, b: Ring) -> float:
    """Area of the common part by clipping signed triangles of both rings against each other."""

    def clip(subject: Ring, triangle: Ring) -> Ring:
        for (x1, y1), (x2, y2) in zip(triangle, [*triangle[1:], triangle[0]], strict=True):
            kept: Ring = []
            for p, q in zip(subject, [*subject[1:], subject[0]], strict=True):
                dp, dq = ((x2 - x1) * (v[1] - y1) - (y2 - y1) * (v[0] - x1) for v in (p, q))
                if dp >= 0:
                    kept.append(p)
                if (dp < 0) != (dq < 0):
                    t = dp / (dp - dq)
                    kept.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
            subject = kept
            if not subject:
                return []
        return subject

    def fan(ring: Ring) -> list[tuple[float, Ring]]:
        parts = []
        for p, q in zip(ring[1:-1], ring[2:], strict=False):
            t = [ring[0], p, q]
            s = plane([*t, t[0]])
            if s:
                parts.append((math.copysign(1, s), t if s > 0 else t[::-1]))
        return parts

    total = 0.0
    for sa, ta in fan(a):
        for sb, tb in fan(b):
            c = clip(ta, tb)
            if len(c) > 2:
                total += sa * sb * plane([*c, c[0]])
    return total


def test_overlay_of_random_stars(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """All sizes, with edges cut into small pieces."""
    monkeypatch.setattr(spatial, "EDGES_PER_PIECE", 4)
    rng = random.Random(5)
    a, b = {k: star(rng, 6) for k in range(40)}, {k: star(rng, 6) for k in range(100, 140)}
    got = areas(
        spatial.overlay(
            polygons(spark, {k: [r] for k, r in a.items()}), polygons(spark, {k: [r] for k, r in b.items()})
        )
    )
    want = {(i, j): clipped_area(ra, rb) for i, ra in a.items() for j, rb in b.items()}
    want = {k: v for k, v in want.items() if v > 1e-9}
    assert len(want) > 100
    assert {k: v for k, v in got.items() if v > 1e-9} == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_overlay_is_symmetric(spark: SparkSession) -> None:
    rng = random.Random(8)
    a = polygons(spark, {k: [star(rng, 4)] for k in range(20)})
    b = polygons(spark, {k: [star(rng, 4)] for k in range(20)})
    forth, back = areas(spatial.overlay(a, b)), areas(spatial.overlay(b, a))
    assert forth == pytest.approx({(i, j): v for (j, i), v in back.items()})


def test_box_pairs_each_once(spark: SparkSession) -> None:
    rng = random.Random(3)

    def boxes(first: int) -> dict[int, list[Ring]]:
        out = {}
        for k in range(first, first + 120):
            x, y, w, h = rng.uniform(-9, 9), rng.uniform(-9, 9), 2 ** rng.uniform(-5, 4), 2 ** rng.uniform(-5, 4)
            out[k] = [box(x, y, x + w, y + h)]
        return out

    a, b = boxes(0), boxes(500)
    for k in range(1000, 1040):  # many copies of one box
        b[k] = [box(0, 0, 1, 1)]
    pairs = [
        (r.a, r.b)
        for r in spatial.box_pairs(
            spatial.polygon_boxes(polygons(spark, a)), spatial.polygon_boxes(polygons(spark, b))
        ).collect()
    ]
    want = {
        (i, j)
        for i, [ra] in a.items()
        for j, [rb] in b.items()
        if max(ra[0][0], rb[0][0]) < min(ra[2][0], rb[2][0]) and max(ra[0][1], rb[0][1]) < min(ra[2][1], rb[2][1])
    }
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


@pytest.mark.parametrize("edges_per_piece", [512, 2])
def test_points_in_polygons(spark: SparkSession, monkeypatch: pytest.MonkeyPatch, edges_per_piece: int) -> None:
    monkeypatch.setattr(spatial, "EDGES_PER_PIECE", edges_per_piece)
    rng = random.Random(2)
    shapes = {k: star(rng, 5) for k in range(30)}
    points = [(i, rng.uniform(-6, 6), rng.uniform(-6, 6)) for i in range(300)] + [(1000 + i, 0.25, 0.25) for i in range(50)]
    frame = spark.createDataFrame(points, "p int, x double, y double")
    got = spatial.points_in_polygons(frame, polygons(spark, {k: [r] for k, r in shapes.items()}), ["p"])
    xs, ys = np.array([p[1] for p in points]), np.array([p[2] for p in points])
    want = {(points[i][0], k) for k, r in shapes.items() for i in np.flatnonzero(inside(r, xs, ys))}
    assert {(r.p, r.id) for r in got.collect()} == want


def test_points_on_edges_and_in_holes(spark: SparkSession) -> None:
    frame = spark.createDataFrame([("edge", 0.0, 2.0), ("hole", 2.0, 2.0), ("rim", 1.0, 2.0), ("corner", 4.0, 4.0), ("out", 4.1, 4.0)], "p string, x double, y double")
    got = spatial.points_in_polygons(frame, polygons(spark, {1: SQUARE_WITH_HOLE}), ["p"])
    assert {r.p for r in got.collect()} == {"edge", "rim", "corner"}


def test_shares_of_covered_tract_add_up(spark: SparkSession) -> None:
    tracts = polygons(spark, {1: [box(0, 0, 3, 3)]}).withColumn("id_radio", F.lit("t"))
    zones = polygons(spark, {k: [box(k, 0, k + 1, 3)] for k in range(3)}).withColumn("id_circuito", F.col("id").cast("string"))
    shares = [r.por_radio for r in overlay_shares(tracts, zones).collect()]
    assert shares == [0.33333] * 3


def test_circuit_ids_drop_other_lengths(spark: SparkSession) -> None:
    df = spark.createDataFrame([("02", "003", "7"), ("02", "003", "12"), ("02", "003", "1234567"), (None, "003", "123A")], "indec_p string, indec_d string, circuito string")
    assert [r.id_circuito for r in circuit_ids(df).collect()] == ["02003000012", "NA00300123A"]


def test_section_match_counts_polygons_and_keeps_ties(spark: SparkSession) -> None:
    zones = polygons(spark, {1: [box(0, 0, 1, 1)], 2: [box(1, 0, 2, 1)], 3: [box(2, 0, 3, 1)]})
    zones = zones.withColumn("indec_p", F.lit("06")).withColumn("indec_d", F.when(F.col("id") < 3, "001").otherwise("002"))
    places = [(1, 1, 0.5, 0.5), (1, 1, 0.6, 0.5), (1, 1, 1.5, 0.5), (1, 1, 2.5, 0.5), (1, 2, 0.5, 0.5), (1, 2, 2.5, 0.5), (16, 1, 0.5, 0.5)]
    frame = spark.createDataFrame(places, "id_distrito int, id_seccion int, x double, y double")
    matches = section_matches(frame, zones)
    assert {tuple(r) for r in matches.collect()} == {
        ("01001", "06001", 2), ("01001", "06002", 1), ("01002", "06001", 1), ("01002", "06002", 1), ("16001", "06001", 1)
    }
    assert {tuple(r) for r in best_matches([matches, matches.limit(0)]).collect()} == {
        ("01001", "06001"), ("01002", "06001"), ("01002", "06002")
    }


def test_repair_and_check(spark: SparkSession) -> None:
    bowtie = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
    messy = [(0, 2), (2, 2), (2, 2), (2, 0), (0, 0)]
    df = polygons(spark, {1: [messy], 2: [bowtie], 3: [box(0, 0, 4, 4), box(1, 1, 2, 2)]})
    fixed = {r.id: r.area for r in repair(df).select("id", shoelace(F.col("rings")).alias("area")).collect()}
    assert fixed == {1: 4.0, 2: 2.0, 3: 15.0}
    assert {(r.id, r.ring): r.crosses for r in check(df).collect()} == {(1, 0): False, (2, 0): True, (3, 0): False, (3, 1): False}


def test_tangled_rings_hold_what_an_odd_number_of_rings_holds(spark: SparkSession) -> None:
    eight = [(0, 0), (1, 1), (2, 2), (2, 0), (1, 1), (0, 2), (0, 0)]  # the crossing is a vertex
    crossing = [box(0, 0, 3, 3), box(2, 2, 5, 5)]  # the shared square is held twice
    twice = [[*box(0, 0, 4, 4)[:-1], *box(0, 0, 2, 2)]]  # a smaller loop within the same ring, on two of its edges
    notch = [[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]]  # a vertex on another edge
    star = [[(math.cos(k * 4 * math.pi / 5), math.sin(k * 4 * math.pi / 5)) for k in (0, 1, 2, 3, 4, 0)]]
    df = polygons(spark, {1: [eight], 2: crossing, 3: twice, 4: notch, 5: star})
    fixed = repair(df)
    found = {r.id: r.area for r in fixed.select("id", shoelace(F.col("rings")).alias("area")).collect()}
    outer, inner = 1.0, math.cos(2 * math.pi / 5) / math.cos(math.pi / 5)
    spikes = 5 * outer * inner * math.sin(math.pi / 5) - 5 / 2 * inner**2 * math.sin(2 * math.pi / 5)
    assert found == pytest.approx({1: 2.0, 2: 16.0, 3: 12.0, 4: 8.0, 5: spikes})
    assert not any(r.crosses for r in check(fixed).collect())
    whole = polygons(spark, {9: [box(-9, -9, 9, 9)]})
    assert {a: v for (a, _), v in areas(spatial.overlay(fixed, whole)).items()} == pytest.approx(found)


def test_random_tangles_against_sampled_points(spark: SparkSession) -> None:
    """Area and directions of untangled edges against even-odd tests of points."""
    draw = np.random.default_rng(5)
    shapes = {k: [[*(ring := [tuple(p) for p in draw.integers(0, 12, (n, 2)).tolist()]), ring[0]] for n in (7, 5)] for k in range(20)}
    fixed = {r.id: np.array([[p.x, p.y, q.x, q.y] for ring in r.rings for p, q in zip(ring, ring[1:], strict=False)]) for r in repair(polygons(spark, shapes)).collect()}
    assert len(fixed) == 20
    for k, rings in shapes.items():
        sides = np.array([[*p, *q] for ring in rings for p, q in zip(ring, ring[1:], strict=False)], float)
        points = draw.uniform(0, 12, (4000, 2))

        def winding(e: np.ndarray, points: np.ndarray = points) -> np.ndarray:
            up = (e[:, 1] <= points[:, 1, None]) & (e[:, 3] > points[:, 1, None])
            down = (e[:, 3] <= points[:, 1, None]) & (e[:, 1] > points[:, 1, None])
            side = (e[:, 2] - e[:, 0]) * (points[:, 1, None] - e[:, 1]) - (points[:, 0, None] - e[:, 0]) * (e[:, 3] - e[:, 1])
            return (up & (side > 0)).sum(1) - (down & (side < 0)).sum(1)

        expected = winding(sides) % 2 == 1
        assert (winding(fixed[k]) == expected).mean() > 0.999


def test_layers_meet_their_own_circuits_only(spark: SparkSession) -> None:
    tracts = polygons(spark, {1: [box(0, 0, 1, 1)], 2: [box(0, 0, 2, 1)]}).selectExpr("*", "concat('t', id) AS id_radio", "concat('0', id) AS province")
    zones = polygons(spark, {1: [box(0, 0, 5, 5)], 2: [box(0, 0, 1, 1)]}).selectExpr("*", "concat('c', id) AS id_circuito", "concat('0', id) AS province")
    shares = {(r.id_radio, r.id_circuito): r.por_radio for r in overlay_shares(tracts, zones).collect()}
    assert shares == {("t1", "c1"): 1.0, ("t2", "c2"): 0.5}


def test_parts_and_islands_keep_their_area(spark: SparkSession) -> None:
    """Outer rings and holes are told apart by what holds them, not by their order."""
    apart = [box(0, 0, 1, 1), box(3, 0, 4, 1)]
    nested = [box(1, 1, 9, 9), box(2, 2, 3, 3), box(0, 0, 10, 10), box(4, 4, 5, 5)]  # a hole with two islands, shuffled
    touching = [box(0, 0, 1, 1), box(1, 0, 3, 1)]  # a shared edge is not nesting
    df = polygons(spark, {1: apart, 2: nested, 3: touching, 4: [r[::-1] for r in apart]})
    found = {r.id: r.area for r in repair(df).select("id", shoelace(F.col("rings")).alias("area")).collect()}
    assert found == {1: 2.0, 2: 100.0 - 64.0 + 2.0, 3: 3.0, 4: 2.0}


def test_shares_of_a_tract_in_two_parts(spark: SparkSession) -> None:
    tracts = repair(polygons(spark, {1: [box(0, 0, 2, 1), box(10, 0, 11, 1)]})).withColumn("id_radio", F.lit("t"))
    zones = polygons(spark, {1: [box(0, 0, 5, 5)], 2: [box(9, 0, 12, 5)]}).withColumn("id_circuito", F.col("id").cast("string"))
    shares = {r.id_circuito: r.por_radio for r in overlay_shares(tracts, zones).collect()}
    assert shares == {"1": 0.66667, "2": 0.33333}


def test_published_transverse_mercator_point(spark: SparkSession) -> None:
    """Worked example of the British National Grid in the EPSG guidance notes."""
    grid = TransverseMercator(-2.0, 49.0, 0.9996012717, 400000.0, -100000.0, AIRY1830)
    east, north = move(F.lit(0.5), F.lit(50.5), grid.forward)
    row = spark.range(1).select(east.alias("e"), north.alias("n")).first()
    assert (row.e, row.n) == pytest.approx((577274.99, 69740.50), abs=0.02)
    lon, lat = move(F.lit(577274.99), F.lit(69740.50), grid.inverse)
    back = spark.range(1).select(lon.alias("x"), lat.alias("y")).first()
    assert (back.x, back.y) == pytest.approx((0.5, 50.5), abs=1e-6)


def test_census_zone_round_trip(spark: SparkSession) -> None:
    df = spark.createDataFrame([(-66.0, -34.0), (-58.4, -34.6), (-63.1, -39.9)], "lon double, lat double")
    east, north = move(F.col("lon"), F.col("lat"), CENSUS_ZONE.forward)
    there = df.select("lon", "lat", east.alias("e"), north.alias("n"))
    lon, lat = move(F.col("e"), F.col("n"), CENSUS_ZONE.inverse)
    for r in there.select("lon", "lat", "e", lon.alias("x"), lat.alias("y")).collect():
        assert (r.x, r.y) == pytest.approx((r.lon, r.lat), abs=1e-8)
    assert there.first().e == pytest.approx(3_500_000.0)


def test_whole_ellipsoid_area(spark: SparkSession) -> None:
    x, y = move(F.lit(180.0), F.lit(90.0), equal_area(WGS84))
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert 4 * row.x * row.y == pytest.approx(5.10065621724e14, rel=1e-9)


def test_crossings_of_rings_with_many_edges(spark: SparkSession) -> None:
    angle = np.linspace(0, 2 * np.pi, 400)
    smooth = list(zip((np.cos(angle) * (2 + np.cos(9 * angle))).tolist(), (np.sin(angle) * (2 + np.cos(9 * angle))).tolist(), strict=True))
    smooth[-1] = smooth[0]
    spiky = [*smooth[:200], (4.0, 0.1), *smooth[201:]]
    n = 20_000
    large = [(math.cos(2 * math.pi * k / n), math.sin(2 * math.pi * k / n)) for k in range(n)]
    swapped = [*large[:500], large[501], large[500], *large[502:]]
    shapes = {1: [smooth], 2: [spiky], 3: [[*large, large[0]]], 4: [[*swapped, large[0]]]}
    df = polygons(spark, shapes)
    assert {r.id: r.crosses for r in check(df).collect()} == {1: False, 2: True, 3: False, 4: True}
    kept = {r.id: r.n for r in repair(df).select("id", F.size("rings").alias("n")).collect()}
    assert kept[1] == kept[3] == 1 and kept[2] > 400 and kept[4] == n + 2


def test_copies_count_once_each(spark: SparkSession) -> None:
    """Equal polygon rows add up, as separate rows would."""
    square = [[{"x": -66.0 + dx, "y": -34.0 + dy} for dx, dy in box(0, 0, 0.01, 0.01)]]
    rows = [("layer", "x", "02", "001", "0012", square)] * 3
    circuits = spark.createDataFrame(rows, f"source_file string, provincia string, indec_p string, indec_d string, circuito string, rings {RINGS_TYPE}")
    good = prepare_circuits(circuits)
    assert good.count() == 1
    tract = spark.createDataFrame([("t", square)], f"link string, rings {RINGS_TYPE}").withColumn("rings", map_vertices(F.col("rings"), CENSUS_ZONE.forward))
    tracts = prepare_tracts(tract)
    shares = overlay_shares(tracts, circuit_ids(good)).collect()
    assert [(r.id_radio, r.id_circuito, r.por_radio) for r in shares] == [("t", "02001000012", 3.0)]


def large_outline(spark: SparkSession, n: int) -> tuple[DataFrame, np.ndarray]:
    """A ragged star-shaped outline of n edges around 0, and the radius of each of its vertices."""
    rng = np.random.default_rng(11)
    radius = 100 + 5 * np.sin(np.arange(n) * 2 * np.pi * 40 / n) + 0.01 * rng.random(n)
    angle = np.arange(n) * 2 * np.pi / n
    table = pd.DataFrame({"k": np.arange(n + 1), "x": np.append(radius * np.cos(angle), radius[0]), "y": np.append(radius * np.sin(angle), 0.0)})
    points = spark.createDataFrame(table).groupBy().agg(F.array_sort(F.collect_list(F.struct("k", "x", "y"))).alias("p"))
    ring = F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))
    return points.select(F.lit(7).cast("bigint").alias("id"), F.array(ring).alias("rings")), radius


def test_an_outline_of_a_million_edges(spark: SparkSession, tmp_path: Path) -> None:
    """Points meet the edges of their row, tracts those of their columns; the tracts' shares add up to the whole area."""
    n = 1_000_000
    outline, radius = large_outline(spark, n)
    outline.write.parquet(str(tmp_path / "outline"))
    outline = spark.read.parquet(str(tmp_path / "outline"))
    rows = spatial._rows_of(outline).agg(F.max(F.size("sides")), F.sum(F.size("sides"))).first()
    assert rows[0] < 2000 and rows[1] < 3 * n
    columns = spatial._columns_of(outline, "a", [10]).agg(F.max(F.size("a_edges")) / 4, F.sum(F.size("a_edges")) / 4).first()
    assert columns[0] <= spatial.EDGES_PER_PIECE and columns[1] < 3 * n

    rng = np.random.default_rng(12)
    x, y = rng.uniform(-110, 110, (2, 100_000))
    found = spatial.points_in_polygons(spark.createDataFrame(pd.DataFrame({"k": np.arange(len(x)), "x": x, "y": y})), outline, ["k"])
    inside = np.zeros(len(x), bool)
    inside[[r.k for r in found.select("k").collect()]] = True
    k = (np.arctan2(y, x) % (2 * np.pi) * n / (2 * np.pi)).astype(int) % n
    ends = [radius[i % n] * np.exp(1j * (i % n) * 2 * np.pi / n) for i in (k, k + 1)]
    assert (inside == ((np.conj(ends[1] - ends[0]) * (x + 1j * y - ends[0])).imag >= 0)).all()

    side = 0.75
    place = F.struct(((F.col("id") % 320 - 160) * side).alias("x0"), ((F.floor(F.col("id") / 320) - 160) * side).alias("y0")).alias("p")
    tracts = spark.range(320 * 320).select("id", place).select("id", F.expr(
        f"array(transform(array(array(0, 0), array(1, 0), array(1, 1), array(0, 1), array(0, 0)), c -> named_struct('x', p.x0 + c[0] * {side}D, 'y', p.y0 + c[1] * {side}D)))"
    ).cast(RINGS_TYPE).alias("rings"))
    shared = spatial.overlay(tracts, outline)
    whole = outline.select(shoelace(F.col("rings"))).first()[0]
    total, count, most = shared.agg(F.sum("area"), F.count("*"), F.max("area")).first()
    assert total == pytest.approx(whole, rel=1e-9) and most <= side * side * (1 + 1e-9)
    assert 50_000 < count < 70_000


def test_rows_of_comb_and_flat_shapes(spark: SparkSession) -> None:
    """Long teeth, horizontal edges, holes and points on every kind of boundary, against the plain parity rule."""
    comb = [(0.0, 0.0), *[(float(k) / 2, 9.0 if k % 2 else 1.0) for k in range(1, 80)], (40.0, 0.0), (0.0, 0.0)]
    stairs = [(0, 0), *[(v, w) for k in range(1, 30) for v, w in ((k, k - 1), (k, k))], (0, 29), (0, 0)]
    shapes = {1: [comb], 2: [[(float(a), float(b)) for a, b in stairs]], 3: [box(0, 0, 30, 30), box(5, 5, 25, 25)[::-1], box(10, 10, 20, 20)]}
    rng = random.Random(4)
    places = [(rng.choice((rng.uniform(-1, 41), float(rng.randint(0, 40)))), rng.choice((rng.uniform(-1, 31), float(rng.randint(0, 30))))) for _ in range(400)]
    places = sorted(set(places))
    points = spark.createDataFrame([(k, *p) for k, p in enumerate(places)], "k int, x double, y double")
    found = {(r.k, r.id) for r in spatial.points_in_polygons(points, polygons(spark, shapes), ["k"]).collect()}

    def holds(rings: list[Ring], x: float, y: float) -> bool:
        odd = False
        for ring in rings:
            for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
                if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                    return True
                if (y1 > y) != (y2 > y):
                    odd ^= x < x1 + (x2 - x1) * (y - y1) / (y2 - y1)
        return odd

    assert found == {(k, i) for k, p in enumerate(places) for i, rings in shapes.items() if holds(rings, *p)}


def test_polygons_of_a_small_file_are_dealt_to_tasks(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """One task of polygons becomes as many as their number asks for, and their edges are not broadcast however small they seem."""
    monkeypatch.setattr(validity, "POLYGONS_PER_TASK", 10)
    x = F.col("id").cast("double")
    polygons = spark.range(0, 95, 1, 1).select("id", F.array(box_ring(x, x, x + 1, x + 1)).alias("rings"))
    checked = validity.check(polygons)
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "10), REPARTITION_BY_NUM" in plan
    assert "SortMergeJoin [id#" in plan and "BroadcastHashJoin [id#" not in plan.split("SortMergeJoin [id#")[1], plan
    assert checked.count() == 95 and checked.where("crosses").isEmpty()
    assert validity.repair(polygons).count() == 95
