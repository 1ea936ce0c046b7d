"""Ring repair and the check for crossing edges.

Polygons whose edges cross or touch, within a ring or between rings, are cut at those points: a place is inside if an odd
number of rings hold it. What is left of them are directed edges with the inside on their left, each a ring of two points; areas,
overlays and point tests are sums over edges and need no loops. All other polygons keep their rings.

Edges meet in equi joins on polygon and strip, so an outline of any size is many rows in many tasks. A small file of polygons may
be one task, and its edges are a table many times its size: polygons are dealt to tasks by their number first, and edges are never
broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from zonalis.operators.geometry import bounds, edges, holds, shoelace
from zonalis.operators.joins import spread
from zonalis.operators.spatial import EDGES_PER_ROW, cell_number, strip_level
from zonalis.sources.stage import staged


def close_ring(ring: Column) -> Column:
    first = F.get(ring, F.lit(0))
    return F.when(F.element_at(ring, -1) == first, ring).otherwise(F.concat(ring, F.array(first)))


def drop_repeats(ring: Column) -> Column:
    """Drop vertices equal to the one before."""
    return F.filter(ring, lambda p, i: (i == 0) | (p != F.get(ring, i - 1)))


def orient(rings: Column) -> Column:
    """Outer rings counter-clockwise, holes clockwise, whatever their order.

    A ring is a hole if an odd number of larger rings hold it, so parts of a polygon and islands in holes are
    outer rings. A ring holds another if three of its vertices lie inside or on it: rings that touch in a point
    or along an edge do not.
    """
    sized = F.transform(rings, lambda ring: F.struct(ring.alias("ring"), F.abs(shoelace(F.array(ring))).alias("area")))

    def inside(inner: Column, outer: Column) -> Column:
        tests = [holds(outer["ring"], F.get(inner["ring"], F.lit(k))["x"], F.get(inner["ring"], F.lit(k))["y"]) for k in range(3)]
        return (outer["area"] > inner["area"]) & F.coalesce(tests[0] & tests[1] & tests[2], F.lit(False))

    def directed(own: Column) -> Column:
        is_outer = F.size(F.filter(sized, lambda other: inside(own, other))) % 2 == 0
        return F.when((shoelace(F.array(own["ring"])) >= 0) == is_outer, own["ring"]).otherwise(F.reverse(own["ring"]))

    return F.when(
        F.size(rings) > 1, F.transform(sized, directed)
    ).otherwise(F.transform(rings, lambda ring: F.when(shoelace(F.array(ring)) >= 0, ring).otherwise(F.reverse(ring))))


def cleaned(rings: Column) -> Column:
    """Closed rings without repeated vertices."""
    return F.transform(F.transform(rings, close_ring), drop_repeats)


POLYGONS_PER_TASK = 50_000


def dealt(polygons: DataFrame) -> DataFrame:
    """Polygons by id, POLYGONS_PER_TASK in a task."""
    return spread(polygons, ["id"], polygons.count(), POLYGONS_PER_TASK)


def repair(polygons: DataFrame) -> DataFrame:
    """Close rings, drop repeated vertices, cut crossing edges, fix ring direction. No polygon is lost; ``id`` must be unique."""
    tidy = dealt(polygons).withColumn("rings", cleaned(F.col("rings")))
    again = untangled(tidy.select("id", "rings"))
    if again is None:
        return tidy.withColumn("rings", orient(F.col("rings")))
    again = again.select(F.col("id").alias("__id"), F.col("rings").alias("__again"))
    joined = tidy.join(again, F.col("id") == F.col("__id"), "left")
    return joined.withColumn("rings", F.coalesce("__again", orient(F.col("rings")))).drop("__id", "__again")


SIDE = ("x1", "y1", "x2", "y2")
# Crossings are rounded to this many binary places of the largest coordinate, so that edges that lie on each other are cut at one point.
PLACES = 40


def _edges(polygons: DataFrame) -> DataFrame:
    """Edges with a length, numbered within the polygon, with the heights of its rows, the widths of its columns and its grain."""
    levels = [strip_level(F.col("rings"), axis, EDGES_PER_ROW).alias(name) for axis, name in (("y", "height"), ("x", "width"))]
    box = bounds(F.col("rings"))
    reach = F.greatest(*[F.abs(box[c]) for c in ("xmin", "ymin", "xmax", "ymax")], F.lit(2.0**-900))
    grain = F.pow(F.lit(2.0), F.ceil(F.log2(reach)) - PLACES).alias("grain")
    # what holds for a polygon is computed before its edges become rows
    whole = polygons.select("id", *levels, grain, edges(F.col("rings")).alias("sides"))
    listed = whole.select("id", "height", "width", "grain", F.posexplode("sides").alias("n", "e")).select("id", "height", "width", "grain", "n", "e.*")
    return listed.where("x1 <> x2 OR y1 <> y2")


def _left_of(a: str, x: str, y: str) -> str:
    """SQL text: above 0 if a point is to the left of the edge ``a``, below 0 to the right."""
    return f"(({a}.x2 - {a}.x1) * ({y} - {a}.y1) - ({a}.y2 - {a}.y1) * ({x} - {a}.x1))"


def _near(axis: str) -> str:
    ends = [(f"{s}.{axis}1", f"{s}.{axis}2") for s in "ab"]
    low, high = (f"{f}({', '.join(f'{g}({p}, {q})' for p, q in ends)})" for f, g in (("greatest", "least"), ("least", "greatest")))
    return f"{low} <= {high}"


def meetings(sides: DataFrame) -> DataFrame:
    """Points at which an edge meets another of its polygon other than at its own ends: ``id, n, x, y, through``.

    ``through`` tells that two edges cross in an inner point of both. Edges are listed in the rows they
    touch, and a pair is looked at in the first row that both touch.
    """
    low, high = cell_number("least(y1, y2)", "height"), cell_number("greatest(y1, y2)", "height")
    listed = sides.selectExpr("id", "n", "grain", *SIDE, f"{low} AS first", f"explode(sequence({low}, {high})) AS row")
    pairs = listed.alias("a").join(listed.alias("b").hint("merge"), F.expr(
        f"a.id = b.id AND a.row = b.row AND a.n < b.n AND a.row = greatest(a.first, b.first) AND {_near('x')} AND {_near('y')}"
    ))
    a_at = [_left_of("b", f"a.x{k}", f"a.y{k}") for k in (1, 2)]
    b_at = [_left_of("a", f"b.x{k}", f"b.y{k}") for k in (1, 2)]
    pairs = pairs.selectExpr("a.id AS id", "struct(a.*) AS a", "struct(b.*) AS b", f"array({', '.join(a_at)}) AS a_at", f"array({', '.join(b_at)}) AS b_at")
    through = "signum(a_at[0]) * signum(a_at[1]) < 0 AND signum(b_at[0]) * signum(b_at[1]) < 0"
    share = "a_at[0] / (a_at[0] - a_at[1])"
    cross = [f"rint((a.{c}1 + {share} * (a.{c}2 - a.{c}1)) / a.grain) * a.grain" for c in "xy"]
    pairs = pairs.withColumn("through", F.expr(through))

    def touch(on: str, other: str, k: int) -> str:
        """The end k of one edge, if it is an inner point of the other one."""
        x, y = f"{other}.x{k}", f"{other}.y{k}"
        box = f"{x} BETWEEN least({on}.x1, {on}.x2) AND greatest({on}.x1, {on}.x2) AND {y} BETWEEN least({on}.y1, {on}.y2) AND greatest({on}.y1, {on}.y2)"
        own_end = f"({x} = {on}.x1 AND {y} = {on}.y1) OR ({x} = {on}.x2 AND {y} = {on}.y2)"
        return f"IF({other}_at[{k - 1}] = 0 AND {box} AND NOT ({own_end}), named_struct('n', {on}.n, 'x', {x}, 'y', {y}, 'through', false), NULL)"

    crossed = [f"IF(through, named_struct('n', {e}.n, 'x', {cross[0]}, 'y', {cross[1]}, 'through', true), NULL)" for e in "ab"]
    touches = [touch(on, other, k) for on, other in ("ab", "ba") for k in (1, 2)]
    return pairs.selectExpr("id", f"inline(filter(array({', '.join([*crossed, *touches])}), t -> t IS NOT NULL))")


def _directed(pieces: DataFrame) -> DataFrame:
    """The pieces, each from the end that has the inside on its left.

    A piece that is rather flat looks up, others look to the right; an odd number of pieces there means that side is inside.
    """
    flat = pieces.where("abs(x2 - x1) >= abs(y2 - y1)")
    steep = pieces.where("abs(x2 - x1) < abs(y2 - y1)")

    def odd(which: DataFrame, u: str, v: str, level: str) -> DataFrame:
        """``beyond``: whether an odd number of pieces run beyond the middle of each, in the direction of v."""
        spans = f"explode(sequence({cell_number(f'least({u}1, {u}2)', level)}, {cell_number(f'greatest({u}1, {u}2)', level)})) AS strip"
        over = pieces.where(f"{u}1 <> {u}2").selectExpr("id", *SIDE, spans).selectExpr("id AS o_id", "strip AS o_strip", *[f"{c} AS o_{c}" for c in SIDE])
        middle = which.selectExpr("*", f"({u}1 + {u}2) / 2 AS mu", f"({v}1 + {v}2) / 2 AS mv").withColumn("strip", F.expr(cell_number("mu", level)))
        height = f"o_{v}1 + (mu - o_{u}1) * ((o_{v}2 - o_{v}1) / (o_{u}2 - o_{u}1))"
        other = " OR ".join(f"{c} <> o_{c}" for c in SIDE)
        match = f"id = o_id AND strip = o_strip AND least(o_{u}1, o_{u}2) <= mu AND mu < greatest(o_{u}1, o_{u}2) AND ({other}) AND {height} > mv"
        return middle.join(over.hint("merge"), F.expr(match), "left").groupBy("id", *SIDE).agg((F.count("o_id") % 2 == 1).alias("beyond"))

    turned = ", ".join(f"{c} AS {d}" for c, d in zip(("x2", "y2", "x1", "y1"), SIDE, strict=True)).split(", ")
    # to the right with the inside above; down with the inside to the right
    forward = odd(flat, "x", "y", "width").withColumn("keep", F.expr("beyond"))
    steep = odd(steep, "y", "x", "height").withColumn("keep", F.expr("(y2 > y1) <> beyond"))
    both = forward.unionByName(steep)
    return both.where("keep").select("id", *SIDE).unionByName(both.where("NOT keep").selectExpr("id", *turned))


def untangled(polygons: DataFrame) -> DataFrame | None:
    """``id, rings`` of the polygons in which edges cross or touch: what an odd number of their rings hold, as directed edges.

    None if there is no such polygon.

    Edges are cut where they meet, and pieces that lie on each other cancel in pairs. A polygon of which nothing is left, and one without
    meeting edges, has no row.
    """
    sides = _edges(polygons)
    starts = F.transform(edges(F.col("rings")), lambda e: F.when((e["x1"] != e["x2"]) | (e["y1"] != e["y2"]), F.xxhash64(e["x1"], e["y1"])))
    starts = F.filter(starts, lambda h: h.isNotNull())
    again = polygons.where(F.size(F.array_distinct(starts)) < F.size(starts)).select("id")  # a vertex that is used twice
    cuts = staged(meetings(sides).groupBy("id", "n").agg(F.collect_set(F.struct("x", "y")).alias("points")), "cuts")
    tangled = staged(cuts.select("id").unionByName(again).distinct(), "tangled")
    if tangled.isEmpty():
        return None
    parts = sides.join(tangled, "id", "left_semi").join(cuts, ["id", "n"], "left")
    along = lambda p: (p["x"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (p["y"] - F.col("y1")) * (F.col("y2") - F.col("y1"))
    inner = F.transform(F.coalesce("points", F.array().cast("array<struct<x:double,y:double>>")), lambda p: F.struct(along(p).alias("at"), p["x"].alias("x"), p["y"].alias("y")))
    chain = F.concat(
        F.array(F.struct(F.lit(float("-inf")).alias("at"), F.col("x1").alias("x"), F.col("y1").alias("y"))),
        inner,
        F.array(F.struct(F.lit(float("inf")).alias("at"), F.col("x2").alias("x"), F.col("y2").alias("y"))),
    )
    parts = parts.select("id", "height", "width", F.array_sort(chain).alias("p"))
    # each piece from its lower left end
    ends = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda k: F.array_sort(F.array(*[
        F.struct(F.element_at("p", k + d)["x"].alias("x"), F.element_at("p", k + d)["y"].alias("y")) for d in (0, 1)
    ])))
    pieces = parts.select("id", "height", "width", F.explode(ends).alias("q")).selectExpr(
        "id", "height", "width", "q[0].x AS x1", "q[0].y AS y1", "q[1].x AS x2", "q[1].y AS y2"
    )
    pieces = pieces.where("x1 <> x2 OR y1 <> y2").groupBy("id", "height", "width", *SIDE).agg(F.count(F.lit(1)).alias("times"))
    directed = _directed(staged(pieces.where("times % 2 = 1").drop("times"), "pieces"))
    segment = F.expr("array(named_struct('x', x1, 'y', y1), named_struct('x', x2, 'y', y2))")
    return directed.groupBy("id").agg(F.collect_list(segment).alias("rings"))


def check(polygons: DataFrame) -> DataFrame:
    """One row per ring as delivered, closed and without repeated vertices: ``id, ring, vertices, crosses``.

    A ring crosses itself if two of its edges cross in an inner point of both.
    """
    rings = dealt(polygons).select("id", F.posexplode(cleaned(F.col("rings"))).alias("ring", "points"))
    alone = rings.select(F.struct("id", "ring").alias("id"), F.array("points").alias("rings"))
    crossed = meetings(_edges(alone)).where("through").select(F.col("id.id").alias("__id"), F.col("id.ring").alias("__ring")).distinct()
    found = rings.join(crossed, (F.col("id") == F.col("__id")) & (F.col("ring") == F.col("__ring")), "left")
    return found.select("id", "ring", F.size("points").alias("vertices"), F.col("__id").isNotNull().alias("crosses"))
