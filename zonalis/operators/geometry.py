"""Polygon measures as column expressions.

A polygon is ``array<array<struct<x:double,y:double>>>``: closed rings, outer rings counter-clockwise
and holes clockwise, so that signed ring areas add up.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(xmin: Column, ymin: Column, xmax: Column, ymax: Column, hole: bool = False) -> Column:
    corners = [point(xmin, ymin), point(xmax, ymin), point(xmax, ymax), point(xmin, ymax), point(xmin, ymin)]
    return F.array(*(corners[::-1] if hole else corners))


def bounds(rings: Column) -> Column:
    """Bounding box as a struct."""
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def edges(rings: Column) -> Column:
    """All edges of all rings as ``array<struct<x1,y1,x2,y2>>``."""

    def of_ring(ring: Column) -> Column:
        starts = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
        return F.transform(
            starts,
            lambda p, i: F.struct(
                p["x"].alias("x1"),
                p["y"].alias("y1"),
                F.get(ring, i + 1)["x"].alias("x2"),
                F.get(ring, i + 1)["y"].alias("y2"),
            ),
        )

    return F.flatten(F.transform(rings, of_ring))


def shoelace(rings: Column) -> Column:
    """Signed area in the plane of the coordinates, measured from the first vertex."""
    origin = F.get(F.get(rings, F.lit(0)), F.lit(0))
    return (
        F.aggregate(
            edges(rings),
            F.lit(0.0),
            lambda acc, e: acc
            + (e["x1"] - origin["x"]) * (e["y2"] - origin["y"])
            - (e["x2"] - origin["x"]) * (e["y1"] - origin["y"]),
        )
        / 2
    )


def edge_state(sides: str, x: str, y: str) -> Column:
    """0 or 1: even or odd number of these edges crossed to the right of a point; 2: the point is on an edge.

    Arguments are column names; ``sides`` as made by :func:`edges`, all or some of a polygon's.
    """
    crosses = (
        f"(e.y1 > {y}) <> (e.y2 > {y}) AND "
        f"{x} < e.x1 + coalesce(try_divide((e.x2 - e.x1) * ({y} - e.y1), e.y2 - e.y1), 0D)"
    )
    touches = (
        f"((e.x2 - e.x1) * ({y} - e.y1) = (e.y2 - e.y1) * ({x} - e.x1) "
        f"AND {x} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
        f"AND {y} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))"
    )
    state = f"CASE WHEN s = 2 OR {touches} THEN 2 WHEN {crosses} THEN 1 - s ELSE s END"
    return F.expr(f"aggregate({sides}, 0, (s, e) -> {state})")


def holds(ring: Column, x: Column, y: Column) -> Column:
    """Whether a point lies inside a ring or on it."""
    state = F.aggregate(
        edges(F.array(ring)),
        F.lit(0),
        lambda s, e: F.when((s == 2) | _on(e, x, y), F.lit(2)).when(_right_of(e, x, y), 1 - s).otherwise(s),
    )
    return state > 0


def _on(e: Column, x: Column, y: Column) -> Column:
    straight = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
    return straight & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(
        F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    )


def _right_of(e: Column, x: Column, y: Column) -> Column:
    at = e["x1"] + F.coalesce(F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]), F.lit(0.0))
    return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)


def box_overlap_area(a: Column, b: Column) -> Column:
    """Area shared by two bounding-box structs."""
    width = F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"])
    height = F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"])
    return F.greatest(width, F.lit(0.0)) * F.greatest(height, F.lit(0.0))
