"""Spatial joins on a grid whose cells follow the size of each polygon.

Every polygon gets a level: the power of two that is at least as large as its longer side. On the
grid of its own level it touches four cells at most. Two polygons are compared on the grid of the
coarser of the two, so small polygons are also listed in the cells of the coarser levels present on
the other side. Candidates therefore come from an equi join on ``(level, cx, cy)``, and no polygon
is spread over many cells however large it is.

Edges are cut by strips, too: into columns of x for areas, into rows of y for points. The strips of a polygon are a power of two
wide, so that each holds about as many edges as are worked on at once and listing the edges by strip at most doubles or
trebles them, whatever their lengths. A pair of polygons, or a point and a polygon, meets the edges of the strips it lies in only.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from zonalis.operators.geometry import bounds, box_overlap_area, edge_state, edges

CELL = ["level", "cx", "cy"]
# Levels are clamped to this range, which also bounds the list read by :func:`levels_of`.
LEVEL_RANGE = (-30, 40)
EDGES_PER_PIECE = 512
# Edges that a row of a polygon should hold, for points; edges that a column should hold, for areas.
EDGES_PER_ROW, EDGES_PER_COLUMN = 32, 256
# A polygon is not cut into columns finer than its own by more than this power of two, however fine the other one's are.
FINER = 6
EDGE_PAIRS_PER_STEP = 1_000_000
# Polygons that only touch share no area, but the sums of their edge pairs round to something like 1e-16 of the room
# of each pair. An area below this share of the common box is such noise; 0 keeps every positive sum.
NOISE = 1e-10


def size_level(box: str = "box") -> Column:
    lowest, highest = LEVEL_RANGE
    side = f"greatest({box}.xmax - {box}.xmin, {box}.ymax - {box}.ymin, {2.0**lowest}D)"
    return F.expr(f"least(CAST(ceil(log2({side})) AS INT), {highest})")


def levels_of(*tables: DataFrame) -> list[list[int]]:
    """Distinct levels of each table of boxes, at most one per step of LEVEL_RANGE.

    One job for all tables; it returns one row per table and level.
    """
    return _distinct_levels([t.select(size_level()) for t in tables])


def _distinct_levels(tables: Sequence[DataFrame]) -> list[list[int]]:
    """Distinct values of the only column of each table."""
    sides = [t.toDF("level").select(F.lit(i).alias("side"), "level") for i, t in enumerate(tables)]
    rows = reduce(DataFrame.unionAll, sides).distinct().collect()
    return [sorted(r.level for r in rows if r.side == i and r.level is not None) for i in range(len(tables))]


def cell_number(value: str, level: str = "level") -> str:
    """Number of the cell that holds a coordinate on the grid of a level, as SQL text."""
    return f"CAST(floor({value} / pow(2D, {level})) AS BIGINT)"


def _in_cells(boxes: DataFrame) -> DataFrame:
    """One row per cell the box touches on the grid of the row's ``level``."""
    columns = boxes.columns
    return boxes.selectExpr(
        *columns, f"explode(sequence({cell_number('box.xmin')}, {cell_number('box.xmax')})) AS cx"
    ).selectExpr(*columns, "cx", f"explode(sequence({cell_number('box.ymin')}, {cell_number('box.ymax')})) AS cy")


def _int_array(values: Sequence[int]) -> str:
    return f"CAST(array({', '.join(map(str, values))}) AS ARRAY<INT>)"


def box_pairs(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pairs ``(a, b, abox, bbox)`` of ids whose boxes share an area, and that are equal in the columns ``by``.

    Inputs have columns ``id`` and ``box``; ids must be unique per table. Each side lists its boxes
    on their own level, and as the finer box of a pair on the coarser levels of the other side; the
    column ``fine`` names the finer side. Boxes of equal level meet with ``b`` as the finer one. A pair
    is emitted only in the cell that holds the lower left corner of the shared box, so none appears
    twice.
    """
    a_levels, b_levels = levels_of(left, right)

    def listed(boxes: DataFrame, side: str, other: str, levels: Sequence[int], above: str) -> DataFrame:
        own = boxes.select("id", "box", *by, size_level().alias("own"))
        native = f"array(struct('{other}' AS fine, own AS level))"
        coarser = f"filter({_int_array(levels)}, v -> v {above} own)"
        lifted = f"transform({coarser}, v -> struct('{side}' AS fine, v AS level))"
        placed = own.selectExpr("id", "box", *by, f"inline(concat({native}, {lifted}))")
        return _in_cells(placed).selectExpr(f"id AS {side}", f"box AS {side}box", "fine", *by, *CELL)

    a_cells = listed(left, "a", "b", b_levels, ">")
    b_cells = listed(right, "b", "a", a_levels, ">=")
    joined = a_cells.join(b_cells, ["fine", *by, *CELL])
    xlo, ylo = "greatest(abox.xmin, bbox.xmin)", "greatest(abox.ymin, bbox.ymin)"
    return joined.filter(
        f"{xlo} < least(abox.xmax, bbox.xmax) AND {ylo} < least(abox.ymax, bbox.ymax) "
        f"AND {cell_number(xlo)} = cx AND {cell_number(ylo)} = cy"
    ).select("a", "b", "abox", "bbox")


def polygon_boxes(polygons: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return polygons.select("id", *by, bounds(F.col("rings")).alias("box"))


def strip_level(rings: Column, axis: str, per_strip: int) -> Column:
    """Power of two as wide as a strip across ``axis`` should be.

    It holds ``per_strip`` edges on average, and is not narrower than the edges are long on average.
    """
    none = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("length"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"))
    ends = lambda e: (e[f"{axis}1"], e[f"{axis}2"])

    def add(t: Column, e: Column) -> Column:
        p, q = ends(e)
        low, high = F.least(t["low"], p, q), F.greatest(t["high"], p, q)
        return F.struct((t["n"] + 1).alias("n"), (t["length"] + F.abs(p - q)).alias("length"), low.alias("low"), high.alias("high"))

    def width(t: Column) -> Column:
        lowest, highest = LEVEL_RANGE
        side = F.greatest(F.try_divide((t["high"] - t["low"]) * per_strip, t["n"]), F.try_divide(t["length"], t["n"]), F.lit(2.0**lowest))
        return F.least(F.ceil(F.log2(side)).cast("int"), F.lit(highest))

    return F.aggregate(edges(rings), none, add, width)


def _columns_of(polygons: DataFrame, prefix: str, others: Sequence[int]) -> DataFrame:
    """Edges by polygon and column, as flat ``x1,y1,x2,y2`` arrays of bounded length.

    Columns are as wide as the pairs with polygons of the levels ``others`` need them; vertical edges bound no area.
    """
    sides = F.filter(edges(F.col("rings")), lambda e: e["x1"] != e["x2"])
    own = polygons.select(F.col("id").alias(prefix), strip_level(F.col("rings"), "x", EDGES_PER_COLUMN).alias("own"), sides.alias("sides"))
    levels = f"array_distinct(transform({_int_array(others)}, other -> {_pair_level('own', 'other')}))"
    listed = own.selectExpr(prefix, f"explode({levels}) AS width", "sides").selectExpr(prefix, "width", "inline(sides)")
    strips = f"explode(sequence({cell_number('least(x1, x2)', 'width')}, {cell_number('greatest(x1, x2)', 'width')})) AS strip"
    placed = listed.selectExpr(prefix, "width", strips, "struct(x1, y1, x2, y2) AS side")
    strip = placed.groupBy(prefix, "width", "strip").agg(F.collect_list("side").alias("sides"))
    flat = F.flatten(F.transform("piece", lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])))
    pieces = strip.select(prefix, "width", "strip", F.explode(_pieces(F.col("sides"))).alias("piece"))
    return pieces.select(prefix, "width", "strip", flat.alias(f"{prefix}_edges"))


def _pair_level(a: str, b: str) -> str:
    """Level of the columns in which two polygons meet: the finer one's, as far as the coarser one may be cut."""
    return f"greatest(least({a}, {b}), greatest({a}, {b}) - {FINER})"


def shared_area(a: np.ndarray, b: np.ndarray, row: np.ndarray, width: np.ndarray, strip: np.ndarray) -> np.ndarray:
    """Signed area below both edges of each edge pair, added up per row; ``width`` and ``strip`` tell the column of each row.

    ``a`` and ``b`` hold one edge ``x1,y1,x2,y2`` per pair. A ring is the sum of the regions below
    its edges, top edges counted plus and bottom edges minus; so the area two polygons share is the
    sum over edge pairs of the signed integral of the lower of the two lines. Edges are listed in every column they
    touch; a pair counts in the column in which its common range begins.
    """
    lo = np.maximum(np.minimum(a[:, 0], a[:, 2]), np.minimum(b[:, 0], b[:, 2]))
    hi = np.minimum(np.maximum(a[:, 0], a[:, 2]), np.maximum(b[:, 0], b[:, 2]))
    keep = (hi > lo) & (np.floor(lo / width[row]) == strip[row])
    a, b, lo, hi, row = a[keep], b[keep], lo[keep], hi[keep], row[keep]

    def line(e: np.ndarray, x: np.ndarray) -> np.ndarray:
        return e[:, 1] + (e[:, 3] - e[:, 1]) * (x - e[:, 0]) / (e[:, 2] - e[:, 0])

    a_lo, a_hi, b_lo, b_hi = line(a, lo), line(a, hi), line(b, lo), line(b, hi)
    d_lo, d_hi = a_lo - b_lo, a_hi - b_hi
    area = np.minimum(a_lo, b_lo) + np.minimum(a_hi, b_hi)
    crossing = d_lo * d_hi < 0
    t = d_lo[crossing] / (d_lo[crossing] - d_hi[crossing])
    at = a_lo[crossing] + t * (a_hi[crossing] - a_lo[crossing])
    area[crossing] = t * (np.minimum(a_lo, b_lo)[crossing] + at) + (1 - t) * (
        at + np.minimum(a_hi, b_hi)[crossing]
    )
    sign = np.sign(a[:, 0] - a[:, 2]) * np.sign(b[:, 0] - b[:, 2])
    return np.bincount(row, weights=sign * area * (hi - lo) / 2, minlength=len(width))


def _piece_areas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = {}
        for name in ("a_edges", "b_edges"):
            column = batch.column(name)
            offsets = np.asarray(column.offsets)
            values = np.asarray(column.flatten()).reshape(-1, 4).copy()
            sides[name] = (values, (offsets[:-1] - offsets[0]) // 4, np.diff(offsets) // 4)
        (a, a_at, a_n), (b, b_at, b_n) = sides["a_edges"], sides["b_edges"]
        width = np.exp2(np.asarray(batch.column("width"), dtype=float))
        strip = np.asarray(batch.column("strip"), dtype=float)
        work = a_n.astype(np.int64) * b_n
        area = np.zeros(len(work))
        # heights are measured from the foot of the common box, which keeps the sums small; it is the same for all columns
        base = np.asarray(batch.column("base"))
        start = 0
        while start < len(work):
            done = np.cumsum(work[start:])
            stop = start + max(1, int(np.searchsorted(done, EDGE_PAIRS_PER_STEP, side="right")))
            n = work[start:stop]
            row = np.repeat(np.arange(stop - start), n)
            k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            left = a[np.repeat(a_at[start:stop], n) + k // np.repeat(b_n[start:stop], n)]
            right = b[np.repeat(b_at[start:stop], n) + k % np.repeat(b_n[start:stop], n)]
            shift = np.repeat(base[start:stop], n)
            left[:, 1] -= shift
            left[:, 3] -= shift
            right[:, 1] -= shift
            right[:, 3] -= shift
            area[start:stop] = shared_area(left, right, row, width[start:stop], strip[start:stop])
            start = stop
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("room"), pa.array(area)],
            names=["a", "b", "room", "area"],
        )


def overlay(left: DataFrame, right: DataFrame, noise: float = NOISE, by: Sequence[str] = ()) -> DataFrame:
    """Area shared by every pair of polygons that overlap: ``(a, b, area)``.

    Inputs have columns ``id`` (unique) and ``rings``. Only ids and boxes go through the grid join. Edges are then joined
    by polygon and column, so a pair reads those of its common columns only: a small polygon on an outline of a
    million edges meets the few above and below it. Only polygons equal in the columns ``by`` are compared.
    ``noise`` is the share of the common box from which on an area counts.
    """
    boxes = [
        p.select("id", *by, bounds(F.col("rings")).withField("width", strip_level(F.col("rings"), "x", EDGES_PER_COLUMN)).alias("box"))
        for p in (left, right)
    ]
    levels = _distinct_levels([b.select("box.width") for b in boxes])
    room = box_overlap_area(F.col("abox"), F.col("bbox")).alias("room")
    pairs = box_pairs(*boxes, by).select(
        "a", "b", room, F.expr(_pair_level("abox.width", "bbox.width")).alias("width"),
        F.expr("greatest(abox.ymin, bbox.ymin)").alias("base"),
        F.expr("greatest(abox.xmin, bbox.xmin)").alias("xlo"), F.expr("least(abox.xmax, bbox.xmax)").alias("xhi"),
    )
    strips = f"explode(sequence({cell_number('xlo', 'width')}, {cell_number('xhi', 'width')})) AS strip"
    placed = pairs.selectExpr("a", "b", "room", "base", "width", strips)
    # (polygon, column) is the key on both sides; what is not in a common column drops out
    with_a = placed.join(_columns_of(left, "a", levels[1]), ["a", "width", "strip"])
    pieces = with_a.join(_columns_of(right, "b", levels[0]), ["b", "width", "strip"])
    pieces = pieces.select("a", "b", "room", "base", "width", "strip", "a_edges", "b_edges")
    id_types = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}
    areas = pieces.mapInArrow(_piece_areas, f"a {id_types['a']}, b {id_types['b']}, room double, area double")
    return (
        areas.groupBy("a", "b")
        .agg(F.sum("area").alias("area"), F.max("room").alias("room"))
        .filter(F.col("area") > F.col("room") * noise)
        .select("a", "b", "area")
    )


def box_overlay(left: DataFrame, right: DataFrame) -> DataFrame:
    """:func:`overlay` for axis-parallel boxes, without leaving the JVM."""
    return box_pairs(left, right).select(
        "a", "b", box_overlap_area(F.col("abox"), F.col("bbox")).alias("area")
    )


def _rows_of(polygons: DataFrame) -> DataFrame:
    """Edges by polygon and row, in blocks: ``id, row, before, start, stop, sides, crossed, after``.

    Between two blocks of a row no edge stands, so there every point of the row is inside or every one is outside. A row
    ends outside; ``crossed`` counts the edges of the block that a line through the middle of the row crosses, ``after`` those of
    the blocks to its right, and ``before`` is the end of the block to its left.
    """
    own = polygons.select("id", strip_level(F.col("rings"), "y", EDGES_PER_ROW).alias("height"), edges(F.col("rings")).alias("sides"))
    listed = own.selectExpr("id", "height", "inline(sides)")
    rows = f"explode(sequence({cell_number('least(y1, y2)', 'height')}, {cell_number('greatest(y1, y2)', 'height')})) AS row"
    placed = listed.selectExpr("id", "height", "x1", "y1", "x2", "y2", rows)
    middle = "(row + 0.5D) * pow(2D, height)"
    placed = placed.selectExpr(
        "id", "row", "least(x1, x2) AS start", "greatest(x1, x2) AS stop", "struct(x1, y1, x2, y2) AS side",
        f"CAST((y1 > {middle}) <> (y2 > {middle}) AS INT) AS crosses",
    )
    by_start = Window.partitionBy("id", "row").orderBy("start")
    reach = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    begins = placed.withColumn("begins", F.when(F.col("start") <= reach, 0).otherwise(1))
    block = F.sum("begins").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    blocks = begins.withColumn("block", block).groupBy("id", "row", "block").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.sum("crosses").alias("crossed"), F.collect_list("side").alias("sides")
    )
    by_block = Window.partitionBy("id", "row").orderBy("block")
    total = F.sum("crossed").over(Window.partitionBy("id", "row"))
    return blocks.select(
        "id", "row", "start", "stop", "sides", "crossed",
        F.coalesce(F.lag("stop").over(by_block), F.lit(float("-inf"))).alias("before"),
        (total - F.sum("crossed").over(by_block.rowsBetween(Window.unboundedPreceding, 0))).alias("after"),
    )


def points_in_polygons(points: DataFrame, polygons: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Pairs of a point (columns ``keep``, ``x``, ``y``) and the id of a polygon that holds it.

    Points on a boundary belong to every polygon that touches them. Equal points are tested once each:
    reduce them to distinct rows first. Only boxes go through the grid join. A point then meets one block of edges of
    its row of the polygon, or none: between blocks the number of edges to the right decides, which the
    block brings along. Within a block its own edges are tested as well.
    """
    boxes = polygons.select("id", bounds(F.col("rings")).withField("height", strip_level(F.col("rings"), "y", EDGES_PER_ROW)).alias("box"))
    [levels] = levels_of(boxes)
    at = points.selectExpr(*keep, "x", "y", f"explode({_int_array(levels)}) AS level").selectExpr(
        *keep, "x", "y", "level", f"{cell_number('x')} AS cx", f"{cell_number('y')} AS cy"
    )
    cells = _in_cells(boxes.withColumn("level", size_level()))
    near = "x BETWEEN box.xmin AND box.xmax AND y BETWEEN box.ymin AND box.ymax"
    pairs = at.join(cells, CELL).filter(near).select(*keep, "x", "y", "id", F.expr(f"{cell_number('y', 'box.height')} AS row"))
    met = pairs.join(_rows_of(polygons), ["id", "row"]).filter("x > before AND x <= stop")
    state = F.when(F.col("x") < F.col("start"), F.col("crossed") % 2).otherwise(edge_state("sides", "x", "y"))
    return met.withColumn("state", state).filter("state = 2 OR (state + after) % 2 = 1").select(*keep, "x", "y", "id")


def _pieces(sides: Column) -> Column:
    """An array cut into arrays of EDGES_PER_PIECE at most."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(sides), F.lit(1)), F.lit(EDGES_PER_PIECE))
    return F.transform(starts, lambda start: F.slice(sides, start, F.lit(EDGES_PER_PIECE)))
