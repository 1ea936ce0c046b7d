"""Hard negatives for anchors: rows of another label that score close below a positive, by best-first search of cover trees.

A vector's components are scaled and rounded down to whole numbers; a score is the inner product of two such vectors. The positives of an
anchor are its ``positives`` best rows of its own label (not of its own id), the negatives of a positive the ``negatives`` best rows of other
labels whose score is between ``low`` and ``high`` hundredths of the positive's. Of equal scores the smaller id comes first.

1. Rows are dealt to shards by a hash. Each shard meets the anchors in slices; shards and slices are bounded in bytes
   (``SHARD_BYTES``), and there are not more shards than that or the number of cores asks for, so what anchors return grows
   with their number and not with the rows.
2. In a shard every candidate gets one component more, which brings all of them to one length M and does not change
   any inner product, as the anchor's is 0. A cover tree is built on them: a node's children are centres further apart than half of
   its scale, the first one is its own centre, every candidate is with the nearest, and each node knows its covering radius. A node
   that does not fall apart into much fewer centres than it has members stays a leaf.
3. On the sphere of radius M the angle between anchor and centre, more or less the angle of the covering radius, bounds the inner products
   in a node from above and below. Each anchor opens its node with the greatest upper bound first; a node goes whose bounds
   are outside all windows still open or below what has been found. Leaves are scored exactly. Anchors that open the same node do so
   in products of matrices of ``TILE`` scores at most, however large the leaf: vectors that do not cluster are one leaf a shard. Rows of the own
   label are looked for among the rows sorted by label. Bounds leave room for rounding, so none cuts a row off.
4. The best of each shard are put together for each anchor.

Scores are exact: products are sums of whole numbers below 2 ** 53 (single floats where lengths keep them below 2 ** 24), else they are taken in
whole numbers of any size. A score beyond 64 bits is
returned as the nearest number of 64 bits, which also gives the windows.

Rows with a NULL id, label or vector, or with a NULL or non-finite component (also after scaling), take no part. Vectors only
meet vectors of their own number of components; those without components score 0. Rows equal in id, label and vector
count once; rows that share only the id are candidates and anchors each for itself. An anchor without positives, or a positive without negatives,
has no row; an empty table has none. Labels are whole numbers. No text is read, and other columns of the input are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalis.llm.common import col
from zonalis.sources.stage import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95
LEAF = 48  # a node with so many members is not taken apart
SHARD_BYTES = 32 << 20  # of vectors in a shard, and of anchors in a slice
PROBE = 2048  # members that tell whether a larger node falls apart
QUERIES = 256  # anchors that are scored together
TILE, FIRST = 1 << 20, 64  # scores held at once, and candidates for which the first are taken
BOUNDS = 1 << 23  # upper bounds held at once
EXACT, EXACT_SINGLE = 1 << 53, 1 << 24
ROOM = 1e-6  # share of the greatest possible score by which bounds are widened


class CoverTree:
    """Nodes with centre, covering radius (as an angle) and children; leaves with the places of their members."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        squares = np.einsum("ij,ij->i", points, points)
        self.length = math.sqrt(float(squares.max(initial=0.0)))
        longer = np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))
        self.points = np.column_stack([points, longer])
        self.centre: list[int] = []
        self.angle: list[float] = []
        self.children: list[np.ndarray] = []
        self.members: list[np.ndarray] = []
        if not len(points):
            return
        everyone = np.arange(len(points))
        todo = [self._node(0, everyone, self._distance(everyone, 0))]
        while todo:
            node, distance = todo.pop()
            parts = self._parts(self.members[node], distance, leaf)
            if parts:
                made = [self._node(*part) for part in parts]
                self.children[node] = np.array([n for n, _ in made])
                todo += made

    def _distance(self, members: np.ndarray, centre: int) -> np.ndarray:
        apart = self.points[members] - self.points[centre]
        return np.sqrt(np.einsum("ij,ij->i", apart, apart))

    def _node(self, centre: int, members: np.ndarray, distance: np.ndarray) -> tuple[int, np.ndarray]:
        radius = float(distance.max())
        self.centre.append(centre)
        self.angle.append(2 * math.asin(min(1.0, radius / (2 * self.length))) if self.length else 0.0)
        self.children.append(np.zeros(0, np.int64))
        self.members.append(members)
        return len(self.centre) - 1, distance

    def _parts(self, members: np.ndarray, distance: np.ndarray, leaf: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Members by nearest centre, centres further apart than the largest power of two below the radius; none if they are too many."""
        radius = float(distance.max())
        if len(members) <= leaf or radius == 0.0 or not math.isfinite(radius):
            return []
        scale = 2.0 ** (math.ceil(math.log2(radius)) - 1)
        most = math.isqrt(len(members))
        if len(members) > 2 * PROBE:
            some = np.arange(0, len(members), len(members) // PROBE)
            if self._centres(members[some], distance[some], scale, most) is None:
                return []
        found = self._centres(members, distance, scale, most)
        if found is None:
            return []
        centres, nearest, distance = found
        return [(c, members[nearest == k], distance[nearest == k]) for k, c in enumerate(centres)]

    def _centres(self, members: np.ndarray, distance: np.ndarray, scale: float, most: int) -> tuple[list[int], np.ndarray, np.ndarray] | None:
        """Centres until all members are within ``scale`` of one, which of them is nearest and how far; nothing if there are too many."""
        # the first centre is the node's own, from which the distances were taken
        centres, nearest = [int(members[distance.argmin()])], np.zeros(len(members), np.int64)
        distance, points = distance.copy(), self.points[members]
        while distance.max() > scale:
            if len(centres) > most:
                return None
            far = int(distance.argmax())
            centres.append(int(members[far]))
            apart = points - points[far]
            own = np.sqrt(np.einsum("ij,ij->i", apart, apart))
            closer = own < distance
            nearest[closer] = len(centres) - 1
            distance[closer] = own[closer]
        return centres, nearest, distance

    def bounds(self, queries: np.ndarray, lengths: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product that a member of each node can have with each query."""
        most = lengths[:, None] * self.length
        if not np.isfinite(most).all():  # beyond what bounds can be computed for
            return np.full((len(queries), len(nodes)), -np.inf), np.full((len(queries), len(nodes)), np.inf)
        centres = self.points[[self.centre[n] for n in nodes], :-1]
        cosine = np.divide(queries @ centres.T, most, out=np.zeros((len(queries), len(nodes))), where=most > 0)
        apart = np.arccos(np.clip(cosine, -1.0, 1.0))
        reach = np.array([self.angle[n] for n in nodes])
        room = ROOM * (most + 1.0)
        lowest = most * np.cos(np.minimum(apart + reach, np.pi)) - room
        return lowest, most * np.cos(np.maximum(apart - reach, 0.0)) + room


def _hundredth(limits: np.ndarray, kind: type, up: bool) -> np.ndarray:
    """Whole limits of 100 * score as whole limits of the score; infinite ones stay."""
    out = limits.astype(kind)
    finite = np.abs(limits.astype(float)) < np.inf
    whole = limits[finite].astype(object if kind is object else np.int64)
    out[finite] = -(-whole // 100) if up else whole // 100
    return out


class Best:
    """The best rows of each window of each query: 100 * score between ``low`` and ``high``, and not NaN."""

    def __init__(self, low: np.ndarray, high: np.ndarray, keep: int, kind: type) -> None:
        self.low, self.high, self.keep = _hundredth(low, kind, True), _hundredth(high, kind, False), keep
        self.score = np.full((*low.shape, keep), -np.inf, kind)
        self.place = np.full((*low.shape, keep), -1, np.int64)

    def least(self, queries: np.ndarray) -> np.ndarray:
        """What a score must reach, for each window of some queries, to be among the best."""
        return np.maximum(self.low[queries], self.score[queries, :, -1])

    def add(self, queries: np.ndarray, places: np.ndarray, scores: np.ndarray, fit: np.ndarray) -> None:
        """Scores of some queries with candidates at rising ``places``, where ``fit``."""
        least = self.least(queries)
        enough = scores >= least.min(axis=1)[:, None]
        enough &= fit
        enough &= scores <= self.high[queries].max(axis=1)[:, None]
        at = np.flatnonzero(enough)
        if not len(at):
            return
        row, column = np.divmod(at, len(places))
        score, place = scores[row, column], places[column]
        for w in range(self.low.shape[1]):
            inside = np.flatnonzero((score >= least[row, w]) & (score <= self.high[queries[row], w]))
            # of a score that is held already only smaller places count
            held, held_at = self.score[queries, w, -1][row[inside]], self.place[queries, w, -1][row[inside]]
            inside = inside[(score[inside] > held) | ((score[inside] == held) & (place[inside] < held_at))]
            if not len(inside):
                continue
            # what has been found and what is new, by query, score and place
            mine = np.unique(row[inside])
            old_row, old_rank = np.nonzero(self.place[queries[mine], w] >= 0)
            old = queries[mine[old_row]]
            rows = np.concatenate([mine[old_row], row[inside]])
            values = np.concatenate([self.score[old, w, old_rank], score[inside]])
            at = np.concatenate([self.place[old, w, old_rank], place[inside]])
            order = np.lexsort((at, -values, rows))
            begin = np.flatnonzero(np.diff(rows[order], prepend=-1))
            rank = np.arange(len(order)) - np.repeat(begin, np.diff(begin, append=len(order)))
            order, rank = order[rank < self.keep], rank[rank < self.keep]
            self.score[queries[rows[order]], w, rank] = values[order]
            self.place[queries[rows[order]], w, rank] = at[order]


Pairing = Callable[[np.ndarray, np.ndarray], np.ndarray]


def search(tree: CoverTree, exact: np.ndarray, queries: np.ndarray, best: Best, fits: Pairing, near: Pairing = lambda rows, places: places) -> None:
    """Fill ``best`` for all queries, each opening its nodes from the greatest upper bound down.

    ``exact`` holds the candidates as they are scored, ``fits`` tells which candidates may be with which queries, and ``near``
    leaves out candidates that may be with none of them.
    """
    if not len(tree.centre):
        return
    for rows in _cut(np.arange(len(queries)), max(1, BOUNDS // len(tree.centre))):
        _search(tree, exact, queries, rows, best, fits, near)


def _cut(values: np.ndarray, size: int) -> list[np.ndarray]:
    return [values[i : i + size] for i in range(0, len(values), size)]


def _score(exact: np.ndarray, queries: np.ndarray, rows: np.ndarray, places: np.ndarray, best: Best, fits: Pairing, near: Pairing) -> None:
    """All products of some queries with a leaf, in tiles. The first is small: what it finds leaves out most of the others."""
    for some in _cut(rows, QUERIES):
        own, rest, size = queries[some], near(some, places), FIRST
        while len(rest):
            now, rest = rest[:size], rest[size:]
            best.add(some, now, own @ exact[now].T, fits(some, now))
            size = min(4 * size, max(1, TILE // len(some)))


def _search(tree: CoverTree, exact: np.ndarray, queries: np.ndarray, block: np.ndarray, best: Best, fits: Pairing, near: Pairing) -> None:
    """The search for the queries of a block of neighbours."""
    plain, first = queries[block].astype(float), block[0]
    lengths = np.sqrt(np.einsum("ij,ij->i", plain, plain))
    upper = np.full((len(block), len(tree.centre)), -np.inf, np.float32)  # bounds have more room than rounding takes

    def enter(rows: np.ndarray, nodes: np.ndarray) -> None:
        lowest, greatest = tree.bounds(plain[rows], lengths[rows], nodes)
        least, most = best.least(first + rows).astype(float), best.high[first + rows].astype(float)
        wanted = np.zeros(lowest.shape, bool)
        for w in range(least.shape[1]):
            wanted |= (greatest >= least[:, w, None]) & (lowest <= most[:, w, None])
        upper[np.ix_(rows, nodes)] = np.where(wanted, greatest, -np.inf)

    active = np.arange(len(block))
    enter(active, np.array([0]))
    while len(active):
        node = np.concatenate([upper[some].argmax(axis=1) for some in _cut(active, max(1, TILE // len(tree.centre)))])
        bound = upper[active, node]
        going = (bound > -np.inf) & (bound >= best.least(first + active).astype(float).min(axis=1))
        active, node = active[going], node[going]
        upper[active, node] = -np.inf
        order = np.argsort(node, kind="stable")
        begin = np.flatnonzero(np.diff(node[order], prepend=-1))
        for opened, rows in zip(node[order][begin].tolist(), np.split(active[order], begin[1:]), strict=False):
            if len(tree.children[opened]):
                for some in _cut(rows, max(1, TILE // len(tree.children[opened]))):
                    enter(some, tree.children[opened])
            else:
                _score(exact, queries, first + rows, np.sort(tree.members[opened]), best, fits, near)


def _packed(values: np.ndarray, lengths: np.ndarray) -> pa.BinaryArray:
    """Vectors of whole components, one after the other, as bytes: two for each component where these are below 2 ** 15, else eight."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    width = np.where(np.bincount(row[np.abs(values) >= 1 << 15], minlength=len(lengths)) > 0, 8, 2)
    offsets = np.concatenate([[0], np.cumsum(lengths * width)])
    if (width == 2).all():
        data = values.astype("<i2")
    else:
        data = np.zeros(int(offsets[-1]), np.uint8)
        within = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = offsets[row] + width[row] * within
        for size, kind in ((2, "<i2"), (8, "<f8")):
            mine = width[row] == size
            data[at[mine, None] + np.arange(size)] = values[mine].astype(kind).view(np.uint8).reshape(-1, size)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _matrix(vectors: pa.ChunkedArray, dimensions: int) -> np.ndarray:
    out = np.zeros((len(vectors), dimensions))
    if not out.size:
        return out
    packs = pa.concat_arrays(vectors.cast(pa.binary()).chunks)
    offsets = np.frombuffer(packs.buffers()[1], np.int32)[packs.offset : packs.offset + len(packs) + 1].astype(np.int64)
    data = np.frombuffer(packs.buffers()[2], np.uint8)
    for size, kind in ((2, "<i2"), (8, "<f8")):
        mine = np.flatnonzero(np.diff(offsets) == size * dimensions)
        if len(mine) == len(out):
            return data[offsets[0] : offsets[-1]].view(kind).reshape(out.shape).astype(float)
        for some in _cut(mine, max(1, TILE // (size * dimensions))):
            out[some] = data[offsets[some, None] + np.arange(size * dimensions)].view(kind)
    return out


def _distinct(ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The places of the rows by id and label, equal rows once."""
    order = np.lexsort((labels, ids))
    again = (np.diff(ids[order]) == 0) & (np.diff(labels[order]) == 0)
    if again.any():
        alike = np.concatenate([again, [False]]) | np.concatenate([[False], again])
        some = order[alike]
        _, one = np.unique(np.column_stack([ids[some], labels[some], points[some].view(np.int64)]), axis=0, return_index=True)
        order = np.concatenate([order[~alike], some[one]])
        order = order[np.lexsort((labels[order], ids[order]))]
    return order


def _limits(lists: pa.ChunkedArray, windows: int, absent: float, kind: type) -> np.ndarray:
    """Lists of whole numbers, as text, as the rows of a matrix."""
    out = np.full((len(lists), windows), absent, object if kind is object else float)
    given = np.arange(windows) < pc.list_value_length(lists).to_numpy()[:, None]
    values = pc.list_flatten(lists)
    out[given] = [int(x) for x in values.to_pylist()] if kind is object else values.cast(pa.float64()).to_numpy()
    return out


def _searcher(same: bool, keep: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """Best candidates of one shard for one slice of anchors, with one window for each entry of ``low`` and ``high``."""

    def run(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        dimensions = key[0].as_py()
        ids, labels = (rows.column(c).to_numpy() for c in ("id", "label"))
        points = _matrix(rows.column("v"), dimensions)
        one = _distinct(ids, labels, points)
        if same:  # of one label by id, as they are by place
            one = one[np.argsort(labels[one], kind="stable")]
            anchors = anchors.sort_by("label")
        ids, labels, points = ids[one], labels[one], points[one]
        asked = _matrix(anchors.column("v"), dimensions)
        own, own_label = (anchors.column(c).to_numpy() for c in ("id", "label"))
        exact = 100.0 * dimensions * np.abs(points).max(initial=1.0) * np.abs(asked).max(initial=1.0) < EXACT
        tree = CoverTree(points)
        # no sum of products is beyond the product of the lengths
        single = exact and 1.01 * tree.length * math.sqrt(np.einsum("ij,ij->i", asked, asked).max(initial=0.0)) < EXACT_SINGLE
        kind = np.float32 if single else float if exact else object
        whole = lambda m: m.astype(kind) if exact else np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)
        points, asked = whole(points), whole(asked)
        if same:
            shape = (len(asked), 1)
            low, high = np.full(shape, -np.inf), np.full(shape, np.inf)
        else:
            windows = pc.max(pc.list_value_length(anchors.column("scores"))).as_py() or 1
            low, high = _limits(anchors.column("low"), windows, np.inf, kind), _limits(anchors.column("high"), windows, -np.inf, kind)
        best = Best(low, high, keep, kind)
        codes = np.unique(np.concatenate([labels, own_label]), return_inverse=True)[1].astype(np.int32)
        code, own_code = codes[: len(labels)], codes[len(labels) :]
        if codes.max(initial=0) < 1 << 7:
            code, own_code = code.astype(np.int8), own_code.astype(np.int8)

        def fits(queries: np.ndarray, places: np.ndarray) -> np.ndarray:
            if same:
                return (own_code[queries, None] == code[None, places]) & (own[queries, None] != ids[None, places])
            return own_code[queries, None] != code[None, places]

        def near(queries: np.ndarray, places: np.ndarray) -> np.ndarray:
            if not same:
                return places
            first, last = np.searchsorted(code[places], own_code[queries[0]], "left"), np.searchsorted(code[places], own_code[queries[-1]], "right")
            return places[first:last]

        search(tree, points, asked, best, fits, near)
        query, window, rank = np.nonzero(best.place >= 0)
        found = best.place[query, window, rank]
        score = best.score[query, window, rank]
        limit = (1 << 63) - 1
        score = score.astype(np.int64) if exact else np.array([max(-limit - 1, min(limit, int(s))) for s in score.tolist()], np.int64)
        columns = [own[query], anchors.column("mark").to_numpy()[query], window.astype(np.int32), ids[found], score]
        return pa.table(columns, names=["id", "mark", "window", "found", "score"])

    return run


def _whole(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = vectors.flatten().to_numpy(zero_copy_only=False).astype(float) * scale
                # from 2 ** 53 on doubles are whole numbers; there is no -0
                whole = np.where(np.abs(scaled) >= EXACT, scaled, np.floor(scaled) + 0.0)
            row = np.repeat(np.arange(len(lengths)), lengths)
            good = np.bincount(row[~np.isfinite(whole)], minlength=len(lengths)) == 0
            kept = _packed(whole[good[row]], lengths[good])
            ids, labels = (batch.column(c).filter(pa.array(good)) for c in (0, 1))
            yield pa.RecordBatch.from_arrays([ids, labels, kept, pa.array(lengths[good].astype(np.int32))], ["id", "label", "v", "d"])

    return run


def vectors_of(df: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """``id``, ``label``, whole components as bytes ``v`` and their number ``d`` of the rows that take part."""
    rows = df.select(col(vec_id).cast("long").alias("id"), col(label).cast("long").alias("label"), col(vector).cast("array<double>").alias("v"))
    return rows.dropna().mapInArrow(_whole(scale), "id long, label long, v binary, d int")


def mine(
    df: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; anchors are the rows where ``is_anchor``.

    ``is_anchor`` is an expression over ``id`` and ``label``.
    """
    spark = df.sparkSession
    rows = staged(vectors_of(df, vec_id, vector, label, scale), "vectors")
    asked = rows.where(is_anchor).distinct().withColumn("mark", F.xxhash64("label", "v"))
    asked = staged(asked, "anchors")
    sizes = [8 * (t.agg(F.sum(F.col("d") + 8)).first()[0] or 1) for t in (rows, asked)]
    shards = max(math.ceil(sizes[0] / SHARD_BYTES), 2 * spark.sparkContext.defaultParallelism)
    slices = math.ceil(sizes[1] / SHARD_BYTES)

    dealt = rows.withColumns({"shard": F.pmod(F.xxhash64("id", "label", "v"), F.lit(shards)), "slice": F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))})
    key = ["d", "shard", "slice"]

    def answers(anchors: DataFrame, same: bool, keep: int) -> DataFrame:
        spread = anchors.withColumn("slice", F.pmod(F.xxhash64("id", "mark"), F.lit(slices)).cast("int"))
        spread = spread.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
        both = dealt.groupBy(*key).cogroup(spread.groupBy(*key))
        found = both.applyInArrow(_searcher(same, keep), "id long, mark long, window int, found long, score long")
        # at most ``keep`` rows of each shard for a window
        ordered = F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("below"), "found", "score")))
        return found.groupBy("id", "mark", "window").agg(F.slice(ordered, 1, keep).alias("best"))

    near = answers(asked, True, positives).select("id", "mark", F.col("best").alias("near"))
    edge = lambda share: F.transform("near", lambda p: (p["score"].cast("decimal(20,0)") * share).cast("string"))
    windows = asked.join(near, ["id", "mark"]).withColumns({"scores": F.col("near.score"), "low": edge(low), "high": edge(high)})
    windows = staged(windows, "windows")
    hard = answers(windows.drop("near"), False, negatives)
    each = hard.join(windows.select("id", "mark", "near"), ["id", "mark"]).select("id", F.get("near", "window").alias("p"), F.posexplode("best").alias("rank", "n"))
    return each.select(
        F.col("id").alias("anchor_id"),
        F.col("p.found").alias("positive_id"),
        (F.col("rank") + 1).alias("rank"),
        F.col("n.found").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )
