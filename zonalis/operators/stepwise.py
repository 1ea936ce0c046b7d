"""Forward selection of linear-regression variables, with cross-validation.

Spark reduces the rows to one matrix of product sums per fold. The search itself only needs these
matrices, whose size depends on the number of columns and not on the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from zonalis.operators.joins import left_join
from zonalis.operators.statistics import SCORE_TYPE, Moments, moments_by_model

FOLDS = 10
MAX_SIZE = 10
REPORTED_SIZE = 4
# Folds by outcome: number of strata, steps in which quantiles are looked for, and rows numbered at a time.
STRATA = 4
GRID = 4096
SLICE = 200_000
# A candidate whose variance is explained to this degree by the chosen ones is redundant.
TOLERANCE = 1e-7
GAIN_DIGITS = 10

STEP_TYPE = "size int, added string, rss double, r2 double"
COEFFICIENT_TYPE = "size int, term string, estimate double"


@dataclass
class Step:
    size: int
    added: str
    rss: float
    r2: float
    coefficients: dict[str, float] = field(default_factory=dict)


def forward_path(moments: Moments, features: Sequence[str], max_size: int = MAX_SIZE) -> list[Step]:
    """Best variable to add at each size.

    ``moments`` are those of the features and the outcome, in that order. Works on the correlation scale; equal gains (exact complements)
    go to the first column.
    """
    level, co = moments.mean, moments.co
    scale = np.sqrt(np.clip(np.diag(co), 0, None))
    usable = scale > 0
    unit = np.where(usable, scale, 1.0)
    left = co / np.outer(unit, unit)
    p = len(features)
    corr = left.copy()
    total = float(co[p, p])
    chosen: list[int] = []
    steps: list[Step] = []
    for size in range(1, min(max_size, p) + 1):
        free = np.diag(left)[:p].copy()
        allowed = usable[:p] & (free > TOLERANCE)
        allowed[chosen] = False
        if not allowed.any():
            break
        gain = np.where(allowed, left[:p, p] ** 2 / np.where(allowed, free, 1.0), -1.0)
        best = int(np.argmax(np.round(gain, GAIN_DIGITS)))
        chosen.append(best)
        # partial out the new variable
        left = left - np.outer(left[:, best], left[best, :]) / left[best, best]
        beta = np.linalg.solve(corr[np.ix_(chosen, chosen)], corr[chosen, p]) * unit[p] / unit[chosen]
        rss = float(max(left[p, p], 0.0) * total)
        coefficients = {"(Intercept)": float(level[p] - beta @ level[chosen])}
        coefficients.update({features[c]: float(b) for c, b in zip(chosen, beta, strict=True)})
        steps.append(Step(size, features[best], rss, 1 - rss / total if total else float("nan"), coefficients))
    return steps


def hash_fold(keys: Sequence[str], folds: int = FOLDS) -> Column:
    """Fold of a row by a hash of its key: the same on every run."""
    return F.pmod(F.xxhash64(*keys), F.lit(folds)).cast("int")


def _score(models: Sequence[tuple[Sequence[int], dict[int, np.ndarray]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Error sums per model, fold and size. A model has the places of its fold, features and outcome, and weights
    by fold with one row for each size; rows with a gap in any of them are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            for model, ((fold, *columns), weights) in enumerate(models):
                rows, folds = values[:, columns], values[:, fold]
                whole = ~np.isnan(rows).any(1)
                for number, table in weights.items():
                    own = rows[whole & (folds == number)]
                    if not len(own):
                        continue
                    y = own[:, -1:]
                    p = table[:, 0] + own[:, :-1] @ table[:, 1:].T
                    e = y - p
                    each = np.ones((1, len(table)))
                    sums = [np.abs(e).sum(0), (e * e).sum(0), p.sum(0), (p * p).sum(0), y.sum() * each[0], (y * y).sum() * each[0], (p * y).sum(0)]
                    found = np.stack([len(own) * each[0], *sums], axis=1)
                    totals[model, number] = totals.get((model, number), 0.0) + found
        for (model, number), sums in totals.items():
            size = np.arange(1, len(sums) + 1, dtype=np.int32)
            same = [pa.array(np.full(len(size), k, dtype=np.int32)) for k in (model, number)]
            columns = [pa.array(sums[:, 0].astype(np.int64)), *[pa.array(sums[:, k]) for k in range(1, sums.shape[1])]]
            yield pa.RecordBatch.from_arrays([*same, pa.array(size), *columns], names=SCORE_TYPE.names)

    return run


@dataclass
class ForwardSelection:
    """Result of :func:`forward_selection`."""

    spark: SparkSession
    path: list[Step]
    fold_scores: DataFrame
    rows: int = 0

    def steps(self) -> DataFrame:
        """``size, added, rss, r2`` of the search over all rows."""
        return self.spark.createDataFrame([(s.size, s.added, s.rss, s.r2) for s in self.path], STEP_TYPE)

    def coefficients(self, size: int = REPORTED_SIZE) -> DataFrame:
        rows = [(s.size, t, v) for s in self.path if s.size == size for t, v in s.coefficients.items()]
        return self.spark.createDataFrame(rows, COEFFICIENT_TYPE)

    def cv_results(self) -> DataFrame:
        """Mean and standard deviation over folds of RMSE, squared correlation and MAE per size."""
        n = F.col("n")
        cov = F.col("py") - F.col("p") * F.col("y") / n
        spread = (F.col("pp") - F.col("p") * F.col("p") / n) * (F.col("yy") - F.col("y") * F.col("y") / n)
        per_fold = self.fold_scores.select(
            "size",
            F.sqrt(F.col("sq_error") / n).alias("rmse"),
            F.try_divide(cov * cov, spread).alias("rsquared"),
            (F.col("abs_error") / n).alias("mae"),
        )
        names = ("rmse", "rsquared", "mae")
        return per_fold.groupBy(F.col("size").alias("nvmax")).agg(
            *[F.avg(c).alias(c) for c in names], *[F.stddev_samp(c).alias(f"{c}_sd") for c in names]
        )


def forward_selections(
    df: DataFrame, features: Sequence[str], outcomes: dict[str, Column], max_size: int = MAX_SIZE
) -> dict[str, ForwardSelection]:
    """For each outcome, search over all rows and, per fold, over the rows outside it; score each fold's rows.

    ``outcomes`` are columns with their folds. The rows of a model are those without a gap in the features and its outcome; those without a
    fold are left out. Two passes over the rows serve all models: one for the moments, and one for the errors when
    they are asked for. Persist or stage ``df`` if it is costly.
    """
    models = [(fold, [*features, outcome]) for outcome, fold in outcomes.items()]
    found = moments_by_model(df, models)
    position = {"(Intercept)": 0, **{f: i for i, f in enumerate(features, 1)}}
    weights: list[dict[int, np.ndarray]] = []
    for by_fold in found:
        weights.append({})
        for number in by_fold:
            rest = [m for k, m in by_fold.items() if k != number]
            steps = forward_path(reduce(add, rest), features, max_size) if rest else []
            table = weights[-1][number] = np.zeros((len(steps), len(features) + 1))
            for s in steps:
                for term, value in s.coefficients.items():
                    table[s.size - 1, position[term]] = value
    values = [F.col(f"`{c}`").cast("double").alias(f"v{k}") for k, c in enumerate([*features, *outcomes])]
    folds = [fold.cast("int").alias(f"fold{k}") for k, fold in enumerate(outcomes.values())]
    places = [[len(values) + k, *range(len(features)), len(features) + k] for k in range(len(models))]
    scores = df.select(*values, *folds).mapInArrow(_score(list(zip(places, weights, strict=True))), SCORE_TYPE)
    scores = scores.groupBy("model", "fold", "size").agg(*[F.sum(c).alias(c) for c in SCORE_TYPE.names[3:]])
    out = {}
    for k, (outcome, by_fold) in enumerate(zip(outcomes, found, strict=True)):
        whole = reduce(add, by_fold.values()) if by_fold else None
        path = forward_path(whole, features, max_size) if whole else []
        out[outcome] = ForwardSelection(df.sparkSession, path, scores.where(F.col("model") == k), whole.n if whole else 0)
    return out


def forward_selection(
    df: DataFrame, outcome: str, features: Sequence[str], fold: Column, max_size: int = MAX_SIZE
) -> ForwardSelection:
    """:func:`forward_selections` for one outcome."""
    return forward_selections(df, features, {outcome: fold}, max_size)[outcome]


def stratified_folds(
    df: DataFrame, outcomes: Sequence[str], order: Sequence[str], folds: int = FOLDS, strata: int = STRATA, slices: Column | None = None
) -> DataFrame:
    """``df`` with ``fold_<outcome>`` for each outcome: folds that hold equal parts of every stratum of the outcome.

    Strata are bounded by the quantiles 1 / strata, 2 / strata, ... of the outcome, as far as GRID equal steps from its least to
    its greatest value tell them. Rows are numbered within a stratum by slice and then by ``order``, and dealt to the folds in
    turn, so that in each stratum the sizes of two folds differ by one at most. No stratum is sorted in one task: rows are numbered
    within a slice (by default a hash of ``order``, some SLICE rows each), and slices follow each other by their counts.
    Rows without an outcome (missing or not finite) have no fold for it; equal rows may change places.
    """
    ends = df.agg(F.count(F.lit(1)), *[f(_finite(y)) for y in outcomes for f in (F.min, F.max)]).first()
    count = ends[0]
    if slices is None:
        slices = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in order]), F.lit(math.ceil(count / SLICE) or 1))
    out = df.withColumn("__slice", slices)
    steps = {}
    for k, y in enumerate(outcomes):
        low, high = ends[1 + 2 * k], ends[2 + 2 * k]
        width = (high - low) if low is not None else 0.0
        step = F.least(F.floor((_finite(y) - F.lit(low)) * GRID / F.lit(width)), F.lit(GRID - 1)) if width else F.lit(0)
        steps[y] = F.when(_finite(y).isNotNull(), step.cast("int"))
    # rows per step: at most GRID numbers for each outcome reach the driver
    marked = out.select(*[s.alias(f"s{k}") for k, s in enumerate(steps.values())])
    counted = marked.unpivot([], [f"s{k}" for k in range(len(steps))], "y", "step").where("step IS NOT NULL").groupBy("y", "step").count().collect()
    for k, (y, step) in enumerate(steps.items()):
        per_step = np.zeros(GRID, np.int64)
        for r in counted:
            if r["y"] == f"s{k}":
                per_step[r["step"]] = r["count"]
        bounds = np.searchsorted(np.cumsum(per_step), [per_step.sum() * q / strata for q in range(1, strata)])
        stratum = F.lit(0)
        for b in np.unique(bounds).tolist():
            stratum = stratum + (step > b).cast("int")
        out = out.withColumn("__stratum", F.when(step.isNotNull(), stratum))
        key = ["__stratum", "__slice"]
        before = Window.partitionBy("__stratum").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
        starts = out.groupBy(*key).agg(F.count(F.lit(1)).alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        place = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(f"`{c}`") for c in order])) - 1
        numbered = left_join(out.withColumn("__place", place), starts.drop("__n"), key)
        fold = F.when(F.col("__stratum").isNotNull(), F.pmod(F.col("__before") + F.col("__place"), F.lit(folds))).cast("int")
        out = numbered.withColumn(f"fold_{y}", fold).drop("__before", "__place", "__stratum")
    return out.drop("__slice")


def _finite(name: str) -> Column:
    value = F.col(f"`{name}`").cast("double")
    return F.when(F.abs(value) < float("inf"), value)
