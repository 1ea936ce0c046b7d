"""Mergeable co-moments, correlation tables and regression lines per facet."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Normal quantile of a 95 % band, points on a drawn line, limits of the vote axis.
Z_975 = 1.959963984540054
LINE_POINTS = 80
VOTE_AXIS = (0.0, 80.0)

EXACT_T = 30


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN in the columns."""
    return df.na.drop("any", subset=list(columns or df.columns))


MOMENT_TYPE = "model int, fold int, n bigint, mean array<double>, co array<double>"
# Partial results that are merged at a time; two rounds of merging take the square of it.
MERGED = 512


@dataclass
class Moments:
    """Number of rows, means and sums of products of differences to the means: what two sets of rows need to be put together.

    Nothing is summed around 0, so a large mean does not hide the variance, and a constant column has means that are
    that constant and products that are 0, whatever the order of merging.
    """

    n: int
    mean: np.ndarray
    co: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        first = rows[0]
        apart = rows - first
        mean = apart.mean(0)
        # a constant column: its differences to the first row are 0
        apart -= mean
        return Moments(len(rows), first + mean, apart.T @ apart)

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        step = other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n), self.co + other.co + np.outer(step, step) * (self.n * other.n / n))


def _moment_batch(found: dict[tuple[int, int], Moments]) -> pa.RecordBatch:
    """One row for each model and fold; products as the upper triangle, row by row."""
    upper = np.triu_indices(len(next(iter(found.values())).mean)) if found else ()
    arrays = [
        pa.array([k[0] for k in found], pa.int32()),
        pa.array([k[1] for k in found], pa.int32()),
        pa.array([m.n for m in found.values()], pa.int64()),
        pa.array([m.mean for m in found.values()], pa.list_(pa.float64())),
        pa.array([m.co[upper] for m in found.values()], pa.list_(pa.float64())),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["model", "fold", "n", "mean", "co"])


def _read_moments(table: pa.Table) -> Iterator[tuple[tuple[int, int], Moments]]:
    models, folds, counts = (table.column(c).to_pylist() for c in ("model", "fold", "n"))
    for k, (model, fold, n) in enumerate(zip(models, folds, counts, strict=True)):
        mean, flat = (np.asarray(table.column(c)[k].values) for c in ("mean", "co"))
        co = np.zeros((len(mean), len(mean)))
        co[np.triu_indices(len(mean))] = flat
        yield (model, fold), Moments(n, mean, np.where(np.tri(len(mean), k=-1, dtype=bool), co.T, co))


def _partial_moments(models: Sequence[Sequence[int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each model the fold is one column of the input, and its values are others; rows with a gap in any of them are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], Moments] = {}
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            for model, (fold, *columns) in enumerate(models):
                rows, folds = values[:, columns], values[:, fold]
                whole = ~np.isnan(rows).any(1) & ~np.isnan(folds)
                for number in np.unique(folds[whole]):
                    part = Moments.of(rows[whole & (folds == number)])
                    key = model, int(number)
                    found[key] = found[key] + part if key in found else part
        yield _moment_batch(found)

    return run


def _merge_moments(table: pa.Table) -> pa.Table:
    found: dict[tuple[int, int], Moments] = {}
    for key, part in _read_moments(table):
        found[key] = found[key] + part if key in found else part
    return pa.Table.from_batches([_moment_batch(found)])


def moments(df: DataFrame, models: Sequence[tuple[Column | None, Sequence[str]]]) -> DataFrame:
    """``model, fold, n, mean, co`` of the complete rows of each model, in one pass for all of them.

    A model is a fold (none: 0 for all rows) and its columns. Each task reduces its rows to one triangle for each model and
    fold. These are merged in two rounds, of which the first splits them by the task they come from.
    """
    names = list(dict.fromkeys(c for _, columns in models for c in columns))
    values = [F.col(f"`{c}`").cast("double").alias(f"v{k}") for k, c in enumerate(names)]
    folds = [(F.lit(0) if fold is None else fold).cast("int").alias(f"fold{k}") for k, (fold, _) in enumerate(models)]
    places = [[len(names) + k, *[names.index(c) for c in columns]] for k, (_, columns) in enumerate(models)]
    partial = df.select(*values, *folds).mapInArrow(_partial_moments(places), MOMENT_TYPE)
    partial = partial.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(MERGED)))
    once = partial.groupBy("model", "fold", "part").applyInArrow(_merge_moments, MOMENT_TYPE)
    return once.groupBy("model", "fold").applyInArrow(_merge_moments, MOMENT_TYPE)


def moments_by_model(df: DataFrame, models: Sequence[tuple[Column | None, Sequence[str]]]) -> list[dict[int, Moments]]:
    """:func:`moments` of each model by fold, on the driver; their size depends on the columns only."""
    found: list[dict[int, Moments]] = [{} for _ in models]
    for (model, fold), m in _read_moments(moments(df, models).toArrow()):
        found[model][fold] = m
    return found


def correlation_matrix(
    df: DataFrame, columns: Sequence[str], rows: Sequence[str] | None = None, others: Sequence[str] | None = None
) -> DataFrame:
    """Pearson correlations of the complete rows, long: ``(var, var_cor, corr)``.

    Of ``rows`` with ``others``, by default of all columns with all; complete rows are those without a gap in any of
    ``columns``. A constant column has no correlation: NULL.
    """
    k = len(columns)
    names = F.array(*[F.lit(c) for c in columns])
    cell = lambda i, j: f"get(co, CAST({i} * {k} - {i} * ({i} - 1) / 2 + {j} - {i} AS INT))"
    low, high = "least(i, j)", "greatest(i, j)"
    corr = f"CASE WHEN i <> j THEN try_divide({cell(low, high)}, sqrt({cell('i', 'i')}) * sqrt({cell('j', 'j')})) WHEN {cell('i', 'i')} > 0 THEN 1D END"
    places = f"flatten(transform(sequence(0, {k - 1}), i -> transform(sequence(0, {k - 1}), j -> named_struct('i', i, 'j', j, 'corr', {corr}))))"
    # the global aggregate is one row, whether there are complete rows or not
    whole = moments(df, [(None, columns)]).agg(F.first("co").alias("co"))
    pairs = whole.select(F.inline(F.expr(places))).select(F.get(names, "i").alias("var"), F.get(names, "j").alias("var_cor"), "corr")
    for name, some in (("var", rows), ("var_cor", others)):
        pairs = pairs if some is None else pairs.where(F.col(name).isin(list(some)))
    return pairs


def has_prefix(column: Column, prefixes: Sequence[str]) -> Column:
    test = F.lit(False)
    for p in prefixes:
        test = test | column.startswith(p)
    return test


def ranked_correlations(matrix: DataFrame, outcomes: Sequence[str], excluded: Sequence[str]) -> DataFrame:
    """Correlations of outcome variables with all others, strongest first per outcome.

    ``outcomes`` are prefixes of the rows to keep, ``excluded`` of the columns to drop.
    """
    return (
        matrix.filter(has_prefix(F.col("var"), outcomes) & ~has_prefix(F.col("var_cor"), excluded))
        .withColumn("corr_abs", F.abs("corr"))
        .orderBy("var", F.desc_nulls_last("corr_abs"), "var_cor")
    )


def correlation_shift(ranked: DataFrame, now: str, before: str) -> DataFrame:
    """Correlations with two outcomes side by side, and how far they moved."""
    table = (
        ranked.filter(F.col("var").isin(now, before))
        .groupBy("var_cor")
        .pivot("var", [now, before])
        .agg(F.first("corr", ignorenulls=True))
    )
    return table.withColumn("evol15_19", F.abs(F.col(now) - F.col(before))).withColumn("abs_paso19", F.abs(F.col(now)))


def within(column: Column, limits: tuple[float, float] = VOTE_AXIS) -> Column:
    return column.between(*limits)


def regression_lines(df: DataFrame, facet: str, x: str, y: str) -> DataFrame:
    """Least-squares line of each facet, with what its confidence band needs."""
    moments = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(facet).agg(
        F.regr_count(y, x).alias("n"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_avgx(y, x).alias("mean_x"),
        F.regr_sxx(y, x).alias("sxx"),
        (F.regr_syy(y, x) - F.regr_slope(y, x) * F.regr_sxy(y, x)).alias("rss"),
        F.min(x).alias("min_x"),
        F.max(x).alias("max_x"),
    )
    return moments.withColumn("sigma", F.expr("if(n > 2, sqrt(greatest(rss, 0D) / (n - 2)), NULL)")).drop("rss")


def exact_t(df: int, p: float) -> float:
    """Student quantile for a whole number of degrees of freedom, by halving an interval around it."""

    def inside(t: float) -> float:
        """Probability between -t and t, a finite sum."""
        angle = math.atan(t / math.sqrt(df))
        term = total = math.sin(angle) * (math.cos(angle) if df % 2 else 1.0)
        for k in range(2 + df % 2, df - 1, 2):
            term *= math.cos(angle) ** 2 * (k - 1) / k
            total += term
        return 2 / math.pi * (angle + (total if df > 1 else 0.0)) if df % 2 else total

    low, high = 0.0, 1e6
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if inside(middle) < 2 * p - 1 else (low, middle)
    return (low + high) / 2


def t_quantile(df: Column, z: float = Z_975) -> Column:
    """Student quantile: exact up to EXACT_T degrees of freedom, the expansion in ``1 / df`` beyond them."""
    p = 0.5 * (1 + math.erf(z / math.sqrt(2)))
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    series = F.lit(z)
    for power, term in enumerate(terms, 1):
        series = series + F.lit(term) / F.pow(df, F.lit(power))
    exact = F.array(*[F.lit(exact_t(n, p)) for n in range(1, EXACT_T + 1)])
    return F.when(df.between(1, EXACT_T), F.get(exact, (df - 1).cast("int"))).when(df > EXACT_T, series)


def band(lines: DataFrame, facet: str, points: int = LINE_POINTS) -> DataFrame:
    """Points on each line with the lower and upper end of its 95 % band."""
    step = (F.col("max_x") - F.col("min_x")) / (points - 1)
    grid = lines.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn(
        "x", F.col("min_x") + step * F.col("step")
    )
    off = F.col("x") - F.col("mean_x")
    half = (
        t_quantile(F.col("n") - 2)
        * F.col("sigma")
        * F.sqrt(F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(off * off, F.col("sxx")))
    )
    fit = F.col("intercept") + F.col("slope") * F.col("x")
    return grid.select(facet, "step", "x", fit.alias("y"), (fit - half).alias("low"), (fit + half).alias("high"))


def facet_series(
    df: DataFrame, keep: Sequence[str], facets: Sequence[str], labels: dict[str, str], name: str, value: str
) -> DataFrame:
    """Chart series: chosen columns, complete rows, one row per facet, labelled."""
    from zonalis.functions import recode
    from zonalis.operators.reshape import to_long

    chosen = complete_rows(df.select(*keep, *facets))
    return to_long(chosen, keep, facets, name, value).withColumn(name, recode(F.col(name), labels))


def paired_series(df: DataFrame, pairs: Sequence[tuple[str, str, str]], x: str, y: str) -> DataFrame:
    """Two elections of each party stacked under common names, with the distance from equality."""
    from zonalis.operators.reshape import stack

    parts = [df.select(F.col(a).alias(x), F.col(b).alias(y), F.lit(label).alias("facet")) for a, b, label in pairs]
    return complete_rows(stack(parts)).withColumn("diff", F.col(y) - F.col(x))


def category_rank(column: Column, order: Sequence[str]) -> Column:
    """Sort rank: the listed categories in that order, then the rest."""
    rank = F.lit(len(order))
    for i, label in reversed(list(enumerate(order))):
        rank = F.when(column == label, F.lit(i)).otherwise(rank)
    return rank


SCORE_TYPE = T.StructType(
    [T.StructField("model", T.IntegerType()), T.StructField("fold", T.IntegerType()), T.StructField("size", T.IntegerType()), T.StructField("n", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in ("abs_error", "sq_error", "p", "pp", "y", "yy", "py")]
)
