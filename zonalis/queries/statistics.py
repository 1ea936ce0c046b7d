"""Correlations, regression lines, chart series and forward selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from zonalis.operators.statistics import (
    LINE_POINTS,
    VOTE_AXIS,
    Z_975,
    band,
    correlation_matrix,
    correlation_shift,
    facet_series,
    paired_series,
    ranked_correlations,
    regression_lines,
    within,
)
from zonalis.operators.stepwise import GRID, ForwardSelection, forward_selection, stratified_folds
from zonalis.queries.registry import Tables, query
from zonalis.sources.stage import staged

# -- correlations ----------------------------------------------------------------------------------

_MEASURES = {
    "paso19_cand_FdT": "l_quantity",
    "paso15_cand_FPV": "l_extendedprice / 1000",
    "ho_tax": "CASE WHEN l_linenumber < 7 THEN l_tax END",
    "ho_discount": "l_discount",
    "per_line": "CAST(l_linenumber AS DOUBLE)",
    "per_part": "CAST(l_partkey % 13 AS DOUBLE) + l_quantity",
}


def _measures_sql() -> str:
    columns = ", ".join(f'{sql} as "{n}"' for n, sql in _MEASURES.items())
    return f"select * from (select {columns} from lineitem) where ho_tax is not null"


def _corr_sql() -> str:
    names = list(_MEASURES)
    pairs = [(a, b) for a in names for b in names]
    values = ", ".join(f'corr("{a}", "{b}") as c{i}' for i, (a, b) in enumerate(pairs))
    rows = " union all ".join(f"select '{a}' as var, '{b}' as var_cor, c{i} as corr from m" for i, (a, b) in enumerate(pairs))
    return f"with m as materialized (select {values} from ({_measures_sql()})) {rows}"


def _matrix(t: Tables) -> DataFrame:
    df = t.lineitem.selectExpr(*[f"{sql} AS {name}" for name, sql in _MEASURES.items()])
    return correlation_matrix(df, list(_MEASURES))


@query(f"select var, var_cor, round(corr, 6) as corr from ({_corr_sql()})")
def stat_corr_matrix(t: Tables) -> DataFrame:
    return _matrix(t).withColumn("corr", F.round("corr", 6))


@query(
    f"""select var, var_cor, round(corr, 6) as corr, round(abs(corr), 6) as corr_abs from ({_corr_sql()})
        where var like 'paso%' and var_cor not like 'paso%' order by var, corr_abs desc, var_cor"""
)
def stat_corr_ranked(t: Tables) -> DataFrame:
    ranked = ranked_correlations(_matrix(t), ["paso19_can", "paso15_can"], ["paso19", "paso15"])
    return ranked.withColumn("corr", F.round("corr", 6)).withColumn("corr_abs", F.round("corr_abs", 6))


@query(
    f"""with c as ({_corr_sql()}),
       p as (select var_cor, max(corr) filter (var = 'paso19_cand_FdT') as a, max(corr) filter (var = 'paso15_cand_FPV') as b
             from c where var_cor not like 'paso%' group by 1)
       select var_cor, round(a, 6) as "paso19_cand_FdT", round(b, 6) as "paso15_cand_FPV",
              round(abs(a - b), 6) as evol15_19, round(abs(a), 6) as abs_paso19 from p"""
)
def stat_corr_shift(t: Tables) -> DataFrame:
    ranked = ranked_correlations(_matrix(t), ["paso19_can", "paso15_can"], ["paso19", "paso15"])
    shift = correlation_shift(ranked, "paso19_cand_FdT", "paso15_cand_FPV")
    return shift.select("var_cor", *[F.round(c, 6).alias(c) for c in shift.columns[1:]])


# -- regression lines ------------------------------------------------------------------------------

_LINE_COLUMNS = {
    "n": "regr_count(y, x)::bigint",
    "slope": "round(regr_slope(y, x), 6)",
    "intercept": "round(regr_intercept(y, x), 6)",
    "r2": "round(regr_r2(y, x), 6)",
    "mean_x": "round(regr_avgx(y, x), 6)",
    "sxx": "round(regr_sxx(y, x), 2)",
    "min_x": "min(x)",
    "max_x": "max(x)",
    "sigma": "round(sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (regr_count(y, x) - 2)), 6)",
}
_POINTS_SQL = "select l_returnflag as facet, l_quantity as x, l_extendedprice / 1000 as y from lineitem"


def lines_sql(points: str, condition: str = "true") -> str:
    columns = ", ".join(f"{sql} as {name}" for name, sql in _LINE_COLUMNS.items())
    return f"select facet, {columns} from ({points}) where {condition} group by facet"


def rounded_lines(lines: DataFrame) -> DataFrame:
    digits = {"slope": 6, "intercept": 6, "r2": 6, "mean_x": 6, "sxx": 2, "sigma": 6}
    return lines.select("facet", *[F.round(c, digits[c]).alias(c) if c in digits else c for c in _LINE_COLUMNS])


def _points(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr("l_returnflag AS facet", "l_quantity AS x", "l_extendedprice / 1000 AS y")


@query(lines_sql(_POINTS_SQL))
def stat_ols_facet(t: Tables) -> DataFrame:
    return rounded_lines(regression_lines(_points(t), "facet", "x", "y"))


@query(lines_sql(_POINTS_SQL, f"y between {VOTE_AXIS[0]} and {VOTE_AXIS[1]}"))
def stat_ols_censored(t: Tables) -> DataFrame:
    """Points outside the vote axis do not enter the fit."""
    return rounded_lines(regression_lines(_points(t).filter(within(F.col("y"))), "facet", "x", "y"))


_T_SQL = " + ".join(
    f"{term!r}::double / pow(n - 2, {power})"
    for power, term in enumerate(
        [
            (Z_975**3 + Z_975) / 4,
            (5 * Z_975**5 + 16 * Z_975**3 + 3 * Z_975) / 96,
            (3 * Z_975**7 + 19 * Z_975**5 + 17 * Z_975**3 - 15 * Z_975) / 384,
        ],
        1,
    )
)


@query(
    f"""with m as (select facet, regr_count(y, x) as n, regr_slope(y, x) as b, regr_intercept(y, x) as a, regr_avgx(y, x) as mx,
                   regr_sxx(y, x) as sxx, min(x) as lo, max(x) as hi,
                   sqrt((regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (regr_count(y, x) - 2)) as s
                   from ({_POINTS_SQL}) group by facet),
            g as (select *, lo + (hi - lo) / {LINE_POINTS - 1} * step as x
                  from m, (select unnest(range(0, {LINE_POINTS}))::int as step)),
            h as (select *, ({Z_975!r}::double + {_T_SQL}) * s * sqrt(1.0 / n + (x - mx) * (x - mx) / sxx) as half from g)
        select facet, step, round(x, 4) as x, round(a + b * x, 4) as y, round(a + b * x - half, 4) as low,
               round(a + b * x + half, 4) as high from h"""
)
def stat_ols_band(t: Tables) -> DataFrame:
    """The drawn line and its 95 % band."""
    drawn = band(regression_lines(_points(t), "facet", "x", "y"), "facet")
    return drawn.select("facet", "step", *[F.round(c, 4).alias(c) for c in ("x", "y", "low", "high")])


# -- chart series ----------------------------------------------------------------------------------


@query(
    """with c as (select o_totalprice as y, (o_custkey % 100)::double as a, (o_orderkey % 7)::double as b from orders
                  where o_orderstatus <> 'P')
       select y, 'Clientes' as facet, a as x from c union all select y, 'orders_b', b from c"""
)
def series_facets(t: Tables) -> DataFrame:
    df = t.orders.selectExpr(
        "o_totalprice AS y",
        "CAST(o_custkey % 100 AS DOUBLE) AS orders_a",
        "if(o_orderstatus <> 'P', CAST(o_orderkey % 7 AS DOUBLE), NULL) AS orders_b",
    )
    return facet_series(df, ["y"], ["orders_a", "orders_b"], {"orders_a": "Clientes"}, "facet", "x")


@query(
    """with p as (select l_quantity as x, l_extendedprice / 1000 as y, 'FdT' as facet from lineitem
                  union all select l_discount, l_tax, 'JxC' from lineitem where l_linenumber < 7)
       select x, y, facet, y - x as diff from p"""
)
def series_paired(t: Tables) -> DataFrame:
    df = t.lineitem.selectExpr(
        "l_quantity AS a1", "l_extendedprice / 1000 AS a2", "l_discount AS b1", "if(l_linenumber < 7, l_tax, NULL) AS b2"
    )
    return paired_series(df, [("a1", "a2", "FdT"), ("b1", "b2", "JxC")], "x", "y")


# -- forward selection -----------------------------------------------------------------------------

# Two features add to 50, so one of them is always redundant.
_FEATURES = {
    "ho_q": "l_quantity",
    "ho_rest": "50 - l_quantity",
    "vi_disc": "l_discount * 100",
    "vi_tax": "l_tax * 100",
    "per_line": "CAST(l_linenumber AS DOUBLE)",
    "per_part": "CAST(l_partkey % 13 AS DOUBLE)",
}
_OUTCOME = (
    "3 * l_quantity - 4 * CAST(l_linenumber AS DOUBLE) + 2 * CAST(l_partkey % 13 AS DOUBLE) + l_discount * 100"
    " + CAST((l_partkey * 7919 + l_suppkey * 31) % 101 AS DOUBLE) / 4"
)
_FOLD = "CAST((l_orderkey * 31 + l_partkey) % 10 AS INT)"
_SIZE = 4


def model_sql(result: str, folds: Sequence[int], source: str, features: Sequence[str], max_size: int) -> str:
    """Forward selection in SQL for each training set: all rows but those of the fold (-1: all rows).

    Correlations are swept one chosen variable at a time: afterwards its row holds the coefficient and
    the outcome's diagonal the share of variance left. ``source`` yields the features, ``y`` and ``fold``.
    """
    names = [*features, "y"]
    pairs = [(i, j) for i in range(len(names)) for j in range(len(names)) if i <= j]
    corr = ", ".join(f"corr({names[i]}, {names[j]}) as c{i}_{j}" for i, j in pairs if i < j)
    stats = ", ".join(f"avg({n}) as mean_{k}, stddev_pop({n}) as sd_{k}" for k, n in enumerate(names))
    cells = " union all ".join(
        f"select f, {i} as i, {j} as j, {'1.0::double' if i == j else f'c{min(i, j)}_{max(i, j)}'} as v from m"
        for i in range(len(names))
        for j in range(len(names))
    )
    y = len(names) - 1
    label = "case i " + " ".join(f"when {k} then '{n}'" for k, n in enumerate(names)) + " end"
    mean = "case i " + " ".join(f"when {k} then mean_{k}" for k in range(len(names))) + " end"
    sd = "case i " + " ".join(f"when {k} then sd_{k}" for k in range(len(names))) + " end"
    steps = []
    for s in range(1, max_size + 1):
        chosen = " and ".join([f"(d.f, d.i) not in (select f, k from k{q})" for q in range(1, s)] or ["true"])
        steps.append(
            f"""k{s} as materialized (
                  select f, i as k from (
                    select d.f, d.i, row_number() over (partition by d.f order by round(g.v * g.v / d.v, 10) desc, d.i) as r
                    from r{s - 1} d join r{s - 1} g on g.f = d.f and g.i = d.i and g.j = {y}
                    where d.i = d.j and d.i < {y} and d.v > 1e-7 and {chosen}) where r = 1),
                r{s} as materialized (
                  select a.f, a.i, a.j, case when a.i = k and a.j = k then -1 / d.v when a.i = k or a.j = k then a.v / d.v
                                             else a.v - x.v * z.v / d.v end as v
                  from r{s - 1} a join k{s} on k{s}.f = a.f
                  join r{s - 1} d on d.f = a.f and d.i = k and d.j = k
                  join r{s - 1} x on x.f = a.f and x.i = a.i and x.j = k
                  join r{s - 1} z on z.f = a.f and z.i = k and z.j = a.j)"""
        )
    betas = " union all ".join(
        f"""select {s} as size, r.f, r.i, r.v * sd_{y} / ({sd}) as b, r.v * sd_{y} / ({sd}) * ({mean}) as shift
            from r{s} r join m on m.f = r.f where r.j = {y} and (r.f, r.i) in ({' union all '.join(f'select f, k from k{q}' for q in range(1, s + 1))})"""
        for s in range(1, max_size + 1)
    )
    path = " union all ".join(
        f"""select {s} as size, k as i, r.v * sd_{y} * sd_{y} as mse, 1 - r.v as r2 from r{s} r join k{s} on k{s}.f = r.f
            join m on m.f = r.f where r.f = -1 and r.i = {y} and r.j = {y}"""
        for s in range(1, max_size + 1)
    )
    return f"""
    with rows as materialized ({source}),
         m as materialized (select f, {corr}, {stats} from rows join (select unnest([{', '.join(map(str, folds))}]) as f) on fold <> f group by f),
         r0 as materialized ({cells}),
         {', '.join(steps)},
         path as (select size, {label} as added, mse, r2 from ({path})),
         beta as materialized ({betas}),
         coef as (select size, f, {label} as term, b as estimate from beta
                  union all select size, beta.f, '(Intercept)', any_value(mean_{y}) - sum(shift) from beta join m on m.f = beta.f group by 1, 2)
    {result}"""


_ROWS_SQL = (
    "select " + ", ".join(f"{sql} as {n}" for n, sql in {**_FEATURES, "y": _OUTCOME, "fold": _FOLD}.items()) + " from lineitem"
)


def _selection(t: Tables) -> ForwardSelection:
    df = t.lineitem.selectExpr(*[f"{sql} AS {n}" for n, sql in _FEATURES.items()], f"{_OUTCOME} AS y", f"{_FOLD} AS fold")
    return forward_selection(df, "y", list(_FEATURES), F.col("fold"), _SIZE)


@query(
    model_sql(
        "select size, added, round(mse, 5) as mse, round(r2, 6) as r2 from path", [-1], _ROWS_SQL, list(_FEATURES), _SIZE
    )
)
def ml_forward_select(t: Tables) -> DataFrame:
    """Variable added at each size, with the error left."""
    model = _selection(t)
    return model.steps().select(
        "size", "added", F.round(F.col("rss") / model.rows, 5).alias("mse"), F.round("r2", 6).alias("r2")
    )


@query(
    model_sql(
        "select size, term, round(estimate, 5) as estimate from coef where size = 4", [-1], _ROWS_SQL, list(_FEATURES), _SIZE
    )
)
def ml_coefficients(t: Tables) -> DataFrame:
    fitted = _selection(t).coefficients(4)
    return fitted.withColumn("estimate", F.round("estimate", 5))


_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax")
_SLICE = "l_orderkey % 16"
_DEALT_SQL = f"""
    with keyed as (select *, {_OUTCOME} as y, {_SLICE} as slice from lineitem),
         ends as (select min(y) as low, max(y) as high, count(*) as n from keyed),
         stepped as (select keyed.*, least(floor((y - low) * {GRID} / (high - low)), {GRID - 1})::int as step from keyed, ends),
         counted as (select step, sum(count(*)) over (order by step) as until from stepped group by step),
         bounds as (select distinct (select min(step) from counted where until >= n * q / 4.0) as bound from ends, (values (1), (2), (3)) v(q)),
         strata as (select *, (select count(*) from bounds where step > bound) as stratum from stepped)
    select *, ((row_number() over (partition by stratum order by slice, {", ".join(_ORDER)}) - 1) % 10)::int as fold from strata"""


def _dealt(t: Tables) -> DataFrame:
    keyed = t.lineitem.selectExpr("*", f"{_OUTCOME} AS y")
    return stratified_folds(keyed, ["y"], list(_ORDER), slices=F.expr(_SLICE))


@query(f"select fold, count(*) as n, sum(l_partkey)::bigint as parts, round(avg(y), 6) as mean from ({_DEALT_SQL}) group by fold")
def ml_stratified_folds(t: Tables) -> DataFrame:
    """Folds with equal parts of the quarters of the outcome."""
    found = _dealt(t).groupBy(F.col("fold_y").alias("fold"))
    return found.agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("parts"), F.round(F.avg("y"), 6).alias("mean"))


def cv_sql(features: Sequence[str]) -> str:
    weights = ", ".join(f"coalesce(max(estimate) filter (term = '{n}'), 0) as b_{n}" for n in features)
    return f"""
    , wide as (select size, f, {weights}, max(estimate) filter (term = '(Intercept)') as b0 from coef group by 1, 2),
      scored as (select size, f, y, b0 + {' + '.join(f'b_{n} * {n}' for n in features)} as p from rows join wide on f = fold),
      per_fold as (select size, f, sqrt(avg((y - p) * (y - p))) as rmse, pow(corr(y, p), 2) as rsquared, avg(abs(y - p)) as mae
                   from scored group by 1, 2)
    select size as nvmax, round(avg(rmse), 6) as rmse, round(avg(rsquared), 6) as rsquared, round(avg(mae), 6) as mae,
           round(stddev_samp(rmse), 6) as rmse_sd, round(stddev_samp(rsquared), 6) as rsquared_sd,
           round(stddev_samp(mae), 6) as mae_sd
    from per_fold group by 1"""


@query(model_sql(cv_sql(list(_FEATURES)), range(10), _ROWS_SQL, list(_FEATURES), _SIZE))
def ml_cv_results(t: Tables) -> DataFrame:
    """Error per size over ten folds."""
    results = _selection(t).cv_results()
    return results.select("nvmax", *[F.round(c, 6).alias(c) for c in results.columns[1:]])


_DEALT_ROWS_SQL = "select " + ", ".join(f"{sql} as {n}" for n, sql in {**_FEATURES, "y": "y", "fold": "fold"}.items()) + f" from ({_DEALT_SQL})"


@query(model_sql(cv_sql(list(_FEATURES)), range(10), _DEALT_ROWS_SQL, list(_FEATURES), _SIZE))
def ml_cv_stratified(t: Tables) -> DataFrame:
    """Error per size over ten folds that are dealt within quarters of the outcome."""
    df = staged(_dealt(t).selectExpr(*[f"{sql} AS {n}" for n, sql in _FEATURES.items()], "y", "fold_y"), "dealt")
    results = forward_selection(df, "y", list(_FEATURES), F.col("fold_y"), _SIZE).cv_results()
    return results.select("nvmax", *[F.round(c, 6).alias(c) for c in results.columns[1:]])
