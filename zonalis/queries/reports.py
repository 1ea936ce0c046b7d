"""Reports on the final table, which is written and read back first, as its own step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from zonalis.operators.statistics import regression_lines, within
from zonalis.plans import reports
from zonalis.queries.registry import Tables, query
from zonalis.queries.spatial import DICTIONARY, FINAL_SQL, build_final
from zonalis.operators.stepwise import MAX_SIZE
from zonalis.queries.statistics import cv_sql, lines_sql, model_sql, rounded_lines
from zonalis.sources.stage import staged

_NUMBERS = [new for _, flag, new in DICTIONARY[1:] if flag]
_CHANGED_SQL = (
    "with f as materialized (select *, "
    + ", ".join(f'"{a}" - "{b}" as {name}' for name, (a, b) in reports.CHANGES.items())
    + f" from ({FINAL_SQL}))"
)


def _final(t: Tables) -> DataFrame:
    return reports.with_changes(staged(build_final(t), "final"))


def _outcome_columns() -> list[str]:
    return [c for c in [*_NUMBERS, *reports.CHANGES] if c.startswith(reports.OUTCOMES)]


def _other_columns() -> list[str]:
    return [c for c in [*_NUMBERS, *reports.CHANGES] if not c.startswith(reports.EXCLUDED)]


def _corr_sql() -> str:
    pairs = [(a, b) for a in _outcome_columns() for b in _other_columns()]
    complete = " and ".join(f'"{c}" is not null' for c in _NUMBERS)
    values = ", ".join(f'corr("{a}", "{b}") as c{i}' for i, (a, b) in enumerate(pairs))
    rows = " union all ".join(f"select '{a}' as var, '{b}' as var_cor, c{i} as corr from m" for i, (a, b) in enumerate(pairs))
    return f"{_CHANGED_SQL}, m as materialized (select {values} from f where {complete}), c as ({rows})"


@query(f"{_corr_sql()} select var, var_cor, round(corr, 6) as corr, round(abs(corr), 6) as corr_abs from c")
def correlation_report(t: Tables) -> DataFrame:
    ranked = reports.correlation_report(_final(t))
    return ranked.withColumn("corr", F.round("corr", 6)).withColumn("corr_abs", F.round("corr_abs", 6))


@query(
    f"""{_corr_sql()}, p as (select var_cor, max(corr) filter (var = 'paso19_cand_FdT') as a,
                                    max(corr) filter (var = 'paso15_cand_FPV') as b from c group by 1)
        select var_cor, round(a, 6) as "paso19_cand_FdT", round(b, 6) as "paso15_cand_FPV",
               round(abs(a - b), 6) as evol15_19, round(abs(a), 6) as abs_paso19 from p"""
)
def correlation_shift_report(t: Tables) -> DataFrame:
    shift = reports.peron_shift(reports.correlation_report(_final(t)))
    return shift.select("var_cor", *[F.round(c, 6).alias(c) for c in shift.columns[1:]])


_FEATURES = [c for family in reports.MODEL_FAMILIES for c in _NUMBERS if c.startswith(family)]
_FOLD = "CAST(substr(id_circuito_elec, 6, 6) AS INT) % 10"


def _model_rows_sql(outcome: str) -> str:
    columns = ", ".join(f'"{c}"' for c in _FEATURES)
    complete = " and ".join(f'"{c}" is not null' for c in [*_FEATURES, outcome])
    return f"{_CHANGED_SQL} select {columns}, {outcome} as y, {_FOLD} as fold from f where {complete}"


def _all_models_sql(result: str, folds: list[int], max_size: int) -> str:
    parts = [
        f"select '{y}' as outcome, * from ({model_sql(result, folds, _model_rows_sql(y), _FEATURES, max_size)})"
        for y in reports.MODEL_OUTCOMES
    ]
    return " union all ".join(parts)


@query(
    _all_models_sql(
        "select size, term, round(estimate, 4) as estimate from coef where size = 4 union all select size, added, round(r2, 6) from path",
        [-1],
        MAX_SIZE,
    )
)
def stepwise_models(t: Tables) -> DataFrame:
    """Four outcomes: squared correlation along the ten-step path, and the four-variable model."""
    parts = []
    for outcome, model in reports.models(_final(t), fold=F.expr(_FOLD)).items():
        path = model.steps().select("size", F.col("added").alias("term"), F.round("r2", 6).alias("estimate"))
        four = model.coefficients().withColumn("estimate", F.round("estimate", 4))
        parts.append(four.unionByName(path).select(F.lit(outcome).alias("outcome"), "*"))
    return reduce(DataFrame.unionByName, parts)


@query(_all_models_sql(cv_sql(_FEATURES), list(range(10)), MAX_SIZE))
def stepwise_cv(t: Tables) -> DataFrame:
    """Four outcomes: cross-validated errors of the models of one to ten variables."""
    parts = []
    for outcome, model in reports.models(_final(t), fold=F.expr(_FOLD)).items():
        results = model.cv_results()
        parts.append(
            results.select(F.lit(outcome).alias("outcome"), "nvmax", *[F.round(c, 6).alias(c) for c in results.columns[1:]])
        )
    return reduce(DataFrame.unionByName, parts)


# -- charts ----------------------------------------------------------------------------------------


def _facets_sql(chart: str, keep: list[str], labels: dict[str, str], facet_is_x: bool, extra: str = "true") -> str:
    """One select per vote column and facet: ``chart, outcome, facet, x, y`` of complete rows."""
    complete = " and ".join(f'"{c}" is not null' for c in [*keep, *labels])
    parts = []
    for column, label in labels.items():
        text = label.replace("'", "''")
        for k in keep:
            x, y = (column, k) if facet_is_x else (k, column)
            outcome = k if facet_is_x else "y"
            parts.append(
                f"select '{chart}' as chart, '{outcome}' as outcome, '{text}' as facet, \"{x}\" as x, \"{y}\" as y from f where {complete}"
            )
    return f"select * from ({' union all '.join(parts)}) where {extra}"


_COMPUTER = reports.MACRI_FACETS["ho_compu"]
_CHART_SQL = " union all ".join(
    [
        _facets_sql("peron", ["paso19_cand_FdT", "pres19_cand_FdT"], reports.PERON_FACETS, True),
        _facets_sql(
            "macri", ["paso19_cand_JxC", "pres19_cand_JxC"], reports.MACRI_FACETS, True,
            f"not (facet = '{_COMPUTER}' and x < {reports.COMPUTER_FLOOR})",
        ),
        _facets_sql("unemployment", ["per_desocupado"], reports.UNEMPLOYMENT_FACETS, False),
        _facets_sql("landline", ["ho_fijo"], reports.LANDLINE_FACETS, False),
    ]
)


def _charts(final: DataFrame) -> DataFrame:
    """All series with a fitted line, long: ``chart, outcome, facet, x, y``."""

    def by_vote(series: DataFrame, chart: str, votes: list[str]) -> DataFrame:
        return series.unpivot(["facet", "x"], votes, "outcome", "y").select(F.lit(chart).alias("chart"), "outcome", "facet", "x", "y")

    def by_facet(series: DataFrame, chart: str, x: str) -> DataFrame:
        return series.select(F.lit(chart).alias("chart"), F.lit("y").alias("outcome"), "facet", F.col(x).alias("x"), "y")

    parts = [
        by_vote(reports.peron_series(final), "peron", ["paso19_cand_FdT", "pres19_cand_FdT"]),
        by_vote(reports.macri_series(final), "macri", ["paso19_cand_JxC", "pres19_cand_JxC"]),
        by_facet(reports.unemployment_series(final), "unemployment", "per_desocupado"),
        by_facet(reports.landline_series(final), "landline", "ho_fijo"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query(f"{_CHANGED_SQL} select chart, outcome, facet, x, y from ({_CHART_SQL})")
def chart_series(t: Tables) -> DataFrame:
    return _charts(_final(t))


@query(
    _CHANGED_SQL
    + lines_sql(
        f"select chart || '/' || outcome || '/' || facet as facet, x, y from ({_CHART_SQL})", "y between 0 and 80"
    )
)
def chart_lines(t: Tables) -> DataFrame:
    points = _charts(_final(t)).filter(within(F.col("y")))
    named = points.withColumn("facet", F.concat_ws("/", "chart", "outcome", "facet"))
    return rounded_lines(regression_lines(named, "facet", "x", "y"))


def _pairs_sql(year: str, pairs: dict[str, str]) -> str:
    parts = [
        f"select '{label}' as facet, \"paso{year}_cand_{c}\" as x, \"pres{year}_cand_{c}\" as y from f"
        for c, label in pairs.items()
    ]
    return f"select '{year}' as year, facet, x, y, y - x as diff from ({' union all '.join(parts)}) where x is not null and y is not null"


@query(
    _CHANGED_SQL
    + _pairs_sql("15", {"Cam": "Cambiemos", "FPV": "Frente para la Victoria"})
    + " union all "
    + _pairs_sql("19", {"JxC": "Juntos por el Cambio", "FdT": "Frente de Todos"})
)
def chart_pairs(t: Tables) -> DataFrame:
    """Primary against general election, both years."""
    final = _final(t)
    parts = [
        pairs.select(F.lit(year).alias("year"), "facet", F.col(f"paso{year}_per").alias("x"), F.col(f"pres{year}_per").alias("y"), "diff")
        for year, pairs in (("15", reports.pairs_2015(final)), ("19", reports.pairs_2019(final)))
    ]
    return reduce(DataFrame.unionByName, parts)
