"""Reports on the final table: changes, correlations, models and chart series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonalis.operators.selectors import starts_with
from zonalis.operators.statistics import (
    category_rank,
    complete_rows,
    correlation_matrix,
    correlation_shift,
    facet_series,
    paired_series,
    ranked_correlations,
)
from zonalis.operators.stepwise import ForwardSelection, forward_selections, stratified_folds

# Differences between elections, outcome prefixes and model outcomes of the report.
CHANGES = {
    "change_peron_paso19_paso15": ("paso19_cand_FdT", "paso15_cand_FPV"),
    "change_peron_paso19_pres15": ("paso19_cand_FdT", "pres15_cand_FPV"),
    "change_macri_paso19_paso15": ("paso19_cand_JxC", "paso15_cand_Cam"),
    "change_macri_paso19_pres15": ("paso19_cand_JxC", "pres15_cand_Cam"),
    "change_peron_paso15_pres15": ("pres15_cand_FPV", "paso15_cand_FPV"),
    "change_macri_paso15_pres15": ("pres15_cand_Cam", "paso15_cand_Cam"),
}
OUTCOMES = ("chan", "paso19_can", "paso15_can", "pres15_can")
EXCLUDED = ("chan", "paso19", "paso15", "pres15")
MODEL_OUTCOMES = (
    "paso19_cand_FdT",
    "paso19_cand_JxC",
    "change_peron_paso19_paso15",
    "change_macri_paso19_paso15",
)
MODEL_FAMILIES = ("ho_", "vi_", "per_")

# Facet labels of the charts.
PERON_FACETS = {
    "ho_3omas_por_cuarto": "Hogares con 3 o más personas por cuarto",
    "per_nietos_hogar": "Jefes de hogar que viven con nietos",
    "per_edad_20_24": "Personas entre 20 y 24 años",
    "ho_necesidad_basica_insatisfecha": "Hogares con necesidades básicas insatisfechas",
}
MACRI_FACETS = {
    "per_estud_universitario": "Personas con estudio universitarios",
    "per_servicio_domestico_interno": "Personas con servicio doméstico",
    "per_edad_65mas": "Personas de 60 o más años",
    "ho_compu": "Hogares con computadora",
}
UNEMPLOYMENT_FACETS = {
    "paso19_cand_FdT": "Frente de Todos (PASO '19)",
    "paso15_cand_FPV": "Frente para la Victoria (PASO '15)",
    "pres19_cand_FdT": "Frente de Todos (pres. '19)",
    "pres15_cand_FPV": "Frente para la Victoria (pres. '15)",
}
LANDLINE_FACETS = {"paso19_cand_FdT": "Frente de Todos", "paso19_cand_JxC": "Frente Juntos por el Cambio"}
COMPUTER_FLOOR = 75


def with_changes(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(a) - F.col(b) for name, (a, b) in CHANGES.items()})


def correlation_report(
    df: DataFrame, outcomes: Sequence[str] = OUTCOMES, excluded: Sequence[str] = EXCLUDED
) -> DataFrame:
    """All numeric columns against the outcome columns, strongest first."""
    columns = [c for c in df.columns if c not in ("id_circuito_elec", "province")]
    rows = [c for c in columns if c.startswith(tuple(outcomes))]
    others = [c for c in columns if not c.startswith(tuple(excluded))]
    return ranked_correlations(correlation_matrix(df, columns, rows, others), outcomes, excluded)


def peron_shift(ranked: DataFrame) -> DataFrame:
    return correlation_shift(ranked, "paso19_cand_FdT", "paso15_cand_FPV")


def macri_shift(ranked: DataFrame) -> DataFrame:
    return correlation_shift(ranked, "paso19_cand_JxC", "paso15_cand_Cam")


def model_features(df: DataFrame) -> list[str]:
    """Census columns, family by family."""
    return [c for family in MODEL_FAMILIES for c in starts_with(df, family)]


def models(
    df: DataFrame, outcomes: Sequence[str] = MODEL_OUTCOMES, fold: Column | None = None
) -> dict[str, ForwardSelection]:
    """Forward selection over the census columns for each outcome.

    Without a ``fold`` each outcome has folds of its own, which hold equal parts of every stratum of it.
    """
    features = model_features(df)
    if fold is not None:
        return forward_selections(df, features, dict.fromkeys(outcomes, fold))
    dealt = stratified_folds(complete_rows(df, features), outcomes, ["id_circuito_elec"])
    return forward_selections(dealt, features, {y: F.col(f"fold_{y}") for y in outcomes})


def peron_series(df: DataFrame) -> DataFrame:
    return facet_series(df, ["paso19_cand_FdT", "pres19_cand_FdT"], list(PERON_FACETS), PERON_FACETS, "facet", "x")


def macri_series(df: DataFrame) -> DataFrame:
    series = facet_series(df, ["paso19_cand_JxC", "pres19_cand_JxC"], list(MACRI_FACETS), MACRI_FACETS, "facet", "x")
    return series.filter(~((F.col("facet") == MACRI_FACETS["ho_compu"]) & (F.col("x") < COMPUTER_FLOOR)))


def unemployment_series(df: DataFrame) -> DataFrame:
    return facet_series(df, ["per_desocupado"], list(UNEMPLOYMENT_FACETS), UNEMPLOYMENT_FACETS, "facet", "y")


def landline_series(df: DataFrame) -> DataFrame:
    """With ``facet_rank``, which puts the first label first."""
    series = facet_series(df, ["ho_fijo"], list(LANDLINE_FACETS), LANDLINE_FACETS, "facet", "y")
    return series.withColumn("facet_rank", category_rank(F.col("facet"), ["Frente de Todos"]))


def pairs_2015(df: DataFrame) -> DataFrame:
    pairs = [
        ("paso15_cand_Cam", "pres15_cand_Cam", "Cambiemos"),
        ("paso15_cand_FPV", "pres15_cand_FPV", "Frente para la Victoria"),
    ]
    return paired_series(df, pairs, "paso15_per", "pres15_per")


def pairs_2019(df: DataFrame) -> DataFrame:
    pairs = [
        ("paso19_cand_JxC", "pres19_cand_JxC", "Juntos por el Cambio"),
        ("paso19_cand_FdT", "pres19_cand_FdT", "Frente de Todos"),
    ]
    return paired_series(df, pairs, "paso19_per", "pres19_per")
