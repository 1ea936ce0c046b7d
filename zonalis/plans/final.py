"""The final table: interpolated census percentages and election results per electoral circuit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonalis.functions import exact
from zonalis.operators.joins import join_fold, left_join
from zonalis.operators.reshape import sum_to_wide
from zonalis.operators.selectors import dictionary_projection, everything
from zonalis.plans.geography import SHARE_DIGITS

# Families of census variables, most specific prefix first, and province names.
FAMILIES = ("vi_urban_", "vi_", "ho_", "per_")
PROVINCES = {"01": "CABA", "02": "Buenos Aires"}

COUNT_DIGITS = 3  # decimal places of census values that count; they are whole numbers as a rule


def interpolate(lookup: DataFrame, census: DataFrame, names: Sequence[str]) -> DataFrame:
    """Census counts of tracts, weighted by area share and summed to electoral circuits.

    ``census`` is long ``(radio, var, value)``. Every circuit of the lookup gets a row; what no tract
    reports is 0. Sums are rounded to whole numbers, half to even.

    Shares have SHARE_DIGITS decimal places and counts are taken to COUNT_DIGITS, so products are decimals without any
    rounding, their sums are the same in every order, and the one rounding at the end sees the exact sum.
    """
    share = exact("por_radio", 15, SHARE_DIGITS).alias("por_radio")
    weighted = left_join(lookup.select(F.col("id_radio").alias("radio"), "id_circuito_elec", share), census, ["radio"])
    product = exact("value", 15, COUNT_DIGITS) * F.col("por_radio")
    table = sum_to_wide(weighted, ["id_circuito_elec"], "var", product, names)
    rounded = [F.bround(F.coalesce(F.col(f"`{c}`"), F.lit(0)), 0).cast("double").alias(c) for c in names]
    return table.select("id_circuito_elec", *rounded)


def family_of(name: str, families: Sequence[str] = FAMILIES) -> str:
    """Prefix of the family a census column belongs to."""
    for family in families:
        if name.lower().startswith(family):
            return family
    raise ValueError(f"column {name} belongs to none of the families {families}")


def census_percentages(counts: DataFrame, families: Sequence[str] = FAMILIES) -> DataFrame:
    """Each count over its family's total; the totals are dropped."""

    shown = [c for c in counts.columns[1:] if not c.endswith("TOTAL")]
    return counts.selectExpr(
        f"`{counts.columns[0]}`", *[_percent(c, f"{family_of(c, families)}TOTAL") for c in shown]
    )


def _percent(part: str, whole: str) -> str:
    return f"try_divide(`{part}`, `{whole}`) * 100 AS `{part}`"


def vote_percentages(df: DataFrame, elections: Sequence[str]) -> DataFrame:
    """Party columns of each election as percentages of its valid votes."""
    whole = {c: f"{e}_validos" for e in elections for c in df.columns if c.startswith(f"{e}_cand")}
    return df.selectExpr(*[_percent(c, whole[c]) if c in whole else f"`{c}`" for c in df.columns])


def province(circuit: Column, names: Mapping[str, str] = PROVINCES) -> Column:
    chain = F.lit(None).cast("string")
    for prefix, name in names.items():
        chain = F.when(circuit.startswith(prefix), F.lit(name)).otherwise(chain)
    return chain


def final_table(
    lookup: DataFrame,
    census: DataFrame,
    names: Sequence[str],
    elections: Mapping[str, DataFrame],
    dictionary: Sequence[tuple[str, int, str]],
) -> DataFrame:
    """All steps: interpolate, percentages, join elections, select and rename, add the province."""
    zones = census_percentages(interpolate(lookup, census, names))
    joined = vote_percentages(join_fold([zones, *elections.values()], ["id_circuito_elec"]), list(elections))
    chosen = dictionary_projection(joined, dictionary)
    chosen = chosen.withColumn("province", province(F.col("id_circuito_elec")))
    return chosen.selectExpr(*[f"`{c}`" for c in everything(chosen, "id_circuito_elec", "province")])
