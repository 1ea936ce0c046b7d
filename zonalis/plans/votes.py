"""Votes per electoral circuit, long and wide, from the 2019 and 2015 file layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonalis.functions import (
    as_integer,
    circuit_zeroes,
    first_by,
    paste,
    recode,
    strict_sum,
    strict_sum_where,
)
from zonalis.operators.joins import attach_group_values, salted_left_join
from zonalis.operators.reshape import stack, to_wide
from zonalis.schemas import ZONE_2015

# Codes and labels of the vote files.
PRESIDENT = "000100000000000"
DISTRICTS = ("01", "02")
OTHERS = "Otros"
LABELS_2019 = {"JUNTOS POR EL CAMBIO": "Juntos por el Cambio", "FRENTE DE TODOS": "Frente de Todos"}
SHORT_2019 = {"Frente de Todos": "FdT", "Juntos por el Cambio": "JxC", OTHERS: OTHERS}
LABELS_2015 = {
    "ALIANZA CAMBIEMOS": "Cambiemos",
    "ALIANZA FRENTE PARA LA VICTORIA": "Frente Para la Victoria",
    "ALIANZA UNIDOS POR UNA NUEVA ALTERNATIVA (UNA)": "UNA",
}
SHORT_2015 = {"Frente Para la Victoria": "FPV", "Cambiemos": "Cam", "UNA": "UNA", OTHERS: OTHERS}
BLANK_CODE = 9004
FIRST_SPECIAL_CODE = 9000

LONG_COLUMNS = ["year", "id_circuito_elec", "votos_blanco", "votos_validos", "partido", "votos_candidatura"]


def party_names(parties: DataFrame, category: str = PRESIDENT) -> DataFrame:
    """First name of each party of one race, in file order (column ``ordinal``)."""
    return (
        parties.filter(F.col("codigo_categoria") == category)
        .groupBy("codigo_agrupacion")
        .agg(first_by(F.col("nombre_agrupacion"), F.col("ordinal")).alias("nombre_agrupacion"))
    )


def blank_votes(totals: DataFrame, blank: str, category: str = PRESIDENT) -> DataFrame:
    return totals.filter((F.col("codigo_categoria") == category) & (F.col("contador") == blank))


def box_table(
    votes: DataFrame, totals: DataFrame, parties: DataFrame, regions: DataFrame, blank: str, category: str = PRESIDENT
) -> DataFrame:
    """One row per box and party with blank and valid votes, region and party names."""
    cast = votes.filter(F.col("codigo_categoria") == category)
    blanks = blank_votes(totals, blank, category).select("codigo_mesa", F.col("valor").alias("votos_blanco"))
    en_mesa = {"en_mesa": strict_sum(F.col("votos_agrupacion"))}
    rows = attach_group_values(cast, ["codigo_mesa"], en_mesa, also=blanks)
    for role in ("distrito", "seccion"):
        names = regions.select(
            F.col("codigo_region").alias(f"codigo_{role}"), F.col("nombre_region").alias(f"name_{role}")
        )
        rows = salted_left_join(rows, names, [f"codigo_{role}"])
    rows = salted_left_join(rows, party_names(parties, category), ["codigo_agrupacion"])
    return rows.select(
        "codigo_distrito",
        "name_distrito",
        "codigo_seccion",
        "name_seccion",
        "codigo_circuito",
        "codigo_mesa",
        "votos_blanco",
        (F.col("en_mesa") + F.col("votos_blanco")).alias("votos_validos"),
        "codigo_agrupacion",
        "nombre_agrupacion",
        "votos_agrupacion",
    )


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "\\'") + "'"


def _label_sums(labels: Sequence[str | None], votes: str, times: Sequence[str]) -> list[Column]:
    """Sum of ``votes`` per label, and which labels occur (``present``) or lack a number (``missing``).

    ``times[i]`` is the SQL text of how often a row counts for label ``i``. The two flags are bit
    masks, one bit per label.
    """
    present = " + ".join(f"if({t} > 0, {1 << i}, 0)" for i, t in enumerate(times))
    return [
        F.expr(f"bit_or({present})").alias("present"),
        F.expr(f"bit_or(if({votes} IS NULL, {present}, 0))").alias("missing"),
        *[F.expr(f"sum(coalesce({votes}, 0) * {t})").alias(f"votes_{i}") for i, t in enumerate(times)],
    ]


def _labels_to_rows(zones: DataFrame, labels: Sequence[str | None]) -> DataFrame:
    """One row per zone and label that occurs there; a missing number makes the label's sum missing."""
    entries = ", ".join(
        f"struct({'CAST(NULL AS STRING)' if label is None else _sql_text(label)} AS partido, "
        f"present & {1 << i} AS here, if(missing & {1 << i} = 0, votes_{i}, NULL) AS votos_candidatura)"
        for i, label in enumerate(labels)
    )
    kept = [f"`{c}`" for c in zones.columns if c not in ("present", "missing") and not c.startswith("votes_")]
    return zones.selectExpr(*kept, f"inline(array({entries}))").filter("here <> 0").drop("here")


def _times(dimension: DataFrame, key: str, alias: str) -> DataFrame:
    """How often each code occurs: a repeated code repeats the rows that join it."""
    return dimension.groupBy(F.expr(f"coalesce({key}, '') AS {alias}")).agg(F.expr(f"count(1) AS n_{alias}"))


def circuits_2019(
    votes: DataFrame,
    totals: DataFrame,
    parties: DataFrame,
    regions: DataFrame,
    blank: str,
    category: str = PRESIDENT,
    districts: Sequence[str] = DISTRICTS,
    labels: Mapping[str, str] = LABELS_2019,
) -> DataFrame:
    """Votes per circuit and party label with the circuit's blank and valid votes.

    Ballots are read once and shrink to one row per box, region and party before any join, and then to one row per box
    and circuit, with the sums of each label in columns. Both sides of every join get a shuffle of the join's own (or one
    is small and sent to all tasks), and the ballots of a party or region, which may be a third of all, are dealt to salts. A repeated blank
    or region row would repeat the ballots it joins; it enters as a factor, so no join multiplies rows. ``totals`` and ``parties`` need the column ``ordinal``
    (file order). Missing codes are held as empty text, so that they match each other.
    """
    codes = ["codigo_mesa", "codigo_circuito", "codigo_distrito", "codigo_seccion", "codigo_agrupacion"]
    shown = [*labels.values(), OTHERS, None]
    coded = parties.withColumn("codigo_agrupacion", F.expr("coalesce(codigo_agrupacion, '')"))
    names = party_names(coded, category).select(
        "codigo_agrupacion",
        recode(F.col("nombre_agrupacion"), labels, OTHERS).alias("partido"),
    )
    cast = votes.filter(F.col("codigo_categoria") == category).selectExpr(
        *[f"coalesce({c}, '') AS {c}" for c in codes], "votos_agrupacion"
    )
    cast = cast.groupBy(*codes).agg(strict_sum(F.col("votos_agrupacion")).alias("votos_agrupacion"))
    named = salted_left_join(cast, names, ["codigo_agrupacion"])
    for role in ("codigo_distrito", "codigo_seccion"):
        named = salted_left_join(named, _times(regions, "codigo_region", role), [role])
    # how often a ballot counts for a label: never outside the districts shown
    in_scope = f"codigo_distrito IN ({', '.join(map(_sql_text, districts))})"
    repeats = "coalesce(n_codigo_distrito, 1) * coalesce(n_codigo_seccion, 1)"
    counts = [
        f"if({in_scope} AND {'partido IS NULL' if label is None else f'partido <=> {_sql_text(label)}'}, {repeats}, 0)"
        for label in shown
    ]
    # a ballot whose region codes are listed several times counts once for its box
    in_circuit = named.groupBy("codigo_mesa", "codigo_circuito").agg(
        *_label_sums(shown, "votos_agrupacion", counts), strict_sum(F.col("votos_agrupacion")).alias("en_circuito")
    )
    blanks = (
        blank_votes(totals, blank, category)
        .groupBy(F.expr("coalesce(codigo_mesa, '') AS codigo_mesa"))
        .agg(F.expr("min_by(valor, ordinal) AS blanco"), F.expr("count(1) AS n_mesa"))
    )
    in_box = attach_group_values(in_circuit, ["codigo_mesa"], {"en_mesa": strict_sum(F.col("en_circuito"))}, also=blanks)
    zones = in_box.groupBy("codigo_circuito").agg(
        strict_sum(F.col("blanco")).alias("votos_blanco"),
        strict_sum(F.expr("en_mesa + blanco")).alias("votos_validos"),
        *[F.expr(f"bit_or({mask}) AS {mask}") for mask in ("present", "missing")],
        *[F.expr(f"sum(votes_{i} * coalesce(n_mesa, 1)) AS votes_{i}") for i in range(len(shown))],
    )
    return _labels_to_rows(zones, shown).selectExpr(
        "2019 AS year", "nullif(codigo_circuito, '') AS id_circuito_elec", *LONG_COLUMNS[2:]
    )


def circuits_2015(
    votes: Sequence[DataFrame], parties: DataFrame, labels: Mapping[str, str] = LABELS_2015
) -> DataFrame:
    """As :func:`circuits_2019`, from files that give circuit and vote code per row.

    Codes below 9000 are parties, 9004 is blank, others are ignored. The party table may list a code
    several times; each time counts, as a factor per label, so the join adds no rows.
    """
    shown = [*labels.values(), OTHERS, None]
    rows = stack(votes).select(
        *[f"`{c}`" for c in ZONE_2015],
        as_integer(F.col("`codigo votos`").cast("string")).alias("code"),
        as_integer(F.col("votos").cast("string")).alias("cast"),
    )
    is_party, is_blank = F.expr(f"code < {FIRST_SPECIAL_CODE}"), F.expr(f"code = {BLANK_CODE}")
    per_code = rows.filter(is_party | is_blank).groupBy(*ZONE_2015, "code").agg(strict_sum(F.col("cast")).alias("cast"))
    label = recode(F.col("denominacion"), labels, OTHERS)
    listed = parties.groupBy(as_integer(F.col("codigo_partido")).alias("code")).agg(
        *[F.count_if(label.eqNullSafe(F.lit(name))).alias(f"times_{i}") for i, name in enumerate(shown)]
    )
    times = [
        f"if(code < {FIRST_SPECIAL_CODE}, coalesce(times_{i}, {1 if name is None else 0}), 0)"
        for i, name in enumerate(shown)
    ]
    zones = salted_left_join(per_code, listed, ["code"]).groupBy(*ZONE_2015).agg(
        strict_sum_where(is_blank, F.col("cast")).alias("votos_blanco"),
        strict_sum_where(is_party, F.col("cast")).alias("candidaturas"),
        *_label_sums(shown, "`cast`", times),
    )
    province, department, circuit = (F.col(f"`{c}`") for c in ZONE_2015)
    return _labels_to_rows(zones, shown).select(
        F.lit(2015).alias("year"),
        paste(province, department, circuit_zeroes(circuit), circuit).alias("id_circuito_elec"),
        "votos_blanco",
        F.expr("votos_blanco + candidaturas AS votos_validos"),
        "partido",
        "votos_candidatura",
    )


def wide(long: DataFrame, election: str, short: Mapping[str, str]) -> DataFrame:
    """One row per circuit: ``<election>_blanco``, ``_validos`` and ``_cand_<label>`` columns.

    Rows whose party has no name get no column.
    """
    keys = ["id_circuito_elec", "votos_blanco", "votos_validos"]
    table = to_wide(long, keys, "partido", "votos_candidatura", list(short))
    return table.withColumnsRenamed(
        {
            "votos_blanco": f"{election}_blanco",
            "votos_validos": f"{election}_validos",
            **{label: f"{election}_cand_{code}" for label, code in short.items()},
        }
    )
