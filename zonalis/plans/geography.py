"""Lookups between census tracts, census circuits and electoral circuits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonalis.functions import circuit_zeroes, paste, round_even, section_code, slice_text
from zonalis.operators.geometry import shoelace
from zonalis.operators.joins import SALT, attach_group_values, salted
from zonalis.operators.projection import CENSUS_ZONE, TransverseMercator, equal_area, map_vertices, move
from zonalis.operators.reshape import stack
from zonalis.operators.spatial import overlay, points_in_polygons
from zonalis.operators.validity import repair

# The threshold and codes of the lookup step.
SLIVER = 0.001
SHARE_DIGITS = 5
FOREIGN_SECTION = "16001"
RIO_NEGRO = ("Río Negro", "63")

# Column that tells the layers of different provinces apart; tables without it are one layer.
LAYER = "province"


def _layer(polygons: DataFrame) -> list[str]:
    return [LAYER] if LAYER in polygons.columns else []


def overwrite_province(
    circuits: DataFrame, source: str = "source_file", name: str = RIO_NEGRO[0], code: str = RIO_NEGRO[1]
) -> DataFrame:
    """Set ``indec_p`` on all rows of a file in which any row names the province."""
    flagged = attach_group_values(circuits, [source], {"__found": F.max(F.col("provincia") == name)})
    corrected = F.when(F.col("__found"), F.lit(code)).otherwise(F.col("indec_p"))
    return flagged.withColumn("indec_p", corrected).drop("__found")


def circuit_ids(circuits: DataFrame) -> DataFrame:
    """Add ``id_circuito``; polygons whose code has another length than 2 to 6 are dropped."""
    zeroes = circuit_zeroes(F.col("circuito"))
    return circuits.filter(zeroes.isNotNull()).withColumn(
        "id_circuito", paste(F.col("indec_p"), F.col("indec_d"), zeroes, F.col("circuito"))
    )


def _distinct_rows(polygons: DataFrame, *codes: str) -> DataFrame:
    """Equal rows as one, with their number in ``copies``, and an ``id`` made from codes and outline."""
    return (
        polygons.groupBy(*codes, "rings")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("id", F.md5(F.to_json(F.struct(*codes, "rings"))))
    )


def without_geometry(polygons: DataFrame) -> DataFrame:
    """Attributes of polygons as a plain table."""
    return polygons.drop("rings")


def prepare_tracts(tracts: DataFrame, zone: TransverseMercator = CENSUS_ZONE) -> DataFrame:
    """Census polygons ``(link, rings)`` in zone metres to ``(id, id_radio, rings, copies)`` in an equal-area plane, repaired."""
    layer = _layer(tracts)
    rows = _distinct_rows(tracts.select(F.col("link").alias("id_radio"), *layer, "rings"), "id_radio", *layer)
    return repair(rows.withColumn("rings", map_vertices(F.col("rings"), [*zone.inverse, *equal_area()])))


def prepare_circuits(circuits: DataFrame) -> DataFrame:
    """Circuit polygons in degrees, with ``source_file``, to an equal-area plane, repaired.

    The province code is corrected here, once, for the circuits' own ids and for their sections.
    """
    rows = _distinct_rows(overwrite_province(circuits), "indec_p", "indec_d", "circuito", *_layer(circuits))
    return repair(rows.withColumn("rings", map_vertices(F.col("rings"), equal_area())))


def place_points(places: DataFrame) -> DataFrame:
    """Polling places in degrees to the plane the circuits are in."""
    x, y = move(F.col("x"), F.col("y"), equal_area())
    return places.withColumns({"x": x, "y": y})


def _copies(polygons: DataFrame) -> Column:
    return F.col("copies") if "copies" in polygons.columns else F.lit(1)


def overlay_shares(tracts: DataFrame, circuits: DataFrame) -> DataFrame:
    """Share of each tract's area in each circuit: ``(id_radio, id_circuito, por_radio)``.

    Inputs: ``(id, id_radio, rings)`` and ``(id, id_circuito, rings)`` in an equal-area plane, ``id``
    unique per polygon, with an optional number of ``copies``. Shares are rounded per pair of polygons
    and then summed per pair of ids, as decimals, so that the order of the pairs does not show. Where both tables have layers, a tract meets the circuits of its own layer only.
    """
    layer = [c for c in _layer(tracts) if c in circuits.columns]
    whole = tracts.select(
        F.col("id").alias("a"),
        "id_radio",
        shoelace(F.col("rings")).alias("area_radio"),
        _copies(tracts).alias("a_copies"),
    )
    zones = circuits.select(F.col("id").alias("b"), "id_circuito", _copies(circuits).alias("b_copies"))
    share = round_even(F.try_divide(F.col("area"), F.col("area_radio")), SHARE_DIGITS).cast(f"decimal(15,{SHARE_DIGITS})")
    return (
        overlay(tracts, circuits, by=layer)
        .join(whole, "a")
        .join(zones, "b")
        .groupBy("id_radio", "id_circuito")
        .agg(F.sum(share * F.col("a_copies") * F.col("b_copies")).cast("double").alias("por_radio"))
    )


def without_slivers(shares: DataFrame) -> DataFrame:
    return shares.filter(F.col("por_radio") > SLIVER)


def section_matches(places: DataFrame, circuits: DataFrame) -> DataFrame:
    """Number of circuit polygons of each census section that hold a polling place of each section.

    Inputs: ``(id_distrito, id_seccion, x, y)`` and ``(id, indec_p, indec_d, rings)``. Polling places
    are reduced to distinct points first, as only distinct polygons are counted. Each layer is counted by itself.
    """
    layer = _layer(circuits)
    points = places.select(
        section_code(F.col("id_distrito"), F.col("id_seccion")).alias("id_seccion_elec"), "x", "y"
    ).distinct()
    held = points_in_polygons(points, circuits.select("id", "rings"), ["id_seccion_elec"])
    held = held.select("id_seccion_elec", "id").distinct()
    sections = circuits.select(
        "id", *layer, paste(F.col("indec_p"), F.col("indec_d")).alias("id_seccion_indec"), _copies(circuits).alias("copies")
    )
    return (
        held.join(sections, "id")
        .groupBy("id_seccion_elec", "id_seccion_indec", *layer)
        .agg(F.sum("copies").cast("bigint").alias("count"))
        .drop(*layer)
    )


def best_matches(matches: Sequence[DataFrame] | DataFrame) -> DataFrame:
    """Census section with the highest count per electoral section, ties kept.

    Spark drops rows that cannot be first before the shuffle, so only ties of a section meet in a task.
    """
    if not isinstance(matches, DataFrame):
        matches = stack(matches)
    by_count = Window.partitionBy("id_seccion_elec").orderBy(F.desc("count"))
    return (
        matches.filter(F.col("id_seccion_elec") != FOREIGN_SECTION)
        .withColumn("__rank", F.rank().over(by_count))
        .filter("__rank = 1")
        .select("id_seccion_elec", "id_seccion_indec")
    )


def full_lookup(shares: DataFrame, sections: DataFrame, election: DataFrame, blank: str) -> DataFrame:
    """Tract to electoral circuit, for circuits whose blank votes are known in ``election``."""
    known = election.filter(F.col(blank).isNotNull()).select("id_circuito_elec")
    keyed = shares.withColumn("id_seccion_indec", slice_text(F.col("id_circuito"), 1, 5))
    # few sections, each with many tracts
    keyed, sections = salted(keyed, sections)
    return (
        keyed.join(sections, ["id_seccion_indec", SALT], "left")
        .drop(SALT)
        .withColumn(
            "id_circuito_elec", paste(F.col("id_seccion_elec"), slice_text(F.col("id_circuito"), 6, 11))
        )
        .join(known, "id_circuito_elec", "left_semi")
    )
