"""The whole work from source files to the final table and its reports, one stage at a time.

Each stage reads files and earlier stages below one folder and writes its own tables there, so it can be
run again by itself. Folder layout of the inputs: ``pres2019/``, ``paso2019/``, ``paso2015/``,
``pres2015/`` (votes), ``census/`` (one file per variable), and Parquet tables of polygons.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from zonalis import schemas
from zonalis.plans import census as census_plan
from zonalis.plans import geography, reports, votes
from zonalis.plans.final import final_table
from zonalis.plans.census import DENOMINATORS
from zonalis.sources import geo, text
from zonalis.sources.stage import read_stage, write_stage

# File names and labels of each election, and the provinces covered.
ELECTIONS_2019 = {
    "pres19": ("pres2019", "mesas_agrp_politicas.dsv", "Voto blanco"),
    "paso19": ("paso2019", "mesas_totales_agrp_politica.dsv", "VB"),
}
PARTIES_FILE_2015 = "paso2015/codigosbasicospaso2015provisional/FPARTIDOS.csv"
ELECTIONS_2015 = {
    "paso15": [f"paso2015/presidentepaso2015provisional/FMESPR_{p}.csv" for p in ("0202", "0101")],
    "pres15": [f"pres2015/FMESPR_{p}.csv" for p in ("0202", "0101")],
}
PROVINCES = ("01", "02")
LOOKUP_ELECTION = "paso19"
ELECTION_ORDER = ("paso19", "pres19", "paso15", "pres15")


def election_2019(spark: SparkSession, data: str, election: str) -> DataFrame:
    folder, votes_file, blank = ELECTIONS_2019[election]
    base = f"{data}/{folder}"
    return votes.circuits_2019(
        text.read_pipe(spark, f"{base}/{votes_file}", schemas.BOX_VOTES_2019),
        text.with_file_order(text.read_pipe(spark, f"{base}/mesas_totales.dsv", schemas.BOX_TOTALS_2019)),
        text.with_file_order(text.read_pipe(spark, f"{base}/descripcion_postulaciones.dsv", schemas.PARTIES_2019)),
        text.read_pipe(spark, f"{base}/descripcion_regiones.dsv", schemas.REGIONS_2019),
        blank,
    )


def election_2015(spark: SparkSession, data: str, election: str) -> DataFrame:
    files = [text.read_semicolon(spark, f"{data}/{f}", schemas.VOTES_2015) for f in ELECTIONS_2015[election]]
    return votes.circuits_2015(files, text.read_semicolon(spark, f"{data}/{PARTIES_FILE_2015}", schemas.PARTIES_2015))


def prepare_elections(spark: SparkSession, data: str, out: str) -> None:
    """Four elections, long and wide: ``<election>_long`` and ``<election>_wide``."""
    for election in ELECTION_ORDER:
        is_2019 = election in ELECTIONS_2019
        long = (election_2019 if is_2019 else election_2015)(spark, data, election)
        write_stage(long, f"{out}/{election}_long")
        short = votes.SHORT_2019 if is_2019 else votes.SHORT_2015
        write_stage(votes.wide(read_stage(spark, f"{out}/{election}_long"), election, short), f"{out}/{election}_wide")


def prepare_census(
    spark: SparkSession, data: str, out: str, prefixes: Mapping[str, str], totals: Mapping[str, str] = DENOMINATORS
) -> None:
    """``census_long`` for the interpolation, ``census_wide`` and ``census_totals`` as published."""
    folder = f"{data}/census"
    categories = census_plan.category_files(spark, folder, prefixes)
    whole = census_plan.total_files(spark, folder, totals)
    long = census_plan.within_first(categories).unionByName(census_plan.within_first(whole))
    write_stage(long, f"{out}/census_long")
    write_stage(census_plan.census_wide(categories), f"{out}/census_wide")
    write_stage(census_plan.census_wide(whole), f"{out}/census_totals")


def create_lookup(spark: SparkSession, tracts: str, circuits: str, places: str, out: str) -> None:
    """Tract shares, section crosswalk and full lookup.

    ``tracts`` and ``circuits`` are Parquet tables partitioned by province; ``places`` is GeoJSON with one
    feature per line. Tracts are laid over the circuits of their own province; polygons with crossing edges are repaired.
    """
    write_stage(geography.prepare_tracts(geo.read_provinces(spark, tracts, PROVINCES)), f"{out}/tracts")
    write_stage(geography.prepare_circuits(geo.read_provinces(spark, circuits, PROVINCES)), f"{out}/circuits")
    planar_tracts, planar_circuits = read_stage(spark, f"{out}/tracts"), read_stage(spark, f"{out}/circuits")
    shares = geography.overlay_shares(planar_tracts, geography.circuit_ids(planar_circuits))
    write_stage(geography.without_slivers(shares), f"{out}/tract_shares")

    points = geography.place_points(geo.read_points(spark, places, schemas.POLLING_PLACE))
    write_stage(geography.section_matches(points, planar_circuits), f"{out}/section_matches")
    write_stage(geography.best_matches(read_stage(spark, f"{out}/section_matches")), f"{out}/section_crosswalk")
    lookup = geography.full_lookup(
        read_stage(spark, f"{out}/tract_shares"),
        read_stage(spark, f"{out}/section_crosswalk"),
        read_stage(spark, f"{out}/{LOOKUP_ELECTION}_wide"),
        f"{LOOKUP_ELECTION}_blanco",
    )
    write_stage(lookup, f"{out}/lookup")


def read_dictionary(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """The dictionary of final columns; it has one row per column, so it fits the driver."""
    rows = text.with_file_order(text.read_semicolon(spark, path, schemas.DICTIONARY)).orderBy("ordinal").collect()
    return [(r.vars, r.in_file, r.new_name) for r in rows]


def create_final(spark: SparkSession, dictionary: str, out: str) -> None:
    """The final table as Parquet (``final``) and semicolon text (``final_csv``)."""
    long = read_stage(spark, f"{out}/census_long")
    names = [
        c
        for table in ("census_wide", "census_totals")
        for c in read_stage(spark, f"{out}/{table}").columns[1:]
    ]
    elections = {e: read_stage(spark, f"{out}/{e}_wide") for e in ELECTION_ORDER}
    table = final_table(read_stage(spark, f"{out}/lookup"), long, names, elections, read_dictionary(spark, dictionary))
    write_stage(table, f"{out}/final")
    text.write_semicolon(read_stage(spark, f"{out}/final"), f"{out}/final_csv")


def analyse(spark: SparkSession, out: str, outcomes: Sequence[str] = reports.MODEL_OUTCOMES) -> None:
    """Correlations, models and chart series of the final table."""
    final = reports.with_changes(read_stage(spark, f"{out}/final"))
    write_stage(reports.correlation_report(final), f"{out}/correlations")
    ranked = read_stage(spark, f"{out}/correlations")
    write_stage(reports.peron_shift(ranked), f"{out}/correlation_shift_peron")
    write_stage(reports.macri_shift(ranked), f"{out}/correlation_shift_macri")
    for outcome, model in reports.models(final, outcomes).items():
        write_stage(model.steps(), f"{out}/model_{outcome}/steps")
        write_stage(model.cv_results(), f"{out}/model_{outcome}/cv_results")
        write_stage(model.coefficients(), f"{out}/model_{outcome}/coefficients")
    for name, series in {
        "peron": reports.peron_series,
        "macri": reports.macri_series,
        "unemployment": reports.unemployment_series,
        "landline": reports.landline_series,
        "pairs_2015": reports.pairs_2015,
        "pairs_2019": reports.pairs_2019,
    }.items():
        write_stage(series(final), f"{out}/chart_{name}")


def run(
    spark: SparkSession, data: str, prefixes: Mapping[str, str], dictionary: str, out: str
) -> DataFrame:
    """All stages in order, with polygons in ``tracts/`` and ``circuits/`` and places in ``places.json``."""
    prepare_elections(spark, data, out)
    prepare_census(spark, data, out, prefixes)
    create_lookup(spark, f"{data}/tracts", f"{data}/circuits", f"{data}/places.json", out)
    create_final(spark, dictionary, out)
    return read_stage(spark, f"{out}/final")
