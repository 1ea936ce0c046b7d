"""Sources, census files, interpolation and the final table on small fixtures."""

from __future__ import annotations

import itertools
import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F, types as T

from zonalis import schemas
from zonalis.plans.census import category_files, census_wide, fan_in, total_files, within_first
from zonalis.plans.final import census_percentages, final_table, interpolate
from zonalis.plans.geography import full_lookup, overwrite_province
from zonalis.session import stage_root
from zonalis.sources import geo, links, text


def test_pipe_file_keeps_zeroes_and_order(spark: SparkSession, tmp_path: Path) -> None:
    (tmp_path / "t.dsv").write_text("CODIGO_MESA|EXTRA|CODIGO_CATEGORIA|CONTADOR|VALOR\n0007|x|000100000000000|VB|12\n0003|y|000100000000000|VB|\n")
    df = text.with_file_order(text.read_pipe(spark, str(tmp_path / "t.dsv"), schemas.BOX_TOTALS_2019))
    rows = df.orderBy("ordinal").collect()
    assert [(r.codigo_mesa, r.valor) for r in rows] == [("0007", 12), ("0003", None)]
    assert df.columns[:4] == ["codigo_categoria", "codigo_mesa", "contador", "valor"]
    assert rows[0].codigo_categoria == "000100000000000"
    with pytest.raises(ValueError, match="nombre_region"):
        text.read_pipe(spark, str(tmp_path / "t.dsv"), schemas.REGIONS_2019)


def test_semicolon_round_trip(spark: SparkSession, tmp_path: Path) -> None:
    df = spark.createDataFrame([("01001", 1234.5, 3), ("02", None, None)], "id string, pct double, n int")
    text.write_semicolon(df, str(tmp_path / "out"))
    body = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*")))
    assert "01001;1234,5;3" in body and "02;NA;NA" in body
    schema = text.strings("id").add("pct", T.DoubleType())
    back = text.read_semicolon(spark, str(tmp_path / "out"), schema).orderBy("id").collect()
    assert [(r.id, r.pct) for r in back] == [("01001", 1234.5), ("02", None)]


def _census_folder(folder: Path) -> str:
    files = {
        "PERSONA-P02.csv": 'radio,"1 Varón","2 Mujer",TOTAL\n020010101,4,6,10\n020010102,1,3,4\n020010103,2,2,4\n',
        "EDAD.csv": "radio,1 0-4,2 5-9,10 45-49,TOTAL\n020010101,1,2,7,10\n020010102,4,0,0,4\n",
    }
    for name, body in files.items():
        (folder / name).write_bytes(body.encode("latin-1"))
    return str(folder)


def test_census_files(spark: SparkSession, tmp_path: Path) -> None:
    folder = _census_folder(tmp_path)
    tables = category_files(spark, folder, {"PERSONA-P02.csv": "per_sexo_", "EDAD.csv": "per_edad_"})
    assert tables[0].columns == ["radio", "per_sexo_Varón", "per_sexo_Mujer"]
    assert tables[1].columns == ["radio", "per_edad_0-4", "per_edad_5-9", "per_edad__45-49"]
    wide = census_wide(tables).orderBy("radio").collect()
    assert [tuple(r) for r in wide] == [("020010101", 4, 6, 1, 2, 7), ("020010102", 1, 3, 4, 0, 0), ("020010103", 2, 2, None, None, None)]
    # the first file decides which tracts there are
    assert [r.radio for r in census_wide(tables[::-1]).orderBy("radio").collect()] == ["020010101", "020010102"]
    assert fan_in(tables).count() == 12
    [totals] = total_files(spark, folder, {"per_": "PERSONA-P02.csv"})
    assert [tuple(r) for r in totals.orderBy("radio").collect()] == [("020010101", 10), ("020010102", 4), ("020010103", 4)]


def test_geojson(spark: SparkSession, tmp_path: Path) -> None:
    features = [
        {"type": "Feature", "properties": {"ID_DISTRITO": 2, "ID_SECCION": k}, "geometry": {"type": "Point", "coordinates": [k + 0.5, -34.0]}}
        for k in range(3)
    ]
    (tmp_path / "all.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, features)))
    names = {"ID_DISTRITO": T.IntegerType(), "ID_SECCION": T.IntegerType()}
    whole = geo.read_points(spark, str(tmp_path / "all.geojson"), names, collection=True)
    lines = geo.read_points(spark, str(tmp_path / "lines.json"), names)
    assert whole.columns == ["id_distrito", "id_seccion", "x", "y"]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, lines.collect())) == [(2, k, k + 0.5, -34.0) for k in range(3)]


def test_provinces_are_pruned(spark: SparkSession, tmp_path: Path) -> None:
    path = str(tmp_path / "polygons")
    rows = spark.createDataFrame([("01", 1), ("02", 2), ("06", 3)], "province string, id int")
    rows.write.partitionBy("province").parquet(path)
    kept = geo.read_provinces(spark, path, ["01", "02"])
    assert {(r.province, r.id) for r in kept.collect()} == {("01", 1), ("02", 2)}
    plan = kept._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "province" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_links(spark: SparkSession) -> None:
    html = '<a href="HOGAR-ALGUNBI.csv">x</a> <a class=b href=\'y.html\'>y</a> <a href="VIVIENDA-V00.csv">z</a>'
    found = links.harvest_links(spark.createDataFrame([(1, html)], "page int, html string"))
    assert [r.href for r in found.orderBy("position").collect()] == ["HOGAR-ALGUNBI.csv", "y.html", "VIVIENDA-V00.csv"]
    assert [r.href for r in links.data_files(found).collect()] == ["HOGAR-ALGUNBI.csv"]


def test_links_of_all_forms(spark: SparkSession) -> None:
    html = """<A HREF=a.csv>1</A> <a href = 'b c.csv' >2</a> <a data-href="no.csv">-</a> <!-- <a href="no.csv"> --> <abbr href="no.csv">
      <a title="x > y" href="c.csv?p=1&amp;q=2">3</a> <a
      href="d.csv"
      class=x>4</a> <a name=top>-</a> <a href=''>-</a><a title="href=no.csv" href=e.csv>5</a><a href="f&quot;.csv"/>"""
    found = links.harvest_links(spark.createDataFrame([(1, html), (2, None), (3, "")], "page int, html string"))
    got = [r.href for r in found.orderBy("page", "position").collect()]
    assert got == ["a.csv", "b c.csv", "c.csv?p=1&q=2", "d.csv", "", "e.csv", 'f".csv']


def test_province_overwrite_is_per_file(spark: SparkSession) -> None:
    df = spark.createDataFrame([("f1", "Río Negro", "62"), ("f1", None, "62"), ("f2", "Chaco", "22"), ("f3", None, "10")], "source_file string, provincia string, indec_p string")
    assert sorted(r.indec_p for r in overwrite_province(df).collect()) == ["10", "22", "63", "63"]


def _lookup(spark: SparkSession) -> object:
    shares = spark.createDataFrame(
        [("t1", "02001000012", 0.25), ("t1", "02001000013", 0.75), ("t2", "02001000013", 1.0), ("t9", "02001000014", 1.0), ("t1", "99001000012", 0.1)],
        "id_radio string, id_circuito string, por_radio double",
    )
    sections = spark.createDataFrame([("02003", "02001")], "id_seccion_elec string, id_seccion_indec string")
    paso = spark.createDataFrame(
        [("02003000012", 5, 50, 30), ("02003000013", 6, 60, 15), ("02003000014", 7, 0, 0), ("02003000015", None, 9, 1)],
        "id_circuito_elec string, paso19_blanco int, paso19_validos int, paso19_cand_FdT int",
    )
    return full_lookup(shares, sections, paso, "paso19_blanco"), paso


def test_lookup_interpolation_and_final(spark: SparkSession) -> None:
    lookup, paso = _lookup(spark)
    assert {(r.id_radio, r.id_circuito_elec) for r in lookup.collect()} == {
        ("t1", "02003000012"), ("t1", "02003000013"), ("t2", "02003000013"), ("t9", "02003000014")
    }
    census = spark.createDataFrame(
        [("t1", "ho_a", 10), ("t1", "ho_TOTAL", 20), ("t2", "ho_a", 4), ("t2", "ho_TOTAL", 8), ("t1", "vi_urban_u", 6), ("t1", "vi_urban_TOTAL", 12)],
        "radio string, var string, value bigint",
    )
    names = ["ho_a", "ho_TOTAL", "vi_urban_u", "vi_urban_TOTAL"]
    counts = {r.id_circuito_elec: tuple(r)[1:] for r in interpolate(lookup, census, names).collect()}
    # 0.25 * 10 = 2.5 -> 2 and 0.75 * 10 + 4 = 11.5 -> 12: halves go to even
    assert counts == {"02003000012": (2.0, 5.0, 2.0, 3.0), "02003000013": (12.0, 23.0, 4.0, 9.0), "02003000014": (0.0,) * 4}
    zones = census_percentages(interpolate(lookup, census, names))
    assert zones.columns == ["id_circuito_elec", "ho_a", "vi_urban_u"]
    table = final_table(
        lookup, census, names, {"paso19": paso},
        [("id_circuito_elec", 1, "id_circuito_elec"), ("ho_a", 1, "ho_owner"), ("vi_urban_u", 0, ""), ("paso19_cand_FdT", 1, "paso19_cand_FdT"), ("paso19_blanco", 1, "paso19_blanco")],
    )
    rows = {r.id_circuito_elec: r for r in table.collect()}
    assert table.columns == ["id_circuito_elec", "province", "ho_owner", "paso19_cand_FdT", "paso19_blanco"]
    assert rows["02003000012"].ho_owner == 40.0 and rows["02003000012"].paso19_cand_FdT == 60.0
    assert rows["02003000014"].ho_owner is None and rows["02003000014"].paso19_cand_FdT is None
    assert {r.province for r in rows.values()} == {"Buenos Aires"}


def test_stage_root_comes_from_the_session(spark: SparkSession) -> None:
    assert stage_root(spark) == f"{spark.conf.get('spark.checkpoint.dir')}/stages-{spark.sparkContext.applicationId}"


def test_staged_tables_go_with_the_application(tmp_path: Path) -> None:
    """Nothing is left in the shared folder."""
    script = f"""
from zonalis.session import build_session
from zonalis.sources.stage import staged
spark = build_session("local[1]", **{{"spark.checkpoint.dir": "{tmp_path}/shared"}})
table = staged(spark.range(5), "numbers")
print("AT", table.inputFiles()[0], table.count())
spark.stop()
"""
    out = subprocess.run([sys.executable, "-c", script], cwd=Path(__file__).parents[1], capture_output=True, text=True, timeout=300)
    assert f"{tmp_path}/shared/stages-" in out.stdout and out.stdout.strip().endswith(" 5"), out.stderr[-2000:]
    assert not list(tmp_path.glob("shared/stages-*"))


def test_census_of_tracts_that_the_first_file_lacks(spark: SparkSession) -> None:
    first = spark.createDataFrame([("t1", 5)], "radio string, per_a int")
    second = spark.createDataFrame([("t1", 1), ("t2", 7)], "radio string, per_b int")
    long = within_first([first, second])
    assert {tuple(r) for r in long.collect()} == {("t1", "per_a", 5), ("t1", "per_b", 1)}
    lookup = spark.createDataFrame([("t1", "c", 1.0), ("t2", "c", 1.0)], "id_radio string, id_circuito_elec string, por_radio double")
    assert tuple(interpolate(lookup, long, ["per_a", "per_b"]).first()) == ("c", 5.0, 1.0)


def test_totals_over_covered_zones_are_kept(spark: SparkSession) -> None:
    lookup = spark.createDataFrame([("t1", "a", 0.5), ("t1", "b", 0.5), ("t2", "b", 1.0)], "id_radio string, id_circuito_elec string, por_radio double")
    census = spark.createDataFrame([("t1", "per_TOTAL", 100), ("t2", "per_TOTAL", 40)], "radio string, var string, value bigint")
    assert interpolate(lookup, census, ["per_TOTAL"]).agg(F.sum("per_TOTAL")).first()[0] == pytest.approx(140)


def test_interpolated_counts_do_not_depend_on_the_order_of_rows(spark: SparkSession) -> None:
    shares = [0.20195, 0.16488, 0.39712, 0.73605]  # a sum of 1.5, which doubles give in some orders only
    census = spark.createDataFrame([(f"r{k}", "per_x", 1.0) for k in range(4)] + [("r0", "per_y", None), ("r1", "per_y", float("nan"))], "radio string, var string, value double")
    for order in itertools.permutations(range(4)):
        lookup = spark.createDataFrame([(f"r{k}", "c", shares[k]) for k in order], "id_radio string, id_circuito_elec string, por_radio double")
        assert [tuple(r) for r in interpolate(lookup.coalesce(1), census, ["per_x", "per_y"]).collect()] == [("c", 2.0, 0.0)]
    lookup = spark.createDataFrame([("r0", "c", 0.5), ("r1", "c", 0.0), ("r2", "d", 1.5)], "id_radio string, id_circuito_elec string, por_radio double")
    found = {r[0]: tuple(r)[1:] for r in interpolate(lookup, census, ["per_x", "per_y"]).collect()}
    assert found == {"c": (0.0, 0.0), "d": (2.0, 0.0)}


def test_tracts_of_a_section_are_dealt_to_salts(spark: SparkSession) -> None:
    """Rows and columns as ever; without broadcasts the join on the few sections has the salt as a key."""
    shares = spark.createDataFrame([("r1", "01001000007", 0.5), ("r2", "01001000007", 0.25), ("r3", "02002000008", 1.0)], "id_radio string, id_circuito string, por_radio double")
    sections = spark.createDataFrame([("05005", "01001"), ("06006", "01001")], "id_seccion_elec string, id_seccion_indec string")
    known = spark.createDataFrame([("05005000007", 1), ("06006000007", 2), ("NA000008", 3)], "id_circuito_elec string, blank int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = full_lookup(shares, sections, known, "blank")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert any("SortMergeJoin [id_seccion_indec" in line and "__salt" in line for line in plan.splitlines()), plan
        rows = {(r.id_radio, r.id_circuito_elec, r.por_radio) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "__salt" not in out.columns
    assert rows == {(r, c, s) for r, s in (("r1", 0.5), ("r2", 0.25)) for c in ("05005000007", "06006000007")} | {("r3", "NA000008", 1.0)}
