"""All stages from files, on a small country of two provinces."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import SparkSession, functions as F

from zonalis import jobs
from zonalis.operators.geometry import RINGS_TYPE
from zonalis.operators.projection import CENSUS_ZONE, map_vertices
from zonalis.plans import reports
from zonalis.plans.votes import PRESIDENT

CIRCUITS = [("01", "001", "12"), ("01", "001", "13"), ("02", "003", "0004"), ("02", "003", "27A")]
PREFIXES = {"PERSONA-P02.csv": "per_sexo_", "HOGAR-ALGUNBI.csv": "ho_nbi_", "VIVIENDA-URP.csv": "vi_urban_", "VIVIENDA-INCALCONS.csv": "vi_cal_cons_"}


def _box(k: int, rows: float = 1.0, step: float = 0.02) -> list[list[dict[str, float]]]:
    x0, y0 = -60.0 + k * step, -35.0
    corners = [(x0, y0), (x0 + step, y0), (x0 + step, y0 + 0.02 * rows), (x0, y0 + 0.02 * rows), (x0, y0)]
    return [[{"x": x, "y": y} for x, y in corners]]


def _write(path: Path, lines: list[str], encoding: str = "utf-8") -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))


@pytest.fixture(scope="module")
def data(spark: SparkSession, tmp_path_factory: pytest.TempPathFactory) -> Path:
    root, rng = tmp_path_factory.mktemp("data"), random.Random(1)
    for folder, votes_file, blank in jobs.ELECTIONS_2019.values():
        base = root / folder
        votes = ["CODIGO_CATEGORIA|CODIGO_DISTRITO|CODIGO_SECCION|CODIGO_CIRCUITO|CODIGO_MESA|CODIGO_AGRUPACION|VOTOS_AGRUPACION"]
        totals = ["CODIGO_CATEGORIA|CODIGO_MESA|CONTADOR|VALOR"]
        for i, (p, d, c) in enumerate(CIRCUITS):
            for box in range(3):
                mesa = f"{i:02d}{box:03d}"
                for party in ("136", "135", "87"):
                    votes.append(f"{PRESIDENT}|{p}|{p}{d}|{p}{d}{c.rjust(6, '0')}|{mesa}|{party}|{rng.randint(50, 90)}")
                totals.append(f"{PRESIDENT}|{mesa}|{blank}|{rng.randint(1, 9)}")
        _write(base / votes_file, votes)
        _write(base / "mesas_totales.dsv", totals)
        _write(base / "descripcion_regiones.dsv", ["CODIGO_REGION|NOMBRE_REGION", "01|CABA", "02|Buenos Aires"])
        _write(
            base / "descripcion_postulaciones.dsv",
            ["CODIGO_CATEGORIA|NOMBRE_CATEGORIA|CODIGO_AGRUPACION|NOMBRE_AGRUPACION"]
            + [f"{PRESIDENT}|x|{c}|{n}" for c, n in (("136", "FRENTE DE TODOS"), ("135", "JUNTOS POR EL CAMBIO"), ("87", "OTRA"))],
        )
    parties = [
        "CODIGO_PARTIDO;LISTA_INTERNA;AGRUPACION;DENOMINACION",
        "0131;1;x;ALIANZA FRENTE PARA LA VICTORIA",
        "0135;1;x;ALIANZA CAMBIEMOS",
        "0138;1;x;ALIANZA UNIDOS POR UNA NUEVA ALTERNATIVA (UNA)",
        "0900;1;x;OTRA",
    ]
    _write(root / jobs.PARTIES_FILE_2015, parties)
    for files in jobs.ELECTIONS_2015.values():
        for file, province in zip(files, ("02", "01"), strict=True):
            rows = ["CODIGO PROVINCIA;CODIGO DEPARTAMENTO;CODIGO CIRCUITO;CODIGO MESA;CODIGO VOTOS;VOTOS"]
            for p, d, c in CIRCUITS:
                if p == province:
                    rows += [f"{p};{d};{c};1;{code};{rng.randint(20, 99)}" for code in ("0131", "0135", "0138", "0900", "9004", "9001")]
            _write(root / file, rows)
    for name, labels in {
        "PERSONA-P02.csv": ["1 Varón", "2 Mujer"],
        "HOGAR-ALGUNBI.csv": ["1 Sí", "2 No"],
        "VIVIENDA-URP.csv": ["1 Urbano", "2 Rural"],
        "VIVIENDA-INCALCONS.csv": ["1 Satisfactoria", "2 Insuficiente"],
    }.items():
        rows = [",".join(["radio", *labels, "TOTAL"])]
        for k in range(8):
            counts = [10 * (k + 1), 30]
            rows.append(",".join(map(str, [f"r{k}", *counts, sum(counts)])))
        _write(root / "census" / name, rows, "latin-1")
    tracts = [("01" if k < 4 else "02", f"r{k}", _box(k, step=0.01)) for k in range(8)]
    frame = spark.createDataFrame(tracts, f"province string, link string, rings {RINGS_TYPE}")
    frame.withColumn("rings", map_vertices(F.col("rings"), CENSUS_ZONE.forward)).write.partitionBy("province").parquet(str(root / "tracts"))
    circuits = [(p, "file", "x", p, d, c, _box(k)) for k, (p, d, c) in enumerate(CIRCUITS)]
    spark.createDataFrame(
        circuits, f"province string, source_file string, provincia string, indec_p string, indec_d string, circuito string, rings {RINGS_TYPE}"
    ).write.partitionBy("province").parquet(str(root / "circuits"))
    places = [
        {"type": "Feature", "properties": {"ID_DISTRITO": int(p), "ID_SECCION": int(d)}, "geometry": {"type": "Point", "coordinates": [-60.0 + 0.02 * k + 0.01, -34.99]}}
        for k, (p, d, _) in enumerate(CIRCUITS)
    ]
    _write(root / "places.json", [json.dumps(f) for f in places])
    names = ["id_circuito_elec", "ho_nbi_Sí", "per_sexo_Mujer", "vi_urban_Urbano", "vi_cal_cons_Insuficiente"]
    names += [f"{e}_{c}" for e in ("paso19", "pres19") for c in ("blanco", "validos", "cand_FdT", "cand_JxC", "cand_Otros")]
    names += [f"{e}_{c}" for e in ("pres15", "paso15") for c in ("blanco", "validos", "cand_Cam", "cand_FPV", "cand_Otros", "cand_UNA")]
    lines = ["vars;in_file;new_name", *[f"{n};1;{n.replace('í', 'i')}" for n in names], "ho_nbi_No;0;"]
    _write(root / "varnames.csv", lines)
    return root


def test_all_stages(spark: SparkSession, data: Path, tmp_path: Path) -> None:
    final = jobs.run(spark, str(data), PREFIXES, str(data / "varnames.csv"), str(tmp_path))
    assert final.columns[:3] == ["id_circuito_elec", "province", "ho_nbi_Si"]
    rows = {r.id_circuito_elec: r for r in final.collect()}
    assert sorted(rows) == ["01001000012", "01001000013", "02003000004", "0200300027A"]
    assert {r.province for r in rows.values()} == {"CABA", "Buenos Aires"}
    for k, (p, d, c) in enumerate(CIRCUITS):
        r = rows[f"{p}{d}{c.rjust(6, '0')}"]
        # two tracts lie in each circuit: 10 * (2k + 1) + 10 * (2k + 2) with, 60 without
        part = 10 * (4 * k + 3)
        assert r.ho_nbi_Si == pytest.approx(100 * part / (part + 60))
        assert r.per_sexo_Mujer == pytest.approx(100 * 60 / (part + 60))
        for e, labels in (("paso19", ("FdT", "JxC", "Otros")), ("pres19", ("FdT", "JxC", "Otros")), ("paso15", ("Cam", "FPV", "UNA", "Otros"))):
            shown = sum(r[f"{e}_cand_{x}"] for x in labels) + 100 * r[f"{e}_blanco"] / r[f"{e}_validos"]
            assert shown == pytest.approx(100)
    text = "".join(p.read_text() for p in sorted((tmp_path / "final_csv").glob("part-*")))
    assert text.startswith("id_circuito_elec;province;") and "," in text


def test_analysis_stage(spark: SparkSession, tmp_path: Path) -> None:
    from zonalis.queries.registry import Tables
    from zonalis.queries.spatial import build_final
    from zonalis.sources.stage import write_stage

    write_stage(build_final(Tables(spark, "/root/testdata/sf0.01")), f"{tmp_path}/final")
    outcome = "change_peron_paso19_paso15"
    jobs.analyse(spark, str(tmp_path), [outcome])
    steps = spark.read.parquet(f"{tmp_path}/model_{outcome}/steps").orderBy("size").collect()
    assert [s.size for s in steps] == list(range(1, len(steps) + 1)) and len(steps) == 10
    # the first variable is the one with the strongest correlation
    final = reports.with_changes(spark.read.parquet(f"{tmp_path}/final"))
    features = reports.model_features(final)
    corr = final.select(outcome, *features).toPandas().dropna().corr()[outcome][features].abs()
    assert steps[0].added == corr.idxmax() and steps[0].r2 == pytest.approx(corr.max() ** 2)
    assert spark.read.parquet(f"{tmp_path}/model_{outcome}/coefficients").count() == 5
    assert spark.read.parquet(f"{tmp_path}/chart_landline").select("facet").distinct().count() == 2
