"""The roll-ups against the definition, row by row in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import SparkSession

from zonalis.queries import queries
from zonalis.plans.votes import PRESIDENT, circuits_2015, circuits_2019, wide, SHORT_2019
from zonalis.schemas import BOX_VOTES_2019, PARTIES_2015, VOTES_2015

NAMES = {"A": "FRENTE DE TODOS", "B": "JUNTOS POR EL CAMBIO", "C": "PARTIDO C"}
LABELS = {"FRENTE DE TODOS": "Frente de Todos", "JUNTOS POR EL CAMBIO": "Juntos por el Cambio"}


LONG_COLUMNS_2015 = ("year", "id_circuito_elec", "votos_blanco", "votos_validos", "partido", "votos_candidatura")


def strict(values: list) -> int | None:
    return None if any(v is None for v in values) else sum(values)


def expected_2019(votes: list, totals: list, regions: list) -> set:
    blanks = defaultdict(list)
    for _, box, counter, value, ordinal in totals:
        if counter == "VB":
            blanks[box].append((ordinal, value))
    in_box = defaultdict(list)
    for v in votes:
        in_box[v[4]].append(v[6])
    region_rows = defaultdict(int)
    for code, _ in regions:
        region_rows[code] += 1
    box_total, label_votes = {}, defaultdict(list)
    for _, district, section, circuit, box, party, n in votes:
        first_blank = min(blanks[box])[1] if blanks[box] else None
        cast = strict(in_box[box])
        box_total[circuit, box] = (first_blank, None if cast is None or first_blank is None else cast + first_blank)
        if district in ("01", "02"):
            name = NAMES.get(party)
            label = None if name is None else LABELS.get(name, "Otros")
            times = max(1, len(blanks[box])) * max(1, region_rows[district]) * max(1, region_rows[section])
            label_votes[circuit, label] += [n] * times
    per_circuit = defaultdict(list)
    for (circuit, _), pair in box_total.items():
        per_circuit[circuit].append(pair)
    return {
        (2019, c, strict([b for b, _ in per_circuit[c]]), strict([v for _, v in per_circuit[c]]), label, strict(ns))
        for (c, label), ns in label_votes.items()
    }


@pytest.mark.parametrize("seed", range(4))
def test_2019_against_definition(spark: SparkSession, seed: int) -> None:
    rng = random.Random(seed)
    votes, totals = [], []
    for box in range(40):
        for _ in range(rng.randint(1, 6)):
            circuit = f"c{rng.randint(0, 6)}"
            district = f"0{rng.randint(1, 3)}"
            n = None if rng.random() < 0.02 else rng.randint(0, 99)
            votes.append((PRESIDENT, district, district + "001", circuit, str(box), rng.choice("ABCD"), n))
        for _ in range(rng.choice([0, 1, 1, 1, 1, 1, 1, 1, 2])):
            totals.append((PRESIDENT, str(box), "VB", rng.randint(0, 9), len(totals)))
        totals.append((PRESIDENT, str(box), "VN", 99, len(totals)))
    regions = [("01", "x"), ("02", "y"), ("02", "y again"), ("03", "z"), ("01001", "s")]
    parties = [(PRESIDENT, c, n, i) for i, (c, n) in enumerate(NAMES.items())] + [(PRESIDENT, "A", "SECOND NAME", 9)]
    got = circuits_2019(
        spark.createDataFrame(votes, BOX_VOTES_2019),
        spark.createDataFrame(totals, "codigo_categoria string, codigo_mesa string, contador string, valor bigint, ordinal int"),
        spark.createDataFrame(parties, "codigo_categoria string, codigo_agrupacion string, nombre_agrupacion string, ordinal int"),
        spark.createDataFrame(regions, "codigo_region string, nombre_region string"),
        "VB",
    )
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == expected_2019(votes, totals, regions)
    table = wide(got, "paso19", SHORT_2019)
    assert table.columns[1:] == ["paso19_blanco", "paso19_validos", "paso19_cand_FdT", "paso19_cand_JxC", "paso19_cand_Otros"]
    assert table.count() == len({r[1] for r in rows})


@pytest.mark.parametrize("seed", range(3))
def test_2015_against_definition(spark: SparkSession, seed: int) -> None:
    rng = random.Random(seed)
    listed = [
        ("0101", "1", "x", "ALIANZA CAMBIEMOS"),
        ("0102", "1", "x", "ALIANZA FRENTE PARA LA VICTORIA"),
        ("0102", "2", "x", "ALIANZA FRENTE PARA LA VICTORIA"),
        ("0103", "1", "x", "PARTIDO 3"),
        ("0103", "2", "x", "ALIANZA CAMBIEMOS"),
    ]
    labels = {"ALIANZA CAMBIEMOS": "Cambiemos", "ALIANZA FRENTE PARA LA VICTORIA": "Frente Para la Victoria"}
    votes = []
    for _ in range(300):
        circuit = rng.choice(["7", "12", "345", "1234567"])
        code = rng.choice(["101", "102", "0103", "104", "9004", "9001"])
        votes.append((f"0{rng.randint(1, 2)}", "003", circuit, code, "bad" if rng.random() < 0.01 else str(rng.randint(0, 50))))
    votes = [v for v in votes if not (v[2] == "12" and v[3] == "9004")]

    zones = {v[:3] for v in votes}
    want = set()
    for zone in zones:
        numbers = [(int(v[3]), None if v[4] == "bad" else int(v[4])) for v in votes if v[:3] == zone]
        blank = [n for c, n in numbers if c == 9004]
        blank_sum = strict(blank) if blank else None
        party = [n for c, n in numbers if c < 9000]
        valid = None if blank_sum is None or strict(party) is None else blank_sum + strict(party)
        by_label = defaultdict(list)
        for c, n in numbers:
            if c < 9000:
                for name in [d for p, _, _, d in listed if int(p) == c] or [None]:
                    by_label[None if name is None else labels.get(name, "Otros")].append(n)
        pad = {2: "0000", 3: "000"}.get(len(zone[2]), "NA")
        for label, ns in by_label.items():
            want.add((2015, f"{zone[0]}{zone[1]}{pad}{zone[2]}", blank_sum, valid, label, strict(ns)))
    files = [spark.createDataFrame(votes[:150], VOTES_2015), spark.createDataFrame(votes[150:], VOTES_2015)]
    got = circuits_2015(files, spark.createDataFrame([(p, d) for p, _, _, d in listed], PARTIES_2015))
    assert {tuple(r[c] for c in LONG_COLUMNS_2015) for r in got.collect()} == want


def test_every_ballot_join_can_be_split(spark: SparkSession) -> None:
    """Without broadcasts, both sides of each join stand on an exchange of their own, and no window gathers boxes."""
    folder = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queries()["elections_2019_long"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-")) for line in plan.splitlines()]
    joins = 0
    for k, (depth, text) in enumerate(lines):
        if not text.startswith("SortMergeJoin"):
            continue
        joins += 1
        below = [i for i in range(k + 1, len(lines)) if lines[i][0] == depth + 3][:2]
        for child in below:
            names = [lines[i][1].split("(")[0].split(" ")[0] for i in range(child, child + 4)]
            assert names[0] == "Sort" and names[1] == "Exchange", names
    assert joins >= 4 and "Window" not in plan


def test_ballots_of_a_party_or_region_are_dealt_to_salts(spark: SparkSession) -> None:
    """The joins of ballots with parties, districts and sections have the salt as a key, as each of these holds a large share of all."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, keys in (("elections_2019_long", ("codigo_agrupacion", "codigo_distrito", "codigo_seccion")), ("elections_2015_long", ("code",))):
            plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            joins = [line.split("SortMergeJoin ")[1] for line in plan.splitlines() if "SortMergeJoin " in line]
            for key in keys:
                own = [j for j in joins if j.startswith(f"[coalesce({key}#")]
                assert own and all("__salt" in j for j in own), (key, joins)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
