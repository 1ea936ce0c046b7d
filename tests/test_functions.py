from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import Row, SparkSession, functions as F

from zonalis import functions as fn
from zonalis.operators import joins, selectors as sel
from zonalis.operators.joins import attach_group_values, fan_out, join_fold, left_join, salted_left_join
from zonalis.operators.reshape import stack, to_wide
from zonalis.queries import queries


def test_sums_and_missing_values(spark: SparkSession) -> None:
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 3), ("c", None)], "k string, x int")
    rows = {
        r.k: (r.strict, r.skip)
        for r in df.groupBy("k")
        .agg(fn.strict_sum(F.col("x")).alias("strict"), fn.skipna_sum(F.col("x")).alias("skip"))
        .collect()
    }
    assert rows == {"a": (None, 1), "b": (5, 5), "c": (None, 0)}


def test_strict_sum_where_needs_a_row(spark: SparkSession) -> None:
    df = spark.createDataFrame([("a", 9, 1), ("a", 1, None), ("b", 1, 2), ("c", 9, None)], "k string, code int, x int")
    got = df.groupBy("k").agg(fn.strict_sum_where(F.col("code") == 9, F.col("x")).alias("s")).collect()
    assert {r.k: r.s for r in got} == {"a": 1, "b": None, "c": None}


def test_codes(spark: SparkSession) -> None:
    codes = ["7", "12", "123", "1234", "12345", "123456", "1234567"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    z = fn.circuit_zeroes(F.col("c"))
    rows = df.select(z.alias("z"), fn.paste(F.lit("01"), z, F.col("c")).alias("id")).collect()
    assert [r.z for r in rows] == [None, "0000", "000", "00", "0", "", None]
    assert [r.id for r in rows][:3] == ["01NA7", "01000012", "01000123"]
    assert rows[-1].id == "01NA1234567"


def test_section_code_and_slices(spark: SparkSession) -> None:
    row = spark.range(1).select(
        fn.section_code(F.lit(2), F.lit(7)).alias("s"), fn.slice_text(F.lit("01003000012"), 6, 11).alias("t")
    ).first()
    assert (row.s, row.t) == ("02007", "000012")


def test_numbers(spark: SparkSession) -> None:
    df = spark.createDataFrame([("12.7",), ("-3",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.as_integer(F.col("t"))).collect()] == [12, -3, None, None]
    commas = spark.createDataFrame([("1.234,5",), ("0,25",), ("7",), ("1.234.567",), ("NA",)], "t string")
    assert [r[0] for r in commas.select(fn.decimal_comma_text(F.col("t"))).collect()] == [1234.5, 0.25, 7.0, 1234567.0, None]
    halves = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in halves.select(fn.round_even(F.col("x"))).collect()] == [0.0, 2.0, 2.0, 0.0]
    assert spark.range(1).select(fn.percent_of(F.lit(1.0), F.lit(0.0))).first()[0] is None
    nan = spark.createDataFrame([(math.nan,), (1.0,)], "x double").select(fn.null_if_nan(F.col("x")))
    assert [r[0] for r in nan.collect()] == [None, 1.0]


def test_recode(spark: SparkSession) -> None:
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "p string")
    assert [r[0] for r in df.select(fn.recode(F.col("p"), {"A": "Alfa"}, "Otros")).collect()] == ["Alfa", "Otros", None]
    assert [r[0] for r in df.select(fn.recode(F.col("p"), {"A": "Alfa"})).collect()] == ["Alfa", "Z", None]


def test_category_names_keep_the_first_cut() -> None:
    assert sel.category_names(["1 0-4", "2 5-9", "10 45-49"], "p_") == ["p_0-4", "p_5-9", "p__45-49"]


def test_selectors(spark: SparkSession) -> None:
    df = spark.createDataFrame([(1, 2, 3, 4)], "Vi_a int, vi_TOTAL int, ho_a int, per_a int")
    assert sel.starts_with(df, "vi") == ["Vi_a", "vi_TOTAL"]
    assert sel.ends_with(df, "total") == ["vi_TOTAL"]
    assert sel.between(df, "vi_TOTAL", "per_a") == ["vi_TOTAL", "ho_a", "per_a"]
    assert sel.everything(df, "per_a") == ["per_a", "Vi_a", "vi_TOTAL", "ho_a"]
    try:
        sel.dictionary_projection(df, [("absent", 1, "x")])
    except ValueError as e:
        assert "absent" in str(e)
    else:
        raise AssertionError("a missing dictionary column must be an error")


def test_group_values_with_hot_and_missing_keys(spark: SparkSession) -> None:
    rows = [("hot", i) for i in range(500)] + [(None, i) for i in range(300)] + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, x int")
    values = {"n": F.count(F.lit(1)), "top": F.max("x")}
    plain = sorted(map(str, attach_group_values(df, ["k"], values).collect()))
    assert len(plain) == len(rows)
    assert str(Row(k="hot", x=3, n=500, top=499)) in plain
    assert str(Row(k=None, x=7, n=300, top=299)) in plain
    extra = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)], "k string, e int")
    also = attach_group_values(df, ["k"], values, also=extra)
    assert also.count() == 2 * 500 + 300 + 50
    assert also.filter("k IS NULL AND e = 3").count() == 300 and also.filter("k = 'hot' AND e = 2").count() == 500


@pytest.mark.parametrize("one_key", [False, True])
def test_hot_keys_are_split_however_many(spark: SparkSession, one_key: bool) -> None:
    """200 keys with many rows each, or one key with two thirds of all: the largest join task stays small."""
    settings = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 60_000
        hot = F.when(F.col("id") % 3 > 0, F.lit(0)) if one_key else F.when(F.col("id") % 3 > 0, F.col("id") % 200)
        rows = spark.range(0, n, 1, 24).select(hot.otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
        out = attach_group_values(rows, ["k"], {"n": F.count(F.lit(1))}).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("task").agg(F.count("*").alias("count"), F.sum("x")).collect()]
        assert sum(sizes) == n
        # without the split the rows of the one key would meet in one task
        assert max(sizes) < 0.3 * n and len(sizes) > 5
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_folds_match_missing_keys(spark: SparkSession) -> None:
    a = spark.createDataFrame([("r", 1), (None, 2)], "radio string, a int")
    b = spark.createDataFrame([("r", 3), (None, 4)], "radio string, b int")
    c = spark.createDataFrame([("q", 5), (None, 6)], "radio string, c int")
    rows = {tuple(r) for r in join_fold([a, b, c], ["radio"]).collect()}
    assert rows == {("r", 1, 3, None), (None, 2, 4, 6)}


def test_a_second_row_for_key_and_label_is_an_error(spark: SparkSession) -> None:
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 6), (2, None, 7), (2, None, 8)], "k int, name string, v int")
    with pytest.raises(Exception, match="more than one row"):
        to_wide(df, ["k"], "name", "v", ["a"]).collect()
    assert {tuple(r) for r in to_wide(df.where("v <> 6"), ["k"], "name", "v", ["a"]).collect()} == {(1, 5), (2, None)}


def test_left_join_matches_missing_keys_and_fans_out(spark: SparkSession) -> None:
    a = spark.createDataFrame([(1,), (None,)], "k int")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, v string")
    assert sorted(str(r.v) for r in left_join(a, b, ["k"]).collect()) == ["x", "y", "z"]
    assert [tuple(r) for r in fan_out(b, ["k"]).collect()] == [(1, 2)]


def test_pivot_and_stack(spark: SparkSession) -> None:
    long = spark.createDataFrame([(1, "a", 5), (1, None, 6), (2, "b", 7)], "id int, p string, v int")
    wide = to_wide(long, ["id"], "p", "v", ["a", "b"]).orderBy("id").collect()
    assert [tuple(r) for r in wide] == [(1, 5, None), (2, None, 7)]
    both = stack([long.select("id"), long.select("v")])
    assert both.count() == 6 and both.columns == ["id", "v"]


def test_few_keys_are_dealt_to_salts(spark: SparkSession) -> None:
    """Three keys, one of them missing: without broadcasts and without any split, no join task gets the rows of a key."""
    settings = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        rows = spark.range(n).selectExpr("IF(id % 3 = 2, NULL, id % 3) AS k", "id AS x")
        names = spark.createDataFrame([(0, "a"), (None, "b"), (None, "c"), (7, "d")], "k bigint, name string")
        out = salted_left_join(rows, names, ["k"])
        assert out.columns == ["k", "x", "name"]
        assert sorted(map(str, out.collect())) == sorted(map(str, left_join(rows, names, ["k"]).collect()))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert sum(sizes) == n + n // 3
        assert max(sizes) < n // 6 and len(sizes) > 20
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_boxes_get_partitions_by_their_rows(spark: SparkSession, monkeypatch: pytest.MonkeyPatch) -> None:
    """The task that joins and sums boxes holds so many rows, however many there are."""
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 500)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    plan = queries()["agg_two_level"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert re.search(rf"hashpartitioning\(o_orderkey#\d+L?, {math.ceil(lines / 500)}\), REPARTITION_BY_NUM", plan), plan
