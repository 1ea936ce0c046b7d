"""Every registered query against its SQL, and its plan."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import SparkSession

import __spark_entry__ as contract
from tests.compare import connection, difference
from zonalis.queries import oracles, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(oracles()))
def test_rows_equal(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str) -> None:
    assert difference(spark, con, name, FOLDER) is None


def test_every_query_has_sql() -> None:
    assert set(oracles()) == set(queries())
    assert set(contract.queries()) >= set(queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark: SparkSession) -> None:
    table = contract.entry(spark)
    assert table.columns[0] == "id_circuito_elec"
    assert table.count() > 0


@pytest.mark.parametrize(
    "name", ["geo_overlay_boxes", "geo_overlay_polygons", "geo_point_in_polygon", "win_total", "elections_2019_wide"]
)
def test_no_nested_loops(spark: SparkSession, name: str) -> None:
    plan = queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan


def test_filter_and_columns_reach_the_scan(spark: SparkSession) -> None:
    plan = queries()["filt_and"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "EqualTo(l_linestatus,F)" in plan
    assert "l_extendedprice" not in plan.split("ReadSchema:")[1].split("\n")[0]
