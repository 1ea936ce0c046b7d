"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import decimal
import math

import duckdb
from pyspark.sql import SparkSession

from zonalis.queries import oracles, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _value(v: object) -> object:
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (v + 0.0 if v else 0.0)
    return v


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(spark: SparkSession, name: str, folder: str) -> tuple[list[str], list[tuple]]:
    df = queries()[name](spark, folder)
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con: duckdb.DuckDBPyConnection, name: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(oracles()[name])
    names = [d[0] for d in result.description]
    return sorted(names), _rows(names, result.fetchall())


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, folder: str) -> str | None:
    """None if both agree, else what differs first."""
    left_names, left = spark_rows(spark, name, folder)
    right_names, right = oracle_rows(con, name)
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if len(left) != len(right):
        return f"{len(left)} rows / {len(right)} rows; first {left[:2]} / {right[:2]}"
    for a, b in zip(left, right, strict=True):
        if a != b:
            return f"{left_names}: {a} / {b}"
        for x, y in zip(a, b, strict=True):
            if x is not None and type(x) is not type(y):
                return f"{left_names}: types differ in {a} / {b}"
    return None
