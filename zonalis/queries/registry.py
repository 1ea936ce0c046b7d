"""Registration of queries and their SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("sources", "projections", "filters", "joins", "aggregates", "scalars", "spatial", "statistics", "reports")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """Tables of one folder by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = table
        return table


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of :class:`Tables` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = fn.__name__
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            _ORACLES[name] = sql
        return fn

    return register


def _load() -> None:
    for module in MODULES:
        importlib.import_module(f"zonalis.queries.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
