"""Collects the registered queries of the core library and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, read when first named: t.orders, t.events ..."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of Tables under name; sql is its DuckDB equivalent."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered already")
        _QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            _SQL[name] = sql
        return f

    return register


def _load() -> None:
    from weftline.plans import aggregates, folds, graphs, imports, joins, projections, resolution, search, sinks, sources, statistics, validation  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
