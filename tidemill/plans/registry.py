"""The registered queries: a function over (spark, sf_dir) and, where SQL can express it, the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_MODULES = ("slice_queries", "record_queries", "measure_queries", "contract_queries", "text_queries", "join_queries", "interval_queries", "catalog_queries", "composed_queries", "index_queries", "decision_queries", "ledger_queries", "lookup_queries", "rule_queries")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name."""

    def add(f: Query) -> Query:
        if name in _QUERIES and _QUERIES[name] is not f:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    for name in _MODULES:
        import_module(f"tidemill.plans.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
