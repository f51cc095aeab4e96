"""Every operator applied to the shared test tables, with the equivalent DuckDB SQL.

``queries()`` and ``oracles()`` are what ``__spark_entry__.py`` hands out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tunewright.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = ("corpus", "similarity", "evaluation", "runs")


def query(name: str, sql: str | None = None):
    """Register a query; without SQL it is checked by brute force in the tests."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return add


def _load() -> None:
    for name in _MODULES:
        import_module(f"tunewright.catalog.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
