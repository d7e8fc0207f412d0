"""Registry of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from broadsheet.plans.bindings import Tables, oracle_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None):
    """Register ``fn(tables) -> DataFrame``, with SQL giving the same rows where that exists."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        QUERIES[name].__doc__ = fn.__doc__
        if sql is not None:
            ORACLES[name] = oracle_text(sql, views)
        return fn

    return register
