"""Where queries and the SQL of their answers are listed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with SQL over the given tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return register
