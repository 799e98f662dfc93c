"""The catalogue of demonstration queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function of (session, folder of Parquet tables) under its own name."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql.strip()
        return function

    return add
