"""Registration of queries with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name; ``sql`` states the same result."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def fixture(build: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """Files made of the tables, written once in a session: a query that reads them only reads."""
    built: dict[tuple[str, str], str] = {}

    @wraps(build)
    def once(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in built:
            built[key] = build(spark, sf_dir)
        return built[key]

    return once
