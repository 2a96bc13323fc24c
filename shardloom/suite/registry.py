"""Registry of runnable queries and their SQL twins."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shardloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and the SQL that gives the same rows on the same tables."""
    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(prepare(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = prepared
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register
