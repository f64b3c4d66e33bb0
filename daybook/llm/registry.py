"""Queries of this package and, where SQL can say the same, their SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybook.session import configure

# Whole texts go to Python in batches: 2,000 of them, or 32 MB, keep a task's share of memory small.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and those for texts in Python tasks."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return configure(spark)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, folder of Parquet tables) under a name."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepared(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
