"""Bronze tables: landed rows as typed Parquet by the day they landed on, with audit columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from daybook.operators.metadata import with_audit
from daybook.session import STORED
from daybook.sources.landing import FILES, LANDED_DAY, read_table


def load_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    table: str,
    source_system: str = "landing",
    days: Sequence[str] | None = None,
    files: str = FILES,
) -> DataFrame:
    """Rewrite a landed table as Parquet by ``landed_day`` and return all of it.

    With ``days`` only those days are read; ``files`` is the pattern of the landed files' names. A day is the folder a file lies in; the cell ``load_date``
    stays a column, so a broken or stray line is replaced with its own file and never with another
    day's. Only days found are replaced, others stay. A landed file holds one day, so a task writes
    the days of the files it read and nothing is shuffled. Later readers skip days and columns, which
    the raw files do not allow.
    """
    path = f"{bronze.rstrip('/')}/{table}"
    rows = with_audit(read_table(spark, landing, table, days=days, with_landed_day=True, files=files), source_system)
    (
        rows.write.mode("overwrite")
        .options(**STORED)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(LANDED_DAY)
        .parquet(path)
    )
    return spark.read.schema(rows.schema).parquet(path)


def as_view(df: DataFrame, name: str) -> str:
    """Register a temp view for SQL and return its name."""
    df.createOrReplaceTempView(name)
    return name


def daily_totals_sql(
    spark: SparkSession, view: str, day: str = "order_date", amount: str = "order_amount"
) -> DataFrame:
    """Order count and amount per day of a view, in SQL."""
    return spark.sql(
        f"""
        SELECT {day}, COUNT(*) AS order_count, SUM({amount}) AS total_order_amount
        FROM {view}
        GROUP BY {day}
        ORDER BY {day}
        """
    )
