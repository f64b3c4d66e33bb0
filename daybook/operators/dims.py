"""The date dimension and the campaign dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.dates import calendar_columns, within
from daybook.schemas import CAMPAIGNS


def days_spanned(df: DataFrame, day: Column, name: str = "date_day") -> DataFrame:
    """Every day from the first to the last one in a table, one row each."""
    return df.agg(F.min(day).cast("date").alias("a"), F.max(day).cast("date").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias(name)
    )


def calendar(days: DataFrame, day: str = "date_day") -> DataFrame:
    """Date dimension for a table of days."""
    return days.withColumns(calendar_columns(F.col(day)))


def campaigns(spark: SparkSession) -> DataFrame:
    """The five fixed campaigns."""
    rows = spark.createDataFrame(
        CAMPAIGNS,
        "campaign_id string, campaign_name string, source_channel string, "
        "start_date string, end_date string, budget_amount int",
    )
    return rows.withColumns(
        {c: F.col(c).cast("date") for c in ("start_date", "end_date")}
        | {"currency": F.lit("PLN"), "is_active": F.lit(True)}
    )


def active_on(campaigns: DataFrame, day: Column) -> DataFrame:
    """Campaigns that run on a day."""
    return campaigns.filter(within(day, F.col("start_date"), F.col("end_date")))
