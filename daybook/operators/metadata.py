"""Load metadata, deferred rows and late arrivals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_audit(df: DataFrame, source_system: str, layer: str = "bronze") -> DataFrame:
    """Stamp rows with the instant, source system and layer of their ingestion."""
    return df.withColumns(
        {
            "_ingested_at": F.current_timestamp(),
            "_source_system": F.lit(source_system),
            "_source_layer": F.lit(layer),
        }
    )


def with_load_metadata(
    df: DataFrame,
    load_date: Column,
    event_time: Column | None = None,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Add load_date, loaded_at and source_event_at.

    Without ``event_time`` the event time is updated_at, else created_at, else the load date,
    from those of the columns that exist.
    """
    load_date = load_date.cast("date")
    if event_time is None:
        known = [F.col(c) for c in ("updated_at", "created_at") if c in df.columns]
        event_time = F.coalesce(*known, load_date.cast("timestamp"))
    return df.withColumns(
        {
            "load_date": load_date,
            "loaded_at": F.current_timestamp() if loaded_at is None else loaded_at,
            "source_event_at": event_time,
        }
    )


def without_internal(df: DataFrame) -> DataFrame:
    """Drop the columns whose name starts with two underscores."""
    return df.select([c for c in df.columns if not c.startswith("__")])


def due_on(df: DataFrame, defer_until: str, day: Column) -> DataFrame:
    """Rows that are not deferred, or deferred to exactly this day."""
    return df.filter(F.col(defer_until).isNull() | (F.col(defer_until) == day))


def split_due(df: DataFrame, arrival: str, day: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that have arrived by ``day``, and those still to come."""
    return df.filter(F.col(arrival) <= day), df.filter(F.col(arrival) > day)


def land_deferred(due: DataFrame, day: Column, event_time: str = "source_event_at") -> DataFrame:
    """Due rows as loaded on ``day``: new load metadata, event time kept."""
    return with_load_metadata(due, day, F.col(event_time))


def with_lateness(
    df: DataFrame,
    grace_days: int | Column = 1,
    load_date: str = "load_date",
    event_time: str = "source_event_at",
) -> DataFrame:
    """Add lag_days and is_late.

    Status rows of a day are landed with the next day's load even when on time: use a grace of 1
    for them, 0 for web events and first payments. loaded_at is no measure of lateness.
    """
    lag = F.datediff(F.col(load_date), F.to_date(F.col(event_time)))
    return df.withColumns({"lag_days": lag, "is_late": lag > grace_days})


def usual_grace(table: str) -> Column:
    """Days a table's on-time rows may trail their event.

    Web events and first payments land on their day; status rows, and the payment rows that follow
    from another event, are scheduled for the next load.
    """
    if table == "payments":
        scheduled = F.col("payment_status").isin("authorized", "refunded")
        return F.when(scheduled, 1).otherwise(0)
    return F.lit(1 if table in ("orders", "shipments", "refunds") else 0)


def lateness_by_day(df: DataFrame, load_date: str = "load_date") -> DataFrame:
    """Rows, late rows and the longest lag per load date."""
    return df.groupBy(load_date).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("is_late").alias("late_count"),
        F.max("lag_days").alias("max_lag_days"),
    )
