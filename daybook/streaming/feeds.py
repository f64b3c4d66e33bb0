"""The daily feed as streams: ingest each landed file once, drop repeats, keep totals current.

Two kinds of operators are here. Those by batch (``without_repeats``, ``daily_totals``) write what a batch
brings at once and use the table itself as memory. Those by event time (``first_copies``, ``closed_totals``,
``current_totals``) keep state behind a watermark: a batch costs what it brings, not what has come
before, and the state holds the open days only. Rows behind the bound, by their own dates, never reach that
state; ``kept_aside`` writes them to a table of their own.

Every query runs with the availableNow trigger: it takes what has landed since its checkpoint, in
bounded batches, and stops. Checkpoints and outputs belong in storage all executors share.

No row is lost, and what the tables hold does not depend on how files fall into batches. Each batch
writes a folder of its own, so a batch that is run again replaces what it wrote. Lateness is a
property of a row, the days between its event and its load, and late rows go to a table of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daybook.operators.metadata import with_audit
from daybook.sources.landing import READ_OPTIONS, landed_schema

# A row is late when it is loaded more than 4 calendar days after its event.
LATE_BOUND = 4
BATCH = "batch"


def landing_stream(
    spark: SparkSession, root: str, table: str, files_per_batch: int = 1000
) -> DataFrame:
    """Stream of a landed table's rows."""
    return (
        spark.readStream.schema(landed_schema(table))
        .options(**READ_OPTIONS)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(f"{root.rstrip('/')}/{table}")
    )


def ingest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    source_system: str = "landing",
    partition_by: Sequence[str] = ("load_date",),
) -> StreamingQuery:
    """Append a stream to a Parquet table with audit columns, each source file exactly once."""
    writer = with_audit(stream, source_system).writeStream.format("parquet")
    return (
        writer.partitionBy(*partition_by)
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _written_before(spark: SparkSession, target: str, batch: int | None = None) -> DataFrame | None:
    """Rows of the batches below ``batch``, or of all; None where nothing was written yet."""
    try:
        rows = spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return rows if batch is None else rows.filter(F.col(BATCH) < batch)


def _by_batch(stream: DataFrame, write, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _put(rows: DataFrame, target: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{BATCH}={batch}")


def without_repeats(
    stream: DataFrame, target: str, checkpoint: str, key: Sequence[str] = ("event_id",)
) -> StreamingQuery:
    """Append to ``target`` the rows whose key it does not hold yet, one row per key.

    The table itself is the memory: a batch reads its key columns, whatever time has passed. Copies
    within a batch collapse in the map tasks, so a key with a third of the rows is no single
    task's work; of those the one with the least content stays, so a batch that is run again writes the same
    rows. Rows without a whole key are all kept. Where copies come within days of each other,
    ``first_copies`` does without reading the table.
    """
    key = list(key)

    def take(batch: DataFrame, number: int) -> None:
        whole = F.lit(True)
        for name in key:
            whole = whole & F.col(name).isNotNull()
        columns = batch.columns
        content = F.struct(F.xxhash64(*columns), F.to_json(F.struct(*columns)))
        new = batch.filter(whole).groupBy(*[F.col(name).alias(f"__{name}") for name in key])
        new = new.agg(F.min_by(F.struct(*columns), content).alias("row")).select("row.*")
        known = _written_before(batch.sparkSession, target, number)
        if known is not None:
            new = new.join(known.select(*key), key, "left_anti").select(*batch.columns)
        _put(new.unionByName(batch.filter(~whole)), target, number)

    return _by_batch(stream, take, checkpoint)


def is_late(event_time: str, load_date: str, bound: int = LATE_BOUND) -> Column:
    """Whether a row is loaded more than ``bound`` days after its event; NULL dates are not late."""
    return F.coalesce(F.datediff(F.col(load_date), F.to_date(event_time)) > bound, F.lit(False))


def daily_totals(
    stream: DataFrame,
    event_time: str,
    amount: str,
    target: str,
    checkpoint: str,
    load_date: str = "load_date",
    bound: int = LATE_BOUND,
) -> StreamingQuery:
    """Keep row count and amount per event day in ``target``, and late rows in ``target_late``.

    A batch adds its own sums, one row per day; ``totals`` adds them up. Late rows are kept as they are
    and are no part of the sums.
    """

    def take(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("__late", is_late(event_time, load_date, bound))
        sums = marked.groupBy(F.to_date(event_time).alias("order_date")).agg(
            F.count(F.when(~F.col("__late"), 1)).alias("row_count"),
            F.sum(F.when(~F.col("__late"), F.col(amount))).alias("total_amount"),
            F.count(F.when(F.col("__late"), 1)).alias("late_count"),
            F.max(load_date).alias("last_load"),
        )
        _put(sums, target, number)
        _put(marked.filter("__late").drop("__late"), late_target(target), number)

    return _by_batch(stream, take, checkpoint)


def late_target(target: str) -> str:
    return f"{target.rstrip('/')}_late"


def totals(spark: SparkSession, target: str) -> DataFrame:
    """order_date, row_count, total_amount and late_count over all batches so far."""
    return (
        spark.read.parquet(target)
        .groupBy("order_date")
        .agg(
            F.sum("row_count").alias("row_count"),
            F.sum("total_amount").alias("total_amount"),
            F.sum("late_count").alias("late_count"),
        )
    )


def closed_days(spark: SparkSession, target: str, bound: int = LATE_BOUND) -> DataFrame:
    """The totals of days that later loads can add late rows to only.

    A day is closed when something has been loaded more than ``bound`` days after it.
    """
    last = spark.read.parquet(target).agg(F.max("last_load")).first()[0]
    closed = F.date_add("order_date", bound) < F.lit(last).cast("date")
    return totals(spark, target).filter(closed & (F.col("row_count") > 0))


# --- by event time, with state behind a watermark ---


class RowsBehindWatermark(RuntimeError):
    """A stream dropped rows because their day was closed when they came."""


def _usable(event_time: str, load_date: str, key: Sequence[str], bound: int) -> Column:
    whole = [F.col(name).isNotNull() for name in (event_time, *key)]
    return reduce(lambda a, b: a & b, whole, ~is_late(event_time, load_date, bound))


def on_time(
    stream: DataFrame, event_time: str, load_date: str = "load_date", key: Sequence[str] = (), bound: int = LATE_BOUND
) -> DataFrame:
    """Rows with an event time and a whole key that are not late, behind a watermark of ``bound`` days.

    Where days are landed in order, no such row is behind the watermark: it is at most ``bound`` days
    older than its load, and no event is from after its load.
    """
    kept = stream.filter(_usable(event_time, load_date, key, bound))
    return kept.withWatermark(event_time, f"{bound} days")


def kept_aside(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    event_time: str,
    load_date: str = "load_date",
    key: Sequence[str] = (),
    bound: int = LATE_BOUND,
) -> StreamingQuery:
    """Append to ``target`` all rows that ``on_time`` leaves out, with the ``reason``: late, no_time or no_key."""
    reason = (
        F.when(F.col(event_time).isNull(), "no_time").when(is_late(event_time, load_date, bound), "late").otherwise("no_key")
    )
    rows = stream.filter(~_usable(event_time, load_date, key, bound)).withColumn("reason", reason)
    return _appended(rows, target, checkpoint)


def _appended(rows: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()


def first_copies(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    event_time: str,
    key: Sequence[str],
    order: Sequence[str] = (),
    load_date: str = "load_date",
    bound: int = LATE_BOUND,
) -> StreamingQuery:
    """Append each on-time event to ``target`` once, when its day closes.

    Copies are rows with the same key on the same event day, whatever batch or load day they come with. The one
    with the least ``order`` stays, by default the first loaded, then the least event time and content; so the
    table does not depend on how files fall into batches. Copies are combined before the shuffle, so a
    key with a third of the rows is no single task's work. A day closes when an event comes that is
    more than ``bound`` days after its end; until then its rows are state.
    """
    columns = stream.columns
    content = F.xxhash64(*columns)
    by = [F.col(name) for name in order] or [F.col(load_date), F.col(event_time), content]
    first = F.min_by(F.struct(*columns), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(by)])).alias("row")
    rows = on_time(stream, event_time, load_date, key, bound)
    rows = rows.groupBy(F.window(event_time, "1 day"), *key).agg(first)
    return _appended(rows.select("row.*"), target, checkpoint)


def _day_sums(stream: DataFrame, event_time: str, amount: str, load_date: str, bound: int) -> DataFrame:
    rows = on_time(stream, event_time, load_date, (), bound)
    sums = rows.groupBy(F.window(event_time, "1 day")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(amount).alias("total_amount")
    )
    return sums.select(F.to_date("window.start").alias("order_date"), "row_count", "total_amount")


def closed_totals(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    event_time: str,
    amount: str,
    load_date: str = "load_date",
    bound: int = LATE_BOUND,
) -> StreamingQuery:
    """Append the row count and amount of each event day to ``target`` once, when the day closes.

    Only on-time rows count; a row that is written never changes.
    """
    return _appended(_day_sums(stream, event_time, amount, load_date, bound), target, checkpoint)


def current_totals(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    event_time: str,
    amount: str,
    load_date: str = "load_date",
    bound: int = LATE_BOUND,
) -> StreamingQuery:
    """Keep the row count and amount of all event days so far, open ones too; ``latest`` reads them.

    Each batch writes all days anew into a folder of its own, a row per day.
    """
    sums = _day_sums(stream, event_time, amount, load_date, bound)

    def take(batch: DataFrame, number: int) -> None:
        _put(batch, target, number)

    writer = sums.writeStream.foreachBatch(take).outputMode("complete").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The rows of the last batch that ``current_totals`` wrote."""
    last = spark.read.parquet(target).agg(F.max(BATCH)).first()[0]
    return spark.read.parquet(target).filter(F.col(BATCH) == last).drop(BATCH)


def finished(query: StreamingQuery) -> StreamingQuery:
    """Wait for a stream by event time; raises RowsBehindWatermark if it had to leave rows out.

    That happens only where a day is landed after later days have closed it. What was written stays right for
    the rows that came in time; land the day again and use ``daily_totals``, which takes any order.
    """
    query.awaitTermination()
    dropped = sum(
        operator["numRowsDroppedByWatermark"] for progress in query.recentProgress for operator in progress["stateOperators"]
    )
    if dropped:
        raise RowsBehindWatermark(f"{dropped} groups of rows came after their day was closed")
    return query
