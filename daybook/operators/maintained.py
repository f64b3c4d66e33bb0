"""Tables that each load brings up to date: current state, version history, totals, deferred rows.

A stored table is Parquet in buckets, by default of a hash of its key. A load reads and rewrites the
buckets that its rows fall into; the files of all others stay as they are. Give a ``bucket`` of your own where
a load's keys lie together, such as the month in which an order was made, so that a load touches
few buckets however many keys it has.

A load has a name. What it changes is written first, as images of the rows before and after, and all
else follows from the images: a load that is run again, after a failure or by mistake, finds its images
and leaves the tables as they are. Loads of one table come one after the other, in any order of their days.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.skew import PROBE, latest_per_key
from daybook.operators.state import version_history
from daybook.session import checkpointed

BUCKETS = 64
BUCKET, LOAD, SIGN = "bucket", "load", "sign"


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a stored table; None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def hash_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _touched(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame | None:
    """The stored rows of the buckets that occur in ``rows``; no file of another bucket is read."""
    known = stored(spark, path)
    if known is None:
        return None
    # Bounded by the number of buckets.
    buckets = [row[0] for row in rows.select(BUCKET).distinct().collect()]
    return known.filter(F.col(BUCKET).isin(buckets))


def _same(keys: Sequence[str], other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{other}{k}")) for k in keys])


def _with_key(rows: DataFrame, changed: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows whose key is, or is not, among those of ``changed``; NULL is a key like any other."""
    names = changed.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return rows.join(names, _same(keys, "__"), how)


def _replaced(rows: DataFrame, path: str) -> None:
    """Rewrite the buckets of ``rows``, which are written to the shared folder before a file is replaced."""
    rows = checkpointed(rows.hint("rebalance", BUCKET))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)


def _is_done(spark: SparkSession, path: str) -> bool:
    """Whether a write to a folder has ended well."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def merge_current(
    changes: DataFrame,
    target: str,
    load: str,
    keys: Sequence[str],
    version: Sequence[str],
    keep: Column | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Merge a load's rows into the current state below ``target`` and return what changed.

    The row of a key with the greatest ``version`` is current, whichever load brought it. Returned are
    signed images: the row before with sign -1 and the row after with sign 1, of keys whose current row is another
    one now. Rows for which ``keep`` does not hold, such as those held back by a check, stay in the
    state, so that a later version can replace them, and have no image: a row that is held back later is
    retracted. ``current`` reads the state. Rows that are equal in all of ``version`` should be equal. A
    ``bucket`` of your own is a whole number that all versions of a key share.
    """
    spark, path = changes.sparkSession, f"{target}/current"
    names = changes.columns
    bucket = hash_bucket(keys) if bucket is None else bucket
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))

    def images() -> DataFrame:
        new = changes.withColumn(BUCKET, bucket)
        known = _touched(spark, path, new)
        if known is None:
            return latest_per_key(new, keys, version).withColumn(SIGN, F.lit(1))
        before = _with_key(known, new, keys, "left_semi").select(*names, BUCKET)
        before = before.withColumn("__old", F.lit(True))
        both = before.unionByName(new.withColumn("__old", F.lit(False)))
        after = latest_per_key(both, keys, [*version, "__old"]).filter("NOT __old").drop("__old")
        gone = _with_key(before, after, keys, "left_semi").drop("__old").withColumn(SIGN, F.lit(-1))
        return after.withColumn(SIGN, F.lit(1)).unionByName(gone)

    written, merged = f"{target}/images/{LOAD}={load}", f"{target}/merged/{LOAD}={load}"
    if not _is_done(spark, written):
        images().write.mode("overwrite").parquet(written)
    changed = spark.read.parquet(written)
    if not _is_done(spark, merged):
        after = changed.filter(F.col(SIGN) == 1).drop(SIGN)
        known = _touched(spark, path, changed)
        others = [] if known is None else [_with_key(known, after, keys, "left_anti").select(*names, BUCKET)]
        if not changed.isEmpty():
            _replaced(reduce(DataFrame.unionByName, others, after.select(*names, BUCKET)), path)
        changed.groupBy(SIGN).count().write.mode("overwrite").parquet(merged)
    return changed.filter(kept).select(*names, SIGN)


def current(spark: SparkSession, target: str, keep: Column | None = None) -> DataFrame | None:
    """The current rows of ``merge_current``, those that ``keep`` holds for."""
    rows = stored(spark, f"{target}/current")
    if rows is None:
        return None
    return (rows if keep is None else rows.filter(keep)).drop(BUCKET)


def merge_history(
    changes: DataFrame,
    target: str,
    keys: Sequence[str],
    version: Sequence[str],
    attributes: Sequence[str],
    bucket: Column | None = None,
    hot: DataFrame | str | None = PROBE,
) -> None:
    """Merge versions into the history below ``target``, in any order of time.

    All versions are stored, so one that comes late finds its place between those there. A version that is there
    already, equal in key, version and attributes, changes nothing; so a load may be run again. Keys
    that a load does not mention keep their rows. ``history`` reads it. A ``bucket`` of your own is a
    whole number that all versions of a key share.
    """
    spark = changes.sparkSession
    columns = list(dict.fromkeys([*keys, *version, *attributes]))
    new = changes.select(*columns).withColumn(BUCKET, hash_bucket(keys) if bucket is None else bucket)
    new = checkpointed(new.distinct())
    known = _touched(spark, target, new)
    rows, others = new, None
    if known is not None:
        known = known.select(*columns, "valid_from", "valid_to", "is_current", BUCKET)
        rows = new.unionByName(_with_key(known, new, keys, "left_semi").select(*columns, BUCKET)).distinct()
        others = _with_key(known, new, keys, "left_anti")
    dated = [name for name in version if name not in (*keys, *attributes)]
    made = version_history(rows, keys, version, [*attributes, *dated, BUCKET], hot=hot)
    if new.isEmpty():
        return
    _replaced(made if others is None else made.unionByName(others), target)


def history(
    spark: SparkSession,
    target: str,
    keys: Sequence[str],
    version: Sequence[str],
    attributes: Sequence[str],
    strategy: str = "timestamp",
) -> DataFrame | None:
    """The stored history; strategy "check" keeps only versions that change an attribute."""
    rows = stored(spark, target)
    if rows is None:
        return None
    if strategy == "check":
        return version_history(rows, keys, version, attributes, strategy)
    return rows.select(*keys, *attributes, "valid_from", "valid_to", "is_current")


def merge_totals(images: DataFrame, target: str, load: str, by: Sequence[str], amount: str) -> None:
    """Write the signed sums of a load's images; a load that is run again replaces its own.

    Only the images are read: what came before is in the sums of the loads before.
    """
    signed = F.col(SIGN) * F.col(amount)
    sums = images.groupBy(*by).agg(F.sum(SIGN).alias("row_count"), F.sum(signed).alias("total_amount"))
    sums.write.mode("overwrite").parquet(f"{target}/{LOAD}={load}")


def totals(spark: SparkSession, target: str, by: Sequence[str]) -> DataFrame:
    """Row count and amount per group over all loads; groups whose rows were all retracted are gone."""
    sums = spark.read.parquet(target).groupBy(*by)
    sums = sums.agg(F.sum("row_count").alias("row_count"), F.sum("total_amount").alias("total_amount"))
    return sums.filter("row_count <> 0")


# --- deferred rows ---

DUE, RUN = "due", "run"
AT_ONCE = "0000-00-00"  # before any day


def defer(rows: DataFrame, target: str, load: str, due: Column) -> None:
    """Put rows into the queue below ``target`` until the day ``due``; a load that is run again replaces its own.

    Rows without a day are due at once.
    """
    day = F.coalesce(F.date_format(due, "yyyy-MM-dd"), F.lit(AT_ONCE))
    rows = rows.withColumn(DUE, day).hint("rebalance", DUE)
    rows.write.mode("overwrite").partitionBy(DUE).parquet(f"{target}/waiting/{LOAD}={load}")


def take_due(spark: SparkSession, target: str, day: str) -> DataFrame | None:
    """The rows of the queue that are due by ``day`` (ISO date) and that no other day has taken.

    What a day takes is noted, by load and due day, before a row is returned: taking the same day again gives the
    same rows, and rows that were put in since wait for the next one. No file of another due day or load
    is read. None where nothing was ever deferred.
    """
    waiting = stored(spark, f"{target}/waiting")
    if waiting is None:
        return None
    waiting = waiting.withColumns({LOAD: F.col(LOAD).cast("string"), DUE: F.col(DUE).cast("string")})
    ledger = f"{target}/taken/{RUN}={day}"
    if not _is_done(spark, ledger):
        open_parts = waiting.filter(F.col(DUE) <= day).select(LOAD, DUE).distinct()
        taken = stored(spark, f"{target}/taken")
        if taken is not None:
            taken = taken.filter(F.col(RUN).cast("string") != day)
            open_parts = open_parts.join(taken, [LOAD, DUE], "left_anti")
        # A row per load and due day.
        open_parts.select(LOAD, DUE).coalesce(1).write.mode("overwrite").parquet(ledger)
    parts = [(F.col(LOAD) == row[LOAD]) & (F.col(DUE) == row[DUE]) for row in spark.read.parquet(ledger).collect()]
    return waiting.filter(reduce(lambda a, b: a | b, parts, F.lit(False)))
