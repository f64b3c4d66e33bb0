"""Set operations, duplicates, fingerprints, samples and bounded child lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.scalars import count_of_share, joined_text
from daybook.operators.skew import HOT_ROWS, PROBE, apart, hot_keys, ordered_columns
from daybook.session import checkpointed

MOST_DAYS = 10_000  # days that a filter on folders names


def union_batches(*batches: DataFrame) -> DataFrame:
    """Append batches of one table by column name; a column a batch lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def drop_copies(df: DataFrame) -> DataFrame:
    """Remove exact copies. Copies collapse within each map task before anything is shuffled."""
    return df.dropDuplicates()


def count_copies(
    df: DataFrame, name: str = "copy_count", keys: Sequence[str] = (), repeated: DataFrame | None = None
) -> DataFrame:
    """Distinct rows with how often each occurs, at the cost of ``drop_copies``.

    With the ``repeated`` ones of some keys only their rows are compared: copies have the same key.
    """
    if repeated is not None:
        single, several = apart(df, keys, repeated)
        return single.withColumn(name, F.lit(1).cast("bigint")).unionByName(count_copies(several, name))
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], repeated: DataFrame | None = None
) -> DataFrame:
    """Keep the first row of each key in ``order`` (limited per key before the shuffle).

    With ``repeated`` keys only their rows are shuffled.
    """
    if repeated is not None:
        single, several = apart(df, keys, repeated)
        return single.unionByName(first_per_key(several, keys, order))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with the number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def fingerprint(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row count and sum of a 60-bit row hash: equal for equal data in any order or file layout."""
    text = joined_text(*[F.col(c) for c in sorted(df.columns)])
    row_hash = F.conv(F.substring(F.md5(text), 1, 15), 16, 10)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(row_hash.cast("decimal(20,0)")).alias("hash_sum"),
    )


def distinct_and_quarter(df: DataFrame, key: str) -> DataFrame:
    """Number of distinct keys, and a quarter of it rounded down."""
    ids = F.countDistinct(key)
    return df.agg(ids.alias("distinct_count"), F.floor(ids / 4).alias("quarter_count"))


def sample_share(
    df: DataFrame,
    key: Sequence[str],
    share: float,
    seed: str = "",
    least: int = 0,
    digits: int = 4,
) -> DataFrame:
    """A reproducible sample of exactly ``share`` of the rows, without replacement.

    It is the rows with the lowest md5 of key and seed. The rows are first counted per leading hex
    ``digits``, at most 16^digits counts. The groups below the one the cut falls into are taken
    whole and only that one group is ranked, so no task orders the table.
    """
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(seed))
    hashed = df.withColumn("__md5", F.md5(text)).withColumn("__head", F.substring("__md5", 1, digits))
    up_to = Window.orderBy("__head").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wanted = count_of_share(F.sum("n").over(Window.partitionBy()), share, least)
    cut = (
        hashed.groupBy("__head")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("__head", "n", F.sum("n").over(up_to).alias("upto"), wanted.alias("wanted"))
        .filter("upto - n < wanted")
        .orderBy(F.desc("__head"))
        .limit(1)
        .first()
    )
    if cut is None:
        return df.limit(0)
    below = hashed.filter(F.col("__head") < cut["__head"])
    group = hashed.filter(F.col("__head") == cut["__head"])
    ranked = ordered_columns(
        group, ["__head"], ["__md5", *key], number="__rank",
        hot=hot_keys(group, ["__head"]) if cut["n"] > HOT_ROWS else None,
    ).filter(F.col("__rank") <= cut["wanted"] - (cut["upto"] - cut["n"]))
    return below.select(*df.columns).unionByName(ranked.select(*df.columns))


def child_lists(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: Column,
    per_list: int = 1000,
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Child values of each key as ordered lists of at most ``per_list``.

    There is one row per key **and list_no** (1, 2, ...): a key with more children than ``per_list`` gets
    further rows, so no single cell grows with it. Join on both, or on the rows of ``list_no = 1``;
    a join on the key alone repeats its other side per list.
    """
    numbered = ordered_columns(
        df.select(key, *[c for c in order if c != key], value.alias("__value")),
        [key], order, number="__n", hot=hot,
    )
    return (
        numbered.withColumn("list_no", F.floor((F.col("__n") - 1) / per_list) + 1)
        .groupBy(key, "list_no")
        .agg(
            F.count(F.lit(1)).alias("child_count"),
            F.sort_array(F.collect_list(F.struct("__n", "__value"))).alias("__children"),
        )
        .withColumn("children", F.transform("__children", lambda c: c["__value"]))
        .drop("__children")
    )


def rows_per_load_date(df: DataFrame, load_date: str = "load_date") -> DataFrame:
    return df.groupBy(load_date).agg(F.count(F.lit(1)).alias("row_count"))



def hash_tree(df: DataFrame, day: str, keys: Sequence[str], buckets: int = 256) -> DataFrame:
    """Rows and sum of row hashes per day and hash bucket of the key; a day's are the sums of its buckets.

    It is small beside the table; written with it, it is what ``differing_rows`` needs to know of it.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")
    return df.groupBy(F.col(day).alias("day"), bucket).agg(F.count(F.lit(1)).alias("row_count"), _hash_sum(df))


def _hash_sum(df: DataFrame) -> Column:
    return F.sum(_content(df).cast("decimal(38,0)")).alias("hash_sum")


def _content(df: DataFrame) -> Column:
    return F.xxhash64(joined_text(*[F.col(c) for c in sorted(df.columns)]))


def differing_rows(
    left: DataFrame,
    right: DataFrame,
    day: str,
    keys: Sequence[str],
    left_tree: DataFrame | None = None,
    right_tree: DataFrame | None = None,
    buckets: int = 256,
) -> DataFrame:
    """Day, key and ``kind`` (changed, left, right) of what differs between two runs of a table.

    The trees are compared first; only rows of days that differ, and of those only differing buckets, are
    compared themselves. With trees of earlier runs and tables in folders by ``day``, days that are equal
    are not read. Copies of one row count as often as they occur.
    """
    left_tree = hash_tree(left, day, keys, buckets) if left_tree is None else left_tree
    right_tree = hash_tree(right, day, keys, buckets) if right_tree is None else right_tree
    signed = left_tree.withColumn("side", F.lit(1)).unionByName(right_tree.withColumn("side", F.lit(-1)))
    net = [F.sum(F.col(c) * F.col("side")).alias(c) for c in ("row_count", "hash_sum")]
    branches = signed.groupBy("day", "bucket").agg(*net).filter("row_count <> 0 OR hash_sum <> 0")
    branches = checkpointed(branches.select("day", "bucket"))
    # A day per row; where many differ the join below reads them all anyway.
    days = [row.day for row in branches.select("day").distinct().limit(MOST_DAYS + 1).collect()]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def rows(df: DataFrame) -> DataFrame:
        content = _content(df).alias("content")
        if len(days) <= MOST_DAYS:
            known = F.col(day).isin([d for d in days if d is not None])
            df = df.filter(known | F.col(day).isNull() if None in days else known)
        chosen = df.select(*[F.col(k) for k in keys], F.col(day).alias("day"), bucket.alias("bucket"), content)
        same = [F.col("day").eqNullSafe(F.col("__day")), F.col("bucket") == F.col("__bucket")]
        return chosen.join(branches.withColumnsRenamed({"day": "__day", "bucket": "__bucket"}), same, "left_semi")

    both = rows(left).withColumn("side", F.lit(1)).unionByName(rows(right).withColumn("side", F.lit(-1)))
    contents = both.groupBy("day", *keys, "content").agg(F.sum("side").alias("n")).filter("n <> 0")
    sides = contents.groupBy("day", *keys).agg(F.max("n").alias("most"), F.min("n").alias("least"))
    kind = F.when(F.col("least") > 0, "left").when(F.col("most") < 0, "right").otherwise("changed")
    return sides.select("day", *keys, kind.alias("kind"))
