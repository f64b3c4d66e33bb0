"""Tables kept in buckets of a key, so that joins and groupings by it move no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def bucket_count(rows: int, rows_of_bucket: int = 2_000_000) -> int:
    """A power of two, so that tables of unlike sizes divide each other; 2**16 at most.

    Tables that are joined should have the same number: give all the one of the largest.
    """
    buckets = 1
    while buckets < 1 << 16 and buckets * rows_of_bucket < rows:
        buckets *= 2
    return buckets


def store(df: DataFrame, name: str, path: str, key: str, buckets: int, append: bool = False) -> DataFrame:
    """Write rows below ``path`` as the table ``name`` in buckets of ``key``; return the table.

    With ``append`` the rows join those of earlier loads: each bucket gets one more file, and reading
    still moves nothing. Rows without a key are in one bucket of their own kind. The rows are shuffled
    once by the key here, into as many tasks as buckets, so a load writes one file a bucket.

    A bucket is read by one task. Rows are read as a stream and groupings need memory for distinct keys
    only, but a key with a large share of the rows keeps its task busy: leave such a table as it
    is and use ``skew.join_unique``.
    """
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.mode("append" if append else "overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def open_stored(spark: SparkSession, name: str, path: str, like: DataFrame, key: str, buckets: int) -> DataFrame:
    """The table that ``store`` wrote, in a session whose catalog does not have it yet."""
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
        spark.sql(
            f"CREATE TABLE `{name}` ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)
