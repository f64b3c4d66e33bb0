"""Session settings the operators rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")
STEPS_AT_ONCE = 4
# Options of stored Parquet tables. Level 1 took less space and time than the usual 3.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
# For jobs whose steps are stored tables. The shuffle files of a query are deleted when it ends, otherwise they stay
# until the driver happens to collect its garbage; a DataFrame that is run twice makes its shuffles anew. Rows take
# several times the bytes of their files, which counts where Spark asks whether a table is small enough to broadcast.
STEPWISE = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.fileCompressionFactor": "4",
}

# Days are UTC days; a skewed join is split even where that costs one more shuffle; streaming state
# lives in RocksDB, outside the heap, and is saved as changes; times are written as 64-bit numbers.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; partition counts and memory stay the cluster's choice."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def _base_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    A local session without that setting gets a temporary folder; a cluster session
    without it is refused, because a machine's own folder is lost with the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="daybook-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{_base_folder(spark)}/{name}-{uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder with all that is in it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def held(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Within it the session has these settings, after it those from before."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as written to the shared folder, with no plan behind them."""
    _base_folder(df.sparkSession)
    return df.checkpoint()


def side_by_side(spark: SparkSession, steps: Mapping[str, Callable[[], Result]]) -> dict[str, Result]:
    """Results of steps that do not need each other, a few at once: while one ends, the next has the cores."""
    with ThreadPoolExecutor(STEPS_AT_ONCE) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()}
        return {name: step.result() for name, step in running.items()}
