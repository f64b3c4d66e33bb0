"""The landing zone: ``<table>/load_date=YYYY-MM-DD/*.csv`` below a root folder."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from math import ceil
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.scalars import landing_path
from daybook.operators.metadata import without_internal
from daybook.schemas import schema_of
from daybook.session import checkpointed

CORRUPT = "_corrupt_record"
FILES = "*.csv"  # names of landed files

# The folder name carries load_date and so does the file. Looking files up recursively keeps Spark
# from taking the column out of the file's schema, which would shift all columns after it;
# enforceSchema=false turns any header that does not match into an error. Quotes are doubled.
READ_OPTIONS = {
    "header": "true",
    "recursiveFileLookup": "true",
    "pathGlobFilter": FILES,
    "enforceSchema": "false",
    "escape": '"',
    "columnNameOfCorruptRecord": CORRUPT,
}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
LANDED_DAY = "landed_day"
FILES_PER_TASK = 50
BYTES_PER_TASK = 256 << 20


def landed_schema(table: str) -> T.StructType:
    """The table's schema plus the column that keeps unreadable lines."""
    return T.StructType([*schema_of(table).fields, T.StructField(CORRUPT, T.StringType())])


def literal_rows(spark: SparkSession, rows: list[tuple], columns: list[str] | str) -> DataFrame:
    """A relation from literal rows; column names (types inferred) or a schema."""
    return spark.createDataFrame(rows, columns)


def read_table(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType | None = None,
    load_date_in_file: bool = True,
    days: Sequence[str] | None = None,
    with_landed_day: bool = False,
    with_file: bool = False,
    files: str = FILES,
) -> DataFrame:
    """All landed files of a table; blank files have no rows, a missing table is empty.

    With ``days`` (ISO dates) only those days' folders are listed and read. ``with_landed_day`` adds the
    day of the folder a file lies in, which the cell ``load_date`` of a broken line does not tell;
    ``with_file`` adds the path of the file and the byte its part begins at. ``files`` is the pattern of
    the files' names: ``*.csv.gz`` or that of another codec of Spark's where they are compressed. Such a
    file is read by one task.

    Cells that do not parse are NULL and the line is kept in ``_corrupt_record``. Files written by
    ``write_table`` have load_date in the folder name only: read them with
    ``load_date_in_file=False``, which also lets a filter on load_date skip folders.
    """
    schema = schema or landed_schema(table)
    options = READ_OPTIONS | {"recursiveFileLookup": str(load_date_in_file).lower(), "pathGlobFilter": files}
    path = f"{root.rstrip('/')}/{table}"
    if days is not None:
        path += f"/load_date={{{','.join(days)}}}"
        options["basePath"] = f"{root.rstrip('/')}/{table}"
    try:
        rows = spark.read.schema(schema).options(**options).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
        if with_file:
            rows = rows.withColumns({"file_path": F.lit("x"), "file_part": F.lit(0).cast("bigint")})
        return rows.withColumn(LANDED_DAY, F.lit(None).cast("date")) if with_landed_day else rows
    if with_file:
        part = F.col("_metadata.file_block_start")
        rows = rows.withColumns({"file_path": F.col("_metadata.file_path"), "file_part": part})
    if with_landed_day:
        # ``=YYYY-MM-DD`` at the end of the folder's name; a pattern costs more.
        folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -2), "/", 1)
        end = F.substring(folder, -11, 11)
        day = F.substring(end, 2, 10).try_cast("date")
        rows = rows.withColumn(LANDED_DAY, F.when(F.concat(F.lit("="), day.cast("string")) == end, day))
    return rows


def write_table(df: DataFrame, root: str, table: str, clean: bool = True) -> None:
    """Write a table as daily folders, leaving out internal columns.

    ``clean`` replaces all earlier output, otherwise only the days being written are replaced. The
    rebalance hint gathers each day into few files and splits a day that is too large for one.
    """
    (
        without_internal(df)
        .hint("rebalance", "load_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if clean else "dynamic")
        .option("header", True)
        .option("escape", '"')
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .partitionBy("load_date")
        .csv(f"{root.rstrip('/')}/{table}")
    )


def _below(path: Column, root: str) -> Column:
    """Path relative to the root, without scheme and host."""
    plain = r"^[^/:]+:(//[^/]*)?"
    base = re.sub(plain, "", root).rstrip("/")
    return F.substr(F.regexp_replace(path, plain, ""), F.lit(len(base) + 2))


def _whole_path(spark: SparkSession, root: str) -> str:
    """The root with its scheme and all folders above it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def manifest(spark: SparkSession, root: str, prefix: str = "bronze/landing") -> DataFrame:
    """Every CSV file below the root: source_path, file_length, target_path. Other files are ignored.

    File contents are not read. Its count is the number of files to land. A relative root is taken
    from the session's default folder, as every Spark reader takes it.
    """
    root = _whole_path(spark, root)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", FILES)
        .load(root)
    )
    relative = _below(F.col("path"), root)
    return files.select(
        F.col("path").alias("source_path"),
        F.col("length").alias("file_length"),
        landing_path(prefix, relative).alias("target_path"),
    )


def in_path_order(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Landed rows with their file path, files in path order."""
    return (
        read_table(spark, root, table)
        .withColumn("file_path", F.col("_metadata.file_path"))
        .orderBy("file_path")
    )


def with_positions(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Landed rows with file_path, line_number (from 1 in its file) and position (from 1 over all files in path order).

    No row is sorted or moved. A task numbers the rows of the parts of files that it reads; the numbers of
    rows in the parts before are running sums over one row per part, kept by range of path.
    """
    rows = read_table(spark, root, table, with_file=True)
    # The same scan gives the same numbers: they are written before they are used twice.
    rows = checkpointed(rows.withColumn("__at", F.monotonically_increasing_id()))
    part = ["file_path", "file_part"]
    parts = rows.groupBy(*part).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    ranged = parts.repartitionByRange(*part).sortWithinPartitions(*part)
    ranged = checkpointed(ranged.withColumn("__range", F.spark_partition_id()))
    within, file = Window.partitionBy("__range").orderBy(*part), Window.partitionBy("file_path").orderBy("file_part")
    # A row per range, of which there are as many as shuffle partitions.
    ranges = ranged.groupBy("__range").agg(F.sum("__n").alias("__rows"))
    all_before = F.sum("__rows").over(Window.orderBy("__range")) - F.col("__rows")
    ranges = ranges.select("__range", all_before.alias("__all_before"))
    parts = ranged.join(F.broadcast(ranges), "__range").select(
        *part,
        "__first",
        (F.sum("__n").over(file) - F.col("__n")).alias("__in_file"),
        (F.col("__all_before") + F.sum("__n").over(within) - F.col("__n")).alias("__in_all"),
    )
    here = F.col("__at") - F.col("__first") + 1
    numbered = {"line_number": F.col("__in_file") + here, "position": F.col("__in_all") + here}
    return rows.join(parts, part).withColumns(numbered).drop("file_part", "__at", "__first", "__in_file", "__in_all")


def land_files(
    spark: SparkSession, root: str, target: str, prefix: str = "bronze/landing"
) -> int:
    """Copy every CSV file below the root to ``<target>/<prefix>/<relative path>``, byte for byte.

    Earlier copies are replaced and the number of files is returned. The files are dealt out to tasks
    of about ``BYTES_PER_TASK`` or ``FILES_PER_TASK``, a number that adaptive execution does not merge,
    and each file is streamed. A copy is written aside and renamed, so that a task that is run twice
    or breaks off leaves no mixed file. What the tasks run is defined in here, so that they do without
    this package.
    """
    target = _whole_path(spark, target)

    def located(uri: str) -> tuple[fs.FileSystem, str]:
        uri = re.sub("^s3[an]:", "s3:", uri)
        local = re.match("^file:/+(.*)", uri)
        return fs.FileSystem.from_uri(f"/{local[1]}" if local else uri)

    def copy_file(source: str, copied: str) -> int:
        (from_fs, from_path), (to_fs, to_path) = located(source), located(copied)
        folder, _, name = to_path.rpartition("/")
        aside = f"{folder}/.{name}.{uuid4().hex}"
        to_fs.create_dir(folder, recursive=True)
        size = 0
        with from_fs.open_input_stream(from_path) as read, to_fs.open_output_stream(aside) as out:
            while piece := read.read(8 << 20):
                out.write(piece)
                size += len(piece)
        to_fs.move(aside, to_path)
        return size

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = zip(batch.column("source_path").to_pylist(), batch.column("target").to_pylist())
            sizes = [copy_file(source, copied) for source, copied in files]
            yield pa.RecordBatch.from_pydict({"file_length": pa.array(sizes, pa.int64())})

    files = manifest(spark, root, prefix).select(
        "source_path", "file_length", landing_path(target, F.col("target_path")).alias("target")
    )
    size = files.agg(F.count(F.lit(1)).alias("files"), F.sum("file_length").alias("bytes")).first()
    tasks = max(1, ceil(size["files"] / FILES_PER_TASK), ceil((size["bytes"] or 0) / BYTES_PER_TASK))
    copied = files.repartition(tasks, "source_path").mapInArrow(copy, "file_length long")
    return copied.agg(F.count("file_length")).first()[0]


def land_table(spark: SparkSession, root: str, table: str, target: str) -> None:
    """Write a table's landed rows to another landing root, replacing what is there.

    Day folders are kept, file names are Spark's and cells that do not parse are lost:
    ``land_files`` keeps files as they are.
    """
    write_table(read_table(spark, root, table).drop(CORRUPT), target, table)
