"""Ordered and joined work that holds up when one key has a third of all rows.

A plain window or shuffled join puts every row of a key into one task. The helpers here first look
for keys above ``HOT_ROWS`` rows. Without any, which is the usual case, the plain Spark plan is used.
With some, only those keys are split:

* ordered columns: rows of a hot key go into consecutive chunks of its order, each chunk is a
  window partition of its own, and what has to cross a chunk border (counts, the last row, ...)
  is carried over from a summary with one row per chunk; where copies of one row are themselves too
  many for a chunk, they are dealt out to several chunks in a row;
* joins to a side that is unique per key: rows of a hot key are salted and the one matching row
  is repeated per salt.

The look-up is a pruned, sampled scan with map-side counts and returns at most ``MAX_HOT_KEYS`` rows.
A key outside that list is either below ``HOT_ROWS`` rows or has less than 1/10,000 of the table.
Which keys are listed never changes a result, only how the work is spread. It runs when the plan
is built: pass ``hot=None`` where keys are known to be small, or the result of ``hot_keys`` where
several steps share it.

What is broadcast has a bound that does not grow with the data: ``MAX_HOT_KEYS`` keys, about
``MAX_ALL_PARTS`` chunk borders, and one summary row per chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import checkpointed

HOT_ROWS = 5_000_000
MAX_HOT_KEYS = 10_000
MAX_PARTS = 4_096
MAX_ALL_PARTS = 200_000
MAX_REPEATED = 1_000_000
HASHED_PER_TASK = 500_000
PROBE = "probe"

_HASH_RANGE = 1 << 40
_ROWS, _PARTS, _CHUNK, _DEAL, _SALT, _SPLIT = "__rows", "__parts", "__chunk", "__deal", "__salt", "__split"
_HASH = "__hash"


def hot_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, sample: float = 0.01
) -> DataFrame | None:
    """The most frequent keys with at least about ``hot_rows`` rows, or None when there are none."""
    picked = df.select(*keys)
    if sample < 1:
        picked = picked.sample(sample, seed=17)
    found = (
        picked.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(_ROWS))
        .filter(F.col(_ROWS) >= hot_rows * sample)
        .orderBy(F.desc(_ROWS))
        .limit(MAX_HOT_KEYS)
        .collect()
    )
    if not found:
        return None
    estimates = [ceil(row[_ROWS] / sample) for row in found]
    # What is broadcast later has a row per part, so the sum of the parts is bounded as well.
    rows_per_part = max(hot_rows / 16, sum(estimates) / MAX_ALL_PARTS)
    rows = [
        (*row[:-1], estimate, min(MAX_PARTS, max(2, ceil(estimate / rows_per_part))))
        for row, estimate in zip(found, estimates)
    ]
    schema = T.StructType(
        [*df.select(*keys).schema.fields]
        + [T.StructField(_ROWS, T.LongType()), T.StructField(_PARTS, T.IntegerType())]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def _resolve(df: DataFrame, keys: Sequence[str], hot: DataFrame | str | None) -> DataFrame | None:
    return hot_keys(df, keys) if isinstance(hot, str) else hot


def _attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join a bounded table on keys that may be NULL (NULL matches NULL)."""
    renamed = small.withColumnsRenamed({k: f"__on_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__on_{k}")) for k in keys])
    return df.join(F.broadcast(renamed), same, how).drop(*[f"__on_{k}" for k in keys])


def _with_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot: DataFrame,
    ties: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of hot keys by chunk, ascending with ``order``; NULL for all other rows.

    Chunk borders are rows picked by a hash of their values: every evaluation of the plan picks
    the same ones, so a lost executor cannot move a border. There are about ``parts`` of them per key.

    Each of the ``ties``, which are orders that very many rows share, opens a chunk. Its rows are
    dealt out by map partition and come before the rest of the chunk. That assignment depends on
    how the rows are laid out, so it is written to the checkpoint folder before it is used.
    """
    share = F.col(_PARTS) / F.col(_ROWS) * _HASH_RANGE
    picked = (
        _attach(df.select(*keys, *order), hot, keys, "inner")
        .filter(F.pmod(F.xxhash64(*keys, *order), F.lit(_HASH_RANGE)) < share)
        .select(*keys, *order)
    )
    if ties is not None:
        picked = picked.unionByName(ties.select(*keys, *order))
    borders = (
        picked.groupBy(*keys)
        .agg(F.array_sort(F.collect_set(F.struct(*order))).alias("__borders"))
        # A row is compared with the ends of blocks and with one block: least work at the root of the borders.
        .withColumn("__step", F.ceil(F.sqrt(F.size("__borders"))).cast("int"))
        .withColumn(
            "__block_ends", F.filter("__borders", lambda _, i: i % F.col("__step") == F.col("__step") - 1)
        )
    )
    here = F.struct(*order)
    block = F.size(F.filter("__block_ends", lambda end: end <= here))
    before = F.col("__block") * F.col("__step")
    rest = F.slice("__borders", before + 1, F.col("__step"))
    chunk = before + F.size(F.filter(rest, lambda border: border <= here))
    chunked = (
        _attach(df, borders, keys, "left")
        .withColumn("__block", F.when(F.col("__borders").isNotNull(), block))
        .withColumn(_CHUNK, F.when(F.col("__borders").isNotNull(), chunk))
        # A filter on the number itself would find the chunk of each row once more.
        .withColumn(_SPLIT, F.col("__borders").isNotNull())
        .drop("__borders", "__block_ends", "__block", "__step")
    )
    if ties is None:
        return chunked.withColumn(_DEAL, F.lit(0))
    dealt = _attach(chunked, ties.select(*keys, *order, _PARTS), [*keys, *order], "left")
    deal = F.coalesce(F.spark_partition_id() % F.col(_PARTS), F.lit(MAX_PARTS))
    return checkpointed(dealt.withColumn(_DEAL, deal).drop(_PARTS))


def ordered_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    number: str | None = None,
    previous: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    latest: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
    hot: DataFrame | str | None = PROBE,
    ties: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Add columns that depend on the rows of the same key, taken in ascending ``order``.

    ``number`` is the 1-based position, ``previous`` and ``following`` read the neighbouring row,
    ``latest`` is the last non-NULL value up to this row and ``running`` the sum up to this row.
    ``order`` should identify a row within its key, or else rows it does not tell apart come in
    any order. ``ties`` are the orders, with their key, that very many rows share; they are looked
    up only when there are hot keys.
    """
    previous, following = previous or {}, following or {}
    latest, running = latest or {}, running or {}
    order = [c for c in order if c not in keys]
    hot = _resolve(df, keys, hot)

    def in_window(parts: Sequence[str]) -> dict[str, Column]:
        w = Window.partitionBy(*parts).orderBy(*order)
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        columns = {number: F.row_number().over(w).cast("bigint")} if number else {}
        columns |= {name: F.lag(value).over(w) for name, value in previous.items()}
        columns |= {name: F.lead(value).over(w) for name, value in following.items()}
        columns |= {name: F.last(v, ignorenulls=True).over(so_far) for name, v in latest.items()}
        columns |= {name: F.sum(value).over(so_far) for name, value in running.items()}
        return columns

    if hot is None:
        return df.withColumns(in_window(keys))

    chunked = _with_chunks(df, keys, order, hot, _resolve(df, [*keys, *order], ties))
    parts = [*keys, _CHUNK, _DEAL]
    w = Window.partitionBy(*parts).orderBy(*order)
    inside = chunked.withColumns(
        in_window(parts)
        | {
            "__opens": F.row_number().over(w) == 1,
            "__closes": F.lead(F.lit(True)).over(w).isNull(),
        }
    )

    here = F.struct(*order)
    per_chunk = [F.count(F.lit(1)).alias("__count")]
    per_chunk += [F.max_by(F.struct(v.alias("v")), here).alias(f"__p_{n}") for n, v in previous.items()]
    per_chunk += [F.min_by(F.struct(v.alias("v")), here).alias(f"__f_{n}") for n, v in following.items()]
    per_chunk += [
        F.max_by(F.struct(v.alias("v")), F.when(v.isNotNull(), here)).alias(f"__l_{n}")
        for n, v in latest.items()
    ]
    per_chunk += [F.sum(v).alias(f"__r_{n}") for n, v in running.items()]

    across = Window.partitionBy(*keys).orderBy(_CHUNK, _DEAL)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.sum("__count").over(earlier).alias("__count")]
    carried += [F.lag(f"__p_{n}").over(across).alias(f"__p_{n}") for n in previous]
    carried += [F.lead(f"__f_{n}").over(across).alias(f"__f_{n}") for n in following]
    carried += [F.last(f"__l_{n}", ignorenulls=True).over(earlier).alias(f"__l_{n}") for n in latest]
    carried += [F.sum(f"__r_{n}").over(earlier).alias(f"__r_{n}") for n in running]
    carry = (
        chunked.filter(_SPLIT)
        .groupBy(*parts)
        .agg(*per_chunk)
        .select(*parts, *carried)
    )

    joined = _attach(inside, carry, parts, "left")
    result = {number: F.col(number) + F.coalesce("__count", F.lit(0))} if number else {}
    for name in previous:
        border = F.col("__opens") & F.col(f"__p_{name}").isNotNull()
        result[name] = F.when(border, F.col(f"__p_{name}.v")).otherwise(F.col(name))
    for name in following:
        border = F.col("__closes") & F.col(f"__f_{name}").isNotNull()
        result[name] = F.when(border, F.col(f"__f_{name}.v")).otherwise(F.col(name))
    for name in latest:
        result[name] = F.coalesce(F.col(name), F.col(f"__l_{name}.v"))
    for name in running:
        before = F.col(f"__r_{name}")
        summed = F.coalesce(F.col(name) + before, F.col(name), before)
        result[name] = summed.cast(inside.schema[name].dataType)
    helpers = [c for c in joined.columns if c.startswith("__") and c not in df.columns]
    return joined.withColumns(result).drop(*[c for c in helpers if c not in result])


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Join many rows to a side with at most one row per key, spreading hot keys of the left side.

    This is for a right side that is computed on the spot, e.g. grouped by the key: its grouping
    takes the place of the shuffle that adaptive execution would need to split a skewed join. For
    two stored tables adaptive execution does that, so pass ``hot=None`` or join them plainly.
    ``how`` is inner, left, left_semi or left_anti. The salt is the map partition, which a re-run
    task keeps, so copies of a row spread as well and a lost executor changes nothing.
    """
    on = list(on)
    hot = _resolve(left, on, hot)
    if hot is None:
        return left.join(right, on, how)
    parts = hot.select(*on, _PARTS)
    salted = (
        _attach(left, parts, on, "left")
        .withColumn(_SALT, F.spark_partition_id() % F.coalesce(_PARTS, F.lit(1)))
        .drop(_PARTS)
    )
    repeated = (
        _attach(right, parts, on, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_PARTS, F.lit(1)) - 1)))
        .drop(_PARTS)
    )
    return salted.join(repeated, [*on, _SALT], how).drop(_SALT)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Hashes of the keys that several rows have, or None where these are more than ``MAX_REPEATED``.

    Only hashes are shuffled. Keys that share a hash are taken for repeated, which ``apart`` allows.
    """
    hashed = df.groupBy(F.xxhash64(*keys).alias(_HASH)).agg(F.count(F.lit(1)).alias(_ROWS))
    found = checkpointed(hashed.filter(F.col(_ROWS) > 1).select(_HASH))
    rows = found.count()
    if rows > MAX_REPEATED:
        return None
    # Of a relation known to be empty the optimizer drops all work.
    return found if rows else found.limit(0)


def hashed_side(df: DataFrame) -> DataFrame:
    """The narrow right side of a join as a hash table per task, so that the wide left side is not sorted.

    Beyond ``HASHED_PER_TASK`` rows per shuffle partition Spark sorts; it decides as well below ``MAX_REPEATED`` rows,
    which it may broadcast.
    """
    rows, tasks = df.count(), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash") if MAX_REPEATED < rows <= HASHED_PER_TASK * tasks else df


def apart(df: DataFrame, keys: Sequence[str], repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that are certainly the only ones of their key, and all others. No row is moved for it.

    ``repeated`` is that of a table that has all rows of ``df``, or more.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    single, several = (hashed.join(F.broadcast(repeated), _HASH, how) for how in ("left_anti", "left_semi"))
    return single.drop(_HASH), several.drop(_HASH)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], repeated: DataFrame | None = None
) -> DataFrame:
    """The last row of each key in ``order``.

    Spark turns rank 1 into a limit per key before the shuffle, so a task receives at most one
    row per key and map task, however many rows the key has. With ``repeated`` keys only their rows are shuffled.
    """
    if repeated is not None:
        single, several = apart(df, keys, repeated)
        return single.unionByName(latest_per_key(several, keys, order))
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")
