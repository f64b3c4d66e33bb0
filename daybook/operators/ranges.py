"""Look-ups of points in ranges by the nodes of a tree over whole numbers, such as days or minutes.

Every range is the union of few nodes, aligned blocks of ``FAN`` to some power of numbers: fewer than
2 * FAN per level, however long the range is. A point lies in one node per level. So the look-up
is an equi-join on level and node, ranges may be open or centuries long at minute grain, and no
range is ever expanded to its days or minutes.

Where only totals over the ranges of a point are asked for, the ranges are totalled per node first.
A point then meets one row per level, however many ranges hold it, and no pair of the two is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAN_BITS = 4
FAN = 1 << FAN_BITS
LEVELS = 7  # numbers from -FAN^7 / 2 up to FAN^7 / 2: minutes of 127 years around 1970, or any day
MOST = FAN**LEVELS // 2
BROADCAST_NODES = 500_000


def day_number(day: Column) -> Column:
    return F.unix_date(day.cast("date")).cast("bigint")


def minute_number(moment: Column) -> Column:
    return F.floor(F.unix_micros(moment.cast("timestamp")) / 60_000_000)


def cover(low: Column, high: Column) -> Column:
    """Level and node of the nodes whose union is ``low`` to ``high``, both ends included.

    A NULL end is open; a range that ends before it begins has none.
    """
    start = F.greatest(F.coalesce(low, F.lit(-MOST)), F.lit(-MOST))
    stop = F.least(F.coalesce(high, F.lit(MOST - 1)), F.lit(MOST - 1)) + 1

    def first(level: int) -> Column:
        return -F.floor(-start / FAN**level)

    def end(level: int) -> Column:
        return F.floor(stop / FAN**level)

    def nodes(level: int, a: Column, b: Column) -> Column:
        run = F.when(a < b, F.sequence(a, b - 1)).otherwise(F.expr("cast(array() as array<bigint>)"))
        return F.transform(run, lambda n: F.struct(F.lit(level).alias("level"), n.alias("node")))

    parts = []
    for level in range(LEVELS):
        a, b = first(level), end(level)
        if level == LEVELS - 1:
            parts.append(nodes(level, a, b))
            continue
        # What the level above does not cover: all, or what is left of its first and right of its last node.
        above_a, above_b = first(level + 1) * FAN, end(level + 1) * FAN
        some = above_a < above_b
        parts.append(nodes(level, a, F.when(some, above_a).otherwise(b)))
        parts.append(nodes(level, F.when(some, above_b).otherwise(b), b))
    return F.concat(*parts)


def in_ranges(
    points: DataFrame, point: Column, ranges: DataFrame, low: Column, high: Column, on: Sequence[str] = ()
) -> DataFrame:
    """A row per point and range that holds it, of ranges with equal ``on``, with the columns of both.

    ``point``, ``low`` and ``high`` are whole numbers, as ``day_number`` and ``minute_number`` return. Names other than
    those in ``on`` should differ. Points are repeated for the levels that occur in the ranges, at most
    ``LEVELS`` times. Up to ``BROADCAST_NODES`` nodes are sent to the points, which do not move then.
    """
    return _at_nodes(points, point, _with_nodes(ranges, low, high), on)


def totals_in_ranges(
    points: DataFrame,
    keys: Sequence[str],
    point: Column,
    ranges: DataFrame,
    low: Column,
    high: Column,
    on: Sequence[str],
    value: str,
) -> DataFrame:
    """``keys`` with the number of ranges that hold a point of theirs and the least and greatest ``value`` of them.

    The totals are those of grouping ``in_ranges`` by ``keys``, without its rows: the work grows with points and
    ranges, and not with their product. Keys whose points are in no range are left out.
    """
    per_node = _with_nodes(ranges, low, high).groupBy(*on, "__level", "__node")
    nodes = per_node.agg(
        F.count(F.lit(1)).alias("__count"), F.min(value).alias("__least"), F.max(value).alias("__greatest")
    )
    found = _at_nodes(points.withColumn("__point", point).select(*dict.fromkeys([*keys, *on]), "__point"), F.col("__point"), nodes, on)
    return found.groupBy(*keys).agg(
        F.sum("__count").alias("count"), F.min("__least").alias("least"), F.max("__greatest").alias("greatest")
    )


def _with_nodes(ranges: DataFrame, low: Column, high: Column) -> DataFrame:
    """A row per range and node of it."""
    nodes = ranges.withColumn("__node", F.explode(cover(low, high))).select("*", "__node.level", "__node.node")
    return nodes.drop("__node").withColumnsRenamed({"level": "__level", "node": "__node"})


def _at_nodes(points: DataFrame, point: Column, nodes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Points joined with the rows of the nodes they lie in."""
    count, levels = nodes.agg(F.count(F.lit(1)), F.sort_array(F.collect_set("__level"))).first()
    if count <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    levels = F.array(*map(F.lit, levels)) if levels else F.expr("cast(array() as array<int>)")
    probes = points.withColumn("__point", point).withColumn("__level", F.explode(levels))
    node = F.floor(F.col("__point") / F.pow(F.lit(FAN), F.col("__level"))).cast("bigint")
    probes = probes.withColumn("__node", node).filter(F.col("__point").between(-MOST, MOST - 1))
    return probes.join(nodes, [*on, "__level", "__node"]).drop("__level", "__node", "__point")
