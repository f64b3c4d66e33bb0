"""Web events: the checkout gate and matching purchases to orders in a time interval."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.skew import PROBE, hot_keys, ordered_columns


def checkout_gate(
    events: DataFrame,
    session: Sequence[str] = ("session_id",),
    order: Sequence[str] = ("event_timestamp", "event_id"),
    event_type: str = "event_type",
    opening: str = "page_view",
    checkout: str = "checkout_started",
    purchase: str = "purchase_completed",
    instead: str = "product_view",
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Add checkout_happened and gated_type.

    The first event of a session counts as ``opening``; a purchase without an earlier checkout
    counts as ``instead``. ``order`` is the caller's: event times need not be session order.
    """
    if isinstance(hot, str):
        hot = hot_keys(events, session)
    numbered = ordered_columns(events, session, order, number="__n", hot=hot)
    is_checkout = (F.col(event_type) == checkout) & (F.col("__n") > 1)
    seen = ordered_columns(
        numbered, session, order, latest={"__seen": F.when(is_checkout, F.lit(1))}, hot=hot
    ).withColumn("checkout_happened", F.col("__seen").isNotNull())
    gated = (
        F.when(F.col("__n") == 1, opening)
        .when((F.col(event_type) == purchase) & ~F.col("checkout_happened"), instead)
        .otherwise(F.col(event_type))
    )
    return seen.withColumn("gated_type", gated).drop("__n", "__seen")


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def interval_pairs(
    early: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    early_time: str,
    late_time: str,
    low_minutes: int = 1,
    high_minutes: int = 20,
) -> DataFrame:
    """Pairs of the same key where ``late`` is low to high minutes after ``early``, both included.

    Time is cut into slots as long as the interval, so the join is an equi-join on key and slot and
    looks at the two slots an interval can touch, not at all rows of a key. The columns of the two
    sides need different names, apart from the keys.
    """
    low, high = low_minutes * 60_000_000, high_minutes * 60_000_000
    width = max(high - low, 1_000_000)

    def slot(micros: Column) -> Column:
        return F.floor(micros / width)

    at = _micros(F.col(early_time))
    probes = early.withColumns({"__from": at + low, "__to": at + high}).withColumn(
        "__slot", F.explode(F.sequence(slot(F.col("__from")), slot(F.col("__to"))))
    )
    targets = late.withColumn("__at", _micros(F.col(late_time))).withColumn(
        "__slot", slot(F.col("__at"))
    )
    return (
        probes.join(targets, [*keys, "__slot"])
        .filter(F.col("__at").between(F.col("__from"), F.col("__to")))
        .drop("__slot", "__from", "__to", "__at")
    )


def next_in_interval(
    early: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    early_time: str,
    late_time: str,
    values: Sequence[str],
    early_tie: Sequence[str],
    late_tie: Sequence[str],
    low_minutes: int = 1,
    high_minutes: int = 20,
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Each ``early`` row with ``values`` of the first ``late`` row low to high minutes later.

    One result row per early row (NULLs without a match), linear in both inputs: the two are merged
    backwards in time per key and each early row takes the late row seen last. Of several late
    rows at the same instant the first in ``late_tie`` order counts; ``early_tie`` identifies an
    early row among those of the same instant.
    """
    low, high = low_minutes * 60_000_000, high_minutes * 60_000_000
    probes = early.withColumns(
        {"__at": -(_micros(F.col(early_time)) + low), "__probe": F.lit(1)}
        | {f"__tie{i}": F.col(c) for i, c in enumerate(early_tie)}
    )
    targets = (
        late.dropna(subset=list(keys))  # a NULL key matches nothing, as in a join
        .groupBy(*keys, _micros(F.col(late_time)).alias("__late"))
        .agg(F.min_by(F.struct(*values), F.struct(*late_tie)).alias("__values"))
        .select(
            *keys,
            (-F.col("__late")).alias("__at"),
            F.lit(0).alias("__probe"),
            F.struct("__late", "__values").alias("__target"),
        )
    )
    merged = probes.unionByName(targets, allowMissingColumns=True)
    order = ["__at", "__probe", *[f"__tie{i}" for i in range(len(early_tie))]]
    found = ordered_columns(
        merged, keys, order, latest={"__next": F.col("__target")}, hot=hot
    ).filter(F.col("__probe") == 1)
    in_time = F.col("__next.__late") <= high - low - F.col("__at")
    return found.select(
        *early.columns,
        *[F.when(in_time, F.col(f"__next.__values.{v}")).alias(v) for v in values],
    )
