"""Current state, version history and look-ups that are valid at a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.skew import PROBE, apart, hashed_side, hot_keys, join_unique, latest_per_key, ordered_columns


def current_state(
    feed: DataFrame, keys: Sequence[str], version: Sequence[str], keep: Column | None = None
) -> DataFrame:
    """Latest row per key of a change feed; ``keep`` filters the current rows, e.g. active ones."""
    current = latest_per_key(feed, keys, version)
    return current if keep is None else current.filter(keep)


def active_customers(customers: DataFrame) -> DataFrame:
    """Customers whose current status is active."""
    return current_state(
        customers, ["customer_id"], ["updated_at", "loaded_at"], F.col("customer_status") == "active"
    )


def active_products(products: DataFrame) -> DataFrame:
    """Products that are currently on sale."""
    return current_state(products, ["product_id"], ["updated_at", "loaded_at"], F.col("is_active"))


def version_history(
    feed: DataFrame,
    keys: Sequence[str],
    version: Sequence[str],
    attributes: Sequence[str],
    strategy: str = "timestamp",
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """One row per version with valid_from, valid_to and is_current, which only the last one of a key is.

    ``version`` starts with the time a version begins; further columns break ties. The
    "timestamp" strategy keeps every feed row, "check" only rows that change an attribute.
    """
    if strategy not in ("timestamp", "check"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if isinstance(hot, str):
        hot = hot_keys(feed, keys)
    rows = feed.select(*dict.fromkeys([*keys, *version, *attributes]))
    if strategy == "check":
        now = F.struct(*attributes)
        rows = (
            ordered_columns(rows, keys, version, previous={"__before": now}, hot=hot)
            .filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(now))
            .drop("__before")
        )
    following = {"valid_to": F.col(version[0]), "__next": F.lit(True)}
    return (
        ordered_columns(rows, keys, version, following=following, hot=hot)
        .withColumns({"valid_from": F.col(version[0]), "is_current": F.col("__next").isNull()})
        .select(*keys, *attributes, "valid_from", "valid_to", "is_current")
    )


def at_point_in_time(
    facts: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    version_time: str,
    values: Sequence[str],
    version_tie: Sequence[str] = (),
    fact_tie: Sequence[str] = (),
    hot: DataFrame | str | None = PROBE,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Add to each fact the ``values`` of the latest version at or before the fact's time.

    Versions and facts are merged in time order per key, so the work is linear in both and no pair of
    a fact and a wrong version is ever formed. Facts without a version get NULLs, and so do facts
    without a time; a version without a time is never valid. Of versions at the same time the last
    in ``version_tie`` order counts; ``fact_tie`` identifies a fact among those of the same key and time.

    With the ``repeated`` keys of the versions only their facts are merged; all other keys have one version, which
    is joined.
    """
    if repeated is not None:
        one, more = apart(versions, keys, repeated)
        of_one, of_more = apart(facts, keys, repeated)
        one = one.dropna(subset=[*keys, version_time])
        one = one.select(*keys, F.col(version_time).alias("__at"), F.struct(*values).alias("__found"))
        joined = join_unique(of_one, hashed_side(one), keys, "left", hot)
        valid = F.col("__at") <= F.col(fact_time)
        found = [F.when(valid, F.col(f"__found.{c}")).alias(c) for c in values]
        merged = at_point_in_time(
            of_more, more, keys, fact_time, version_time, values, version_tie, fact_tie, hot
        )
        return joined.select(*facts.columns, *found).unionByName(merged)
    tie = F.struct(*version_tie) if version_tie else F.lit(0)
    # A NULL key matches nothing, as in a join.
    known = (
        versions.dropna(subset=[*keys, version_time])
        .groupBy(*keys, F.col(version_time).alias("__at"))
        .agg(F.max_by(F.struct(*values), tie).alias("__version"))
    )
    fact_rows = facts.withColumns(
        {"__at": F.col(fact_time), "__fact": F.lit(1)}
        | {f"__tie{i}": F.col(c) for i, c in enumerate(fact_tie)}
    )
    order = ["__at", "__fact", *[f"__tie{i}" for i in range(len(fact_tie))]]
    merged = fact_rows.unionByName(known.withColumn("__fact", F.lit(0)), allowMissingColumns=True)
    return (
        ordered_columns(merged, keys, order, latest={"__found": F.col("__version")}, hot=hot)
        .filter(F.col("__fact") == 1)
        .select(*facts.columns, *[F.col(f"__found.{c}").alias(c) for c in values])
    )


def item_prices(
    items: DataFrame,
    products: DataFrame,
    hot: DataFrame | str | None = PROBE,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Order items with the list price that applied on their load date.

    Product changes of a day come before the orders of that day, whatever their time stamp, so
    the look-up is by load date and not by event time. ``repeated`` are products with several rows.
    """
    listed = products.withColumnRenamed("unit_price", "list_price")
    return at_point_in_time(
        items, listed, ["product_id"], "load_date", "load_date", ["list_price"],
        version_tie=["updated_at"], fact_tie=["order_item_id"], hot=hot, repeated=repeated,
    )
