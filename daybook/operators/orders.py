"""Order facts: roll-ups, conversion, campaigns, payments, shipments, refunds and lifecycle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.scalars import base_rate_to_pln, from_pln
from daybook.operators.skew import PROBE, apart, join_unique, latest_per_key, ordered_columns
from daybook.schemas import ORDER_STATUSES, ORDER_TRANSITIONS

# Campaign days and daily rates, narrow rows both, are broadcast up to these numbers.
BROADCAST_CAMPAIGN_DAYS = 500_000
BROADCAST_RATES = 500_000
BROADCAST_CAMPAIGNS = 100_000


def daily_totals(
    orders: DataFrame, day: str = "order_date", amount: str = "order_amount", by: Sequence[str] = ()
) -> DataFrame:
    """Order count and amount per day, in day order; also per ``by``, such as the amount's currency."""
    return (
        orders.groupBy(day, *by)
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum(amount).alias("daily_order_amount"))
        .orderBy(day, *by)
    )


def order_totals(
    items: DataFrame,
    key: str = "order_id",
    gross: Column | None = None,
    discount: Column | None = None,
) -> DataFrame:
    """Gross, discount and net amount per order from its items."""
    gross = F.col("unit_price") * F.col("quantity") if gross is None else gross
    discount = F.col("discount_amount") if discount is None else discount
    return (
        items.groupBy(key)
        .agg(F.sum(gross).alias("gross_amount"), F.sum(discount).alias("discount_amount"))
        .withColumn("net_amount", F.round(F.col("gross_amount") - F.col("discount_amount"), 2))
    )


def with_order(
    children: DataFrame,
    orders: DataFrame,
    columns: Sequence[str],
    key: str = "order_id",
    how: str = "inner",
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Items, payments, shipments or refunds with ``columns`` of their order.

    ``orders`` holds one row per order, as current_state returns it.
    """
    return join_unique(children, orders.select(key, *columns), [key], how, hot)


def convert_from_pln(
    orders: DataFrame,
    amounts: Sequence[str],
    currency: str = "currency",
    rates: DataFrame | None = None,
    day: str = "order_date",
) -> DataFrame:
    """Convert PLN amounts to each row's currency, two places.

    Fixed base rates by default; with ``rates`` (rate_date, currency, rate_to_pln; one row per day
    and currency) that day's rate. Up to ``BROADCAST_RATES`` rates are sent to the orders.
    """
    if rates is None:
        rate = base_rate_to_pln(F.col(currency))
        return orders.withColumns({a: from_pln(F.col(a), rate) for a in amounts})
    daily = rates.select(
        F.col("rate_date").alias(day),
        F.col("currency").alias(currency),
        F.col("rate_to_pln").alias("__rate"),
    )
    if daily.limit(BROADCAST_RATES + 1).count() <= BROADCAST_RATES:
        rated = orders.join(F.broadcast(daily), [day, currency], "left")
    else:
        rated = join_unique(orders, daily, [day, currency], "left")
    converted = {a: from_pln(F.col(a), F.col("__rate")) for a in amounts}
    return rated.withColumns(converted).select(*orders.columns)


def with_campaigns(
    orders: DataFrame, campaigns: DataFrame, day: str = "order_date", mode: str = "all"
) -> DataFrame:
    """Left join to the campaigns that run on an order's day.

    Campaigns are expanded to their days, which makes the range look-up an equi-join. Mode "all"
    returns a row per running campaign, "one" a single row with the lowest campaign_id. Up to
    ``BROADCAST_CAMPAIGN_DAYS`` the days are sent to the orders, beyond that both sides are shuffled.
    """
    if mode not in ("all", "one"):
        raise ValueError(f"unknown mode {mode!r}")
    valid = campaigns.filter(F.col("start_date") <= F.col("end_date"))
    length = F.sum(F.datediff("end_date", "start_date") + 1)
    small = (valid.agg(length).first()[0] or 0) <= BROADCAST_CAMPAIGN_DAYS
    days = valid.select(
        F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))).alias(day),
        "campaign_id",
    )
    if mode == "one":
        days = days.groupBy(day).agg(F.min("campaign_id").alias("campaign_id"))
    if small:
        return orders.join(F.broadcast(days), day, "left")
    if mode == "one":
        return join_unique(orders, days, [day], "left")
    return orders.join(days.hint("merge"), day, "left")


def with_channel(orders: DataFrame, campaigns: DataFrame, fallback: Column) -> DataFrame:
    """Channel of the order's campaign, or ``fallback`` where there is no such campaign."""
    channels = campaigns.select("campaign_id", F.col("source_channel").alias("__channel"))
    # Few ids for all orders: up to ``BROADCAST_CAMPAIGNS`` no order is moved, beyond that hot ids are split.
    if channels.limit(BROADCAST_CAMPAIGNS + 1).count() <= BROADCAST_CAMPAIGNS:
        found = orders.join(F.broadcast(channels), "campaign_id", "left")
    else:
        found = join_unique(orders, channels, ["campaign_id"], "left")
    return found.withColumn("source_channel", F.coalesce(F.col("__channel"), fallback)).drop("__channel")


def numbered_lines(
    items: DataFrame, key: str, order: Sequence[str], hot: DataFrame | str | None = PROBE
) -> DataFrame:
    """Line number within the order and the composite item key ``<order>_<line>``."""
    return ordered_columns(items, [key], order, number="line_number", hot=hot).withColumn(
        "order_item_id", F.concat_ws("_", F.col(key).cast("string"), F.col("line_number"))
    )


def numbered_attempts(
    payments: DataFrame,
    key: str = "order_id",
    status: str = "payment_status",
    order: Sequence[str] = ("created_at", "payment_id"),
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Attempt number of each payment row.

    Failed and captured rows count up in time order, authorized rows are always 1 and refunded
    rows carry the number of the capture they return.
    """
    counts = F.when(F.col(status).isin("failed", "captured"), 1).otherwise(0)
    return ordered_columns(
        payments, [key], order, running={"payment_attempt_number": counts}, hot=hot
    ).withColumn(
        "payment_attempt_number",
        F.when(F.col(status) == "authorized", 1)
        .otherwise(F.col("payment_attempt_number"))
        .cast("int"),
    )


def last_captured(
    payments: DataFrame,
    key: str = "order_id",
    status: str = "payment_status",
    captured: str = "captured",
    order: Sequence[str] = ("created_at", "payment_id"),
) -> DataFrame:
    """The last captured payment of each order."""
    return latest_per_key(payments.filter(F.col(status) == captured), [key], order)


def refunds_with_payment(
    refunds: DataFrame, payments: DataFrame, hot: DataFrame | str | None = PROBE
) -> DataFrame:
    """Refunds with the last captured payment of their order; a refund without one is dropped."""
    paid = last_captured(payments).select(
        "order_id",
        F.col("payment_id").alias("captured_payment_id"),
        F.col("payment_attempt_number").alias("captured_attempt_number"),
        F.col("payment_method").alias("captured_payment_method"),
    )
    return join_unique(refunds, paid, ["order_id"], "inner", hot)


def payment_outcome(
    orders: DataFrame,
    payments: DataFrame,
    key: str = "order_id",
    status: str = "payment_status",
    attempt: str = "payment_attempt_number",
) -> DataFrame:
    """How paying an order ended: first_try, retried, cancelled, or open without a final attempt.

    ``orders`` has one row per order, and so have the payments once they are counted.
    """
    captured = F.col(status) == "captured"
    per_order = payments.groupBy(key).agg(
        F.min(F.when(captured, F.col(attempt))).alias("captured_attempt"),
        F.count_if(F.col(status) == "failed").alias("failed_count"),
        F.count_if(captured).alias("captured_count"),
    )
    outcome = (
        F.when(F.col("captured_attempt") == 1, "first_try")
        .when(F.col("captured_attempt") > 1, "retried")
        .when(F.col("failed_count") > 0, "cancelled")
        .otherwise("open")
    )
    zero = {"failed_count": 0, "captured_count": 0}
    return (
        orders.join(per_order, key, "left")
        .fillna(zero)
        .withColumn("payment_outcome", outcome)
    )


def shipment_outcome(
    shipments: DataFrame,
    key: str = "shipment_id",
    version: Sequence[str] = ("source_event_at", "loaded_at"),
    status: str = "shipment_status",
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Latest state of each shipment as in_transit, lost, delivered or returned."""
    return latest_per_key(shipments, [key], version, repeated).withColumn(
        "shipment_outcome",
        F.when(F.col(status) == "shipped", "in_transit").otherwise(F.col(status)),
    )


def with_delivery_delay(
    shipments: DataFrame,
    delivered: str = "delivered_at",
    estimated: str = "estimated_delivery_at",
) -> DataFrame:
    """Flag deliveries after the estimate and their delay in days; open ones are not late."""
    late = F.coalesce(F.col(delivered) > F.col(estimated), F.lit(False))
    days = F.datediff(F.col(delivered), F.col(estimated))
    return shipments.withColumns(
        {"is_late": late, "days_late": F.when(late, days).otherwise(0)}
    )


def refund_class(
    orders: DataFrame,
    refunds: DataFrame,
    key: str = "order_id",
    net: str = "net_amount",
    amount: str = "refund_amount",
    status: str = "refund_status",
) -> DataFrame:
    """Refund state of each order: none, rejected, partial or full.

    ``orders`` has one row per order, and so have the refunds once they are summed.
    """
    per_order = refunds.groupBy(key).agg(
        F.sum(F.when(F.col(status) == "processed", F.col(amount))).alias("refunded_amount"),
        F.count(F.lit(1)).alias("refund_count"),
    )
    state = (
        F.when(F.col("refund_count").isNull(), "none")
        .when(F.col("refunded_amount").isNull(), "rejected")
        .when(F.col("refunded_amount") < F.col(net), "partial")
        .otherwise("full")
    )
    return (
        orders.join(per_order, key, "left")
        .withColumn("refund_class", state)
        .fillna({"refund_count": 0})
    )


def lifecycle(
    feed: DataFrame,
    key: str = "order_id",
    status: str = "order_status",
    at: str = "order_updated_at",
    statuses: Sequence[str] = tuple(ORDER_STATUSES),
    closed: Sequence[str] = ("cancelled", "refunded", "partially_refunded"),
    tie: Sequence[str] = ("loaded_at",),
    repeated: DataFrame | None = None,
) -> DataFrame:
    """First time per status, current status and whether the order is closed.

    One aggregation with map-side combining; a status an order never reached is NULL. With ``repeated`` keys only
    their rows are aggregated.
    """
    reached = {f"{s}_at": F.when(F.col(status) == s, F.col(at)) for s in statuses}

    def in_groups(rows: DataFrame) -> DataFrame:
        current = F.max_by(status, F.struct(at, *tie)).alias("current_status")
        return rows.groupBy(key).agg(*[F.min(first).alias(name) for name, first in reached.items()], current)

    if repeated is None:
        orders = in_groups(feed)
    else:
        single, several = apart(feed, [key], repeated)
        firsts = [first.alias(name) for name, first in reached.items()]
        alone = single.select(key, *firsts, F.col(status).alias("current_status"))
        orders = alone.unionByName(in_groups(several))
    return orders.withColumn("is_closed", F.col("current_status").isin(*closed))


def status_transitions(
    feed: DataFrame,
    key: str = "order_id",
    status: str = "order_status",
    order: Sequence[str] = ("order_updated_at", "loaded_at"),
    allowed: Sequence[tuple[str, str]] = tuple(ORDER_TRANSITIONS),
    hot: DataFrame | str | None = PROBE,
) -> DataFrame:
    """Each status change with the status before it and whether it is allowed."""
    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in allowed]
    change = F.struct(F.col("from_status").alias("a"), F.col("to_status").alias("b"))
    return (
        ordered_columns(feed, [key], order, previous={"from_status": F.col(status)}, hot=hot)
        .filter(F.col("from_status").isNotNull())
        .withColumnRenamed(status, "to_status")
        .withColumn("is_allowed", change.isin(*pairs))
    )


def transition_counts(transitions: DataFrame) -> DataFrame:
    return transitions.groupBy("from_status", "to_status", "is_allowed").agg(
        F.count(F.lit(1)).alias("transition_count")
    )


def order_facts(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    refunds: DataFrame,
    extra: Mapping[str, Column] | None = None,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """One row per order: current state, item totals, payment outcome and refund class.

    ``orders`` is the raw order feed. The children are reduced to one row per order before they are
    joined, so each join is one row to one row.
    """
    current = latest_per_key(orders, ["order_id"], ["order_updated_at", "loaded_at"], repeated)
    totals = order_totals(items).withColumnsRenamed(
        {
            "gross_amount": "items_gross_pln",
            "discount_amount": "items_discount_pln",
            "net_amount": "items_net_pln",
        }
    )
    facts = current.join(totals, "order_id", "left")
    facts = payment_outcome(facts, payments)
    facts = refund_class(facts, refunds)
    return facts.withColumns(dict(extra)) if extra else facts
