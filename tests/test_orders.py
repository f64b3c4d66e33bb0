from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.functions.scalars import surrogate_key
from daybook.operators import dims, orders, skew, state, tables
from daybook.operators.events import checkout_gate, interval_pairs, next_in_interval
from tests.conftest import at, day

FEED = "order_id string, order_status string, order_updated_at timestamp, loaded_at timestamp"


def feed(spark, rows):
    return spark.createDataFrame([(o, s, at(u), at(v)) for o, s, u, v in rows], FEED)


@pytest.fixture
def statuses(spark):
    """Order 1: delivered landed before shipped. Order 2: lost, stays shipped. Order 3: illegal."""
    return feed(
        spark,
        [
            ("o1", "created", "2026-01-01 10:00:00", "2026-01-01 00:00:00"),
            ("o1", "paid", "2026-01-01 10:10:00", "2026-01-02 00:00:00"),
            ("o1", "delivered", "2026-01-03 10:00:00", "2026-01-03 00:00:00"),
            ("o1", "shipped", "2026-01-02 10:00:00", "2026-01-04 00:00:00"),
            ("o2", "created", "2026-01-01 11:00:00", "2026-01-01 00:00:00"),
            ("o2", "paid", "2026-01-01 11:10:00", "2026-01-02 00:00:00"),
            ("o2", "shipped", "2026-01-02 11:00:00", "2026-01-03 00:00:00"),
            ("o3", "created", "2026-01-01 12:00:00", "2026-01-01 00:00:00"),
            ("o3", "refunded", "2026-01-01 13:00:00", "2026-01-02 00:00:00"),
        ],
    )


def test_current_state_goes_by_event_time(spark, statuses):
    current = state.current_state(statuses, ["order_id"], ["order_updated_at", "loaded_at"])
    assert {r.order_id: r.order_status for r in current.collect()} == {
        "o1": "delivered", "o2": "shipped", "o3": "refunded",
    }


def test_transitions(spark, statuses):
    found = orders.status_transitions(statuses).collect()
    assert {(r.order_id, r.from_status, r.to_status) for r in found if not r.is_allowed} == {
        ("o3", "created", "refunded")
    }
    assert len(found) == 6
    counts = orders.transition_counts(orders.status_transitions(statuses))
    assert {(r.from_status, r.to_status): r.transition_count for r in counts.collect()}[
        ("paid", "shipped")
    ] == 2


def test_lifecycle_tolerates_open_orders(spark, statuses):
    rows = {r.order_id: r for r in orders.lifecycle(statuses).collect()}
    assert rows["o1"].shipped_at == at("2026-01-02 10:00:00")
    assert (rows["o2"].current_status, rows["o2"].delivered_at, rows["o2"].is_closed) == (
        "shipped", None, False,
    )
    assert rows["o3"].is_closed is True


CUSTOMER = "customer_id string, city string, customer_status string, updated_at timestamp, loaded_at timestamp"


@pytest.fixture
def customers(spark):
    rows = [
        ("c1", "Brno", "active", "2025-01-01 00:00:00"),
        ("c1", "Praha", "active", "2026-01-02 00:00:00"),
        ("c1", "Praha", "active", "2026-01-03 00:00:00"),  # changes nothing
        ("c1", "Praha", "inactive", "2026-01-04 00:00:00"),
        ("c2", None, "active", "2026-01-01 00:00:00"),
        ("c2", "Nitra", "active", "2026-01-02 00:00:00"),
    ]
    return spark.createDataFrame(
        [(c, t, s, at(u), at(u)) for c, t, s, u in rows], CUSTOMER
    )


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("strategy, versions", [("timestamp", 6), ("check", 5)])
def test_version_history(spark, customers, strategy, versions, split):
    hot = skew.hot_keys(customers, ["customer_id"], 1, sample=1.0) if split else None
    history = state.version_history(
        customers, ["customer_id"], ["updated_at", "loaded_at"], ["city", "customer_status"],
        strategy, hot,
    )
    rows = sorted(history.collect(), key=lambda r: (r.customer_id, r.valid_from))
    assert len(rows) == versions
    for a, b in zip(rows, rows[1:]):
        if a.customer_id == b.customer_id:
            assert a.valid_to == b.valid_from and not a.is_current
        else:
            assert a.valid_to is None and a.is_current
    assert rows[-1].city == "Nitra" and rows[-1].is_current


def test_unknown_strategy(spark, customers):
    with pytest.raises(ValueError):
        state.version_history(customers, ["customer_id"], ["updated_at"], ["city"], "other")


def test_active_masters(spark, customers):
    assert [r.customer_id for r in state.active_customers(customers).collect()] == ["c2"]
    products = spark.createDataFrame(
        [("p1", True, at("2026-01-01")), ("p1", False, at("2026-01-02")), ("p2", True, at("2026-01-01"))],
        "product_id string, is_active boolean, updated_at timestamp",
    ).withColumn("loaded_at", F.col("updated_at"))
    assert [r.product_id for r in state.active_products(products).collect()] == ["p2"]


@pytest.mark.parametrize("split", [False, True])
def test_price_by_load_date(spark, split):
    """A price changed at 18:00 applies to all orders loaded that day, not to the day before."""
    products = spark.createDataFrame(
        [("p1", Decimal("10.00"), day("2026-01-01"), at("2026-01-01 09:00:00")),
         ("p1", Decimal("12.00"), day("2026-01-02"), at("2026-01-02 18:00:00"))],
        "product_id string, unit_price decimal(12,2), load_date date, updated_at timestamp",
    )
    items = spark.createDataFrame(
        [("i0", "p1", day("2025-12-31")), ("i1", "p1", day("2026-01-01")),
         ("i2", "p1", day("2026-01-02")), ("i3", "p1", day("2026-01-09")), ("i4", "p9", day("2026-01-09"))],
        "order_item_id string, product_id string, load_date date",
    )
    hot = skew.hot_keys(items, ["product_id"], 1, sample=1.0) if split else None
    listed = products.withColumnRenamed("unit_price", "list_price")
    found = state.at_point_in_time(
        items, listed, ["product_id"], "load_date", "load_date", ["list_price"],
        ["updated_at"], ["order_item_id"], hot,
    )
    prices = {r.order_item_id: r.list_price and float(r.list_price) for r in found.collect()}
    assert prices == {"i0": None, "i1": 10.0, "i2": 12.0, "i3": 12.0, "i4": None}
    assert state.item_prices(items, products).count() == 5
    assert state.item_prices(items, products).filter("list_price = 12").count() == 2


def amounts(*values):
    return [Decimal(v) for v in values]


def test_order_totals_round_half_up_on_decimals(spark):
    items = spark.createDataFrame(
        [("o1", 2, *amounts("10.05", "1.01")), ("o1", 1, *amounts("0.10", "0.00")),
         ("o2", 3, *amounts("5.00", "0.00"))],
        "order_id string, quantity int, unit_price decimal(12,2), discount_amount decimal(12,2)",
    )
    rows = {r.order_id: r for r in orders.order_totals(items).collect()}
    assert [rows["o1"].gross_amount, rows["o1"].discount_amount, rows["o1"].net_amount] == amounts(
        "20.20", "1.01", "19.19"
    )
    numbered = orders.numbered_lines(items, "order_id", ["unit_price"]).collect()
    assert {r.order_item_id for r in numbered} == {"o1_1", "o1_2", "o2_1"}


@pytest.mark.parametrize("broadcast_rates", [500_000, 1])
def test_conversion_by_base_and_daily_rate(spark, broadcast_rates, monkeypatch):
    monkeypatch.setattr(orders, "BROADCAST_RATES", broadcast_rates)
    rows = spark.createDataFrame(
        [("o1", "EUR", day("2026-01-01"), *amounts("432.00")),
         ("o2", "CZK", day("2026-01-01"), *amounts("17.00")),
         ("o3", "EUR", day("2026-01-02"), *amounts("432.00"))],
        "order_id string, currency string, order_date date, net_amount decimal(12,2)",
    )
    base = {r.order_id: r.net_amount for r in orders.convert_from_pln(rows, ["net_amount"]).collect()}
    assert base == dict(zip(["o1", "o2", "o3"], amounts("100.00", "100.00", "100.00")))
    rates = spark.createDataFrame(
        [(day("2026-01-01"), "EUR", Decimal("4.0000")), (day("2026-01-01"), "CZK", Decimal("0.2000"))],
        "rate_date date, currency string, rate_to_pln decimal(12,4)",
    )
    daily = orders.convert_from_pln(rows, ["net_amount"], rates=rates)
    assert {r.order_id: r.net_amount for r in daily.collect()} == {
        "o1": Decimal("108.00"), "o2": Decimal("85.00"), "o3": None,
    }


@pytest.mark.parametrize("broadcast_days", [500_000, 1])
def test_campaigns_overlap_and_fall_back(spark, broadcast_days, monkeypatch):
    monkeypatch.setattr(orders, "BROADCAST_CAMPAIGN_DAYS", broadcast_days)
    rows = spark.createDataFrame(
        [("o1", day("2026-01-15")), ("o2", day("2026-06-01"))], "order_id string, order_date date"
    )
    every = orders.with_campaigns(rows, dims.campaigns(spark))
    assert {(r.order_id, r.campaign_id) for r in every.collect()} == {
        ("o1", "cmp_winter"), ("o1", "cmp_student"), ("o1", "cmp_retention"), ("o2", None),
    }
    one = orders.with_campaigns(rows, dims.campaigns(spark), mode="one")
    channels = orders.with_channel(one, dims.campaigns(spark), F.lit("direct"))
    assert {(r.order_id, r.campaign_id, r.source_channel) for r in channels.collect()} == {
        ("o1", "cmp_retention", "email"), ("o2", None, "direct"),
    }
    with pytest.raises(ValueError):
        orders.with_campaigns(rows, dims.campaigns(spark), mode="some")


PAYMENT = (
    "payment_id string, order_id string, payment_status string, created_at timestamp, "
    "payment_method string"
)


@pytest.fixture
def payments(spark):
    rows = [
        ("p1", "o1", "captured", "2026-01-01 10:00:00"),
        ("p2", "o2", "failed", "2026-01-01 10:00:00"),
        ("p3", "o2", "captured", "2026-01-01 10:30:00"),
        ("p4", "o2", "authorized", "2026-01-01 10:29:00"),
        ("p5", "o3", "failed", "2026-01-01 10:00:00"),
        ("p6", "o2", "refunded", "2026-01-09 10:00:00"),
    ]
    return spark.createDataFrame([(p, o, s, at(t), "card") for p, o, s, t in rows], PAYMENT)


@pytest.mark.parametrize("split", [False, True])
def test_attempts_and_outcomes(spark, payments, split):
    hot = skew.hot_keys(payments, ["order_id"], 1, sample=1.0) if split else None
    numbered = orders.numbered_attempts(payments, hot=hot)
    assert {r.payment_id: r.payment_attempt_number for r in numbered.collect()} == {
        "p1": 1, "p2": 1, "p3": 2, "p4": 1, "p5": 1, "p6": 2,
    }
    heads = spark.createDataFrame([("o1",), ("o2",), ("o3",), ("o4",)], "order_id string")
    outcome = orders.payment_outcome(heads, numbered)
    assert {r.order_id: r.payment_outcome for r in outcome.collect()} == {
        "o1": "first_try", "o2": "retried", "o3": "cancelled", "o4": "open",
    }


def test_refund_takes_the_last_captured_payment(spark, payments):
    refunds = spark.createDataFrame([("r1", "o2"), ("r2", "o3")], "refund_id string, order_id string")
    found = orders.refunds_with_payment(refunds, orders.numbered_attempts(payments)).collect()
    assert [(r.refund_id, r.captured_payment_id, r.captured_attempt_number) for r in found] == [
        ("r1", "p3", 2)
    ]


def test_refund_classes(spark):
    heads = spark.createDataFrame(
        [(o, Decimal("100.00")) for o in ("none", "rejected", "partial", "full", "twice")],
        "order_id string, net_amount decimal(12,2)",
    )
    refunds = spark.createDataFrame(
        [("rejected", *amounts("100.00"), "rejected"), ("partial", *amounts("40.00"), "processed"),
         ("full", *amounts("100.00"), "processed"), ("twice", *amounts("40.00"), "processed"),
         ("twice", *amounts("60.00"), "processed")],
        "order_id string, refund_amount decimal(12,2), refund_status string",
    )
    found = {r.order_id: (r.refund_class, r.refund_count) for r in orders.refund_class(heads, refunds).collect()}
    assert found == {
        "none": ("none", 0), "rejected": ("rejected", 1), "partial": ("partial", 1),
        "full": ("full", 1), "twice": ("full", 2),
    }


def test_shipments(spark):
    rows = [
        ("s1", "shipped", "2026-01-01 10:00:00", None),
        ("s2", "delivered", "2026-01-05 10:00:00", "2026-01-05 10:00:00"),
        ("s2", "shipped", "2026-01-01 10:00:00", None),
        ("s3", "lost", "2026-01-05 10:00:00", None),
        ("s4", "returned", "2026-01-09 10:00:00", "2026-01-03 10:00:00"),
    ]
    shipments = spark.createDataFrame(
        [(s, t, at(e), at(e), d and at(d), at("2026-01-03 10:00:00")) for s, t, e, d in rows],
        "shipment_id string, shipment_status string, source_event_at timestamp, loaded_at timestamp, "
        "delivered_at timestamp, estimated_delivery_at timestamp",
    )
    latest = orders.with_delivery_delay(orders.shipment_outcome(shipments))
    found = {r.shipment_id: (r.shipment_outcome, r.is_late, r.days_late) for r in latest.collect()}
    assert found == {
        "s1": ("in_transit", False, 0), "s2": ("delivered", True, 2), "s3": ("lost", False, 0),
        "s4": ("returned", False, 0),
    }


# --- web events ---


def test_checkout_gate(spark):
    rows = [
        ("s1", 1, "checkout_started", "page_view", False),  # the first event is always a page view
        ("s1", 2, "purchase_completed", "product_view", False),
        ("s1", 3, "checkout_started", "checkout_started", True),
        ("s1", 4, "purchase_completed", "purchase_completed", True),
        ("s2", 1, "page_view", "page_view", False),
        ("s2", 2, "purchase_completed", "product_view", False),
    ]
    events = spark.createDataFrame(
        [(s, n, kind) for s, n, kind, _, _ in rows], "session_id string, n int, event_type string"
    )
    for hot in (None, skew.hot_keys(events, ["session_id"], 1, sample=1.0)):
        gated = checkout_gate(events, order=["n"], hot=hot)
        assert {(r.session_id, r.n): (r.gated_type, r.checkout_happened) for r in gated.collect()} == {
            (s, n): (gated_type, seen) for s, n, _, gated_type, seen in rows
        }


@pytest.fixture
def sides(spark):
    early = spark.createDataFrame(
        [("c1", "e1", at("2026-01-01 10:00:00")), ("c1", "e2", at("2026-01-01 10:19:30")),
         ("c2", "e3", at("2026-01-01 10:00:00"))],
        "customer_id string, event_id string, event_at timestamp",
    )
    late = spark.createDataFrame(
        [("c1", "o1", at("2026-01-01 10:01:00")), ("c1", "o2", at("2026-01-01 10:20:00")),
         ("c1", "o3", at("2026-01-01 10:20:30")), ("c1", "o4", at("2026-01-01 10:00:59")),
         ("c2", "o5", at("2026-01-01 10:20:01")), ("c1", "o6", at("2026-01-01 10:20:30"))],
        "customer_id string, order_id string, order_at timestamp",
    )
    return early, late


def test_interval_pairs_include_both_ends(sides):
    pairs = interval_pairs(*sides, ["customer_id"], "event_at", "order_at")
    assert {(r.event_id, r.order_id) for r in pairs.collect()} == {
        ("e1", "o1"), ("e1", "o2"), ("e2", "o3"), ("e2", "o6"),
    }


@pytest.mark.parametrize("split", [False, True])
def test_next_in_interval(spark, sides, split):
    early, late = sides
    hot = skew.hot_keys(early, ["customer_id"], 1, sample=1.0) if split else None
    found = next_in_interval(
        early, late, ["customer_id"], "event_at", "order_at", ["order_id"], ["event_id"], ["order_id"],
        hot=hot,
    )
    assert {r.event_id: r.order_id for r in found.collect()} == {"e1": "o1", "e2": "o3", "e3": None}


# --- tables ---


def test_union_dedupe_and_keys(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    both = tables.union_batches(a, b)
    assert both.count() == 5 and both.filter("v is null").count() == 2
    assert tables.drop_copies(both).count() == 4
    assert sorted(r.copy_count for r in tables.count_copies(both).collect()) == [1, 1, 1, 2]
    assert {(r.k, r.row_count) for r in tables.duplicate_keys(both, ["k"]).collect()} == {(1, 2), (2, 2)}
    assert {(r.k, r.v) for r in tables.first_per_key(both, ["k"], ["v"]).collect()} == {
        (1, "x"), (2, None), (3, None),
    }


def test_fingerprint_ignores_order_and_layout(spark):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("n"))
    same = rows.repartition(5).orderBy(F.desc("v")).select("n", "v", "id")
    other = rows.withColumn("v", F.when(F.col("id") == 5, 9).otherwise(F.col("v")))
    first = tables.fingerprint(rows).first()
    assert tables.fingerprint(same).first() == first
    assert tables.fingerprint(other).first() != first
    assert tables.fingerprint(rows, ["v"]).count() == 7


def test_keys_are_equal_in_two_runs(spark, small):
    def build():
        rows = spark.read.parquet(f"{small}/orders.parquet")
        return rows.select(surrogate_key("ord_", F.col("o_orderkey")).alias("order_id"))

    assert tables.fingerprint(build()).first() == tables.fingerprint(build()).first()
    assert build().distinct().count() == build().count()


@pytest.mark.parametrize("n, share, least, want", [(1000, 0.25, 0, 250), (3, 0.25, 0, 0), (3, 0.03, 1, 1), (0, 0.5, 1, 0), (40, 1.0, 0, 40)])
def test_sample_size_is_exact(spark, n, share, least, want):
    rows = spark.range(n).select(F.col("id").alias("k"))
    sample = tables.sample_share(rows, ["k"], share, seed="s", least=least)
    assert sample.distinct().count() == sample.count() == want


def test_sample_of_one_repeated_key(spark):
    rows = spark.range(100).select(F.lit(1).alias("k"), "id")
    assert tables.sample_share(rows, ["k"], 0.25).count() == 25


def test_sample_depends_on_the_seed_only(spark):
    rows = spark.range(500).select(F.col("id").alias("k"))
    first = {r.k for r in tables.sample_share(rows, ["k"], 0.2, "a").collect()}
    again = {r.k for r in tables.sample_share(rows.repartition(7), ["k"], 0.2, "a").collect()}
    other = {r.k for r in tables.sample_share(rows, ["k"], 0.2, "b").collect()}
    assert first == again != other


@pytest.mark.parametrize("split", [False, True])
def test_child_lists_are_bounded_and_whole(spark, split):
    rows = spark.range(25).select(F.lit("o1").alias("k"), F.col("id").cast("int").alias("n"))
    hot = skew.hot_keys(rows, ["k"], 5, sample=1.0) if split else None
    lists = tables.child_lists(rows, "k", ["n"], F.col("n"), per_list=10, hot=hot).orderBy("list_no").collect()
    assert [r.child_count for r in lists] == [10, 10, 5]
    assert [v for r in lists for v in r.children] == list(range(25))


def test_distinct_and_quarter(spark):
    rows = spark.createDataFrame([(i % 11,) for i in range(50)], "k int")
    assert tuple(tables.distinct_and_quarter(rows, "k").first()) == (11, 2)
