"""Tables in buckets of a key: same rows as plain ones, and no exchange in what joins them."""

from __future__ import annotations

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from daybook.operators import bucketed, orders
from tests.conftest import plan_of


@pytest.fixture
def stored(spark, tmp_path):
    names = []

    def make(df, buckets=4, append_to=None):
        name = append_to or f"t{uuid4().hex}"
        names.append(name)
        return name, bucketed.store(df, name, f"{tmp_path}/{name}", "order_id", buckets, append_to is not None)

    yield make
    for name in set(names):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def feeds(spark):
    key = (F.col("id") % 50).alias("order_id")
    feed = spark.range(120).select(
        key, F.col("id").alias("order_updated_at"), F.col("id").alias("loaded_at"), F.lit("10.00").cast("decimal(12,2)").alias("net_amount")
    )
    items = spark.range(300).select(
        key, F.lit("2.00").cast("decimal(12,2)").alias("unit_price"), F.lit(1).alias("quantity"),
        F.lit("0.50").cast("decimal(12,2)").alias("discount_amount"),
    )
    payments = spark.range(90).select(
        key, (F.col("id") % 3 + 1).cast("int").alias("payment_attempt_number"),
        F.when(F.col("id") % 2 == 0, "captured").otherwise("failed").alias("payment_status"),
    )
    refunds = spark.range(40).select(
        (F.col("id") % 30).alias("order_id"), F.lit("5.00").cast("decimal(12,2)").alias("refund_amount"),
        F.when(F.col("id") % 2 == 0, "processed").otherwise("rejected").alias("refund_status"),
    )
    return [feed, items, payments, refunds]


def test_order_facts_move_no_rows(spark, stored, no_broadcast):
    tables = feeds(spark)
    kept = [stored(t)[1] for t in tables]
    plain, facts = orders.order_facts(*tables), orders.order_facts(*kept)
    assert "Exchange" in plan_of(plain)
    assert "Exchange" not in plan_of(facts)
    assert sorted(map(str, facts.collect())) == sorted(map(str, plain.collect()))


def test_children_with_their_order_move_no_rows(spark, stored, no_broadcast):
    feed, items, *_ = feeds(spark)
    current = feed.dropDuplicates(["order_id"])
    plain = orders.with_order(items, current, ["net_amount"], hot=None)
    kept = orders.with_order(stored(items)[1], stored(current)[1], ["net_amount"], hot=None)
    assert "Exchange" not in plan_of(kept)
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))


def test_loads_are_added_to_their_buckets(spark, stored, no_broadcast):
    feed, items, *_ = feeds(spark)
    name, _ = stored(items.filter("order_id < 20"))
    _, kept = stored(items.filter("order_id >= 20 or order_id is null"), append_to=name)
    assert kept.count() == items.count()
    totals = orders.order_totals(kept)
    assert "Exchange" not in plan_of(totals)
    assert sorted(map(str, totals.collect())) == sorted(map(str, orders.order_totals(items).collect()))


def test_another_session_opens_a_stored_table(spark, stored, tmp_path, no_broadcast):
    _, items, *_ = feeds(spark)
    name, kept = stored(items)
    want = sorted(map(str, kept.collect()))
    spark.sql(f"DROP TABLE {name}")
    again = bucketed.open_stored(spark, name, f"{tmp_path}/{name}", items, "order_id", 4)
    assert sorted(map(str, again.collect())) == want
    assert "Exchange" not in plan_of(orders.order_totals(again))


def test_empty_and_null_keys(spark, stored, no_broadcast):
    rows = spark.createDataFrame([(None, 1), (None, 2), (3, 4)], "order_id long, n int")
    _, kept = stored(rows)
    assert sorted(r.n for r in kept.collect()) == [1, 2, 4]
    _, none = stored(rows.filter("n > 9"))
    assert none.count() == 0


def test_bucket_count():
    assert [bucketed.bucket_count(n, 10) for n in (0, 10, 11, 45, 10**9)] == [1, 1, 2, 8, 1 << 16]
