from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from daybook.operators import dims, quality, skew
from tests.conftest import at, day


def failing(df, rules):
    found = []
    for good, bad in (quality.split(df, rules), quality.split_checked(quality.check_rows(df, rules))):
        assert good.count() + bad.count() == df.count()
        assert "failed_rules" not in good.columns
        found.append({r.id: sorted(r.failed_rules) for r in bad.collect()})
    assert found[0] == found[1]
    return found[0]


def test_item_rules(spark):
    items = spark.createDataFrame(
        [("ok", 2, "10.00", "1.00", "19.00"), ("negative", -1, "10.00", "0.00", "10.00"),
         ("cent", 1, "10.00", "0.00", "10.01"), ("wrong", 1, "10.00", "0.00", "10.02"),
         ("missing", 1, "10.00", "0.00", None)],
        "id string, quantity int, unit_price string, discount_amount string, line_total string",
    )
    money = ["unit_price", "discount_amount", "line_total"]
    items = items.withColumns({c: F.col(c).cast("decimal(12,2)") for c in money})
    assert failing(items, quality.item_rules()) == {
        "negative": ["line_total", "quantity_positive"], "wrong": ["line_total"], "missing": ["line_total"],
    }


def test_order_and_city_rules(spark):
    rows = spark.createDataFrame(
        [("ok", "PL", "PLN", "c1"), ("unknown", "XX", "PLN", "c1"), ("none", None, "PLN", "c1"),
         ("money", "DE", "PLN", "c1"), ("blank", "DE", "EUR", "")],
        "id string, country_code string, currency string, customer_id string",
    )
    assert failing(rows, quality.order_rules()) == {
        "unknown": ["country_known"], "none": ["country_known"], "money": ["currency_of_country"],
        "blank": ["customer_given"],
    }
    places = spark.createDataFrame(
        [("ok", "CZ", "Brno"), ("moved", "CZ", "Berlin")], "id string, country_code string, city string"
    )
    assert failing(places, quality.customer_rules()) == {"moved": ["city_in_country"]}


def test_delivery_before_shipping(spark):
    rows = spark.createDataFrame(
        [("ok", at("2026-01-01"), at("2026-01-02")), ("open", at("2026-01-01"), None),
         ("bad", at("2026-01-02"), at("2026-01-01"))],
        "id string, shipped_at timestamp, delivered_at timestamp",
    ).withColumns({"delivery_city": F.lit("Brno"), "delivery_country": F.lit("CZ")})
    assert failing(rows, quality.shipment_rules()) == {"bad": ["delivered_after_shipped"]}


def test_report_counts_each_rule(spark):
    rows = spark.range(10).withColumn("quantity", F.col("id").cast("int"))
    rules = {"positive": quality.not_positive(F.col("quantity")), "below_8": F.col("quantity") >= 8}
    want = {("positive", 10, 1), ("below_8", 10, 2)}
    assert {tuple(r) for r in quality.report(rows, rules).collect()} == want
    checked = quality.check_rows(rows, rules)
    assert {tuple(r) for r in quality.report(checked, quality.as_rules(list(rules))).collect()} == want


@pytest.mark.parametrize("split", [False, True])
def test_orphans(spark, split):
    child = spark.createDataFrame([("a", 1), ("a", 2), ("missing_customer", 3), (None, 4)], "c string, n int")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "customer_id string")
    hot = skew.hot_keys(child, ["c"], 1, sample=1.0) if split else None
    orphans = quality.without_parent(child, parent, "c", "customer_id", hot)
    assert {r.n for r in orphans.collect()} == {3, 4}
    members = quality.with_parent(child, parent, "c", "customer_id", hot)
    assert sorted(r.n for r in members.collect()) == [1, 2]


def test_payment_and_refund_amounts(spark):
    orders = spark.createDataFrame([("o1", Decimal("100.00"))], "order_id string, net_amount decimal(12,2)")
    payments = spark.createDataFrame(
        [("ok", "captured", "100.00"), ("cent", "failed", "100.01"), ("more", "captured", "150.00"),
         ("refund", "refunded", "40.00"), ("less", "authorized", "30.00")],
        "id string, payment_status string, amount string",
    ).withColumns({"order_id": F.lit("o1"), "amount": F.col("amount").cast("decimal(12,2)")})
    assert {r.id for r in quality.wrong_payment_amount(payments, orders).collect()} == {"more", "less"}
    refunds = payments.withColumnRenamed("amount", "refund_amount")
    assert {r.id for r in quality.excessive_refund(refunds, orders).collect()} == {"more", "cent"}


def test_columns_and_completeness(spark):
    rows = spark.createDataFrame([(day("2026-01-02"), "orders"), (day("2026-01-04"), "orders"),
                                  (day("2026-01-02"), "payments")], "load_date date, table_name string")
    report = quality.column_report(rows, "landed", ["load_date", "loaded_at"])
    assert {tuple(r) for r in report.collect()} == {
        ("landed", "load_date", True, 3), ("landed", "loaded_at", False, 3),
    }
    days = dims.days_spanned(rows, F.col("load_date"), "load_date")
    missing = quality.missing_days(rows, days, ["orders", "payments"], "table_name", "load_date")
    assert {(str(r.load_date), r.table_name) for r in missing.collect()} == {
        ("2026-01-03", "orders"), ("2026-01-03", "payments"), ("2026-01-04", "payments"),
    }
