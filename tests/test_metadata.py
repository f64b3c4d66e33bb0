from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from daybook.functions.dates import arrival_date, demand_factor, expected_orders, shifted
from daybook.functions.scalars import (
    blank,
    city_in_country,
    count_of_share,
    currency_of,
    from_pln,
    base_rate_to_pln,
    line_total,
    padded_key,
    page_url,
    surrogate_key,
)
from daybook.operators import dims, metadata
from daybook.operators.tables import union_batches
from daybook.session import shared_folder
from tests.conftest import at, day


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_event_time_falls_back_to_created_then_load_date(spark):
    rows = spark.createDataFrame(
        [(1, at("2026-01-01 10:00:00"), at("2026-01-02 11:00:00")),
         (2, at("2026-01-01 10:00:00"), None), (3, None, None)],
        "id int, created_at timestamp, updated_at timestamp",
    )
    loaded = metadata.with_load_metadata(rows, F.lit("2026-01-05"))
    assert {r.id: r.source_event_at for r in loaded.collect()} == {
        1: at("2026-01-02 11:00:00"), 2: at("2026-01-01 10:00:00"), 3: at("2026-01-05 00:00:00"),
    }
    plain = metadata.with_load_metadata(spark.range(1), F.lit("2026-01-05")).first()
    assert plain.load_date == day("2026-01-05") and plain.source_event_at == at("2026-01-05 00:00:00")


def test_lateness_counts_days_from_load_date_not_loaded_at(spark):
    rows = spark.createDataFrame(
        [
            ("on time", "2026-01-02", "2026-01-02 23:00:00", "2026-01-02 01:00:00"),
            ("same-day status", "2026-01-03", "2026-01-02 12:00:00", "2026-01-03 01:00:00"),
            ("late", "2026-01-05", "2026-01-02 12:00:00", "2026-01-05 01:00:00"),
            ("latest", "2026-01-05", "2026-01-01 23:40:00", "2026-01-05 01:00:00"),
        ],
        "name string, load_date string, source_event_at string, loaded_at string",
    ).select("name", F.to_date("load_date").alias("load_date"),
             F.to_timestamp("source_event_at").alias("source_event_at"))
    found = {r.name: (r.lag_days, r.is_late) for r in metadata.with_lateness(rows).collect()}
    assert found == {
        "on time": (0, False), "same-day status": (1, False), "late": (3, True), "latest": (4, True),
    }
    strict = metadata.with_lateness(rows, grace_days=0).filter("is_late").count()
    assert strict == 3


def test_deferred_rows_land_on_their_day_with_their_event_time(spark):
    rows = spark.createDataFrame(
        [(1, at("2026-01-02 10:00:00"), day("2026-01-02")), (2, at("2026-01-02 11:00:00"), day("2026-01-04"))],
        "id int, source_event_at timestamp, arrives date",
    )
    today = F.lit("2026-01-03").cast("date")
    due, waiting = metadata.split_due(rows, "arrives", today)
    assert [r.id for r in due.collect()] == [1] and [r.id for r in waiting.collect()] == [2]
    landed = metadata.land_deferred(due, today).first()
    assert landed.load_date == day("2026-01-03")
    assert landed.source_event_at == at("2026-01-02 10:00:00")
    both = union_batches(landed_df := metadata.land_deferred(due, today), waiting)
    assert both.count() == 2 and set(landed_df.columns) == set(both.columns)
    kept = metadata.due_on(
        rows.withColumn("d", F.when(F.col("id") == 2, F.col("arrives"))), "d", today
    )
    assert [r.id for r in kept.collect()] == [1]


@pytest.mark.parametrize(
    "event, load, delay, want",
    [
        ("2026-01-02 10:00:00", "2026-01-02", 0, "2026-01-02"),
        ("2026-01-01 23:40:00", "2026-01-02", 3, "2026-01-05"),
        ("2026-01-04 01:00:00", "2026-01-02", 1, "2026-01-05"),
    ],
)
def test_arrival_date(spark, event, load, delay, want):
    column = arrival_date(F.to_timestamp(F.lit(event)), F.lit(load).cast("date"), F.lit(delay))
    assert one(spark, column) == day(want)


def test_shifted(spark):
    start = F.to_timestamp(F.lit("2026-01-01 00:00:00"))
    assert one(spark, shifted(start, days=-1, hours=2, minutes=3, seconds=4)) == at("2025-12-31 02:03:04")


def test_audit_columns(spark):
    row = metadata.with_audit(spark.range(1), "manual").first()
    assert (row._source_system, row._source_layer) == ("manual", "bronze")
    assert row._ingested_at is not None


def test_calendar_of_2026(spark):
    import calendar as cal
    import datetime as dt

    days = spark.createDataFrame([(day("2025-12-28"),), (day("2027-01-05"),)], "d date")
    built = dims.calendar(dims.days_spanned(days, F.col("d")))
    rows = built.collect()
    assert len(rows) == 374
    for r in rows:
        d: dt.date = r.date_day
        want = (d.year, (d.month + 2) // 3, d.month, d.day, d.isoweekday(), cal.day_name[d.weekday()],
                d.isocalendar().week, d.weekday() >= 5)
        got = (r.year, r.quarter, r.month, r.day_of_month, r.day_of_week, r.day_name, r.week_of_year,
               r.is_weekend)
        assert got == want
    holidays = {str(r.date_day): r.holiday_name for r in rows if r.is_polish_public_holiday}
    assert len(holidays) == 8 and holidays["2026-05-03"] == "Constitution Day"


@pytest.mark.parametrize(
    "when, want",
    [
        ("2026-06-03", 1.0), ("2026-06-05", 1.35), ("2026-01-12", 1.15), ("2026-01-06", 1.15 * 0.65),
        ("2026-02-16", 1.10), ("2026-02-17", 1.0), ("2026-03-08", 1.35 * 1.2), ("2026-01-01", 1.15 * 0.65),
    ],
)
def test_demand_factor(spark, when, want):
    assert one(spark, demand_factor(F.lit(when).cast("date"))) == pytest.approx(want)


def test_expected_orders_and_active_campaigns(spark):
    assert one(spark, expected_orders(F.lit("2026-01-06").cast("date"), 80)) == 59  # 59.8
    assert one(spark, expected_orders(F.lit("2026-06-05").cast("date"), 80)) == 108
    found = dims.active_on(dims.campaigns(spark), F.lit("2026-02-16").cast("date"))
    assert {r.campaign_id for r in found.collect()} == {"cmp_valentine", "cmp_retention"}


def test_scalars(spark):
    assert one(spark, padded_key("prod_", F.lit(42))) == "prod_00042"
    assert one(spark, padded_key("prod_", F.lit(1234567))) == "prod_1234567"
    key = one(spark, surrogate_key("ord_", F.lit("a"), F.lit(1)))
    assert key.startswith("ord_") and len(key) == 36
    parts = [("a|b", "c"), ("a", "b|c"), ("a", None), ("a", ""), (None, "a"), ("1:a", "")]
    keys = [one(spark, surrogate_key("", *[F.lit(p).cast("string") for p in pair])) for pair in parts]
    assert len(set(keys)) == len(parts)
    assert key == one(spark, surrogate_key("ord_", F.lit("a"), F.lit(1)))
    assert one(spark, line_total(F.lit("10.01").cast("decimal(12,2)"), F.lit(3), F.lit("1.50").cast("decimal(12,2)"))) * 100 == 2853
    assert [one(spark, count_of_share(F.lit(n).cast("bigint"), 0.03, 1)) for n in (0, 5, 100, 1000)] == [0, 1, 3, 30]
    assert one(spark, blank(F.lit(""))) and not one(spark, blank(F.lit("x")))


def test_page_urls(spark):
    none = F.lit(None).cast("string")
    cases = [
        ("product_view", F.lit("SKU-00001"), "/product/SKU-00001"), ("add_to_cart", none, "/"),
        ("checkout_started", none, "/checkout"), ("purchase_completed", none, "/checkout/success"),
        ("page_view", none, "/"),
    ]
    for kind, sku, want in cases:
        assert one(spark, page_url(F.lit(kind), sku)) == want


def test_conversion_and_domains(spark):
    def euros(pln):
        return one(spark, from_pln(F.lit(pln).cast("decimal(12,2)"), base_rate_to_pln(F.lit("EUR"))))

    assert str(euros("432.00")) == "100.00"
    assert str(euros("0.54")) == "0.13"  # an exact tie, rounded half up
    assert one(spark, currency_of(F.lit("LT"))) == "EUR"
    assert one(spark, currency_of(F.lit("XX"))) is None
    assert one(spark, city_in_country(F.lit("Łódź"), F.lit("PL"))) is True
    assert one(spark, city_in_country(F.lit("Berlin"), F.lit("PL"))) is False


class FakeSession:
    """The part of a session that shared_folder looks at."""

    def __init__(self, master, folder=None):
        self.master, self.folder, self.set_to = master, folder, None
        self.conf = self.sparkContext = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.folder or default

    def getCheckpointDir(self):
        return self.set_to

    def setCheckpointDir(self, folder):
        self.set_to = folder


def test_shared_folder_follows_the_session_setting():
    cluster = FakeSession("yarn", "hdfs://shared/checkpoints/")
    first, second = shared_folder(cluster, "x"), shared_folder(cluster, "x")
    assert first.startswith("hdfs://shared/checkpoints/x-") and first != second


def test_shared_folder_is_never_a_machine_folder_of_a_cluster():
    with pytest.raises(ValueError):
        shared_folder(FakeSession("yarn"), "x")


def test_shared_folder_of_a_local_session_is_set_once():
    local = FakeSession("local[2]")
    first, second = shared_folder(local, "x"), shared_folder(local, "y")
    assert local.set_to and first.startswith(local.set_to) and second.startswith(local.set_to)
