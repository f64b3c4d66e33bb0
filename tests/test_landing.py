from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daybook.operators.orders import daily_totals
from daybook.operators.tables import rows_per_load_date
from daybook.schemas import TABLES, schema_of
from daybook.sources import bronze, landing
from tests.conftest import at, day

ORDER_HEADER = (
    "order_id,customer_id,order_status,order_created_at,order_updated_at,country_code,currency,"
    "gross_amount,discount_amount,net_amount,source_channel,campaign_id,load_date,loaded_at,source_event_at"
)
ORDER = (
    "ord_{n},cust_1,created,2026-01-02 10:00:00,2026-01-02 10:00:00,PL,PLN,"
    "100.0,5.5,94.5,email,,{d},{d} 07:08:09,2026-01-02 10:00:00"
)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture
def raw(tmp_path):
    """Two days of orders, one blank day, a file of another kind and one campaign."""
    orders = tmp_path / "orders"
    for n, d in enumerate(["2026-01-02", "2026-01-03"]):
        put(orders / f"load_date={d}" / "orders.csv", f"{ORDER_HEADER}\n{ORDER.format(n=n, d=d)}\n")
    put(orders / "load_date=2026-01-04" / "orders.csv", "\n")
    put(orders / "load_date=2026-01-04" / "notes.txt", "not data\n")
    put(
        tmp_path / "marketing_campaigns" / "load_date=2026-01-02" / "marketing_campaigns.csv",
        "campaign_id,campaign_name,source_channel,start_date,end_date,budget_amount,currency,"
        "created_at,updated_at,is_active,load_date,loaded_at,source_event_at\n"
        'cmp_winter,"Winter ""big"" Sale, 1",paid_search,2026-01-01,2026-01-21,7000,PLN,'
        "2025-12-22,2025-12-22,True,2026-01-02,2026-01-02 03:04:05,2025-12-22\n",
    )
    return str(tmp_path)


def test_columns_do_not_shift_when_load_date_is_in_path_and_file(spark, raw):
    rows = landing.read_table(spark, raw, "orders").orderBy("order_id").collect()
    assert [r.order_id for r in rows] == ["ord_0", "ord_1"]
    assert rows[1].load_date == day("2026-01-03")
    assert rows[1].loaded_at == at("2026-01-03 07:08:09")
    assert rows[1].source_event_at == at("2026-01-02 10:00:00")
    assert rows[1].campaign_id is None and float(rows[1].net_amount) == 94.5
    assert rows[1]._corrupt_record is None


def test_midnight_timestamps_quotes_and_booleans(spark, raw):
    row = landing.read_table(spark, raw, "marketing_campaigns").first()
    assert row.created_at == at("2025-12-22 00:00:00")
    assert row.campaign_name == 'Winter "big" Sale, 1'
    assert row.is_active is True and row.start_date == day("2026-01-01")


def test_missing_table_and_blank_file_are_empty(spark, raw, tmp_path):
    missing = landing.read_table(spark, raw, "refunds")
    assert missing.count() == 0
    assert missing.columns[:-1] == schema_of("refunds").fieldNames()
    put(tmp_path / "refunds" / "load_date=2026-01-02" / "refunds.csv", "\n")
    assert landing.read_table(spark, raw, "refunds").count() == 0


def test_single_days(spark, raw, tmp_path):
    one = landing.read_table(spark, raw, "orders", days=["2026-01-03", "2026-01-09"])
    assert [r.order_id for r in one.collect()] == ["ord_1"]
    assert one.first().load_date == day("2026-01-03")
    assert landing.read_table(spark, raw, "orders", days=["2026-01-09"]).count() == 0
    target = str(tmp_path / "bronze")
    bronze.load_bronze(spark, raw, target, "orders", days=["2026-01-02"])
    assert bronze.load_bronze(spark, raw, target, "orders", days=["2026-01-03"]).count() == 2


def test_unreadable_cell_is_null_and_its_line_is_kept(spark, tmp_path):
    line = ORDER.format(n=1, d="2026-01-02").replace("94.5", "abc")
    put(tmp_path / "orders" / "load_date=2026-01-02" / "orders.csv", f"{ORDER_HEADER}\n{line}\n")
    row = landing.read_table(spark, str(tmp_path), "orders").first()
    assert row.net_amount is None and row.order_id == "ord_1"
    assert row._corrupt_record == line


def test_header_that_does_not_match_is_an_error(spark, tmp_path):
    header = ORDER_HEADER.replace("customer_id", "buyer_id")
    text = f"{header}\n{ORDER.format(n=1, d='2026-01-02')}\n"
    put(tmp_path / "orders" / "load_date=2026-01-02" / "orders.csv", text)
    with pytest.raises(Exception, match="CSV header"):
        landing.read_table(spark, str(tmp_path), "orders").collect()


def test_write_then_read_back(spark, raw, tmp_path):
    source = landing.read_table(spark, raw, "orders").drop(landing.CORRUPT)
    with_internal = source.withColumn("__defer_until__", F.lit(None).cast("date"))
    target = str(tmp_path / "out")
    landing.write_table(with_internal, target, "orders")
    back = landing.read_table(spark, target, "orders", load_date_in_file=False)
    assert "__defer_until__" not in back.columns
    assert back.select(source.columns).exceptAll(source).count() == 0
    assert back.count() == 2
    pruned = back.filter(F.col("load_date") == day("2026-01-03"))
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(load_date" in pruned._jdf.queryExecution().toString()


def test_keep_or_replace_earlier_days(spark, raw, tmp_path):
    rows = landing.read_table(spark, raw, "orders").drop(landing.CORRUPT)
    target = str(tmp_path / "out")
    landing.write_table(rows, target, "orders")
    second = rows.filter(F.col("load_date") == day("2026-01-03")).withColumn("currency", F.lit("EUR"))
    landing.write_table(second, target, "orders", clean=False)
    back = landing.read_table(spark, target, "orders", load_date_in_file=False)
    assert {(r.load_date, r.currency) for r in back.collect()} == {
        (day("2026-01-02"), "PLN"), (day("2026-01-03"), "EUR"),
    }
    landing.write_table(second, target, "orders", clean=True)
    back = landing.read_table(spark, target, "orders", load_date_in_file=False)
    assert [r.load_date for r in back.collect()] == [day("2026-01-03")]


DEEP = ("stock/eu/north/a b.csv", "item,held\n7,\"x, y\"\n")
FLAT = ("prices.csv", "item;price\n")


def put_landing(root):
    for name, content in (DEEP, FLAT, ("stock/notes.md", "no"), ("prices.csv.bak", "no")):
        put(root / name, content)


def test_manifest_lists_csv_files_with_their_target(spark, tmp_path, monkeypatch):
    put_landing(tmp_path / "in")
    monkeypatch.chdir(tmp_path)
    # A relative root is relative to where the session started, which is its default folder.
    here = os.path.relpath(tmp_path / "in", landing._whole_path(spark, ".").removeprefix("file:"))
    for root in (str(tmp_path / "in"), f"file://{tmp_path}/in", f"{tmp_path}/in/", here):
        found = landing.manifest(spark, root, prefix="lake/raw/")
        assert {(r.target_path, r.file_length) for r in found.collect()} == {
            (f"lake/raw/{name}", len(content)) for name, content in (DEEP, FLAT)
        }


def test_land_files_copies_bytes_and_replaces(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    put_landing(source)
    put(lake / "raw" / FLAT[0], "longer than what replaces it\n" * 20)
    for _ in range(2):
        assert landing.land_files(spark, str(source), str(lake), prefix="raw") == 2
        copies = {str(f.relative_to(lake / "raw")): f.read_text() for f in lake.rglob("*") if f.is_file()}
        assert copies == dict((DEEP, FLAT))


def test_nothing_to_land(spark, tmp_path):
    put(tmp_path / "in" / "only.json", "{}")
    assert landing.manifest(spark, str(tmp_path / "in")).count() == 0
    assert landing.land_files(spark, str(tmp_path / "in"), str(tmp_path / "lake")) == 0


def test_many_files_are_more_than_one_task(spark, tmp_path, monkeypatch):
    for k in range(120):
        put(tmp_path / "in" / f"{k}.csv", f"k\n{k}\n")
    seen = []
    frame = type(spark.range(0))
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda df, n, *c: seen.append(n) or plain(df, n, *c))
    assert landing.land_files(spark, str(tmp_path / "in"), str(tmp_path / "lake")) == 120
    assert seen == [3]


def test_a_day_loaded_later_replaces_no_other_day(spark, tmp_path):
    names = ",".join(n for n in landing.landed_schema("exchange_rates").fieldNames() if n != landing.CORRUPT)
    days = ("2026-01-02", "2026-01-03")
    for said, d in zip(reversed(days), days):
        lines = [f"{d},EUR,4.3200,whole {d},{d},{d} 01:00:00", f"{d},EUR,4.3200,cut {d}", f"{d},EUR,4.3200,stray {d},{said},{d} 01:00:00"]
        put(tmp_path / "raw" / "exchange_rates" / f"load_date={d}" / "f.csv", "\n".join([names, *lines, ""]))
    for d in (*days, *days):
        table = bronze.load_bronze(spark, str(tmp_path / "raw"), str(tmp_path / "b"), "exchange_rates", days=[d])
    found = sorted((str(r.landed_day), r.source, str(r.load_date), r[landing.CORRUPT] is not None) for r in table.collect())
    assert found == [
        ("2026-01-02", "cut 2026-01-02", "None", True),
        ("2026-01-02", "stray 2026-01-02", "2026-01-03", False),
        ("2026-01-02", "whole 2026-01-02", "2026-01-02", False),
        ("2026-01-03", "cut 2026-01-03", "None", True),
        ("2026-01-03", "stray 2026-01-03", "2026-01-02", False),
        ("2026-01-03", "whole 2026-01-03", "2026-01-03", False),
    ]


def test_land_table_keeps_days(spark, raw, tmp_path):
    target = str(tmp_path / "lake" / "landing")
    landing.land_table(spark, raw, "orders", target)
    landed = landing.read_table(spark, target, "orders", load_date_in_file=False)
    assert {tuple(r) for r in rows_per_load_date(landed).collect()} == {
        (day("2026-01-02"), 1), (day("2026-01-03"), 1),
    }


def test_files_in_path_order(spark, raw):
    paths = [r.file_path for r in landing.in_path_order(spark, raw, "orders").collect()]
    assert len(paths) == 2 and paths == sorted(paths)


def test_bronze_is_partitioned_and_stamped(spark, raw, tmp_path):
    table = bronze.load_bronze(spark, raw, str(tmp_path / "bronze"), "orders")
    row = table.orderBy("order_id").first()
    assert (row._source_system, row._source_layer) == ("landing", "bronze")
    assert isinstance(row._ingested_at, dt.datetime)
    assert (tmp_path / "bronze" / "orders" / "landed_day=2026-01-03").is_dir()
    again = bronze.load_bronze(spark, raw, str(tmp_path / "bronze"), "orders")
    assert again.count() == 2


def test_literal_rows_and_daily_totals(spark):
    rows = [("n1", 5, "2031-03-09"), ("n2", 7, "2031-03-08"), ("n3", 11, "2031-03-09")]
    sold = landing.literal_rows(spark, rows, ["note", "paid", "sold_on"])
    assert dict(sold.dtypes) == {"note": "string", "paid": "bigint", "sold_on": "string"}
    want = [("2031-03-08", 1, 7), ("2031-03-09", 2, 16)]
    assert [tuple(r) for r in daily_totals(sold, "sold_on", "paid").collect()] == want
    view = bronze.as_view(sold, "sold_notes")
    assert [tuple(r) for r in bronze.daily_totals_sql(spark, view, "sold_on", "paid").collect()] == want


def test_all_tables_have_a_schema(spark):
    assert len(TABLES) == 11
    for name in TABLES:
        assert "load_date" in schema_of(name).fieldNames()


def test_positions_over_parts_of_files(spark, tmp_path):
    """Files of several parts, blank ones and one line: numbers follow path and line."""
    header = "rate_date,currency,rate_to_pln,source,load_date,loaded_at\n"
    want, position = [], 0
    for day, lines in (("2026-01-01", 900), ("2026-01-02", 0), ("2026-01-03", 1), ("2026-01-04", 350)):
        folder = tmp_path / "exchange_rates" / f"load_date={day}"
        folder.mkdir(parents=True)
        text = "".join(f"{day},EUR,4.32,{day}-{n},{day},{day} 01:00:00\n" for n in range(1, lines + 1))
        (folder / "exchange_rates.csv").write_text(header + text if lines else "\n")
        for n in range(1, lines + 1):
            position += 1
            want.append((f"{day}-{n}", n, position))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8000")
    try:
        rows = landing.with_positions(spark, str(tmp_path), "exchange_rates").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.source, r.line_number, r.position) for r in rows) == sorted(want)
    assert landing.with_positions(spark, str(tmp_path), "payments").collect() == []
