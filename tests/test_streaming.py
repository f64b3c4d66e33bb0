from __future__ import annotations

import os

import pytest

from daybook.streaming import feeds

HEADER = (
    "payment_id,order_id,payment_attempt_number,payment_method,payment_status,amount,currency,"
    "created_at,processed_at,failure_reason,load_date,loaded_at,source_event_at\n"
)


def put_day(root, day, ids, event_day=None):
    folder = root / "payments" / f"load_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    when = f"{event_day or day} 10:00:00"
    lines = "".join(
        f"{i},o1,1,card,captured,10.50,PLN,{when},{when},,{day},{day} 01:00:00,{when}\n" for i in ids
    )
    (folder / "payments.csv").write_text(HEADER + lines if ids else "\n")


def ids_of(spark, path):
    return sorted(r.payment_id for r in spark.read.parquet(path).collect())


def test_each_file_is_ingested_once(spark, tmp_path):
    raw, target, checkpoint = tmp_path / "raw", str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        stream = feeds.landing_stream(spark, str(raw), "payments")
        feeds.ingest(stream, target, checkpoint).awaitTermination()

    put_day(raw, "2026-01-02", ["p1", "p2"])
    put_day(raw, "2026-01-03", [])
    run()
    assert ids_of(spark, target) == ["p1", "p2"]
    run()
    assert ids_of(spark, target) == ["p1", "p2"]
    put_day(raw, "2026-01-04", ["p3"])
    run()
    assert ids_of(spark, target) == ["p1", "p2", "p3"]
    row = spark.read.parquet(target).filter("payment_id = 'p3'").first()
    assert str(row.load_date) == "2026-01-04" and str(row.amount) == "10.50"
    assert row._source_layer == "bronze"


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_repeats_are_dropped_and_nothing_else(spark, tmp_path, files_per_batch):
    """Files out of day order, a key again after weeks, rows without a key: the same for any batches."""
    raw, target, checkpoint = tmp_path / "raw", str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        stream = feeds.landing_stream(spark, str(raw), "payments", files_per_batch)
        feeds.without_repeats(stream, target, checkpoint, ["payment_id"]).awaitTermination()
        return ids_of(spark, target)

    put_day(raw, "2026-03-02", ["p1"] * 50 + ["p2"])
    put_day(raw, "2026-01-05", ["p3", "p2"])
    put_day(raw, "2026-02-06", ["p4", "p1"], event_day="2026-02-02")
    assert run() == ["p1", "p2", "p3", "p4"]
    put_day(raw, "2025-12-01", ["p0", "p4"])
    assert run() == ["p0", "p1", "p2", "p3", "p4"]
    put_day(raw, "2026-01-06", ["", ""])
    assert spark.read.parquet(target).count() == 5
    run_again = feeds.landing_stream(spark, str(raw), "payments", files_per_batch)
    feeds.without_repeats(run_again, target, checkpoint, ["payment_id"]).awaitTermination()
    assert spark.read.parquet(target).filter("payment_id IS NULL").count() == 2


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_totals_and_late_rows_for_any_batches(spark, tmp_path, files_per_batch):
    raw, target, checkpoint = tmp_path / "raw", str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        stream = feeds.landing_stream(spark, str(raw), "payments", files_per_batch)
        feeds.daily_totals(stream, "source_event_at", "amount", target, checkpoint).awaitTermination()
        return {
            (str(r.order_date), r.row_count, r.total_amount and str(r.total_amount), r.late_count)
            for r in feeds.totals(spark, target).collect()
        }

    put_day(raw, "2026-01-20", ["p5"], event_day="2026-01-16")
    put_day(raw, "2026-01-02", ["p1", "p2"])
    put_day(raw, "2026-01-09", ["p6", "p7"], event_day="2026-01-02")
    put_day(raw, "2026-01-06", ["p3"], event_day="2026-01-02")
    first = {("2026-01-16", 1, "10.50", 0), ("2026-01-02", 3, "31.50", 2)}
    assert run() == first
    assert run() == first
    late = spark.read.parquet(feeds.late_target(target))
    assert sorted(r.payment_id for r in late.collect()) == ["p6", "p7"]
    closed = feeds.closed_days(spark, target).collect()
    assert [(str(r.order_date), r.row_count) for r in closed] == [("2026-01-02", 3)]
    put_day(raw, "2026-01-21", ["p8"])
    assert run() == first | {("2026-01-21", 1, "10.50", 0)}
    closed = feeds.closed_days(spark, target).collect()
    assert sorted(str(r.order_date) for r in closed) == ["2026-01-02", "2026-01-16"]


def land_in_order(root):
    """Days in load order; copies of p1 in three loads, one of them late; rows without a key or an event time."""
    put_day(root, "2026-01-02", ["p1", "p1", "p2"])
    put_day(root, "2026-01-03", ["p1", "p3"], event_day="2026-01-02")
    put_day(root, "2026-01-06", ["p4", "p2"], event_day="2026-01-02")
    put_day(root, "2026-01-07", ["p1", "p5"], event_day="2026-01-02")
    put_day(root, "2026-01-08", ["p6", ""])
    put_day(root, "2026-01-09", [])
    folder = root / "payments" / "load_date=2026-01-10"
    folder.mkdir(parents=True)
    (folder / "payments.csv").write_text(HEADER + "p7,o1,1,card,captured,10.50,PLN,,,,2026-01-10,2026-01-10 01:00:00,\n")
    put_day(root, "2026-01-12", ["p8"])
    put_day(root, "2026-01-13", ["p9"])
    for k, path in enumerate(sorted(root.rglob("*.csv"))):
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_by_event_time_for_any_batches(spark, tmp_path, files_per_batch):
    raw = tmp_path / "raw"
    land_in_order(raw)

    def run(name, start, *args, **more):
        stream = feeds.landing_stream(spark, str(raw), "payments", files_per_batch)
        place = str(tmp_path / name)
        for _ in range(2):  # the second run finds nothing new
            feeds.finished(start(stream, f"{place}/t", f"{place}/c", "source_event_at", *args, **more))
        return f"{place}/t"

    first = spark.read.parquet(run("first", feeds.first_copies, ["payment_id"])).collect()
    got = sorted((r.payment_id, str(r.load_date)) for r in first)
    assert got == [("p1", "2026-01-02"), ("p2", "2026-01-02"), ("p3", "2026-01-03"), ("p4", "2026-01-06"), ("p6", "2026-01-08")]

    aside = spark.read.parquet(run("aside", feeds.kept_aside, key=["payment_id"])).collect()
    got = sorted((r.payment_id or "", str(r.load_date), r.reason) for r in aside)
    assert got == [
        ("", "2026-01-08", "no_key"),
        ("p1", "2026-01-07", "late"),
        ("p5", "2026-01-07", "late"),
        ("p7", "2026-01-10", "no_time"),
    ]

    closed = spark.read.parquet(run("closed", feeds.closed_totals, "amount")).collect()
    days = {("2026-01-02", 7, "73.50"), ("2026-01-08", 2, "21.00")}
    assert {(str(r.order_date), r.row_count, str(r.total_amount)) for r in closed} == days and len(closed) == 2
    current = feeds.latest(spark, run("current", feeds.current_totals, "amount")).collect()
    days |= {("2026-01-12", 1, "10.50"), ("2026-01-13", 1, "10.50")}
    assert {(str(r.order_date), r.row_count, str(r.total_amount)) for r in current} == days


def test_a_day_landed_after_it_was_closed_is_no_silent_loss(spark, tmp_path):
    raw, place = tmp_path / "raw", str(tmp_path / "out")

    def run():
        stream = feeds.landing_stream(spark, str(raw), "payments")
        return feeds.closed_totals(stream, f"{place}/t", f"{place}/c", "source_event_at", "amount")

    put_day(raw, "2026-01-02", ["p1"])
    put_day(raw, "2026-01-20", ["p2"])
    feeds.finished(run())
    put_day(raw, "2026-01-03", ["p3"])
    with pytest.raises(feeds.RowsBehindWatermark):
        feeds.finished(run())


def test_a_batch_by_event_time_reads_no_table(spark, tmp_path):
    raw, place = tmp_path / "raw", str(tmp_path / "out")
    land_in_order(raw)
    stream = feeds.landing_stream(spark, str(raw), "payments", 1)
    query = feeds.finished(feeds.first_copies(stream, f"{place}/t", f"{place}/c", "source_event_at", ["payment_id"]))
    assert max(p["numInputRows"] for p in query.recentProgress) <= 3
    assert max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"]) <= 5


def test_of_copies_in_a_batch_the_least_content_stays(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "t")
    put_day(raw, "2026-01-02", ["p1"])
    for k, day in enumerate(("2026-01-03", "2026-01-04", "2026-01-05")):
        put_day(raw, day, ["p1"])
    got = set()
    for run in range(3):
        stream = feeds.landing_stream(spark, str(raw), "payments")
        feeds.without_repeats(stream, f"{target}{run}", str(tmp_path / f"c{run}"), ["payment_id"]).awaitTermination()
        got.add(str(spark.read.parquet(f"{target}{run}").first().load_date))
    assert len(got) == 1


def test_a_batch_that_runs_again_replaces_itself(spark, tmp_path):
    target = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    for _ in range(2):
        feeds._put(rows, target, 0)
    assert spark.read.parquet(target).count() == 2
    assert feeds._written_before(spark, target, 0).count() == 0
    assert feeds._written_before(spark, target + "-none") is None


def test_a_table_of_several_files_is_a_stream(spark, tmp_path, small):
    import daybook.plans.daily  # noqa: F401  (registers its queries)
    from daybook.plans.registry import QUERIES

    events = spark.read.parquet(f"{small}/events.parquet")
    events.repartition(7).write.parquet(str(tmp_path / "events.parquet"))
    for name in ("stream_ingest", "stream_dedupe", "stream_daily", "stream_closed_days"):
        one, several = (sorted(map(tuple, QUERIES[name](spark, f).collect())) for f in (small, str(tmp_path)))
        assert one == several and one
