"""Tables that loads bring up to date, against building them from all rows at once."""

from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.operators import maintained, state
from tests.conftest import plan_of

SCHEMA = "k string, v int, tie int, a string, amount decimal(9,2), ok boolean"
KEYS, VERSION = ["k"], ["v", "tie"]


def feed(seed, rows=300, keys=40):
    rng = random.Random(seed)
    found = {}
    for n in range(rows):
        k, v, tie = rng.choice([None, *(f"k{i}" for i in range(keys))]), rng.randrange(30), n
        found[n] = (k, v, tie, rng.choice("abc"), rng.randrange(1000) / 4, rng.random() < 0.8)
    return list(found.values())


def frame(spark, rows):
    from decimal import Decimal

    return spark.createDataFrame([(*r[:4], Decimal(str(r[4])), r[5]) for r in rows], SCHEMA)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_history_in_any_order_of_loads_equals_one_build(spark, tmp_path, strategy):
    rows, target = feed(1), str(tmp_path / "h")
    for load in (rows[200:], rows[:90], rows[90:200], rows[:90], []):
        maintained.merge_history(frame(spark, load), target, KEYS, VERSION, ["a"])
    got = maintained.history(spark, target, KEYS, VERSION, ["a"], strategy)
    want = state.version_history(frame(spark, rows), KEYS, VERSION, ["a"], strategy)
    assert rows_of(got.select("k", "a", "valid_from", "valid_to", "is_current")) == rows_of(
        want.select("k", "a", "valid_from", "valid_to", "is_current")
    )


def files(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder)
        for f in names
        if f.endswith(".parquet")
    }


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    target = str(tmp_path / "h")
    maintained.merge_history(frame(spark, feed(2)), target, KEYS, VERSION, ["a"])
    before = files(target)
    one = [("k3", 99, 0, "z", 1, True)]
    maintained.merge_history(frame(spark, one), target, KEYS, VERSION, ["a"])
    bucket = frame(spark, one).select(maintained.hash_bucket(KEYS)).first()[0]
    after = files(target)
    changed = {path for path in before if after.get(path) != before[path]}
    assert changed and all(f"/bucket={bucket}/" in path for path in changed)
    assert len(before) - len(changed) > 10
    last = maintained.history(spark, target, KEYS, VERSION, ["a"]).filter("k = 'k3' AND is_current").collect()
    assert [(r.a, r.valid_from) for r in last] == [("z", 99)]


def test_only_touched_buckets_are_read(spark, tmp_path):
    target = str(tmp_path / "h")
    maintained.merge_history(frame(spark, feed(2)), target, KEYS, VERSION, ["a"])
    one = frame(spark, [("k3", 99, 0, "z", 1, True)]).withColumn("bucket", maintained.hash_bucket(KEYS))
    plan = plan_of(maintained._touched(spark, target, one))
    assert "PartitionFilters: [isnotnull(bucket" in plan


def merge(spark, rows, base, load):
    images = maintained.merge_current(frame(spark, rows), f"{base}/s", load, KEYS, VERSION, F.col("ok"))
    maintained.merge_totals(images, f"{base}/t", load, ["a"], "amount")
    return images


def built(spark, rows):
    kept = state.current_state(frame(spark, rows), KEYS, VERSION, F.col("ok"))
    sums = kept.groupBy("a").agg(F.count(F.lit(1)).cast("bigint"), F.sum("amount"))
    return rows_of(kept), Counter((a, n, float(s)) for a, n, s in sums.collect())


def test_state_and_totals_after_each_load_equal_a_rebuild(spark, tmp_path):
    rows, base = feed(3), str(tmp_path)
    seen = []
    for load, (start, end) in enumerate([(100, 200), (0, 100), (200, 300)]):
        merge(spark, rows[start:end], base, str(load))
        seen += rows[start:end]
        state_rows, sums = built(spark, seen)
        assert rows_of(maintained.current(spark, f"{base}/s", F.col("ok"))) == state_rows
        got = maintained.totals(spark, f"{base}/t", ["a"]).collect()
        assert Counter((r.a, r.row_count, float(r.total_amount)) for r in got) == sums
    # An earlier load again, after later ones: nothing changes.
    merge(spark, rows[100:200], base, "0")
    assert rows_of(maintained.current(spark, f"{base}/s", F.col("ok"))) == state_rows
    got = maintained.totals(spark, f"{base}/t", ["a"]).collect()
    assert Counter((r.a, r.row_count, float(r.total_amount)) for r in got) == sums


def test_a_load_that_stopped_half_way_can_be_run_again(spark, tmp_path, monkeypatch):
    rows, base = feed(4), str(tmp_path)
    merge(spark, rows[:150], base, "a")

    def lost(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken, pytest.raises(OSError):
        broken.setattr(maintained, "_replaced", lost)
        merge(spark, rows[150:], base, "b")
    merge(spark, rows[150:], base, "b")
    state_rows, sums = built(spark, rows)
    assert rows_of(maintained.current(spark, f"{base}/s", F.col("ok"))) == state_rows
    got = maintained.totals(spark, f"{base}/t", ["a"]).collect()
    assert Counter((r.a, r.row_count, float(r.total_amount)) for r in got) == sums


def test_images_are_signed(spark, tmp_path):
    base = str(tmp_path)
    merge(spark, [("x", 1, 0, "a", 2, True), ("y", 1, 0, "a", 3, True), ("z", 5, 0, "b", 4, False)], base, "1")
    later = [("x", 2, 0, "b", 5, True), ("y", 2, 0, "a", 3, False), ("z", 4, 0, "b", 9, True), ("x", 1, 0, "a", 2, True)]
    images = merge(spark, later, base, "2").select("k", "v", "sign").collect()
    assert sorted(map(tuple, images)) == [("x", 1, -1), ("x", 2, 1), ("y", 1, -1)]
    totals = maintained.totals(spark, f"{base}/t", ["a"]).collect()
    assert [(r.a, r.row_count, float(r.total_amount)) for r in totals] == [("b", 1, 5.0)]


def test_empty_loads(spark, tmp_path):
    base = str(tmp_path)
    assert merge(spark, [], base, "0").collect() == []
    assert maintained.current(spark, f"{base}/none") is None
    merge(spark, [("x", 1, 0, "a", 2, True)], base, "1")
    assert merge(spark, [], base, "2").collect() == []
    assert maintained.current(spark, f"{base}/s").count() == 1


def test_deferred_rows_are_taken_once(spark, tmp_path):
    queue = str(tmp_path / "q")
    assert maintained.take_due(spark, queue, "2026-01-01") is None

    def defer(load, rows):
        maintained.defer(spark.createDataFrame(rows, "id int, d string"), queue, load, F.to_date("d"))

    def take(day):
        return sorted(r.id for r in maintained.take_due(spark, queue, day).collect())

    defer("a", [(1, "2026-01-01"), (2, "2026-01-03"), (3, None), (4, "2026-01-09")])
    assert take("2026-01-02") == [1, 3]
    defer("b", [(5, "2026-01-01"), (6, "2026-01-02")])
    assert take("2026-01-02") == [1, 3]
    assert take("2026-01-03") == [2, 5, 6]
    defer("a", [(1, "2026-01-01"), (2, "2026-01-03"), (3, None), (4, "2026-01-09")])
    assert take("2026-01-04") == []
    assert take("2026-01-03") == [2, 5, 6]
    assert take("2026-02-01") == [4]
