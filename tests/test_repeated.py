"""Work on keys that have one row: nothing is shuffled for them, and nothing comes out differently."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from daybook.functions.scalars import padded_key
from daybook.operators import orders, quality, skew, state, tables
from daybook.session import side_by_side
from daybook.sources import landing
from tests.conftest import day, plan_of


def same(left, right) -> bool:
    assert left.schema.simpleString() == right.schema.simpleString()
    return sorted(map(str, left.collect())) == sorted(map(str, right.collect()))


@pytest.fixture(scope="module")
def feed(spark):
    rows = [("a", 1, "created"), ("b", 1, "created"), ("b", 2, "paid"), ("c", 3, "paid"), ("c", 3, "paid"),
            (None, 1, "created"), (None, 2, "paid"), ("d", 4, None)]
    return spark.createDataFrame(rows, "k string, v int, s string")


@pytest.fixture(scope="module")
def repeated(feed):
    return skew.repeated_keys(feed, ["k"])


def test_apart_sets_keys_with_one_row_aside(feed, repeated):
    single, several = skew.apart(feed, ["k"], repeated)
    assert sorted(r.k for r in single.collect()) == ["a", "d"]
    assert several.count() == 6 and single.columns == feed.columns


def test_many_repeated_keys_are_left_to_the_plain_way(feed, monkeypatch):
    monkeypatch.setattr(skew, "MAX_REPEATED", 2)
    assert skew.repeated_keys(feed, ["k"]) is None


def test_results_are_those_of_the_plain_way(feed, repeated):
    assert same(tables.count_copies(feed, keys=["k"], repeated=repeated), tables.count_copies(feed))
    assert same(tables.first_per_key(feed, ["k"], ["v"], repeated), tables.first_per_key(feed, ["k"], ["v"]))
    assert same(skew.latest_per_key(feed, ["k"], ["v"], repeated), skew.latest_per_key(feed, ["k"], ["v"]))
    names = {"key": "k", "status": "s", "at": "v", "tie": (), "statuses": ("created", "paid")}
    assert same(orders.lifecycle(feed, **names, repeated=repeated), orders.lifecycle(feed, **names))


def test_single_rows_are_not_shuffled(spark):
    unique = spark.range(1000).withColumn("v", F.lit(1))
    repeated = skew.repeated_keys(unique, ["id"])
    for done in (
        tables.count_copies(unique, keys=["id"], repeated=repeated),
        tables.first_per_key(unique, ["id"], ["v"], repeated),
        skew.latest_per_key(unique, ["id"], ["v"], repeated),
    ):
        assert len(done.collect()) == 1000
        final = plan_of(done).split("Initial Plan")[0]
        assert "Exchange hashpartitioning" not in final and "Window" not in final


def test_prices_of_products_with_one_and_several_versions(spark):
    versions = spark.createDataFrame(
        [("one", 2, 10), ("two", 1, 20), ("two", 3, 30), (None, 1, 5), ("undated", None, 7)], "p string, at int, price int"
    )
    facts = spark.createDataFrame(
        [("one", 1, 1), ("one", 2, 2), ("one", None, 3), ("two", 0, 4), ("two", 2, 5), ("two", 9, 6),
         ("none", 5, 7), (None, 5, 8), ("undated", 5, 9)], "p string, t int, n int"
    )
    args = (facts, versions, ["p"], "t", "at", ["price"])
    plain = state.at_point_in_time(*args, fact_tie=["n"])
    assert same(state.at_point_in_time(*args, fact_tie=["n"], repeated=skew.repeated_keys(versions, ["p"])), plain)


def test_large_right_sides_are_hashed_in_bounds(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_REPEATED", 5)
    monkeypatch.setattr(skew, "HASHED_PER_TASK", 10)
    many = spark.range(20)
    assert "ShuffledHashJoin" in plan_of(many.join(skew.hashed_side(many), "id"))
    assert "ShuffledHashJoin" not in plan_of(many.join(skew.hashed_side(spark.range(81)), "id"))
    assert "ShuffledHashJoin" not in plan_of(many.join(skew.hashed_side(spark.range(5)), "id"))


def test_children_are_compared_with_their_order_in_one_join(spark):
    landed = spark.createDataFrame([("o1", 10), ("o2", None), (None, 1)], "order_id string, net_amount int")
    children = spark.createDataFrame(
        [("o1", 10), ("o1", 11), ("o2", 1), ("gone", 1), (None, 1)], "order_id string, amount int"
    )
    row = quality.against_order(children, landed, quality.differs(F.col("amount"), F.col("net_amount"))).first()
    assert (row["without"], row["broken"]) == (2, 2)


def test_steps_run_side_by_side(spark):
    meet = threading.Barrier(2, timeout=60)
    steps = {n: lambda n=n: (meet.wait(), spark.range(n).count())[1] for n in (1, 2)}
    assert side_by_side(spark, steps) == {1: 1, 2: 2}


def test_a_failing_step_is_raised(spark):
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, {"a": lambda: 1, "b": lambda: 1 // 0})


def test_padded_keys_are_formatted_ones(spark):
    numbers = spark.createDataFrame([(n,) for n in (0, 7, 99_999, 100_000, 12_345_678, -4, None)], "n bigint")
    rows = numbers.select(padded_key("p_", F.col("n")).alias("a"), F.format_string("p_%05d", "n").alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_landed_day_is_the_end_of_the_folder_name(spark, tmp_path):
    header = ",".join(landing.landed_schema("exchange_rates").fieldNames()[:-1])
    folders = ["load_date=2026-01-02", "load_date=2026-02-30", "load_date=x2026-01-02", "2026-01-02", "load_date=2026-1-002"]
    for n, folder in enumerate(folders):
        (tmp_path / "exchange_rates" / folder).mkdir(parents=True)
        (tmp_path / "exchange_rates" / folder / "a.csv").write_text(f"{header}\n2026-01-02,EUR,1.{n},s,2026-01-02,\n")
    rows = landing.read_table(spark, str(tmp_path), "exchange_rates", with_landed_day=True).collect()
    found = {str(r.rate_to_pln): r[landing.LANDED_DAY] for r in rows}
    assert found == {"1.0000": day("2026-01-02"), "1.1000": None, "1.2000": None, "1.3000": None, "1.4000": None}
