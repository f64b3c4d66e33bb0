from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import ranges, tables
from tests.conftest import plan_of


def numbers(spark, rows):
    return spark.createDataFrame(rows, "id int, low bigint, high bigint")


@pytest.mark.parametrize("low, high", [(0, 0), (0, 15), (0, 16), (1, 16), (-40, 300), (5, 4), (255, 256), (-1, 70_000), (17, 4096)])
def test_nodes_cover_a_range_exactly_once(spark, low, high):
    found = numbers(spark, [(1, low, high)]).select(F.explode(ranges.cover(F.col("low"), F.col("high"))).alias("n")).select("n.*")
    held = []
    for level, node in found.collect():
        held += range(node * 16**level, (node + 1) * 16**level)
    assert sorted(held) == list(range(low, high + 1))


def test_few_nodes_for_long_and_open_ranges(spark):
    rows = [(1, None, None), (2, 20_000, None), (3, None, -5), (4, 1, 30_000_000)]
    sizes = numbers(spark, rows).select(F.size(ranges.cover(F.col("low"), F.col("high"))).alias("n")).collect()
    assert max(r.n for r in sizes) <= 2 * 15 * ranges.LEVELS


@pytest.mark.parametrize("bound", [0, 500_000])
def test_look_up_equals_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(ranges, "BROADCAST_NODES", bound)
    rng = random.Random(6)
    held = []
    for k in range(60):
        low = rng.choice([None, rng.randrange(-50_000, 50_000)])
        high = rng.choice([None, (low or 0) + rng.choice([-3, 0, 1, 40, 5_000, 900_000])])
        held.append((k, low, high, rng.choice(["a", "b", None])))
    points = [(k, rng.choice([None, rng.randrange(-60_000, 60_000)]), rng.choice(["a", "b", None])) for k in range(300)]
    want = sorted(
        (p, k)
        for p, at, g in points
        for k, low, high, h in held
        if at is not None and g is not None and g == h and (low is None or low <= at) and (high is None or at <= high)
    )
    found = ranges.in_ranges(
        spark.createDataFrame(points, "p int, at bigint, g string"), F.col("at"),
        spark.createDataFrame(held, "k int, low bigint, high bigint, g string"), F.col("low"), F.col("high"), ["g"],
    )
    assert sorted((r.p, r.k) for r in found.collect()) == want and want
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


@pytest.mark.parametrize("bound", [0, 500_000])
def test_totals_equal_those_of_the_pairs(spark, monkeypatch, bound):
    monkeypatch.setattr(ranges, "BROADCAST_NODES", bound)
    rng = random.Random(8)
    held = [(k, rng.choice([None, k % 40]), rng.choice([None, k % 90]), rng.choice(["a", "b", None])) for k in range(200)]
    points = [(k // 2, rng.choice([None, rng.randrange(-5, 100)]), rng.choice(["a", "b", None])) for k in range(200)]
    there = spark.createDataFrame(points, "p int, at bigint, g string"), F.col("at")
    of = spark.createDataFrame(held, "k int, low bigint, high bigint, g string"), F.col("low"), F.col("high")
    pairs = ranges.in_ranges(*there, *of, ["g"]).groupBy("p")
    want = sorted(pairs.agg(F.count(F.lit(1)), F.min("k"), F.max("k")).collect())
    found = ranges.totals_in_ranges(there[0], ["p"], there[1], *of, ["g"], "k")
    assert sorted(found.collect()) == want and want


def test_totals_make_no_pairs(spark):
    points = spark.range(500).select("id", F.lit(70).cast("bigint").alias("at"), F.lit("a").alias("g"))
    held = spark.range(400).select("id", F.lit(0).cast("bigint").alias("low"), F.lit(99).cast("bigint").alias("high"), F.lit("a").alias("g"))
    held = held.withColumnRenamed("id", "k")
    found = ranges.totals_in_ranges(points, ["id"], F.col("at"), held, F.col("low"), F.col("high"), ["g"], "k")
    assert {tuple(r)[1:] for r in found.collect()} == {(400, 0, 399)}
    plan = found._jdf.queryExecution().executedPlan()
    # Rows out of each join, as the metrics of the finished run count them.
    made, steps = [], [plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan]
    while steps:
        step = steps.pop()
        if "Join" in step.nodeName():
            made.append(step.metrics().apply("numOutputRows").value())
        inner = step.plan() if "QueryStage" in step.nodeName() else None
        steps += [inner] if inner is not None else []
        children = step.children()
        steps += [children.apply(k) for k in range(children.size())]
    assert made and max(made) <= 500 * ranges.LEVELS


def test_minutes(spark):
    moments = spark.sql("SELECT timestamp'2026-03-01 10:00:59' AS at UNION ALL SELECT timestamp'2026-03-01 10:01:00'")
    span = spark.sql("SELECT timestamp'2016-01-01 00:00:00' AS a, timestamp'2026-03-01 10:00:00' AS b")
    low, high = ranges.minute_number(F.col("a")), ranges.minute_number(F.col("b"))
    found = ranges.in_ranges(moments, ranges.minute_number(F.col("at")), span, low, high)
    assert [str(r.at) for r in found.collect()] == ["2026-03-01 10:00:59"]


def test_no_ranges(spark):
    none = numbers(spark, [])
    assert ranges.in_ranges(spark.range(3), F.col("id"), none.drop("id"), F.col("low"), F.col("high")).collect() == []


def test_differing_rows(spark):
    schema = "day string, k int, v string, w string"
    left = [("d1", 1, "a", None), ("d1", 2, "b", "x"), ("d2", 3, "c", "x"), (None, 4, "d", "x"), ("d3", 5, "e", "x"), ("d3", 5, "e", "x")]
    right = [("d1", 1, None, "a"), ("d1", 2, "b", "x"), ("d2", 6, "c", "x"), (None, 4, "D", "x"), ("d3", 5, "e", "x")]
    found = tables.differing_rows(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "day", ["k"])
    got = {(r.day, r.k, r.kind) for r in found.collect()}
    assert got == {("d1", 1, "changed"), ("d2", 3, "left"), ("d2", 6, "right"), (None, 4, "changed"), ("d3", 5, "left")}
    same = spark.createDataFrame(left, schema)
    assert tables.differing_rows(same, same, "day", ["k"]).collect() == []


def test_only_differing_days_are_read(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") % 10).cast("int").alias("day"), "id", (F.col("id") * 2).alias("v"))
    rows.write.partitionBy("day").parquet(str(tmp_path / "a"))
    other = rows.withColumn("v", F.when(F.col("id") == 123, 0).otherwise(F.col("v")))
    other.write.partitionBy("day").parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / name)) for name in "ab")
    trees = [tables.hash_tree(t, "day", ["id"]) for t in (a, b)]
    found = tables.differing_rows(a, b, "day", ["id"], *trees)
    assert [tuple(r) for r in found.collect()] == [(3, 123, "changed")]
    plan = plan_of(found)
    assert plan.count("day#") and "(day#" in plan and "= 3" in plan
