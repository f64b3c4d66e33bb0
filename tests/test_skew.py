"""Hot keys: the split plans give the same rows as the plain ones and as plain Python."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators import skew
from tests.conftest import plan_of

SCHEMA = "k string, t int, i int, v int"


def skewed_rows(n=900, seed=3):
    """A third of the rows has key "hot", some keys are NULL, values may be NULL, times repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice([None, "a", "b", "c", "d", "e", "f"])
        rows.append((key, rng.randrange(40), i, rng.choice([None, 1, 2, 3])))
    return rows


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    result = []
    for group in groups.values():
        group.sort(key=lambda r: (r[1] is not None, r[1], r[2]))
        seen, total = None, 0
        for n, (k, t, i, v) in enumerate(group):
            seen = v if v is not None else seen
            total += v or 0
            before = group[n - 1][3] if n else None
            after = group[n + 1][2] if n + 1 < len(group) else None
            result.append((k, t, i, v, n + 1, before, after, seen, total))
    return Counter(result)


def with_all_columns(df, hot):
    return skew.ordered_columns(
        df, ["k"], ["t", "i"], number="n", previous={"before": F.col("v")},
        following={"after": F.col("i")}, latest={"seen": F.col("v")},
        running={"total": F.coalesce("v", F.lit(0))}, hot=hot,
    )


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [None, 1, 50, 250])
def test_ordered_columns_equal_brute_force(spark, hot_rows):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    hot = skew.hot_keys(df, ["k"], hot_rows, sample=1.0) if hot_rows else None
    assert (hot is None) == (hot_rows is None)
    found = with_all_columns(df, hot)
    assert rows_of(found) == brute_force(rows)
    assert found.schema == with_all_columns(df, None).schema


def test_running_decimals_keep_their_type(spark):
    df = spark.createDataFrame(skewed_rows(), SCHEMA).withColumn("m", F.col("i").cast("decimal(12,2)"))
    hot = skew.hot_keys(df, ["k"], 50, sample=1.0)
    plain, split = (
        skew.ordered_columns(df, ["k"], ["t", "i"], running={"total": F.col("m")}, hot=h)
        for h in (None, hot)
    )
    assert plain.schema == split.schema
    assert rows_of(plain) == rows_of(split)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from([None, "x", "y"]), st.sampled_from([None, 0, 1, 2]), st.sampled_from([None, 4, 5])
        ),
        min_size=1, max_size=60,
    )
)
def test_ordered_columns_on_any_rows(spark, drawn):
    rows = [(k, t, i, v) for i, (k, t, v) in enumerate(drawn)]
    df = spark.createDataFrame(rows, SCHEMA)
    hot = skew.hot_keys(df, ["k"], 1, sample=1.0)
    assert rows_of(with_all_columns(df, hot)) == brute_force(rows)


def with_copies(n=400):
    """A third of the rows are copies of one row, a NULL key has copies too."""
    rows = skewed_rows(n)
    return rows + [("hot", 20, 7, 2)] * (n // 2) + [(None, 39, 8, None)] * 30


@pytest.mark.parametrize("hot_rows, tie_rows", [(50, 20), (1, 2), (100, 1000)])
def test_ordered_columns_with_many_copies(spark, hot_rows, tie_rows):
    rows = with_copies()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    hot = skew.hot_keys(df, ["k"], hot_rows, sample=1.0)
    ties = skew.hot_keys(df, ["k", "t", "i"], tie_rows, sample=1.0)
    found = skew.ordered_columns(
        df, ["k"], ["t", "i"], number="n", previous={"before": F.col("v")},
        following={"after": F.col("i")}, latest={"seen": F.col("v")},
        running={"total": F.coalesce("v", F.lit(0))}, hot=hot, ties=ties,
    )
    assert found.columns == [*df.columns, "n", "before", "after", "seen", "total"]
    assert rows_of(found) == brute_force(rows)


def test_copies_are_dealt_out(spark):
    df = spark.createDataFrame(with_copies(3000), SCHEMA).repartition(8)
    hot = skew.hot_keys(df, ["k"], 200, sample=1.0)
    ties = skew.hot_keys(df, ["k", "t", "i"], 200, sample=1.0)
    chunks = skew._with_chunks(df, ["k"], ["t", "i"], hot, ties)
    sizes = chunks.filter("k = 'hot'").groupBy("__chunk", "__deal").count()
    assert sizes.agg(F.max("count")).first()[0] < 500


def test_hot_key_is_cut_into_several_window_partitions(spark):
    df = spark.createDataFrame(skewed_rows(3000), SCHEMA)
    hot = skew.hot_keys(df, ["k"], 300, sample=1.0)
    chunks = skew._with_chunks(df, ["k"], ["t", "i"], hot).filter("k = 'hot'")
    sizes = [r["count"] for r in chunks.groupBy("__chunk", "__deal").count().collect()]
    assert len(sizes) > 5
    assert max(sizes) < 600


def test_chunks_follow_the_order(spark):
    df = spark.createDataFrame(skewed_rows(3000), SCHEMA)
    hot = skew.hot_keys(df, ["k"], 300, sample=1.0)
    rows = skew._with_chunks(df, ["k"], ["t", "i"], hot).filter("k = 'hot'").collect()
    rows.sort(key=lambda r: (r["t"], r["i"]))
    numbers = [r["__chunk"] for r in rows]
    assert numbers == sorted(numbers)


def test_many_borders_use_blocks(spark):
    df = spark.range(20_000).select(
        F.lit("hot").alias("k"), F.col("id").cast("int").alias("t"),
        F.col("id").cast("int").alias("i"), F.lit(1).alias("v"),
    )
    hot = skew.hot_keys(df, ["k"], 200, sample=1.0)
    chunked = skew._with_chunks(df, ["k"], ["t"], hot)
    assert chunked.select("__chunk").distinct().count() > 200
    numbered = skew.ordered_columns(df, ["k"], ["t"], number="n", hot=hot)
    assert numbered.filter(F.col("n") != F.col("t") + 1).count() == 0


def test_no_hot_key_means_a_plain_window(spark):
    df = spark.createDataFrame(skewed_rows(), SCHEMA)
    assert skew.hot_keys(df, ["k"]) is None
    plan = plan_of(skew.ordered_columns(df, ["k"], ["t", "i"], number="n"))
    assert plan.count("Exchange") == 1
    assert "Join" not in plan


def test_estimate_of_a_sampled_hot_key(spark):
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    hot = skew.hot_keys(df, ["k"], hot_rows=50_000, sample=0.05).collect()
    assert [r["k"] for r in hot] == [0]
    assert 90_000 < hot[0]["__rows"] < 110_000
    assert 28 < hot[0]["__parts"] < 36


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.createDataFrame(skewed_rows(), SCHEMA)
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("z", 3), (None, 4)], "k string, w int")
    hot = skew.hot_keys(left, ["k"], 50, sample=1.0)
    plain = skew.join_unique(left, right, ["k"], how, hot=None)
    salted = skew.join_unique(left, right, ["k"], how, hot=hot)
    assert sorted(plain.columns) == sorted(salted.columns)
    assert rows_of(salted.select(plain.columns)) == rows_of(plain)


def test_salted_join_spreads_the_hot_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 80_000, 1, 8).select(F.lit("hot").alias("k"), "id")
        right = spark.createDataFrame([("hot", 1)], "k string, w int")
        hot = skew.hot_keys(left, ["k"], 10_000, sample=1.0)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = skew.join_unique(left, right, ["k"], hot=hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) > 2
        assert joined.count() == 80_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_adaptive_execution_splits_a_join_of_two_stored_tables(spark, tmp_path):
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    rows.write.parquet(str(tmp_path / "left"))
    rows.select("k").distinct().write.parquet(str(tmp_path / "right"))
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
    }
    for name, value in low.items():
        spark.conf.set(name, value)
    try:
        left, right = (spark.read.parquet(str(tmp_path / side)) for side in ("left", "right"))
        joined = skew.join_unique(left, right, ["k"], hot=None)
        assert len(joined.collect()) == 400_000
        assert "SortMergeJoin(skew=true)" in plan_of(joined)
    finally:
        for name in low:
            spark.conf.unset(name)


def test_latest_per_key_limits_before_the_shuffle(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    plan = plan_of(skew.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    # read bottom-up: the partial limit stands below the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2


def test_rows_of_hot_keys_are_filtered_without_finding_their_chunk(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    hot = skew.hot_keys(df, ["k"], 100, sample=1.0)
    numbered = skew.ordered_columns(df, ["k"], ["t"], latest={"seen": F.col("t")}, hot=hot, ties=None)
    assert numbered.filter("seen <> t").count() == 0
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Filter")]
    assert "lambda" in plan and not any("lambda" in line for line in filters)
