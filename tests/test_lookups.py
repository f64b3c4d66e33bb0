"""As-of, next-match and interval look-ups on random rows against plain Python."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.operators import skew, state
from daybook.operators.events import interval_pairs, next_in_interval

START = datetime(2026, 1, 1)
KEYS = st.sampled_from(["a", "a", "a", "b", "c"])
MINUTES = st.integers(0, 90)
RANDOM = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
EARLY = "k string, e int, e_at timestamp"
LATE = "k string, o int, o_at timestamp"


def timed(drawn):
    return [(k, i, START + timedelta(minutes=m)) for i, (k, m) in enumerate(drawn)]


def sides(spark, early, late):
    return spark.createDataFrame(early, EARLY), spark.createDataFrame(late, LATE)


@settings(**RANDOM)
@given(st.lists(st.tuples(KEYS, MINUTES), max_size=40), st.lists(st.tuples(KEYS, MINUTES), max_size=40))
def test_as_of(spark, facts, versions):
    early, late = timed(facts), timed(versions)
    want = Counter(
        (k, e, max(((at, o) for k2, o, at in late if k2 == k and at <= e_at), default=(None, None))[1])
        for k, e, e_at in early
    )
    left, right = sides(spark, early, late)
    for hot in (None, skew.hot_keys(left, ["k"], 1, sample=1.0)):
        found = state.at_point_in_time(
            left, right, ["k"], "e_at", "o_at", ["o"], ["o"], ["e"], hot=hot
        )
        assert Counter((r.k, r.e, r.o) for r in found.collect()) == want


@settings(**RANDOM)
@given(
    st.lists(st.tuples(KEYS, MINUTES), max_size=40), st.lists(st.tuples(KEYS, MINUTES), max_size=40),
    st.sampled_from([(1, 20), (0, 5), (7, 7)]),
)
def test_interval(spark, early_rows, late_rows, span):
    early, late = timed(early_rows), timed(late_rows)
    low, high = (timedelta(minutes=m) for m in span)
    inside = [
        (k, e, o, o_at) for k, e, e_at in early for k2, o, o_at in late
        if k2 == k and e_at + low <= o_at <= e_at + high
    ]
    left, right = sides(spark, early, late)
    pairs = interval_pairs(left, right, ["k"], "e_at", "o_at", *span)
    assert Counter((r.k, r.e, r.o) for r in pairs.collect()) == Counter(p[:3] for p in inside)
    first = {
        e: min(((at, o) for _, e2, o, at in inside if e2 == e), default=(None, None))[1]
        for _, e, _ in early
    }
    for hot in (None, skew.hot_keys(left, ["k"], 1, sample=1.0)):
        found = next_in_interval(
            left, right, ["k"], "e_at", "o_at", ["o"], ["e"], ["o"], *span, hot=hot
        )
        assert {r.e: r.o for r in found.collect()} == first


@pytest.mark.parametrize("split", [False, True])
def test_as_of_with_null_keys_and_times(spark, split):
    left, right = sides(
        spark,
        [(None, 1, START), ("a", 2, START), ("a", 3, None), ("b", 4, START), ("b", 5, None)],
        [(None, 7, START), ("a", 8, START), ("a", 9, None), ("b", 10, None)],
    )
    hot = skew.hot_keys(left, ["k"], 1, sample=1.0) if split else None
    found = state.at_point_in_time(left, right, ["k"], "e_at", "o_at", ["o"], fact_tie=["e"], hot=hot)
    assert {(r.e, r.o) for r in found.collect()} == {(1, None), (2, 8), (3, None), (4, None), (5, None)}


def test_only_the_last_version_is_current(spark):
    rows = spark.createDataFrame(
        [("k", None, "x"), ("k", None, "y"), ("k", START, "z")], "k string, at timestamp, v string"
    )
    history = state.version_history(rows, ["k"], ["at", "v"], ["v"])
    assert {(r.v, r.is_current) for r in history.collect()} == {("x", False), ("y", False), ("z", True)}


def test_next_match_of_a_null_key(spark):
    left, right = sides(spark, [(None, 1, START), ("a", 2, START)], [(None, 7, START), ("a", 8, START)])
    found = next_in_interval(left, right, ["k"], "e_at", "o_at", ["o"], ["e"], ["o"], 0, 5)
    assert {(r.e, r.o) for r in found.collect()} == {(1, None), (2, 8)}
    pairs = interval_pairs(left, right, ["k"], "e_at", "o_at", 0, 5)
    assert {(r.e, r.o) for r in pairs.collect()} == {(2, 8)}
