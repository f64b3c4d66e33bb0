"""Every registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from daybook.plans.registry import QUERIES, SQL
from tools.compare import difference, oracle

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython"]
STREAMS = "stream_"


@pytest.fixture(scope="module")
def db(small):
    return oracle(small)


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= registered.queries().keys()
    assert SQL.keys() <= registered.oracle_sql().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, small, db, name):
    build, sql = registered.queries()[name], registered.oracle_sql()[name]
    assert difference(spark, db, small, build, sql) == ""


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(STREAMS)])
def test_plan_has_no_pairs_of_everything_and_no_python(spark, small, name):
    from tests.conftest import plan_of

    plan = plan_of(registered.queries()[name](spark, small))
    assert [p for p in FORBIDDEN if p in plan] == []


def test_orders_do_not_move_for_their_channel(spark, small):
    from tests.conftest import plan_of

    assert "hashpartitioning(campaign_id" not in plan_of(QUERIES["channel_fallback"](spark, small))
