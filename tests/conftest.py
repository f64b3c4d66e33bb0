from __future__ import annotations

import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daybook.session import configure  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def day(text: str) -> date:
    return date.fromisoformat(text)


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
