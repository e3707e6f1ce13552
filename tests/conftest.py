from __future__ import annotations

import datetime as dt
import itertools
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txnlens.schema import layout  # noqa: E402
from txnlens.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        spark__master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def db(spark):
    name = f"db_{next(COUNTER)}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


COUNTER = itertools.count()


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def txn(number, customer=1, ts="2024-03-01 10:00:00", amount=450.0, kind="withdrawal", channel="atm", status="success"):
    """One record of the raw layout."""
    return (number, customer, at(ts) if ts else None, amount, kind, channel, status)


@pytest.fixture
def frame(spark):
    """Builds a raw-layout frame from records."""
    return lambda records: spark.createDataFrame(records, layout("raw"))


def rows(df, *columns):
    """Sorted tuples of some columns."""
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
