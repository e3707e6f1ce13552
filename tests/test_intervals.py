"""Interval operators against plain loops over all rows and intervals."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from tests.conftest import at, rows, txn
from tests.test_bursts import random_records
from txnlens.operators.intervals import bursts, interval_alerts, interval_join, merge_intervals, windows_by_join
from txnlens.operators.sliding import sliding_alerts

SCHEMA = "customer_id LONG, start TIMESTAMP, end TIMESTAMP, name INT"
DAY = at("2024-03-01 00:00:00")


def random_intervals(seed, n=120):
    """Of lengths from none to hours, some before 1970, some repeated, some the wrong way round."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        base = at("1969-12-31 23:50:00") if i % 5 == 0 else DAY
        start = base + dt.timedelta(seconds=rng.randrange(1200))
        length = dt.timedelta(microseconds=rng.choice([0, 1, 7, 8, 9, 10**6, 60 * 10**6, 600 * 10**6 + 1, 9 * 3600 * 10**6]))
        out.append((rng.choice([1, 1, 1, 2, 3, None]), start, start + (length if i % 11 else -length), i))
    return out + out[:3]


def random_rows(seed, intervals, n=300):
    """At random times and exactly on the borders of intervals."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        _, start, end, _ = rng.choice(intervals)
        moment = rng.choice([start, end, end - dt.timedelta(microseconds=1), DAY + dt.timedelta(seconds=rng.randrange(1200))])
        out.append((i, rng.choice([1, 1, 1, 2, 3, 4, None]), None if i % 50 == 0 else moment, 450.0, "withdrawal", "atm", "success"))
    return out


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("hot", [{}, {"hot_rows": 5, "max_hot_bins": 1000}, {"hot_rows": 1, "max_hot_bins": 3}])
def test_join_equals_a_loop(spark, frame, closed, hot):
    intervals = random_intervals(3)
    records = random_rows(4, intervals)
    found = interval_join(
        frame(records), spark.createDataFrame(intervals, SCHEMA), ["customer_id"], "txn_timestamp", end_inclusive=closed, **hot
    )
    expected = [
        (r[0], name)
        for r in records
        for customer, start, end, name in intervals
        if r[2] is not None and r[1] is not None and r[1] == customer and start <= r[2] and (r[2] <= end if closed else r[2] < end)
    ]
    assert expected
    assert rows(found, "transaction_id", "name") == sorted(expected)


def merged(intervals):
    out = []
    for customer in {i[0] for i in intervals}:
        kept = sorted((s, e, n) for c, s, e, n in intervals if c == customer and s <= e)
        group = []
        for start, end, name in kept:
            if group and start <= group[-1][1]:
                group[-1] = (group[-1][0], max(end, group[-1][1]), max(name, group[-1][2]))
            else:
                group.append((start, end, name))
        out += [(customer or 0, *g) for g in group]
    return sorted(out)


@pytest.mark.parametrize("chunk", ["1 second", "7 minutes", "1 day"])
def test_merge_equals_a_loop(spark, chunk):
    intervals = random_intervals(5)
    found = merge_intervals(spark.createDataFrame(intervals, SCHEMA), ["customer_id"], ["name"], chunk)
    assert rows(found.na.fill(0, ["customer_id"]), "customer_id", "start", "end", "name") == merged(intervals)


@pytest.mark.parametrize("hot", [{}, {"hot_rows": 2, "max_hot_bins": 1000}])
def test_alerts_are_the_rows_of_sliding_alerts(frame, hot):
    df = frame(random_records(8))
    expected = rows(sliding_alerts(df, "1 minute", "5 seconds", 5), "transaction_id")
    assert expected
    assert rows(interval_alerts(df, "1 minute", "5 seconds", 5, **hot), "transaction_id") == expected
    each = windows_by_join(df, "1 minute", "5 seconds", 5, **hot).groupBy("transaction_id").agg({"transaction_count": "max"})
    assert rows(each) == rows(sliding_alerts(df, "1 minute", "5 seconds", 5), "transaction_id", "transaction_count")


def test_two_bursts_apart_and_one_prolonged(frame):
    times = ["10:00:00", "10:00:01", "10:00:02", "10:00:50", "10:00:51", "10:10:00", "10:10:01", "10:10:02"]
    df = frame([txn(i, ts=f"2024-03-01 {t}") for i, t in enumerate(times)])
    spans = rows(bursts(df), "start", "end", "transaction_count")
    assert [n for *_, n in spans] == [5, 3]
    found = rows(interval_alerts(df), "transaction_id", "transaction_count", "burst_start")
    assert [(i, n) for i, n, _ in found] == [(0, 5), (1, 5), (2, 5), (3, 5), (4, 5), (5, 3), (6, 3), (7, 3)]
    assert {b for *_, b in found} == {s for s, *_ in spans}


def test_empty_sides_and_clashing_names(spark, frame):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame(random_intervals(1), SCHEMA)
    assert interval_join(frame([txn(1)]), none, ["customer_id"], "txn_timestamp").count() == 0
    assert interval_join(frame([]), some, ["customer_id"], "txn_timestamp").count() == 0
    assert merge_intervals(none, ["customer_id"]).count() == 0
    with pytest.raises(ValueError, match="amount"):
        interval_join(frame([]), some.withColumnRenamed("name", "Amount"), ["customer_id"], "txn_timestamp")


def test_join_is_one_on_equal_bins(spark, frame):
    some = spark.createDataFrame(random_intervals(1), SCHEMA)
    df = interval_join(frame([txn(1)]), some, ["customer_id"], "txn_timestamp")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text
