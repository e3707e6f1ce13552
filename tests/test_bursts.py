"""Burst operators against a plain count over all windows."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest

from tests.conftest import rows, txn
from txnlens.operators import bursts, sliding
from txnlens.operators.matching import join_groups

EPOCH = dt.datetime(1970, 1, 1)


def seconds(ts):
    return (ts - EPOCH).total_seconds()


def tumbling(records, size, min_count, closed):
    """(count, transaction) for each row of each flagged window."""
    inside = Counter((r[1], seconds(r[2]) // size) for r in records if r[1] is not None and r[0] is not None)
    out = []
    for (customer, window), n in inside.items():
        if n <= min_count:
            continue
        for r in records:
            at = seconds(r[2])
            end = (window + 1) * size
            if r[1] == customer and window * size <= at and (at <= end if closed else at < end):
                out.append((n, r[0]))
    return sorted(out)


def sliding_windows(records, size, step, min_count):
    """Count per flagged (customer, window start)."""
    counts = Counter()
    for r in records:
        start = seconds(r[2]) // step * step
        while start > seconds(r[2]) - size:
            counts[r[1], start] += 1
            start -= step
    return {k: n for k, n in counts.items() if n > min_count}


def random_records(seed, n=400, customers=6, span=900):
    rng = random.Random(seed)
    base = dt.datetime(2024, 3, 1, 9, 55)
    picks = [1] * 3 + list(range(1, customers))
    return [
        (i, rng.choice(picks), base + dt.timedelta(seconds=rng.choice([rng.randrange(span), rng.randrange(span) // 60 * 60])))
        + (450.0, "withdrawal", "atm", "success")
        for i in range(n)
    ]


def test_three_in_a_minute_and_one_on_the_end(frame):
    df = frame([txn(i, ts=f"2024-03-01 10:00:{s}") for i, s in enumerate(("10", "20", "30"))] + [txn(3, ts="2024-03-01 10:01:00")])
    assert rows(bursts.fraud_alerts(df), "transaction_count", "transaction_id") == [(3, 0), (3, 1), (3, 2), (3, 3)]
    halfopen = bursts.fraud_alerts(df, end_inclusive=False)
    assert rows(halfopen, "transaction_count", "transaction_id") == [(3, 0), (3, 1), (3, 2)]
    assert rows(bursts.fraud_windows(df), "customer_id", "transaction_count") == [(1, 3)]


def test_filter_is_strict_and_takes_text_as_it_comes(frame):
    df = frame([txn(1, amount=400.0), txn(2, amount=400.01), txn(3, kind="Withdrawal"), txn(4, status="failed"), txn(5, amount=None)])
    assert rows(bursts.large_withdrawals(df), "transaction_id") == [(2,), (4,)]
    assert rows(bursts.large_withdrawals(df, success_only=True), "transaction_id") == [(2,)]


def test_rows_without_customer_or_time_are_never_alerts(frame):
    df = frame([txn(i, customer=None) for i in range(4)] + [txn(10 + i, ts=None) for i in range(4)])
    assert bursts.fraud_alerts(df).count() == 0
    assert sliding.sliding_alerts(df).count() == 0


def test_a_row_in_two_flagged_windows_is_reported_for_both(frame):
    first = [txn(i, ts=f"2024-03-01 10:00:0{i}") for i in range(3)]
    second = [txn(10 + i, ts=f"2024-03-01 10:01:0{i}") for i in range(4)]
    got = rows(bursts.fraud_alerts(frame(first + second)).where("transaction_id = 10"), "transaction_count")
    assert got == [(3,), (4,)]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("hot", [{}, {"hot_rows": 4, "max_hot_groups": 1000}, {"hot_rows": 0, "max_hot_groups": 10**9}])
def test_alerts_equal_plain_count(frame, seed, closed, hot):
    records = random_records(seed)
    got = bursts.fraud_alerts(frame(records), end_inclusive=closed, **hot)
    assert rows(got, "transaction_count", "transaction_id") == tumbling(records, 60, 2, closed)


@pytest.mark.parametrize("seed", [4, 5])
@pytest.mark.parametrize("window, slide", [("1 minute", "1 second"), ("30 seconds", "10 seconds"), ("1 minute", "1 minute")])
@pytest.mark.parametrize("hot", [{}, {"hot_rows": 1, "max_hot_groups": 1000}])
def test_sliding_equals_plain_count(frame, monkeypatch, seed, window, slide, hot):
    monkeypatch.setattr(sliding, "CHUNK_WINDOWS", 2)
    size, step = (x // 1_000_000 for x in sliding.check_slide(window, slide))
    records = random_records(seed, n=150)
    flagged = sliding_windows(records, size, step, 2)
    windows = rows(sliding.sliding_windows(frame(records), window, slide), "customer_id", "window_start", "transaction_count")
    assert {(c, seconds(w)): n for c, w, n in windows} == flagged
    best = {}
    for r in records:
        start = seconds(r[2]) // step * step
        covering = [flagged.get((r[1], start - k * step), 0) for k in range(size // step)]
        if max(covering) > 2:
            best[r[0]] = max(covering)
    got = rows(sliding.sliding_alerts(frame(records), window, slide, **hot), "transaction_id", "transaction_count")
    assert got == sorted(best.items())


def test_sliding_before_1970(frame):
    df = frame([txn(i, ts=f"1969-12-31 23:59:{58 + i}") for i in range(2)] + [txn(2, ts="1970-01-01 00:00:00")])
    assert rows(sliding.sliding_alerts(df), "transaction_id", "transaction_count") == [(0, 3), (1, 3), (2, 3)]


def test_window_must_be_a_multiple_of_slide(frame):
    with pytest.raises(ValueError):
        sliding.sliding_alerts(frame([]), "1 minute", "7 seconds")


def test_halfopen_alerts_are_among_closed_ones(frame):
    df = frame(random_records(9))
    closed = bursts.fraud_alerts(df)
    assert bursts.fraud_alerts(df, end_inclusive=False).exceptAll(closed).count() == 0


@pytest.mark.parametrize("hot_rows", [0, 5, 10**6])
def test_join_groups_keeps_every_pair(spark, hot_rows):
    left = spark.range(1000).selectExpr("IF(id < 400, 0, id % 50) AS k", "id")
    groups = left.groupBy("k").count().where("k % 2 = 0").withColumnRenamed("count", "weight").selectExpr("k", "weight", "k * 10 AS tag")
    got = join_groups(left, groups, ["k"], "weight", hot_rows=hot_rows, max_hot_groups=20)
    assert rows(got, "k", "id", "tag") == rows(left.join(groups, "k"), "k", "id", "tag")


def test_reasons(frame):
    df = frame([txn(i, ts=f"2024-03-01 10:00:0{i}") for i in range(3)])
    got = bursts.with_reasons(bursts.fraud_alerts(df)).first()
    assert got.reason == "Withdrew amount more than 400 INR multiple times within small timeframe"
    assert got.reason_detail == (
        "1 has withdrawn 3 times under 1 minute of amount more than 400 rupees (Rs. 450.0)."
    )
