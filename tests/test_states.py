"""Reports from daily states against the reports from the tables."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from tests.conftest import rows
from tests.test_days import HEADER, files
from tests.test_plans import plan, saved  # noqa: F401
from txnlens.operators.cleaning import clean
from txnlens.plans import states
from txnlens.plans.suite import build_reports, customer_rollup, time_rollup
from txnlens.plans.transform import load_days


def records(seed, n=600):
    """Some customers with many rows, missing values, all kinds of statuses, several months and years."""
    rng = random.Random(seed)
    start = dt.datetime(2023, 12, 20)
    out = []
    for i in range(n):
        ts = start + dt.timedelta(hours=rng.randrange(24 * 60), seconds=rng.randrange(3600))
        amount = rng.choice([None, 500.0, 500.01, round(rng.uniform(0, 1000), 2), 0.005, 3e12])
        out.append(
            (rng.choice([i, i, None]), rng.choice([1, 1, 1, 2, 3, None]), ts, amount, rng.choice(["withdrawal", "deposit"]))
            + (rng.choice(["atm", "online", "branch", None]), rng.choice(["failed", "failed", "success", "pending", None]))
        )
    return out


def by_states(*parts):
    state = states.daily_states(parts[0])
    for part in parts[1:]:
        state = state.unionByName(states.daily_states(part))
    return states.reports_from_states(state)


@pytest.mark.parametrize("seed", [1, 2])
def test_states_of_days_add_up_to_the_reports(frame, seed):
    table = records(seed)
    raw = frame(table)
    expected = build_reports(raw, clean(raw), customer_rollup(clean(raw)), time_rollup(clean(raw)))
    early = [r for r in table if r[2] < dt.datetime(2024, 1, 15)]
    late = [r for r in table if r[2] >= dt.datetime(2024, 1, 15)]
    found = by_states(frame(early), frame(late))
    assert set(found) == set(expected)
    for name, report in expected.items():
        wanted = sorted(map(repr, map(tuple, report.collect())))
        assert wanted, name
        assert sorted(map(repr, map(tuple, found[name].select(*report.columns).collect()))) == wanted, name


def test_empty_table_gives_empty_reports(frame):
    assert all(report.isEmpty() for report in by_states(frame([])).values())


def test_a_sum_that_one_day_cannot_give_is_null(frame):
    moment = dt.datetime(2024, 3, 1, 10)
    table = [(i, 1, moment + dt.timedelta(days=i), a, "deposit", "atm", "success") for i, a in enumerate([1.0, float("inf")])]
    assert rows(by_states(frame(table))["monthly_volume"], "total_amount_transfered") == [(None,)]


def test_states_take_one_scan_and_one_shuffle(saved):  # noqa: F811
    text = plan(states.daily_states(saved))
    assert text.count("FileScan") == 1
    assert text.count("Exchange") == 1
    assert "Python" not in text


def deliver(path, *lines):
    path.mkdir()
    (path / "part.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def line(number, day, customer=1, channel="ATM", status="success"):
    return f"{number},{customer},2024-03-{day:02d} 10:00:00,600,Deposit,{channel},{status}"


def test_only_states_of_days_that_arrive_change(spark, tmp_path, db):
    where = {"db": db, "location": str(tmp_path)}
    states.update_states(spark, load_days(spark, deliver(tmp_path / "a", line(1, 1), line(2, 2), line(3, 2)), **where), **where)
    before = files(tmp_path, states.STATES_TABLE)
    for _ in range(2):  # a run that is repeated changes nothing
        states.update_states(spark, load_days(spark, deliver_again(tmp_path / "b", line(4, 2), line(5, 3)), **where), **where)
    after = files(tmp_path, states.STATES_TABLE)
    kept = {name: time for name, time in before.items() if "2024-03-01" in name}
    assert kept and kept.items() <= after.items()
    states.run_reports_from_states(spark, **where)
    assert rows(spark.read.table(f"{db}.day_wise_txn_volume"), "txn_day", "no_of_transaction") == [(1, 1), (2, 1), (3, 1)]
    assert rows(spark.read.table(f"{db}.top_five_customers")) == [(1, 3)]


def deliver_again(path, *lines):
    return str(path) if os.path.exists(path) else deliver(path, *lines)
