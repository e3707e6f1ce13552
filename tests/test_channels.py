"""Channel sets as masks, the last week from daily tables, and summaries of fields of any type."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, txn
from tests.test_days import deliver, line
from tests.test_plans import plan
from txnlens.operators import channels
from txnlens.operators.cleaning import clean_transactions
from txnlens.operators.summary import channel_sets, describe_fields
from txnlens.plans import reports
from txnlens.plans.states import last_week_from_days, newest_micros, update_states
from txnlens.plans.transform import load_days


@pytest.mark.parametrize("n", [1, 3, 63, 64, 65, 130])
@pytest.mark.parametrize("most", [channels.MOST_CHANNELS, 0])
def test_sets_of_any_number_of_channels(spark, monkeypatch, n, most):
    monkeypatch.setattr(channels.channel_dictionary, "__defaults__", (most,))
    rng = random.Random(n)
    names = [f"c{i:03d}" for i in range(n)]
    used = {0: names, 1: names[:-1], 2: names[1:], **{k: rng.sample(names, rng.randint(0, n)) for k in range(3, 8)}}
    pairs = [(k, c) for k, found in used.items() for c in found * 2] + [(k, None) for k in used]
    df = spark.createDataFrame(pairs, "k int, channel string").repartition(3)
    expected = {k: ",".join(sorted(set(found))) for k, found in used.items()}
    assert dict(rows(channels.set_texts(df, "k"))) == expected
    every = sorted((k,) for k, found in used.items() if len(set(found)) == n)
    assert rows(channels.users_of_every_channel(df, df, "k")) == every


def test_no_channel_in_use(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, channel string")
    assert rows(channels.users_of_every_channel(df, df, "k")) == [(1,), (2,)]  # all of none
    assert rows(channels.set_texts(df, "k")) == [(1, ""), (2, "")]
    assert rows(channels.set_texts(df.limit(0), "k")) == []


def test_one_shuffle(frame):
    df = clean_transactions(frame([txn(i, i % 7, channel="abc"[i % 3]) for i in range(50)]))
    for found in (reports.all_channels_in_week(df), channel_sets(df)):
        assert plan(found).count("Exchange hashpartitioning") == 1
        assert "partial_bit_or" in plan(found)


def test_last_week_reads_the_days_of_the_window(spark, tmp_path, db):
    where = {"db": db, "location": str(tmp_path)}
    first = deliver(tmp_path / "a", line(1, 1), line(2, 2, channel="Branch"), line(3, 20), line(4, 21, channel="Online"))
    update_states(spark, load_days(spark, first, **where), **where)
    assert rows(last_week_from_days(spark, db=db)) == []  # the branch counts though it is not in the window
    second = deliver(tmp_path / "b", line(5, 22, channel="Branch"), line(6, 23, status="failed"))
    update_states(spark, load_days(spark, second, **where), **where)
    found = last_week_from_days(spark, db=db)
    assert rows(found) == [(1,)]
    assert newest_micros(spark, db) == 1711101600000000  # 2024-03-22 10:00, not the failed one
    clean = spark.read.table(f"{db}.transactions")
    as_of = clean.agg(F.max("txn_timestamp")).scalar()
    assert rows(found) == rows(reports.all_channels_in_week(clean, as_of=as_of))
    text = plan(found)
    scans = [x for x in text.splitlines() if "FileScan" in x and "transactions" in x]
    assert len(scans) == 1 and "2024-03-15" in scans[0] and "2024-03-22" in scans[0]


def test_newest_day_without_rows(spark, tmp_path, db):
    where = {"db": db, "location": str(tmp_path)}
    update_states(spark, load_days(spark, deliver(tmp_path / "a"), **where), **where)
    assert newest_micros(spark, db) is None
    assert rows(last_week_from_days(spark, db=db)) == []
    load_days(spark, deliver(tmp_path / "b", line(1, 1)), **where)
    spark.sql(f"ALTER TABLE {db}.transactions ADD PARTITION (txn_date = '2024-05-01')")
    assert newest_micros(spark, db) == 1709287200000000


def test_fields_of_any_type(spark):
    df = spark.createDataFrame(
        [(1, 2.5, "b", True, [1]), (3, None, "é", False, [2]), (None, 7.5, None, None, None)],
        "a int, `x.y` double, c string, d boolean, e array<int>",
    )
    assert rows(describe_fields(df)) == [
        ("a", 2, 2.0, 1.4142, "1", "3"),
        ("c", 2, None, None, "b", "é"),
        ("d", 2, None, None, "false", "true"),
        ("x.y", 2, 5.0, 3.5355, "2.5", "7.5"),
    ]
    assert rows(describe_fields(df.limit(0), ["c"])) == [("c", 0, None, None, None, None)]
    with pytest.raises(TypeError, match="'e'"):
        describe_fields(df, ["a", "e"])
