"""Tables that are published together: all of a run or all of the run before."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, txn
from txnlens.operators.cleaning import clean
from txnlens.plans import suite
from txnlens.schema import REPORT_TABLES
from txnlens.sinks.editions import name_tables, publish, published
from txnlens.sinks.tables import create_database, save_table


def numbers(spark, n):
    return {name: spark.range(n).withColumnRenamed("id", name) for name in ("a", "b", "c")}


def counts(spark, path):
    return {name: df.count() for name, df in published(spark, path).items()}


def failing(df):
    return df.withColumn("bad", F.raise_error(F.lit("no")).cast("long"))


def test_a_failure_leaves_the_edition_before(spark, tmp_path):
    path = str(tmp_path / "set")
    assert published(spark, path) == {}
    assert publish(numbers(spark, 3), path) == 1
    bad = numbers(spark, 4)
    with pytest.raises(Exception, match="no") as caught:
        publish(bad | {"c": failing(bad["c"])}, path)
    assert "table c was not written" in str(caught.value.__notes__)
    assert counts(spark, path) == {"a": 3, "b": 3, "c": 3}
    assert [n for n in os.listdir(path) if n.startswith("edition-")] == [n for n in os.listdir(path) if "000000001" in n]


def test_readers_of_the_edition_before_can_go_on(spark, tmp_path):
    path = str(tmp_path / "set")
    for n in range(1, 6):
        open_before = published(spark, path)
        assert publish(numbers(spark, n), path) == n
        assert all(df.count() == n - 1 for df in open_before.values())
    assert counts(spark, path) == {"a": 5, "b": 5, "c": 5}
    assert len([n for n in os.listdir(path) if n.startswith("edition-")]) == 2


def test_the_slower_of_two_runs_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    from txnlens.sinks import editions

    seen = editions._numbers

    def late(folder):
        found = seen(folder)
        monkeypatch.setattr(editions, "_numbers", seen)
        publish(numbers(spark, 7), path)  # another run, from start to end
        return found

    monkeypatch.setattr(editions, "_numbers", late)
    with pytest.raises(RuntimeError, match="another run"):
        publish(numbers(spark, 2), path)
    assert counts(spark, path) == {"a": 7, "b": 7, "c": 7}


def test_names_follow_and_survive_new_columns(spark, tmp_path, db):
    path = str(tmp_path / "set")
    create_database(spark, db, str(tmp_path / "db"))
    for n in (2, 5):
        publish(numbers(spark, n), path)
        assert name_tables(spark, path, db) == ["a", "b", "c"]
        assert spark.read.table(f"{db}.a").count() == n
    publish({"a": spark.range(3).withColumn("more", F.lit("x"))}, path)
    name_tables(spark, path, db)
    assert spark.read.table(f"{db}.a").columns == ["id", "more"]


def test_a_failing_report_leaves_all_ten_old_tables(spark, frame, db, tmp_path, monkeypatch):
    where = {"db": db, "location": str(tmp_path)}
    create_database(spark, db, str(tmp_path / "db"))

    def save(n):
        raw = frame([txn(i, customer=i % 2, channel=("atm", "online")[i % 2], status=("success", "failed")[i % 5 == 0]) for i in range(n)])
        save_table(raw, "raw_transactions", **where)
        save_table(clean(raw), "transactions", **where)

    def tables():
        return {t: rows(spark.read.table(f"{db}.{t}")) for t in REPORT_TABLES.values()}

    save(40)
    suite.run_reports(spark, **where)
    before = tables()
    save(80)
    whole = suite.build_reports
    monkeypatch.setattr(suite, "build_reports", lambda *a: (r := whole(*a)) | {"all_channels_in_week": failing(r["all_channels_in_week"].select(F.lit(1)).limit(1).unionAll(spark.range(1)))})
    with pytest.raises(Exception, match="no"):
        suite.run_reports(spark, **where)
    assert tables() == before
    monkeypatch.setattr(suite, "build_reports", whole)
    suite.run_reports(spark, **where)
    assert tables() != before
