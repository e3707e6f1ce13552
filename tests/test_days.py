"""Loading by day: what arrives is replaced, everything else stays as it is."""

from __future__ import annotations

import datetime as dt
import os

import pytest

from tests.conftest import rows
from txnlens.__main__ import arguments, main
from txnlens.plans.transform import load_days
from txnlens.sinks import tables

HEADER = "transaction_id,customer_id,timestamp,amount,transaction_type,channel,status"


def deliver(path, *lines):
    path.mkdir()
    (path / "part.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def line(number, day, amount="10.5", status="success", channel="ATM"):
    return f"{number},1,2024-03-{day:02d} 10:00:00,{amount},Deposit,{channel},{status}"


def files(location, table):
    found = {}
    for folder, _, names in os.walk(f"{location}/{table}"):
        found |= {f"{folder}/{n}": os.stat(f"{folder}/{n}").st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def test_only_the_days_that_arrive_change(spark, tmp_path, db):
    where = {"db": db, "location": str(tmp_path)}
    first = deliver(tmp_path / "a", line(1, 1), line(2, 2), line(3, 2, channel="Online"), line(4, 3, status="failed"))
    assert load_days(spark, first, **where) == ["2024-03-01", "2024-03-02", "2024-03-03"]
    before = files(tmp_path, "transactions") | files(tmp_path, "raw_transactions")
    second = deliver(tmp_path / "b", line(5, 2), line(6, 4), line(7, 4, amount="odd"))
    assert load_days(spark, second, **where) == ["2024-03-02", "2024-03-04"]
    assert rows(spark.read.table(f"{db}.transactions"), "transaction_id", "channel") == [(1, "atm"), (5, "atm"), (6, "atm")]
    assert rows(spark.read.table(f"{db}.raw_transactions"), "transaction_id") == [(1,), (4,), (5,), (6,)]
    assert rows(spark.read.table(f"{db}.rejected_transactions"), "transaction_id") == [(7,)]
    after = files(tmp_path, "transactions") | files(tmp_path, "raw_transactions")
    others = {name: time for name, time in before.items() if "2024-03-02" not in name}
    assert others and others.items() <= after.items()
    plan = spark.read.table(f"{db}.transactions").where("txn_date = DATE'2024-03-04'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(txn_date" in plan


def test_a_day_whose_rows_all_failed_goes_from_the_clean_table(spark, tmp_path, db):
    where = {"db": db, "location": str(tmp_path)}
    load_days(spark, deliver(tmp_path / "a", line(1, 1), line(2, 2)), **where)
    load_days(spark, deliver(tmp_path / "b", line(3, 2, status="failed")), **where)
    assert rows(spark.read.table(f"{db}.transactions"), "transaction_id") == [(1,)]
    assert load_days(spark, deliver(tmp_path / "c"), **where) == []
    load_days(spark, deliver(tmp_path / "d", line(4, 2)), **where)
    load_days(spark, str(tmp_path / "d"), **where)  # once more
    assert rows(spark.read.table(f"{db}.transactions"), "transaction_id", "txn_date") == [(1, dt.date(2024, 3, 1)), (4, dt.date(2024, 3, 2))]


def test_command_line(spark, tmp_path, db):
    csv = deliver(tmp_path / "a", line(1, 1))
    main(["transform", "--csv", csv, "--db", db, "--location", str(tmp_path), "--by-day"])
    assert spark.read.table(f"{db}.transactions").count() == 1
    with pytest.raises(SystemExit):
        arguments(["transform", "--csv", csv, "--db", db, "--location", "x", "--by-day", "--keep-incomplete"])


def test_rows_are_checked_against_the_declared_types(spark):
    declared = spark.createDataFrame([], "a bigint, b double, c string").schema
    df = spark.createDataFrame([("x", 1, 2.0)], "C string, a int, b float")
    assert tables.as_declared(df, declared).dtypes == [("a", "bigint"), ("b", "double"), ("c", "string")]
    with pytest.raises(TypeError, match="b: string for double"):
        tables.as_declared(spark.createDataFrame([(1, "2", "x")], "a int, b string, c string"), declared)
    with pytest.raises(TypeError, match="a: double for bigint"):
        tables.as_declared(spark.createDataFrame([(1.0, 2.0, "x")], "a double, b double, c string"), declared)
    with pytest.raises(ValueError, match="'c', 'd'"):
        tables.as_declared(spark.createDataFrame([(1, 2.0, "x")], "a int, b double, d string"), declared)


def test_a_filled_table_keeps_its_declaration(spark, tmp_path, db):
    declared = spark.createDataFrame([], "a bigint, b double, c string").schema
    tables.create_database(spark, db, str(tmp_path / "db"))
    tables.create_table(spark, "t", declared, db=db, location=str(tmp_path), partition_by=["c"])
    for number in (1, 2):
        tables.fill_table(spark.createDataFrame([(str(number), number, 2.0)], "C string, a int, b float"), "t", db=db)
    assert spark.read.table(f"{db}.t").schema == declared
    assert rows(spark.read.table(f"{db}.t"), "a", "c") == [(2, "2")]
