from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows, txn
from txnlens.__main__ import main
from txnlens.functions.durations import micros
from txnlens.operators.cleaning import clean, normalize
from txnlens.operators.quality import quarantine_counts, split_valid
from txnlens.plans.suite import run_reports
from txnlens.plans.transform import build_tables
from txnlens.schema import RAW_TABLE, REPORT_TABLES, layout
from txnlens.session import scratch_dir
from txnlens.sinks import alerts as alert_table
from txnlens.sinks.tables import create_database, create_table, save_table
from txnlens.sources.catalog import load_table, table_partitions
from txnlens.sources.files import read_transactions

HEADER = "transaction_id,customer_id,timestamp,amount,transaction_type,channel,status"
LINES = [
    "1,10,2024-03-01T10:00:00.000Z,450.5,Withdrawal,ATM,success",
    "2,10,2024-03-01T11:00:00.000Z,,deposit,Online,success",
    "3,10,2024-03-01T12:00:00.000Z,much,deposit,Online,success",
    "4,10,2024-03-01T12:00:00.000Z",
    "5,,2024-03-01T12:00:00.000Z,NaN,deposit,Branch,",
    "6,11,2024-03-01T12:00:00.000Z,12,deposit,Branch,failed",
]


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "transactions.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_quarantine_gives_every_reason(spark, csv):
    valid, quarantined = split_valid(read_transactions(spark, csv))
    assert valid.columns == layout("raw").names
    assert rows(valid, "transaction_id", "amount") == [(1, 450.5), (6, 12.0)]
    assert rows(quarantined, "transaction_id", "quarantine_reason") == [
        (2, "amount"),
        (3, "malformed,amount"),
        (4, "malformed,amount,transaction_type,channel,status"),
        (5, "customer_id,amount,status"),
    ]
    assert rows(quarantine_counts(read_transactions(spark, csv)).where("reason = 'valid'")) == [("valid", 2)]


def test_bad_values_are_found_even_if_their_column_is_not_selected(spark, csv):
    valid, _ = split_valid(read_transactions(spark, csv))
    assert rows(valid, "channel") == [("ATM",), ("Branch",)]
    assert valid.count() == 2


def test_unexpected_header_is_an_error(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text(HEADER.replace("channel,status", "status,channel") + "\n" + LINES[0] + "\n")
    with pytest.raises(Exception, match="does not conform to the schema"):
        read_transactions(spark, str(path)).collect()


def test_inferred_types(spark, tmp_path):
    path = tmp_path / "good.csv"
    path.write_text("\n".join([HEADER, LINES[0], LINES[5]]) + "\n")
    df = read_transactions(spark, str(path), infer=True)
    assert df.columns == layout("raw").names
    assert dict(df.dtypes)["txn_timestamp"] == "timestamp"
    assert rows(df.drop("txn_timestamp")) == rows(split_valid(read_transactions(spark, str(path)))[0].drop("txn_timestamp"))


def test_unknown_layout():
    with pytest.raises(ValueError):
        layout("other")


def test_build_tables_is_rerun_safe(spark, csv, db, tmp_path):
    for _ in range(2):
        build_tables(spark, csv, db=db, location=str(tmp_path / "tables"), quarantine_table="quarantine")
        assert rows(load_table(spark, "transactions", db), "transaction_id", "channel", "txn_hour") == [(1, "atm", 10)]
        assert rows(load_table(spark, "raw_transactions", db), "transaction_id", "status") == [(1, "success"), (6, "failed")]
        assert load_table(spark, "quarantine", db).count() == 4
    assert load_table(spark, "transactions", db).columns[-1] == "channel"


def test_incomplete_rows_can_stay_in_the_raw_table(spark, csv, db, tmp_path):
    build_tables(spark, csv, db=db, location=str(tmp_path / "tables"), keep_incomplete=True)
    assert load_table(spark, "raw_transactions", db).count() == 6
    assert rows(load_table(spark, "transactions", db), "transaction_id") == [(1,)]


def test_declared_table_and_partitions(spark, db, tmp_path, frame):
    location = str(tmp_path / "tables")
    create_database(spark, db)
    for _ in range(2):
        create_table(spark, RAW_TABLE, layout("raw"), db=db, location=location, partition_by=["channel"])
    assert load_table(spark, RAW_TABLE, db).count() == 0
    save_table(frame([txn(1), txn(2, channel="online")]), RAW_TABLE, db=db, location=location, partition_by=["channel"])
    assert rows(table_partitions(spark, RAW_TABLE, db)) == [("channel=atm",), ("channel=online",)]
    pruned = load_table(spark, RAW_TABLE, db).where("channel = 'atm'")
    assert "PartitionFilters: [isnotnull(channel" in pruned._jdf.queryExecution().executedPlan().toString()


def test_append_and_overwrite(spark, db, tmp_path, frame):
    create_database(spark, db)
    for mode, expected in (("overwrite", 1), ("append", 2), ("overwrite", 1)):
        save_table(frame([txn(1)]), "t", db=db, location=str(tmp_path / "tables"), mode=mode)
        assert load_table(spark, "t", db).count() == expected


def test_rebalanced_table_keeps_all_rows(spark, db, tmp_path, frame):
    create_database(spark, db)
    df = frame([txn(i, ts=f"2024-03-{1 + i % 20:02d} 10:00:00") for i in range(200)]).withColumn("txn_date", F.to_date("txn_timestamp"))
    save_table(df, "t", db=db, location=str(tmp_path / "tables"), partition_by=["channel", "txn_date"], rebalance=True)
    assert load_table(spark, "t", db).count() == 200
    assert table_partitions(spark, "t", db).count() == 20


def test_reports_run_twice_leaves_tables_unchanged(spark, db, tmp_path, frame):
    location = str(tmp_path / "tables")
    create_database(spark, db)
    raw = normalize(frame([txn(i, i % 7, status="failed" if i % 3 == 0 else "success", channel="ATM") for i in range(100)]))
    save_table(raw, "raw_transactions", db=db, location=location, partition_by=["channel"])
    save_table(clean(raw), "transactions", db=db, location=location, partition_by=["channel"])
    seen = []
    for _ in range(2):
        assert sorted(run_reports(spark, db=db, location=location)) == sorted(REPORT_TABLES.values())
        seen.append({t: rows(load_table(spark, t, db)) for t in REPORT_TABLES.values()})
    assert seen[0] == seen[1]
    assert seen[0]["top_five_customers"]


def test_command_line_builds_tables_and_reports(spark, csv, db, tmp_path):
    where = ["--db", db, "--location", str(tmp_path / "tables")]
    main(["transform", "--csv", csv, *where, "--quarantine-table", "rejected"])
    main(["reports", *where])
    assert load_table(spark, "rejected", db).count() == 4
    assert rows(load_table(spark, "avg_txn_amt_by_channel", db)) == [("atm", 450.5)]
    main(["reports", *where, "--mode", "append"])
    assert load_table(spark, "avg_txn_amt_by_channel", db).count() == 2


def alert(number, count, customer=1):
    return (count, number, customer, txn(0)[2], 450.0, "atm")


ALERT = "transaction_count long, transaction_id long, customer_id long, txn_timestamp timestamp, amount double, channel string"


def test_alert_versions(spark, tmp_path):
    path = str(tmp_path / "alerts")
    for batch in range(6):
        alert_table.write_alert_batch(spark.createDataFrame([alert(1, 3 + batch)], ALERT), batch, path)
    alert_table.write_alert_batch(spark.createDataFrame([alert(2, 3)], ALERT), 6, path)
    stored = alert_table.read_alerts(spark, path)
    assert rows(alert_table.alert_versions(stored), "row_key", "version", "transaction_count") == [
        ("1_1", 1, 8),
        ("1_1", 2, 7),
        ("1_1", 3, 6),
        ("1_1", 4, 5),
        ("1_2", 1, 3),
    ]
    assert rows(alert_table.latest_alerts(stored), "row_key", "transaction_count") == [("1_1", 8), ("1_2", 3)]
    history = {r.row_key: [v.transaction_count for v in r.versions] for r in alert_table.alert_history(stored).collect()}
    assert history == {"1_1": [8, 7, 6, 5], "1_2": [3]}


def test_rerun_of_a_batch_replaces_it(spark, tmp_path):
    path = str(tmp_path / "alerts")
    for _ in range(2):
        alert_table.write_alert_batch(spark.createDataFrame([alert(1, 3), alert(1, 4), alert(2, 3)], ALERT), 0, path)
        alert_table.write_alert_batch(spark.createDataFrame([], ALERT), 1, path)
    assert rows(alert_table.read_alerts(spark, path), "row_key", "transaction_count") == [("1_1", 4), ("1_2", 3)]


def test_durations():
    assert micros("1 minute") == 60_000_000
    assert micros("7 days") == micros("1 week")
    for bad in ("minute", "0 seconds", "1 fortnight", ""):
        with pytest.raises(ValueError):
            micros(bad)


def test_scratch_folder_is_the_shared_one(spark):
    path = scratch_dir(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch_dir(spark, "x")
