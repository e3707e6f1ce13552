"""The alert table over many batches, compactions, retries and readers in between."""

from __future__ import annotations

import os

import pytest

from tests.conftest import at, rows
from txnlens.__main__ import main
from txnlens.sinks import alerts as alert_table

ALERT = "transaction_count long, transaction_id long, customer_id long, txn_timestamp timestamp, amount double, channel string"


def batch(spark, number, keys=range(6)):
    """Alerts of some keys, a new count in each batch; key 0 is in every batch, key k in every k-th."""
    found = [(10 + number, k, 1, at("2024-03-01 10:00:00"), 450.0, "atm") for k in keys if number % max(k, 1) == 0]
    return spark.createDataFrame(found, ALERT)


def expected(numbers, keep=4):
    out = []
    for k in range(6):
        mine = sorted((n for n in numbers if n % max(k, 1) == 0), reverse=True)[:keep]
        out += [(f"1_{k}", n, 10 + n, version) for version, n in enumerate(mine, 1)]
    return sorted(out)


def stored(spark, path):
    versions = alert_table.alert_versions(alert_table.read_alerts(spark, path))
    return rows(versions, "row_key", "batch_id", "transaction_count", "version")


def files(path):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(path) for name in names)


def test_compactions_change_nothing_but_the_files(spark, tmp_path):
    path, listed = str(tmp_path / "alerts"), []
    for number in range(12):
        alert_table.write_alert_batch(batch(spark, number), number, path)
        if number % 3 == 2:
            assert alert_table.compact_alerts(spark, path) == number
            alert_table.write_alert_batch(batch(spark, number), number, path)  # the last batch again
            assert alert_table.compact_alerts(spark, path) is None
            listed.append((files(path), *[sum(name[0] != "." for name in os.listdir(f"{path}/{of}")) for of in ("", "_manifest")]))
        assert stored(spark, path) == expected(range(number + 1))
    assert alert_table.read_alerts(spark, path).count() <= 6 * 4
    assert listed[-1] == listed[-2] and listed[-1][2] <= 2


def test_a_reader_that_comes_late_still_finds_its_segments(spark, tmp_path):
    path = str(tmp_path / "alerts")
    for number in range(3):
        alert_table.write_alert_batch(batch(spark, number), number, path)
    before = alert_table.alert_versions(alert_table.read_alerts(spark, path))
    alert_table.compact_alerts(spark, path)
    assert rows(before, "row_key", "batch_id", "transaction_count", "version") == expected(range(3))


def test_a_failed_compaction_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "alerts")
    for number in range(2):
        alert_table.write_alert_batch(batch(spark, number), number, path)
    monkeypatch.setattr(alert_table.Folder, "write_text", lambda *_: False)  # another one was faster
    assert alert_table.compact_alerts(spark, path) is None
    assert not any(name.startswith("base") for name in os.listdir(path))
    monkeypatch.setattr(alert_table.Folder, "write_text", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        alert_table.compact_alerts(spark, path)
    assert stored(spark, path) == expected(range(2))  # a base that no manifest names is not read
    monkeypatch.undo()
    assert alert_table.compact_alerts(spark, path) == 1
    assert stored(spark, path) == expected(range(2))
    alert_table.write_alert_batch(batch(spark, 2), 2, path)
    assert alert_table.compact_alerts(spark, path) == 2
    assert sum(name.startswith("base") for name in os.listdir(path)) == 2  # the current one and the one before


def test_a_batch_in_writing_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alert_table.write_alert_batch(batch(spark, 0), 0, path)
    batch(spark, 1).write.parquet(f"{path}/_staging/tail-000000000001-draft")
    assert stored(spark, path) == expected([0])
    alert_table.write_alert_batch(batch(spark, 1, [0]), 1, path)
    alert_table.write_alert_batch(batch(spark, 1), 1, path)  # run again before any compaction
    assert stored(spark, path) == expected(range(2))


def test_a_new_stream_cannot_write_into_an_old_table(spark, tmp_path):
    path = str(tmp_path / "alerts")
    for number in range(2):
        alert_table.write_alert_batch(batch(spark, number), number, path)
    alert_table.compact_alerts(spark, path)
    with pytest.raises(ValueError):
        alert_table.write_alert_batch(batch(spark, 0), 0, path)


def test_the_catalog_name_follows_the_table(spark, tmp_path, db):
    path = str(tmp_path / "alerts")
    alert_table.write_alert_batch(batch(spark, 0), 0, path)
    name = alert_table.publish_alerts(spark, path, db)
    assert name == f"{db}.suspicious_transaction"
    for number in range(1, 8):
        alert_table.write_alert_batch(batch(spark, number), number, path)
        if number % 3 == 0:
            main(["compact", "--alerts", path, "--db", db])
        seen = spark.read.table(name)
        assert rows(seen, "row_key", "batch_id", "transaction_count", "version") == expected(range(number + 1))
    assert {t.name for t in spark.catalog.listTables(db)} == {"suspicious_transaction"}
    spark.sql(f"DROP VIEW {name}")
