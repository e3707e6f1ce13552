from __future__ import annotations

import os
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException

from tests.conftest import rows
from txnlens.__main__ import arguments, main
from txnlens.operators.bursts import fraud_alerts, large_withdrawals
from txnlens.operators.quality import split_valid
from txnlens.operators.sliding import sliding_alerts
from txnlens.sinks.alerts import latest_alerts, read_alerts
from txnlens.sources.lines import parse_lines
from txnlens.sources.streams import read_kafka, read_line_files
from txnlens.streaming import runner
from txnlens.streaming.alerts import flagged_steps, judge_spans, stateful_alerts


def message(number, second, customer=1, amount=450.0, kind="withdrawal", minute=0, hour=10):
    return f"{number},{customer},2024-03-01T{hour}:{minute:02d}:{second:02d}.000Z,{amount},{kind},success,1,{hour},atm"


SENTINEL = message(999, 0, customer=-1, hour=12)


class Folder:
    """Message files with increasing modification times."""

    def __init__(self, path):
        self.path, self.n = path, 0
        path.mkdir()

    def add(self, *lines):
        file = self.path / f"{self.n}.txt"
        file.write_text("\n".join(lines) + "\n")
        stamp = time.time() - 1000 + self.n
        os.utime(file, (stamp, stamp))
        self.n += 1


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "messages")


def stream(spark, folder, files_per_batch=None):
    lines = read_line_files(spark, str(folder.path), files_per_batch=files_per_batch)
    return large_withdrawals(parse_lines(lines, "stream"))


def batch(spark, folder):
    return large_withdrawals(parse_lines(spark.read.text(str(folder.path)), "stream"))


def run(spark, tmp_path, df, handler):
    runner.start(df, handler(str(tmp_path / "alerts")), str(tmp_path / "checkpoint"), drain=True).awaitTermination()
    return read_alerts(spark, str(tmp_path / "alerts"))


def test_parse_by_layout(spark):
    raw = spark.createDataFrame([("1,2,2024-03-01T10:00:00.000Z,450.5,withdrawal,atm,success",)], "value string")
    assert parse_lines(raw, "raw").first().channel == "atm"
    wrong = parse_lines(raw, "stream").first()
    assert (wrong.status, wrong.channel, wrong.txn_day) == ("atm", None, None)


def test_parse_bytes_and_malformed(spark):
    lines = [bytearray(message(1, 0).encode()), bytearray(b"2,x,yesterday"), bytearray(b"")]
    df = spark.createDataFrame([(x,) for x in lines], "value binary")
    valid, bad = split_valid(parse_lines(df, "stream", keep_corrupt=True))
    assert rows(valid, "transaction_id") == [(1,)]
    assert bad.count() == 2
    assert bad.where("quarantine_reason LIKE 'malformed%'").count() >= 1


def test_batch_alerts_equal_stream_alerts(spark, tmp_path, folder):
    folder.add(*[message(i, 10 + i) for i in range(3)], message(3, 0, minute=1), message(4, 5, amount=400.0))
    stored = run(spark, tmp_path, stream(spark, folder), runner.burst_handler)
    expected = fraud_alerts(batch(spark, folder))
    assert rows(stored, *expected.columns) == rows(expected)
    assert stored.count() == 4


def test_split_burst_is_missed_per_batch_and_seen_by_state(spark, tmp_path, folder):
    folder.add(message(1, 10), message(2, 20))
    folder.add(message(3, 30), message(7, 40, customer=2))
    folder.add(SENTINEL)
    per_batch = run(spark, tmp_path, stream(spark, folder, 1), runner.burst_handler)
    assert per_batch.count() == 0
    (tmp_path / "state").mkdir()
    found = run(spark, tmp_path / "state", stateful_alerts(stream(spark, folder, 1)), runner.store_handler)
    assert rows(found, "transaction_id", "customer_id") == [(1, 1), (2, 1), (3, 1)]


def test_stateful_alerts_equal_batch_over_window_borders(spark, tmp_path, folder):
    folder.add(*[message(i, (37 * i) % 60, customer=i % 3, minute=i // 12) for i in range(60)])
    folder.add(*[message(100 + i, (23 * i) % 60, customer=i % 2, minute=6 + i // 10) for i in range(40)])
    folder.add(SENTINEL)
    found = run(spark, tmp_path, stateful_alerts(stream(spark, folder, 1), salts=3), runner.store_handler)
    expected = sliding_alerts(batch(spark, folder))
    assert expected.count() > 10
    assert rows(found, *expected.columns) == rows(expected)


def test_stateful_alerts_with_more_salts_than_bits_and_without_ids(spark, tmp_path, folder):
    folder.add(*[message(i, i // 2) for i in range(100)], message("", 7), message("", 30, customer=2))
    folder.add(SENTINEL)
    found = run(spark, tmp_path, stateful_alerts(stream(spark, folder, 1), salts=70), runner.store_handler)
    expected = sliding_alerts(batch(spark, folder))
    found = found.select(*expected.columns)
    assert expected.count() == 101
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_flags_go_only_to_salts_that_have_rows(spark, folder):
    folder.add(*[message(i, 10 + i % 3) for i in range(9)], message("", 11), message(20, 5, customer=2))
    large = batch(spark, folder)
    salted = "DISTINCT unix_micros(txn_timestamp) AS step, CAST(pmod(xxhash64(transaction_id), 16) AS INT) AS salt"
    expected = rows(spark.sql(f"SELECT {salted} FROM {{large}} WHERE customer_id = 1", large=large))
    found = flagged_steps(large, "1 minute", "1 second", 2, salts=16)
    assert rows(found, "flag_step", "flag_salt") == expected
    assert len(expected) <= 10
    assert {r.flag_customer for r in found.collect()} == {1}


def test_spans_judged_together_equal_plain_counts():
    size, random = 60, np.random.default_rng(1)
    starts = [int(s) * size for s in random.integers(-5, 5, 40)]
    spans = []
    for start in starts:
        at = random.choice(3 * size, int(random.integers(0, 12)), replace=False)
        spans.append([{"at": start + int(a), "n": int(random.integers(0, 3)), "salts": 1 << i} for i, a in enumerate(at)])
    kind = pa.list_(pa.struct({"at": pa.int64(), "n": pa.int64(), "salts": pa.int64()}))

    def plain(span, start):
        full = {x["at"]: max(sum(y["n"] for y in span if w <= y["at"] < w + size) for w in range(x["at"] - size + 1, x["at"] + 1)) for x in span}
        middle = sorted((x["at"], x["salts"]) for x in span if start + size <= x["at"] < start + 2 * size and full[x["at"]] > 2)
        return [{"at": a, "count": full[a], "salts": s} for a, s in middle]

    expected = [plain(*x) for x in zip(spans, starts, strict=True)]
    assert sum(map(len, expected)) > 20
    for part in (slice(0, 40), slice(7, 19), slice(5, 5)):
        found = judge_spans(pa.array(spans, kind)[part], pa.array(starts, pa.int64())[part], size, 2)
        assert found.to_pylist() == expected[part]


def test_lines_are_parsed_once_under_filters(spark, folder):
    folder.add(message(1, 10))
    plan = batch(spark, folder).where("customer_id IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv(") == 1


def test_a_stream_has_partitions_of_its_own(spark, tmp_path, folder):
    folder.add(message(1, 10))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = stateful_alerts(stream(spark, folder))
    handle = runner.store_handler(str(tmp_path / "alerts"))
    query = runner.start(found, handle, str(tmp_path / "checkpoint"), drain=True, partitions=3)
    query.awaitTermination()
    assert {s.numShufflePartitions for s in query.recentProgress[0].stateOperators} == {3}
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_late_row_is_dropped(spark, tmp_path, folder):
    folder.add(message(1, 10), message(2, 20))
    # Spark drops what was late by the watermark of the batch before.
    folder.add(message(5, 0, customer=3, minute=30))
    folder.add(message(6, 0, customer=3, minute=31))
    folder.add(message(3, 30), message(7, 0, customer=3, minute=32))
    folder.add(SENTINEL)
    found = run(spark, tmp_path, stateful_alerts(stream(spark, folder, 1)), runner.store_handler)
    assert found.count() == 0


def test_restart_continues_from_the_checkpoint(spark, tmp_path, folder):
    folder.add(*[message(i, 10 + i) for i in range(3)])
    assert run(spark, tmp_path, stream(spark, folder), runner.burst_handler).count() == 3
    folder.add(*[message(10 + i, 10 + i, customer=2) for i in range(3)])
    stored = run(spark, tmp_path, stream(spark, folder), runner.burst_handler)
    assert rows(latest_alerts(stored), "transaction_id", "batch_id") == [(0, 0), (1, 0), (2, 0), (10, 1), (11, 1), (12, 1)]


def test_stream_quarantine(spark, tmp_path, folder):
    folder.add(message(1, 10), "2,x,yesterday", message(3, 10, amount="NaN"))
    lines = read_line_files(spark, str(folder.path))
    valid, bad = split_valid(parse_lines(lines, "stream", keep_corrupt=True))
    for name, part in (("valid", valid), ("bad", bad)):
        runner.start_parquet(part, str(tmp_path / name), str(tmp_path / f"{name}-c"), drain=True).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "valid")), "transaction_id") == [(1,)]
    assert rows(spark.read.parquet(str(tmp_path / "bad")), "transaction_id") == [(2,), (3,)]


def test_console(spark, tmp_path, folder):
    folder.add(message(1, 10))
    query = runner.start_console(stream(spark, folder), str(tmp_path / "checkpoint"), drain=True)
    query.awaitTermination()
    assert query.recentProgress[0].numInputRows == 1


def test_kafka_needs_its_package(spark):
    try:
        df = read_kafka(spark, "localhost:1", "transactions", minPartitions="8")
    except PySparkException as missing:
        assert "kafka" in str(missing).lower()
    else:
        assert "value" in df.columns


def test_command_line_sees_split_bursts_and_keeps_rejects(spark, tmp_path, folder, capsys):
    future = message(9, 0).replace("2024", "2999")
    folder.add(message(1, 10), message(2, 20), "2,x,yesterday", future)
    folder.add(message(3, 30), message(4, 10, customer=2, amount=350.0))
    folder.add(SENTINEL)
    alerts = str(tmp_path / "alerts")
    paths = ["--folder", str(folder.path), "--alerts", alerts, "--checkpoint", str(tmp_path / "c")]
    main(["alerts", *paths, "--per-batch", "1", "--drain"])
    assert rows(read_alerts(spark, alerts), "transaction_id") == [(1,), (2,), (3,)]
    rejected = spark.read.parquet(f"{alerts}_rejected")
    assert rows(rejected.where("quarantine_reason = 'future'"), "transaction_id") == [(9,)]
    assert rejected.where("quarantine_reason LIKE 'malformed%'").count() == 1
    assert rejected.count() == 2


def test_command_line(spark, tmp_path, folder, capsys):
    folder.add(*[message(i, 10 + i, kind="Withdrawal") for i in range(3)])
    alerts = str(tmp_path / "alerts")
    paths = ["--folder", str(folder.path), "--alerts", alerts, "--checkpoint", str(tmp_path / "c")]
    main(["alerts", *paths, "--per-batch", "5", "--per-batch-only", "--drain"])
    main(["scan", "--alerts", alerts])
    assert "1_2" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        arguments(["alerts", "--alerts", alerts])
    with pytest.raises(SystemExit):
        arguments(["alerts", "--kafka", "broker:9092", "--alerts", alerts, "--checkpoint", "c"])
