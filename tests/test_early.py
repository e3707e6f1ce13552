"""Early alerts and late rows, and the steps under full windows, against plain counts."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tests.conftest import rows
from tests.test_streams import Folder, message, stream
from txnlens.__main__ import main
from txnlens.functions.steps import fullest, merged
from txnlens.sinks.alerts import read_alerts
from txnlens.streaming import runner
from txnlens.streaming.early import early_alerts, early_handler


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "messages")


def run(spark, tmp_path, folder, files=1, **params):
    found = early_alerts(stream(spark, folder, files), **params)
    handle = early_handler(str(tmp_path / "alerts"), str(tmp_path / "late"))
    runner.start(found, handle, str(tmp_path / "checkpoint"), drain=True).awaitTermination()
    alerts = rows(read_alerts(spark, str(tmp_path / "alerts")), "transaction_id", "transaction_count", "batch_id")
    return alerts, rows(spark.read.parquet(str(tmp_path / "late")), "transaction_id", "quarantine_reason")


def plain_fullest(at, n, size):
    return [max(sum(c for b, c in zip(at, n, strict=True) if s <= b < s + size) for s in range(a - size + 1, a + 1)) for a in at]


def test_fullest_equals_all_windows():
    rng = np.random.default_rng(0)
    for size in (1, 2, 7, 30):
        for many in (1, 2, 3, 17, 40):
            at, n = merged(rng.integers(-40, 60, many), rng.integers(0, 4, many))
            assert fullest(at, n, size).tolist() == plain_fullest(at.tolist(), n.tolist(), size)
    assert len(fullest(np.empty(0, np.int64), np.empty(0, np.int64), 5)) == 0


def test_three_hours_of_seconds_are_judged_at_once():
    at = np.arange(10_800)
    start = time.perf_counter()
    assert fullest(at, np.ones(10_800, np.int64), 3600).max() == 3600
    assert time.perf_counter() - start < 1


def test_rows_leave_when_their_third_neighbour_arrives(spark, tmp_path, folder):
    folder.add(message(1, 10), message(2, 20), message(7, 20, customer=2))
    folder.add(message(3, 30))  # fills the window: all three leave, no sentinel needed
    folder.add(message(4, 40), message(5, 0, minute=5))
    alerts, late = run(spark, tmp_path, folder)
    assert alerts == [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 4, 2)]
    assert late == []


def test_late_rows_are_kept_and_a_restart_goes_on(spark, tmp_path, folder):
    folder.add(message(1, 10), message(2, 20))
    folder.add(message(5, 0, customer=3, minute=30))
    assert run(spark, tmp_path, folder) == ([], [])
    folder.add(message(3, 30), message(6, 10, customer=3, minute=30), message(8, 50, minute=28))
    folder.add(message(9, 20, customer=3, minute=30), message(10, 59, minute=28))
    alerts, late = run(spark, tmp_path, folder)
    # The watermark is 10:29:00 by then: customer 1's rows are behind it, customer 3's are not.
    assert [a[0] for a in alerts] == [5, 6, 9]
    assert late == [(3, "late"), (8, "late"), (10, "late")]


def test_command_line(spark, tmp_path, folder):
    folder.add(message(1, 10), message(2, 20))
    folder.add(message(3, 30), message(5, 0, customer=3, minute=30))
    folder.add(message(4, 40))
    alerts = str(tmp_path / "alerts")
    paths = ["--folder", str(folder.path), "--alerts", alerts, "--checkpoint", str(tmp_path / "c")]
    main(["alerts", *paths, "--early", "--per-batch", "1", "--drain"])
    assert rows(read_alerts(spark, alerts), "transaction_id") == [(1,), (2,), (3,)]
    assert rows(spark.read.parquet(f"{alerts}_late"), "transaction_id") == [(4,)]
    with pytest.raises(SystemExit):
        main(["alerts", *paths, "--early", "--per-batch-only"])


def test_a_row_is_reported_once_and_all_are_accounted_for(spark, tmp_path, folder):
    rng = np.random.default_rng(3)
    sent, newest, behind = [], 0, set()
    for number in range(8):
        mark = newest - 60
        seconds = rng.integers(max(0, newest - 120), newest + 90, 20)
        lines = []
        for i, second in enumerate(seconds.tolist()):
            txn = 100 * number + i
            sent.append((txn, int(rng.integers(3)), second, number))
            lines.append(message(txn, second % 60, customer=sent[-1][1], minute=second // 60))
            if number and second < mark:
                behind.add(txn)
        newest = max(newest, int(seconds.max()))
        folder.add(*lines)
    alerts, late = run(spark, tmp_path, folder)
    assert [x[0] for x in late] == sorted(behind)
    want = {}
    for upto in range(8):  # by plain counts over what had come in time by then
        for customer in range(3):
            mine = [(t, s) for t, c, s, b in sent if c == customer and b <= upto and t not in behind]
            for txn, second in mine:
                best = max(sum(start <= s < start + 60 for _, s in mine) for start in range(second - 59, second + 1))
                if best > 2 and txn not in want:
                    want[txn] = best
    assert {t: n for t, n, _ in alerts} == want and len(alerts) == len(want)
