"""Alerts in the micro-batch in which a burst happens, and the rows that came too late.

State holds counts by customer and step and the rows that are in no burst yet. A
batch adds its rows to the counts; every row that a full window now covers leaves at
once, and never again. What lies a window behind the watermark can meet no row in
time any more and is forgotten. Customers are dealt to a fixed number of groups and a
group's customers are judged together, so what idle customers left goes with the next row of
their group: state is bounded by the steps of a window and the delay, and by as many rows as
their windows may hold without an alert. Rows behind the watermark are not
dropped, as built-in stateful operators do, but leave as late ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from txnlens.functions.durations import epoch_micros
from txnlens.functions.steps import fullest, merged
from txnlens.operators.sliding import check_slide
from txnlens.schema import ALERT_COLUMNS, BURST_COUNT, BURST_SLIDE, BURST_WINDOW
from txnlens.sinks.alerts import write_late_rows
from txnlens.streaming.runner import COMPACT_EVERY, BatchHandler, store

#: Groups that customers are dealt to; fixed for the life of a checkpoint.
GROUPS = 1024
ROW = ["customer_id", "transaction_id", "at", "amount", "channel"]
STATE = (
    "owners array<long>, steps array<long>, counts array<long>, customers array<long>, ids array<long>, times array<long>, "
    "amounts array<double>, channels array<string>"
)
FOUND = "kind string, transaction_count long, transaction_id long, customer_id long, at long, amount double, channel string"
ALERT, LATE = "alert", "late"


def judge_rows(new: pd.DataFrame, state: tuple | None, watermark: int, size: int, step: int, min_count: int):
    """(rows that leave, with ``kind`` and ``transaction_count``; the new state or None) for the rows of a group."""
    owners, steps, counts, *waiting = state or ([] for _ in range(8))
    behind = (new["at"] < watermark).to_numpy(bool)
    late = new[behind].assign(kind=LATE, transaction_count=pd.array([None] * int(behind.sum()), "Int64"))
    now = new[~behind]
    held = pd.DataFrame(dict(zip(ROW, waiting, strict=True))).astype(new.dtypes.to_dict())
    rows = pd.concat([held, now], ignore_index=True) if len(held) else now
    own = rows["at"].to_numpy(np.int64) // step * step
    n_held = len(held)
    owner = np.concatenate((np.asarray(owners, np.int64), rows["customer_id"].to_numpy(np.int64)))
    at = np.concatenate((np.asarray(steps, np.int64), own))
    # Rows that wait are counted already.
    n = np.concatenate((np.asarray(counts, np.int64), np.zeros(n_held, np.int64), now["transaction_id"].notna().to_numpy(np.int64)))
    alive = at > watermark // step * step - size
    if not alive.any():
        return late, None
    # Customers one after the other on one line of time, too far apart to share a window.
    customers, rank = np.unique(owner, return_inverse=True)
    low = int(at[alive].min())
    stride = int(at[alive].max()) - low + 2 * size
    line = rank * stride + (at - low)
    places, total = merged(line[alive], n[alive])
    most = fullest(places, total, size)
    mine, here = line[len(owners) :], alive[len(owners) :]
    count = np.where(here, most[np.minimum(np.searchsorted(places, mine), len(places) - 1)], 0)
    full = count > min_count
    alerts = rows[full].assign(kind=ALERT, transaction_count=pd.array(count[full], "Int64"))
    rest = rows[here & ~full]
    kept = [customers[places // stride].tolist(), (places % stride + low).tolist(), total.tolist()]
    left = (*kept, *[[None if pd.isna(x) else x for x in rest[c].tolist()] for c in ROW])
    return (pd.concat([late, alerts]) if len(late) else alerts), left


def early_alerts(
    rows: DataFrame,
    window: str = BURST_WINDOW,
    slide: str = BURST_SLIDE,
    min_count: int = BURST_COUNT,
    *,
    delay: str = BURST_WINDOW,
    groups: int = GROUPS,
) -> DataFrame:
    """The alert columns with ``kind``: ``alert`` rows in the batch that flags them, ``late`` rows behind the watermark.

    A row is reported once, with the highest count over it at that time. The watermark is ``delay`` behind the
    newest row of the batches before. Counts take rows with a transaction_id; rows without a customer or time are
    left out. The rows of a group in a batch are one task's, so the size of batches bounds a task.
    """
    size, step = check_slide(window, slide)
    timed = rows.filter("customer_id IS NOT NULL AND txn_timestamp IS NOT NULL").withWatermark("txn_timestamp", delay)
    # The time goes along, as it carries the watermark.
    sent = timed.select("customer_id", "txn_timestamp", "transaction_id", epoch_micros(F.col("txn_timestamp")).alias("at"), "amount", "channel")
    types = {"customer_id": "int64", "transaction_id": "Int64", "at": "int64", "amount": "float64", "channel": "object"}

    def judge(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(parts))[ROW].astype(types)
        watermark = state.getCurrentWatermarkMs() * 1000
        found, left = judge_rows(new, state.get if state.exists else None, watermark, size, step, min_count)
        if left:
            state.update(left)
        elif state.exists:
            state.remove()
        if len(found):
            yield found[[x.split()[0] for x in FOUND.split(", ")]]

    sent = sent.withColumn("group", F.pmod(F.xxhash64("customer_id"), F.lit(groups)))
    judged = sent.groupBy("group").applyInPandasWithState(judge, FOUND, STATE, "append", GroupStateTimeout.NoTimeout)
    return judged.withColumn("txn_timestamp", F.timestamp_micros("at")).select("kind", *ALERT_COLUMNS)


def early_handler(path: str, late_path: str, *, compact_every: int | None = COMPACT_EVERY) -> BatchHandler:
    """Stores alerts in the alert table and late rows, with their reason, in a folder of their own."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            store(batch.filter(F.col("kind") == ALERT).drop("kind"), batch_id, path, compact_every)
            write_late_rows(batch.filter(F.col("kind") == LATE).drop("kind", "transaction_count"), batch_id, late_path)
        finally:
            batch.unpersist()

    return handle
