"""Alerts for bursts in sliding event-time windows, across micro-batches.

A row lies in as many sliding windows as they have steps, 60 by default, so state
per window would be 60 times the rows. Here state is a count per customer and
step, those counts in three overlapping spans, and each row once.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.functions.durations import epoch_micros, floor_to, interval
from txnlens.functions.steps import fullest, merged
from txnlens.operators.sliding import check_slide
from txnlens.schema import ALERT_COLUMNS, BURST_COUNT, BURST_SLIDE, BURST_WINDOW


#: Salts that a count remembers one by one; more of them share these.
SALT_BITS = 62
#: Steps judged at once, so that temporary arrays stay small.
JUDGED_AT_ONCE = 1 << 18


def judge_spans(spans: pa.ListArray, starts: pa.Array, size: int, min_count: int) -> pa.ListArray:
    """Of spans that begin at ``starts``, the steps of the middle third under a window of more than ``min_count``,
    with the highest count. All spans are judged as one line of time, on which they are too far apart to share a
    window. Linear but for a logarithm."""
    steps, lengths = spans.flatten(), spans.value_lengths().to_numpy()
    at, n, salts = (steps.field(c).to_numpy() for c in ("at", "n", "salts"))
    span = np.repeat(np.arange(len(lengths)), lengths)
    line = span * (4 * size) + (at - starts.to_numpy()[span])
    places, counts = merged(line, n)
    masks = np.zeros(len(places), np.int64)
    np.bitwise_or.at(masks, np.searchsorted(places, line), salts)
    most = fullest(places, counts, size)
    owner, offset = places // (4 * size), places % (4 * size)
    kept = (offset >= size) & (offset < 2 * size) & (most > min_count)
    found = [starts.to_numpy()[owner[kept]] + offset[kept], most[kept], masks[kept]]
    ends = np.cumsum(np.bincount(owner[kept], minlength=len(lengths)))
    return pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], ends)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], ["at", "count", "salts"]),
    )


def _fullest_steps(size: int, min_count: int):
    """``judge_spans`` as a column, over so many spans at once as hold ``JUDGED_AT_ONCE`` steps, or one."""

    @F.arrow_udf("array<struct<at:long,count:long,salts:long>>")
    def judged(spans: pa.Array, starts: pa.Array) -> pa.Array:
        piece = np.cumsum(spans.value_lengths().to_numpy()) // JUDGED_AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(spans)]
        parts = [(spans.slice(a, b - a), starts.slice(a, b - a)) for a, b in itertools.pairwise(cuts)]
        return pa.concat_arrays([judge_spans(*part, size, min_count) for part in parts])

    return judged


def _salt(salts: int) -> Column:
    return F.pmod(F.xxhash64("transaction_id"), F.lit(salts)).cast("int")


def flagged_steps(rows: DataFrame, window: str, slide: str, min_count: int, salts: int) -> DataFrame:
    """Each step under a flagged window, once per customer and salt that its rows have, in append mode.

    Rows are counted per step, and their salts noted as bits. A span is three windows long and decides on the
    steps of its middle third, all of whose windows lie within it. It collects one
    entry per step, so its size is bounded by the number of steps in three windows.
    """
    size, _ = check_slide(window, slide)
    counts = rows.groupBy(F.window("txn_timestamp", slide).alias("step"), "customer_id").agg(
        F.count("transaction_id").alias("n"), F.bit_or(_bit(_salt(salts))).alias("salts")
    )
    entry = F.struct(epoch_micros(F.col("step.start")).alias("at"), "n", "salts")
    spans = (
        counts.groupBy(F.window("step", f"{3 * size} microseconds", window).alias("span"), "customer_id")
        .agg(F.collect_list(entry).alias("steps"), F.sum("n").alias("n"))
        .where(F.col("n") > min_count)
    )
    flagged = _fullest_steps(size, min_count)(F.col("steps"), epoch_micros(F.col("span.start")))
    present = F.filter(
        F.sequence(F.lit(0), F.lit(salts - 1)), lambda salt: F.col("flag.salts").bitwiseAND(_bit(salt)) != 0
    )
    return (
        spans.select(
            F.col("customer_id").alias("flag_customer"),
            F.window_time("span").alias("flag_time"),
            F.explode(flagged).alias("flag"),
        )
        .select(
            "flag_customer",
            "flag_time",
            F.col("flag.at").alias("flag_step"),
            F.col("flag.count").alias("transaction_count"),
            F.explode(present).alias("flag_salt"),
        )
    )


def _bit(salt: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(salt, F.lit(SALT_BITS)))


def stateful_alerts(
    rows: DataFrame,
    window: str = BURST_WINDOW,
    slide: str = BURST_SLIDE,
    min_count: int = BURST_COUNT,
    *,
    delay: str = BURST_WINDOW,
    salts: int = 16,
) -> DataFrame:
    """Rows of a stream that lie in a flagged window, each once, with the highest count over it.

    Steps are decided on when the watermark, ``delay`` behind the newest row, is up
    to two windows past them; rows later than the watermark are dropped. The rows
    of flagged steps come from a stream-stream join on customer and step;
    ``salts`` spreads those of one customer and step over that many tasks; a flag
    goes only to those that have rows of its step.
    """
    _, step = check_slide(window, slide)
    timed = rows.where(F.col("customer_id").isNotNull()).withWatermark("txn_timestamp", delay)
    flags = flagged_steps(timed, window, slide, min_count, salts)
    buffered = timed.select(
        *[c for c in ALERT_COLUMNS if c != "transaction_count"],
        floor_to(epoch_micros(F.col("txn_timestamp")), step).alias("step"),
        _salt(salts).alias("salt"),
    )
    same_step = (
        (F.col("customer_id") == F.col("flag_customer"))
        & (F.col("step") == F.col("flag_step"))
        & (F.col("salt") == F.col("flag_salt"))
    )
    # Implied by the step, which is in the span's middle; tells Spark how long to keep either side.
    in_middle = (F.col("txn_timestamp") > F.col("flag_time") - interval(window, 2)) & (
        F.col("txn_timestamp") <= F.col("flag_time") - interval(window)
    )
    return buffered.join(flags, same_step & in_middle).select(*ALERT_COLUMNS)
