"""Bursts in sliding windows.

A window of one minute that slides by a second covers each row 60 times. Rows
are therefore counted per slide step first, and steps are judged without being
spread over windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlens.functions.durations import epoch_micros, floor_to, micros
from txnlens.operators.matching import join_groups
from txnlens.schema import ALERT_COLUMNS, BURST_COUNT, BURST_SLIDE, BURST_WINDOW

STEP = ["customer_id", "step"]
CHUNK_WINDOWS = 16


def check_slide(window: str, slide: str) -> tuple[int, int]:
    """Lengths in microseconds; a window has to be a whole number of steps."""
    size, step = micros(window), micros(slide)
    if size % step:
        raise ValueError(f"window {window!r} is not a multiple of slide {slide!r}")
    return size, step


def _step_counts(df: DataFrame, slide: str) -> tuple[DataFrame, DataFrame]:
    step = F.window("txn_timestamp", slide).getField("start")
    rows = df.where(F.col("customer_id").isNotNull()).withColumn("step", step)
    counts = rows.groupBy(*STEP).agg(
        F.count("transaction_id").alias("n"), F.count(F.lit(1)).alias("weight")
    )
    return rows, counts


def _fullest_window(counts: DataFrame, size: int, step: int) -> DataFrame:
    """Per step, the highest count of any window that covers it, as ``transaction_count``.

    The fullest window over a step can be taken to start at a step with rows, so
    one range frame forward counts the windows and one backward takes the best.
    Customers are cut into chunks of time that overlap by one window on each
    side; a chunk has a fixed number of steps, however many rows there are.
    """
    reach, span = size - step, CHUNK_WINDOWS * size
    at = epoch_micros(F.col("step"))
    chunks = F.sequence(
        floor_to(at - reach, span), floor_to(at + reach, span), F.lit(span).cast("long")
    )
    in_chunk = Window.partitionBy("customer_id", "chunk").orderBy("at")
    return (
        counts.select("*", at.alias("at"), F.explode(chunks).alias("chunk"))
        .withColumn("from_here", F.sum("n").over(in_chunk.rangeBetween(0, reach)))
        .withColumn("transaction_count", F.max("from_here").over(in_chunk.rangeBetween(-reach, 0)))
        .where(F.col("chunk") == floor_to(F.col("at"), span))
        .select(*STEP, "n", "transaction_count", "weight")
    )


def sliding_windows(
    df: DataFrame, window: str = BURST_WINDOW, slide: str = BURST_SLIDE, min_count: int = BURST_COUNT
) -> DataFrame:
    """Sliding windows in which a customer has more than ``min_count`` rows.

    Only steps under a flagged window are spread over windows: they hold all rows
    of every flagged window.
    """
    size, step = check_slide(window, slide)
    _, counts = _step_counts(df, slide)
    return (
        _fullest_window(counts, size, step)
        .where(F.col("transaction_count") > min_count)
        .select("customer_id", "n", F.window("step", window, slide).alias("window"))
        .select("customer_id", "n", F.col("window.start").alias("window_start"))
        .groupBy("customer_id", "window_start")
        .agg(F.sum("n").alias("transaction_count"))
        .where(F.col("transaction_count") > min_count)
    )


def sliding_alerts(
    df: DataFrame,
    window: str = BURST_WINDOW,
    slide: str = BURST_SLIDE,
    min_count: int = BURST_COUNT,
    **skew: int,
) -> DataFrame:
    """Each row of any flagged sliding window, once, with the highest count over it.

    ``skew`` goes to ``join_groups``.
    """
    size, step = check_slide(window, slide)
    rows, counts = _step_counts(df, slide)
    flagged = _fullest_window(counts, size, step).where(F.col("transaction_count") > min_count).drop("n")
    rows = rows.select(*[c for c in ALERT_COLUMNS if c != "transaction_count"], "step")
    return join_groups(rows, flagged, STEP, "weight", **skew).select(*ALERT_COLUMNS)
