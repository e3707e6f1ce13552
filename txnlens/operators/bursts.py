"""Bursts of large withdrawals in tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.functions.cells import reason_sentence, reason_text
from txnlens.functions.durations import interval
from txnlens.operators.matching import join_groups
from txnlens.schema import (
    ALERT_COLUMNS,
    BURST_COUNT,
    BURST_WINDOW,
    LARGE_WITHDRAWAL,
    SUCCESS,
    WITHDRAWAL,
)

GROUP = ["customer_id", "window_start"]


def large_withdrawals(
    df: DataFrame,
    min_amount: float = LARGE_WITHDRAWAL,
    txn_type: str = WITHDRAWAL,
    success_only: bool = False,
) -> DataFrame:
    """Withdrawals above an amount; stateless, so it filters streams as well.

    Case and status are taken as they come: normalise first, or ask for
    ``success_only``, if the source needs it.
    """
    kept = df.where(F.col("transaction_type") == txn_type).where(F.col("amount") > min_amount)
    return kept.where(F.col("status") == SUCCESS) if success_only else kept


def fraud_windows(df: DataFrame, window: str = BURST_WINDOW, min_count: int = BURST_COUNT) -> DataFrame:
    """Windows in which a customer has more than ``min_count`` rows."""
    return (
        df.select("customer_id", "transaction_id", F.window("txn_timestamp", window).alias("window"))
        .select("customer_id", "transaction_id", F.col("window.start").alias("window_start"))
        .groupBy(*GROUP)
        .agg(F.count("transaction_id").alias("transaction_count"))
        .where(F.col("transaction_count") > min_count)
    )


def _touching(df: DataFrame, window: str, end_inclusive: bool) -> DataFrame:
    """Rows with the start of each window they touch; ``inside`` is false on an end.

    A row is inside one window. With closed windows, one exactly on a window
    start also touches the window that ends there. So the interval condition
    becomes equality of ``window_start``.
    """
    start = F.window("txn_timestamp", window).getField("start")
    rows = df.where(F.col("customer_id").isNotNull()).withColumn("own_start", start)
    if not end_inclusive:
        return rows.withColumnRenamed("own_start", "window_start").withColumn("inside", F.lit(True))
    own = F.col("own_start")
    starts = F.when(F.col("txn_timestamp") == own, F.array(own, own - interval(window))).otherwise(F.array(own))
    return (
        rows.withColumn("window_start", F.explode(starts))
        .withColumn("inside", F.col("window_start") == own)
        .drop("own_start")
    )


def fraud_alerts(
    df: DataFrame,
    window: str = BURST_WINDOW,
    min_count: int = BURST_COUNT,
    *,
    end_inclusive: bool = True,
    **skew: int,
) -> DataFrame:
    """The rows of each flagged window with the window's count, once per window.

    Windows are flagged by the rows inside them. By default a row exactly at a
    flagged window's end is reported with it too; ``end_inclusive=False`` leaves
    it out. ``skew`` goes to ``join_groups``.
    """
    touching = _touching(df, window, end_inclusive)
    flagged = (
        touching.groupBy(*GROUP)
        .agg(
            F.count(F.when(F.col("inside"), F.col("transaction_id"))).alias("transaction_count"),
            F.count(F.lit(1)).alias("weight"),
        )
        .where(F.col("transaction_count") > min_count)
    )
    rows = touching.select(*[c for c in ALERT_COLUMNS if c != "transaction_count"], "window_start")
    return join_groups(rows, flagged, GROUP, "weight", **skew).select(*ALERT_COLUMNS)


def with_reasons(
    alerts: DataFrame, window: str = BURST_WINDOW, min_amount: float = LARGE_WITHDRAWAL
) -> DataFrame:
    """Adds the general ``reason`` and a ``reason_detail`` naming customer, count and amount."""
    return alerts.withColumns({"reason": reason_text(), "reason_detail": reason_sentence(window, min_amount)})
