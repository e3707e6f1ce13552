"""The ten reports. ``raw`` holds rows of all statuses, ``clean`` those that did not fail.

Every report is one scan of the columns it names, partial aggregates on the
scanning tasks, and a shuffle of those; a key with very many rows shuffles one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.functions.durations import interval
from txnlens.functions.money import exact_sum, mean_of, percent, rounded
from txnlens.operators.channels import users_of_every_channel
from txnlens.schema import FAILED, HIGH_VALUE, SUCCESS, WITHDRAWAL


def txn_count() -> Column:
    return F.count("transaction_id")


def month_of(calendar: bool = False) -> Column:
    """Month number, 1 to 12 over all years, or the calendar month."""
    return F.trunc("txn_timestamp", "month") if calendar else F.month("txn_timestamp")


def day_of(calendar: bool = False) -> Column:
    """Day of month, 1 to 31 over all months, or the calendar day."""
    return F.to_date("txn_timestamp") if calendar else F.dayofmonth("txn_timestamp")


def top_customers(clean: DataFrame, n: int = 5) -> DataFrame:
    """The customers with most transactions; ties by customer."""
    counts = clean.groupBy("customer_id").agg(txn_count().alias("no_of_transactions"))
    return top_by_count(counts, n)


def top_by_count(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("no_of_transactions"), "customer_id").limit(n)


def top_withdrawal_customer(clean: DataFrame, n: int = 1) -> DataFrame:
    """The customer with the highest sum of withdrawals; ties by customer."""
    totals = (
        clean.where(F.col("transaction_type") == WITHDRAWAL)
        .groupBy("customer_id")
        .agg(exact_sum("amount").alias("total"))
    )
    return top_by_total(totals, n)


def top_by_total(totals: DataFrame, n: int) -> DataFrame:
    return (
        totals.orderBy(F.desc("total"), "customer_id")
        .limit(n)
        .select("customer_id", F.col("total").cast("double").alias("total_withdrawal_amount"))
    )


def monthly_volume(clean: DataFrame, calendar: bool = False) -> DataFrame:
    """Transactions and sum per customer and month."""
    return clean.groupBy("customer_id", month_of(calendar).alias("txn_month")).agg(
        txn_count().alias("total_no_of_transactions"),
        rounded(exact_sum("amount")).alias("total_amount_transfered"),
    )


def avg_amount_by_channel(clean: DataFrame) -> DataFrame:
    """Mean amount per channel."""
    return clean.groupBy("channel").agg(mean_of(exact_sum("amount"), F.count("amount")).alias("avg_amount"))


def success_rate_by_channel(raw: DataFrame) -> DataFrame:
    """Per cent of the transactions of each channel that succeeded."""
    succeeded = F.sum(F.when(F.col("status") == SUCCESS, 1).otherwise(0))
    return raw.groupBy("channel").agg(percent(succeeded, txn_count()).alias("success_rate"))


def hourly_trend(clean: DataFrame, n: int = 10, by: str = "hour") -> DataFrame:
    """Transactions and sum per hour of day, for the ``n`` latest hours.

    ``by='volume'`` takes the ``n`` busiest hours instead.
    """
    hours = clean.groupBy("txn_hour").agg(
        txn_count().alias("no_of_transaction"),
        rounded(exact_sum("amount")).alias("total_amount_transfered"),
    )
    return top_hours(hours, n, by)


def top_hours(hours: DataFrame, n: int, by: str = "hour") -> DataFrame:
    if by not in ("hour", "volume"):
        raise ValueError(f"by must be 'hour' or 'volume', not {by!r}")
    order = [F.desc("txn_hour")]
    if by == "volume":
        order.insert(0, F.desc("no_of_transaction"))
    return hours.orderBy(*order).limit(n)


def daily_volume(clean: DataFrame, calendar: bool = False) -> DataFrame:
    """Transactions and sum per day, in order of days."""
    day = day_of(True) if calendar else F.col("txn_day")
    return (
        clean.groupBy(day.alias("txn_day"))
        .agg(
            txn_count().alias("no_of_transaction"),
            rounded(exact_sum("amount")).alias("total_amount_transfered"),
        )
        .orderBy("txn_day")
    )


def high_value_per_day(clean: DataFrame, threshold: float = HIGH_VALUE, calendar: bool = False) -> DataFrame:
    """Transactions above an amount per customer and day."""
    day = day_of(True) if calendar else F.col("txn_day")
    return (
        clean.where(F.col("amount") > threshold)
        .groupBy("customer_id", day.alias("txn_day"))
        .agg(txn_count().alias("no_of_transaction"))
    )


def failed_over_limit(raw: DataFrame, limit: int = 3, calendar: bool = False) -> DataFrame:
    """Customers with more than ``limit`` failed transactions in a day, once per such day."""
    counts = (
        raw.where(F.col("status") == FAILED)
        .groupBy("customer_id", day_of(calendar).alias("txn_day"))
        .agg(txn_count().alias("no_of_failed_txn"))
    )
    return over_limit(counts, limit)


def over_limit(counts: DataFrame, limit: int = 3) -> DataFrame:
    return counts.where(F.col("no_of_failed_txn") > limit).select("customer_id")


def all_channels_in_week(
    clean: DataFrame,
    window: str = "7 days",
    *,
    as_of: Column | None = None,
    channels: DataFrame | None = None,
) -> DataFrame:
    """Customers who used every channel within a window, once per such window.

    Windows are counted from 1970-01-01. With ``as_of`` there is one window, the
    one that ends at that time. ``channels`` names the channels that count, by
    default all in ``clean``, in whatever window; a job of its own lists them.
    """
    every = clean if channels is None else channels
    if channels is not None:
        clean = clean.join(F.broadcast(channels.select("channel").distinct()), "channel", "left_semi")
    if as_of is None:
        start = F.window("txn_timestamp", window).getField("start")
    else:
        at = F.col("txn_timestamp")
        clean = clean.where((at > as_of - interval(window)) & (at <= as_of))
        start = F.lit(0)
    rows = clean.select("customer_id", "channel", start.alias("window_start"))
    return users_of_every_channel(rows, every, "customer_id", "window_start").select("customer_id")
