"""All ten reports in one run, sharing scans.

Six reports group by parts of the same keys. Two rollups, each one scan of the
clean table, hold what they need: a row per customer and month, and a row per
channel, day and hour. The rollups are cached for the run; the tables, which are
as large as the data, are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.functions.money import exact_sum, mean_of, rounded
from txnlens.plans import reports
from txnlens.schema import CLEAN_TABLE, RAW_TABLE, REPORT_TABLES, WITHDRAWAL
from txnlens.session import require_utc
from txnlens.sinks.editions import name_tables, publish
from txnlens.sinks.tables import add_rows, create_database
from txnlens.sources.catalog import load_table


#: Folder of the report tables' editions.
EDITIONS = "reports"


def customer_rollup(clean: DataFrame) -> DataFrame:
    """Counts and exact sums per customer and month; ``withdrawn`` is NULL without withdrawals."""
    is_withdrawal = F.col("transaction_type") == WITHDRAWAL
    return clean.groupBy("customer_id", reports.month_of().alias("txn_month")).agg(
        reports.txn_count().alias("n"),
        exact_sum("amount").alias("total"),
        exact_sum(F.when(is_withdrawal, F.col("amount"))).alias("withdrawn"),
        F.count(F.when(is_withdrawal, 1)).alias("n_withdrawals"),
    )


def time_rollup(clean: DataFrame) -> DataFrame:
    """Counts and exact sums per channel, day of month and hour: 744 rows per channel at most."""
    return clean.groupBy("channel", "txn_day", "txn_hour").agg(
        reports.txn_count().alias("n"),
        F.count("amount").alias("n_amounts"),
        exact_sum("amount").alias("total"),
    )


def rollup_reports(customers: DataFrame, times: DataFrame) -> dict[str, DataFrame]:
    """The reports that the two rollups hold all of."""
    n = F.sum("n")
    volume = [
        n.alias("no_of_transaction"),
        rounded(F.sum("total")).alias("total_amount_transfered"),
    ]
    by_customer = customers.groupBy("customer_id")
    return {
        "top_customers": reports.top_by_count(by_customer.agg(n.alias("no_of_transactions")), 5),
        "top_withdrawal_customer": reports.top_by_total(
            customers.where(F.col("n_withdrawals") > 0)
            .groupBy("customer_id")
            .agg(F.sum("withdrawn").alias("total")),
            1,
        ),
        "monthly_volume": customers.select(
            "customer_id",
            "txn_month",
            F.col("n").alias("total_no_of_transactions"),
            rounded(F.col("total")).alias("total_amount_transfered"),
        ),
        "avg_amount_by_channel": times.groupBy("channel").agg(
            mean_of(F.sum("total"), F.sum("n_amounts")).alias("avg_amount")
        ),
        "hourly_trend": reports.top_hours(times.groupBy("txn_hour").agg(*volume), 10),
        "daily_volume": times.groupBy("txn_day").agg(*volume).orderBy("txn_day"),
    }


def build_reports(raw: DataFrame, clean: DataFrame, customers: DataFrame, times: DataFrame) -> dict[str, DataFrame]:
    """The reports by name, from the tables and the two rollups."""
    return rollup_reports(customers, times) | {
        "success_rate_by_channel": reports.success_rate_by_channel(raw),
        "high_value_per_day": reports.high_value_per_day(clean),
        "failed_over_limit": reports.failed_over_limit(raw),
        "all_channels_in_week": reports.all_channels_in_week(clean, channels=times),
    }


def write_reports(
    spark: SparkSession, built: dict[str, DataFrame], *, db: str, location: str, mode: str = "overwrite", at_once: int = 4
) -> list[str]:
    """Write report tables, ``at_once`` of them together; their names.

    They are published as one edition under ``location``/reports, so a report that fails leaves the tables of the run before.
    ``mode='append'`` adds to the tables one by one instead.
    """
    named = {REPORT_TABLES[name]: report for name, report in built.items()}
    if mode == "overwrite":
        path = f"{location.rstrip('/')}/{EDITIONS}"
        publish(named, path, at_once=at_once)
        return name_tables(spark, path, db)
    for table, report in named.items():
        add_rows(report, table, db=db, location=location)
    return list(named)


def run_reports(
    spark: SparkSession, *, db: str, location: str, mode: str = "overwrite", at_once: int = 4
) -> list[str]:
    """Write all report tables from the saved raw and clean tables; returns their names.

    A rerun replaces them; ``mode='append'`` adds to them.
    """
    require_utc(spark)
    create_database(spark, db)
    raw, clean = load_table(spark, RAW_TABLE, db), load_table(spark, CLEAN_TABLE, db)
    customers, times = customer_rollup(clean).persist(), time_rollup(clean).persist()
    built = build_reports(raw, clean, customers, times)
    try:
        for rollup in (customers, times):  # before reports that share one start together
            rollup.count()
        return write_reports(spark, built, db=db, location=location, mode=mode, at_once=at_once)
    finally:
        customers.unpersist()
        times.unpersist()
