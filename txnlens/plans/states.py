"""The ten reports from daily states, so that a run reads the days that arrived and not all rows.

A day's state is two kinds of rows, made by one scan and one shuffle: per customer
and channel, and per channel and hour. They hold counts and exact sums only, which
add up over days, so states of any days together give the reports of those days.
They are saved in a table partitioned by day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.durations import interval
from txnlens.functions.money import exact_sum, percent
from txnlens.plans import reports
from txnlens.plans.suite import rollup_reports, write_reports
from txnlens.plans.transform import DAY, drop_day
from txnlens.schema import CLEAN_TABLE, FAILED, HIGH_VALUE, RAW_TABLE, SUCCESS, WITHDRAWAL
from txnlens.session import require_utc
from txnlens.sinks.tables import create_database, create_table, replace_partitions
from txnlens.sources.catalog import load_table, table_partitions

STATES_TABLE = "daily_states"
CUSTOMERS, HOURS = "customers", "hours"
SUM = T.DecimalType(38, 6)
#: What is added up: counts, ``n`` and ``rows`` of the clean rows, ``all`` and those below of all rows.
COUNTS = ["rows", "n", "n_amounts", "n_withdrawals", "n_withdrawn", "n_high", "high_rows", "n_failed", "n_success", "n_all"]
SUMS = {"total": "n_amounts", "withdrawn": "n_withdrawn"}
STATE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("channel", T.StringType()),
        T.StructField("txn_hour", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in COUNTS],
        *[T.StructField(c, SUM) for c in SUMS],
        T.StructField(DAY, T.DateType()),
    ]
)


def daily_states(raw: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """States of the days in ``raw``, normalised rows of all statuses; rows without a time belong to no day.

    Each row counts towards a group by customer and one by hour before anything is
    shuffled, so a key with very many rows is one partial row of each task.
    """
    known = raw.where(F.col("txn_timestamp").isNotNull())
    rows = known.select(
        F.to_date("txn_timestamp").alias(DAY),
        F.hour("txn_timestamp").alias("txn_hour"),
        *["customer_id", "channel", "transaction_id", "amount", "status", "transaction_type"],
    )
    clean = F.col("status") != FAILED
    withdrawal = clean & (F.col("transaction_type") == WITHDRAWAL)
    high = clean & (F.col("amount") > high_value)
    number, amount = F.col("transaction_id"), F.col("amount")

    def numbered(condition: Column) -> Column:
        return F.count(F.when(condition, number))

    measures = {
        "rows": F.count_if(clean),
        "n": numbered(clean),
        "n_amounts": F.count(F.when(clean, amount)),
        "n_withdrawals": F.count_if(withdrawal),
        "n_withdrawn": F.count(F.when(withdrawal, amount)),
        "n_high": numbered(high),
        "high_rows": F.count_if(high),
        "n_failed": numbered(F.col("status") == FAILED),
        "n_success": F.count_if(F.col("status") == SUCCESS),
        "n_all": F.count(number),
        "total": exact_sum(F.when(clean, amount)),
        "withdrawn": exact_sum(F.when(withdrawal, amount)),
    }
    sets = [[DAY, "customer_id", "channel"], [DAY, "channel", "txn_hour"]]
    grouped = rows.groupingSets(sets, DAY, "customer_id", "channel", "txn_hour").agg(
        F.grouping("customer_id").alias("_by_hour"), *[value.alias(name) for name, value in measures.items()]
    )
    kind = F.when(F.col("_by_hour") == 1, F.lit(HOURS)).otherwise(F.lit(CUSTOMERS))
    return grouped.withColumn("kind", kind).select(*STATE.names)


def merged(state: DataFrame, *by: str | Column) -> DataFrame:
    """States added up; a sum that one of the days could not give is NULL."""
    sums = [
        F.when(F.count_if(F.col(c).isNull() & (F.col(n) > 0)) == 0, F.try_sum(c)).try_cast(SUM).alias(c) for c, n in SUMS.items()
    ]
    return state.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS], *sums)


def reports_from_states(state: DataFrame, window: str = "7 days") -> dict[str, DataFrame]:
    """The ten reports by name, over the days of ``state``, as ``build_reports`` gives them from the tables.

    ``window`` has to be a number of whole days.
    """
    customers, hours = (state.where(F.col("kind") == kind) for kind in (CUSTOMERS, HOURS))
    day = F.dayofmonth(DAY).alias("txn_day")
    by_month = merged(customers, "customer_id", F.month(DAY).alias("txn_month")).where("rows > 0")
    by_day = merged(customers, "customer_id", day)
    by_hour = merged(hours, "channel", day, "txn_hour")
    succeeded = by_hour.groupBy("channel").agg(F.sum("n_success").alias("part"), F.sum("n_all").alias("whole"))
    in_use = customers.where("rows > 0").withColumn("txn_timestamp", F.col(DAY).cast("timestamp"))
    return rollup_reports(by_month, by_hour.where("rows > 0")) | {
        "success_rate_by_channel": succeeded.select("channel", percent(F.col("part"), F.col("whole")).alias("success_rate")),
        "high_value_per_day": by_day.where("high_rows > 0").select("customer_id", "txn_day", F.col("n_high").alias("no_of_transaction")),
        "failed_over_limit": reports.over_limit(by_day.withColumnRenamed("n_failed", "no_of_failed_txn")),
        "all_channels_in_week": reports.all_channels_in_week(in_use, window),
    }


def update_states(spark: SparkSession, days: Sequence[str], *, db: str, location: str) -> None:
    """Makes the states of some days anew, from those partitions of the raw table, which ``load_days`` keeps.

    ``load_days`` returns the days. A day without rows loses its state. States of other days are not touched.
    """
    require_utc(spark)
    create_database(spark, db)
    create_table(spark, STATES_TABLE, STATE, db=db, location=location, partition_by=[DAY])
    if not days:
        return
    arrived = load_table(spark, RAW_TABLE, db).where(F.col(DAY).isin([F.lit(day).cast("date") for day in days]))
    made = replace_partitions(daily_states(arrived), STATES_TABLE, DAY, db=db, location=location)
    for day in sorted({*days} - {*made}):
        drop_day(spark, STATES_TABLE, day, db=db, location=location)


def run_reports_from_states(
    spark: SparkSession, *, db: str, location: str, mode: str = "overwrite", at_once: int = 4
) -> list[str]:
    """Write all report tables from the saved states; returns their names."""
    require_utc(spark)
    built = reports_from_states(load_table(spark, STATES_TABLE, db))
    return write_reports(spark, built, db=db, location=location, mode=mode, at_once=at_once)


def last_week_from_days(spark: SparkSession, *, db: str, window: str = "7 days") -> DataFrame:
    """Customers who used every channel in the window that ends with the newest transaction, from the tables ``load_days`` keeps.

    The newest day is told by the table's partitions and the newest time by that day's rows; the channels by the
    saved states. So all that is scanned of the rows is the days of the window.
    """
    require_utc(spark)
    clean = load_table(spark, CLEAN_TABLE, db)
    as_of = F.timestamp_micros(F.lit(newest_micros(spark, db)).cast("long"))
    in_window = F.col(DAY).between(F.to_date(as_of - interval(window)), F.to_date(as_of))
    channels = load_table(spark, STATES_TABLE, db).where((F.col("kind") == HOURS) & (F.col("rows") > 0))
    return reports.all_channels_in_week(clean.where(in_window), window, as_of=as_of, channels=channels)


def newest_micros(spark: SparkSession, db: str, table: str = CLEAN_TABLE) -> int | None:
    """The newest ``txn_timestamp`` in microseconds, from the newest day that has a row; None without rows."""
    day = F.substring_index("partition", "=", -1).cast("date").alias(DAY)
    days = table_partitions(spark, table, db).select(day).where(F.col(DAY).isNotNull())
    rows, before = load_table(spark, table, db), F.lit(True)
    while (newest := days.where(before).agg(F.max(DAY).cast("string")).first()[0]) is not None:
        of_day = F.col(DAY) == F.lit(newest).cast("date")
        found = rows.where(of_day).agg(F.max(F.unix_micros("txn_timestamp"))).first()[0]
        if found is not None:
            return found
        before = F.col(DAY) < F.lit(newest).cast("date")
    return None
