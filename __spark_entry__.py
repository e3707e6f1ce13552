"""Entry points: the flagship query, every query, and the SQL that checks them.

The generated ``events`` table is mapped to transactions; everything below reads
all of it. Bursts within one minute do not occur in it, so alert queries use
windows of a day, sliding by an hour.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from txnlens.fixtures import transactions_from_events  # noqa: E402
from txnlens.functions.cells import amount_text, cell_map, row_key  # noqa: E402
from txnlens.operators import bursts, cleaning, intervals, quality, sliding, summary  # noqa: E402
from txnlens.plans import reports, states, suite, transform  # noqa: E402
from txnlens.schema import ALERT_COLUMNS, REJECTED_TABLE, REPORT_TABLES, layout  # noqa: E402
from txnlens.session import scratch_dir  # noqa: E402
from txnlens.sinks import alerts as alert_table  # noqa: E402
from txnlens.sinks import tables  # noqa: E402
from txnlens.sources import catalog, files, lines, streams  # noqa: E402
from txnlens.streaming import runner  # noqa: E402
from txnlens.streaming.alerts import stateful_alerts  # noqa: E402
from txnlens.streaming.early import early_alerts, early_handler  # noqa: E402

try:
    from txnlens.llm import registry as llm
except ModuleNotFoundError as error:  # the subpackage and its pipeline can be left out
    if not (error.name or "").startswith(("txnlens.llm", "corpus_pipeline")):
        raise
    llm = None

WINDOW, SLIDE = "1 day", "1 hour"
Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ inputs


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return transactions_from_events(spark, sf_dir)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize(records(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(raw(spark, sf_dir))


def withdrawals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursts.large_withdrawals(raw(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursts.fraud_alerts(withdrawals(spark, sf_dir), WINDOW)


def on(source: Query, report: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf_dir: report(source(spark, sf_dir), **params)


def as_text(column: str, query: Query) -> Query:
    """Dates as text, which reads the same from both engines."""
    return lambda spark, sf_dir: query(spark, sf_dir).withColumn(column, F.col(column).cast("string"))


def without_zone(df: DataFrame) -> DataFrame:
    """UTC timestamps as the zone-less type of the generated tables."""
    return df.withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp_ntz"))


# ------------------------------------------------------------- files, tables


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    out = records(spark, sf_dir).withColumn("txn_timestamp", F.col("txn_timestamp").cast("string"))
    out.withColumnRenamed("txn_timestamp", "timestamp").write.csv(path, header=True)
    return without_zone(quality.split_valid(files.read_transactions(spark, path))[0])


def csv_scan_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv-positional")
    order = layout("clean").names
    out = clean(spark, sf_dir).withColumn("txn_timestamp", F.col("txn_timestamp").cast("string"))
    out.select(*order).write.csv(path)
    valid, _ = quality.split_valid(files.read_transactions(spark, path, kind="clean", header=False))
    return without_zone(cleaning.derive(valid))


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv-inferred")
    out = records(spark, sf_dir).withColumn("txn_timestamp", F.col("txn_timestamp").cast("string"))
    out.withColumnRenamed("txn_timestamp", "timestamp").write.csv(path, header=True)
    df = files.read_transactions(spark, path, infer=True)
    ids = {c: F.col(c).cast("long") for c in ("transaction_id", "customer_id")}
    return without_zone(df.withColumns(ids))


def with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with missing values put in by a rule."""
    n = F.col("transaction_id")
    gaps = {
        "amount": n % 7 == 0,
        "channel": n % 11 == 0,
        "status": n % 13 == 0,
        "txn_timestamp": n % 17 == 0,
    }
    return records(spark, sf_dir).withColumns({c: F.when(~gap, F.col(c)) for c, gap in gaps.items()})


def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per reason for a CSV some of whose amounts are text."""
    path = scratch_dir(spark, "csv-malformed")
    bad = F.when(F.col("transaction_id") % 19 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    out = with_gaps(spark, sf_dir).withColumns(
        {"amount": F.when(F.col("amount").isNotNull(), bad), "txn_timestamp": F.col("txn_timestamp").cast("string")}
    )
    out.withColumnRenamed("txn_timestamp", "timestamp").write.csv(path, header=True)
    return quality.quarantine_counts(files.read_transactions(spark, path))


def saved_tables(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A database with the declared raw and clean tables, filled as they were declared."""
    location = scratch_dir(spark, "tables")
    db = "txnlens_" + location.rsplit("-", 1)[1]
    tables.create_database(spark, db, f"{location}/db")
    for name, kind, rows in (
        ("raw_transactions", "raw", raw(spark, sf_dir)),
        ("transactions", "clean", clean(spark, sf_dir)),
    ):
        tables.create_table(spark, name, layout(kind), db=db, location=location, partition_by=["channel"])
        tables.fill_table(rows.withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp")), name, db=db)
    return db, location


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, _ = saved_tables(spark, sf_dir)
    return without_zone(catalog.load_table(spark, "transactions", db))


def table_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, _ = saved_tables(spark, sf_dir)
    value = F.substring_index("partition", "=", -1)
    return catalog.table_partitions(spark, "transactions", db).select(value.alias("channel"))


def built(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """CSV to raw, clean and rejected table; one of them."""
    location = scratch_dir(spark, "build")
    db = "txnlens_" + location.rsplit("-", 1)[1]
    out = with_gaps(spark, sf_dir).withColumn("txn_timestamp", F.col("txn_timestamp").cast("string"))
    out.withColumnRenamed("txn_timestamp", "timestamp").write.csv(f"{location}/csv", header=True)
    tables.create_database(spark, db, f"{location}/db")
    transform.build_tables(spark, f"{location}/csv", db=db, location=location)
    return catalog.load_table(spark, table, db)


def built_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_zone(built(spark, sf_dir, "transactions"))


def built_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = built(spark, sf_dir, REJECTED_TABLE)
    return rejected.groupBy(F.col("quarantine_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def deliveries(spark: SparkSession, sf_dir: str, then: Callable[..., None] | None = None) -> tuple[str, str]:
    """Two deliveries by day: the first lacks rows of the days from the 15th on, which the second holds whole.

    ``then`` is called after each with its days; the database and location of the tables.
    """
    location = scratch_dir(spark, "days")
    db = "txnlens_" + location.rsplit("-", 1)[1]
    tables.create_database(spark, db, f"{location}/db")
    day = F.dayofmonth("txn_timestamp")
    for part, rows in enumerate(((day <= 20) & ((day < 15) | (F.col("transaction_id") % 3 == 0)), day >= 15)):
        out = records(spark, sf_dir).filter(rows).withColumn("txn_timestamp", F.col("txn_timestamp").cast("string"))
        out.withColumnRenamed("txn_timestamp", "timestamp").write.csv(f"{location}/csv-{part}", header=True)
        days = transform.load_days(spark, f"{location}/csv-{part}", db=db, location=location)
        if then:
            then(spark, days, db=db, location=location)
    return db, location


def loaded_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    db, _ = deliveries(spark, sf_dir)
    loaded = without_zone(catalog.load_table(spark, "transactions", db))
    return loaded.withColumn("txn_date", F.col("txn_date").cast("string"))


def report_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run that writes all reports; all rows of each table, as text."""
    db, location = saved_tables(spark, sf_dir)
    suite.run_reports(spark, db=db, location=location)
    return all_report_rows(spark, db)


def incremental_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from daily states, kept as two deliveries arrive."""
    db, location = deliveries(spark, sf_dir, then=states.update_states)
    states.run_reports_from_states(spark, db=db, location=location)
    return all_report_rows(spark, db)


def all_channels_last_week_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last week from tables kept by day."""
    db, _ = deliveries(spark, sf_dir, then=states.update_states)
    return states.last_week_from_days(spark, db=db)


def all_report_rows(spark: SparkSession, db: str) -> DataFrame:
    texts = [row_texts(catalog.load_table(spark, table, db), name) for name, table in REPORT_TABLES.items()]
    out = texts[0]
    for df in texts[1:]:
        out = out.unionByName(df)
    return out


def row_texts(df: DataFrame, name: str) -> DataFrame:
    """Each row as ``name`` and the text of its cells, in order of the columns' names."""
    cells = [amount_text(F.col(c)) if kind == "double" else F.col(c).cast("string") for c, kind in sorted(df.dtypes)]
    return df.select(F.lit(name).alias("report"), F.concat_ws("|", *[F.coalesce(c, F.lit("NULL")) for c in cells]).alias("cells"))


def report_from_rollups(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = clean(spark, sf_dir)
        rollups = suite.customer_rollup(table), suite.time_rollup(table)
        return suite.build_reports(raw(spark, sf_dir), table, *rollups)[name]

    return query


# -------------------------------------------------------------------- alerts


def alert_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = alerts(spark, sf_dir).select(row_key().alias("row_key"), F.explode(cell_map()).alias("cell", "value"))
    return cells


def alert_cells_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of up to a billion, whose texts have no exponent."""
    large = alerts(spark, sf_dir).withColumn("amount", F.col("amount") * 1_000_000)
    return large.select(row_key().alias("row_key"), cell_map()["info:amount"].alias("value"))


def stored_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five screenings of all rows at ever lower amounts, so that keys get one to five versions."""
    path = scratch_dir(spark, "alerts")
    for batch, found in enumerate(screenings(spark, sf_dir)):
        alert_table.write_alert_batch(found, batch, path)
    return alert_table.read_alerts(spark, path)


def screenings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = raw(spark, sf_dir)
    return [bursts.fraud_alerts(bursts.large_withdrawals(rows, 400 - 100 * batch), WINDOW) for batch in range(5)]


def compacted_alerts(spark: SparkSession, sf_dir: str) -> str:
    """The same five, compacted after the third and the fourth, of which each is run again; the table's path."""
    path = scratch_dir(spark, "alerts-compacted")
    for batch, found in enumerate(screenings(spark, sf_dir)):
        for _ in range(2 if batch in (2, 3) else 1):
            alert_table.write_alert_batch(found, batch, path)
            if batch in (2, 3):
                alert_table.compact_alerts(spark, path)
    return path


def alert_versions_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_table.alert_versions(alert_table.read_alerts(spark, compacted_alerts(spark, sf_dir)))


def alert_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions by the table's name in the catalog."""
    path = compacted_alerts(spark, sf_dir)
    return spark.read.table(alert_table.publish_alerts(spark, path, "txnlens_" + path.rsplit("-", 1)[1]))


def alert_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = alert_table.alert_history(stored_alerts(spark, sf_dir))
    counts = F.transform("versions", lambda v: v["transaction_count"].cast("string"))
    return history.select(
        "row_key", F.size("versions").alias("n_versions"), F.array_join(counts, ",").alias("counts")
    )


# ------------------------------------------------------------------- streams


def message_folder(spark: SparkSession, sf_dir: str, spoil: bool = False, only: str = "true", path: str | None = None) -> str:
    """Transactions as CSV messages in text files; spoilt, some amounts are text and some dates far ahead."""
    path = path or scratch_dir(spark, "messages")
    rows = cleaning.derive(raw(spark, sf_dir)).filter(only).withColumn("txn_timestamp", F.col("txn_timestamp").cast("string"))
    if spoil:
        n = F.col("transaction_id")
        bad = {"amount": (19, "n/a"), "txn_timestamp": (23, "2999-01-01 00:00:00")}
        texts = {c: F.when(n % k == 0, F.lit(text)).otherwise(F.col(c).cast("string")) for c, (k, text) in bad.items()}
        rows = rows.withColumns(texts)
    rows.select(F.to_csv(F.struct(*layout("stream").names)).alias("value")).write.mode("append").text(path)
    return path


def message_stream(spark: SparkSession, folder: str) -> DataFrame:
    parsed = lines.parse_lines(streams.read_line_files(spark, folder), "stream")
    return bursts.large_withdrawals(parsed)


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = message_stream(spark, message_folder(spark, sf_dir))
    path = scratch_dir(spark, "parsed")
    runner.start_parquet(stream, f"{path}/rows", f"{path}/checkpoint", drain=True).awaitTermination()
    return without_zone(spark.read.parquet(f"{path}/rows"))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per reason of the spoilt messages."""
    messages = streams.read_line_files(spark, message_folder(spark, sf_dir, spoil=True))
    _, rejected = quality.split_valid(lines.parse_lines(messages, "stream", keep_corrupt=True), ahead="1 day")
    path = scratch_dir(spark, "rejects")
    runner.start_parquet(rejected, f"{path}/rows", f"{path}/checkpoint", drain=True).awaitTermination()
    stored = spark.read.parquet(f"{path}/rows")
    return stored.groupBy(F.col("quarantine_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def stream_alerts_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files arrive in one micro-batch."""
    stream = message_stream(spark, message_folder(spark, sf_dir))
    path = scratch_dir(spark, "per-batch")
    handle = runner.burst_handler(f"{path}/alerts", window=WINDOW)
    runner.start(stream, handle, f"{path}/checkpoint", drain=True).awaitTermination()
    return without_zone(alert_table.latest_alerts(alert_table.read_alerts(spark, f"{path}/alerts")))


def state_partitions(spark: SparkSession) -> int:
    """Two for each core."""
    return 2 * spark.sparkContext.defaultParallelism


def stream_alerts_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A last message, four days after the others, moves the watermark past their windows."""
    folder = message_folder(spark, sf_dir)
    end = raw(spark, sf_dir).agg((F.max("txn_timestamp") + F.expr("INTERVAL 4 days")).alias("at"))
    fields = [F.lit("-1,-1"), F.col("at").cast("string"), F.lit("1000.0,withdrawal,success,1,0,atm")]
    end.select(F.concat_ws(",", *fields).alias("value")).write.mode("append").text(folder)
    path = scratch_dir(spark, "stateful")
    found = stateful_alerts(message_stream(spark, folder), WINDOW, SLIDE, delay=WINDOW)
    handle = runner.store_handler(f"{path}/alerts")
    runner.start(found, handle, f"{path}/checkpoint", drain=True, partitions=state_partitions(spark)).awaitTermination()
    stored = alert_table.latest_alerts(alert_table.read_alerts(spark, f"{path}/alerts"))
    return without_zone(stored.drop("batch_id"))


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth message arrives after all others, in a second run of the stream: early alerts, and what came too late."""
    path = scratch_dir(spark, "early")
    messages = f"{path}/messages"
    for part in ("transaction_id % 10 <> 9", "transaction_id % 10 = 9"):
        message_folder(spark, sf_dir, only=part, path=messages)
        found = early_alerts(message_stream(spark, messages), WINDOW, SLIDE, delay="10 days")
        handle = early_handler(f"{path}/alerts", f"{path}/late")
        runner.start(found, handle, f"{path}/checkpoint", drain=True, partitions=state_partitions(spark)).awaitTermination()
    stored = alert_table.read_alerts(spark, f"{path}/alerts").withColumn("kind", F.lit("alert"))
    late = spark.read.parquet(f"{path}/late").withColumns({"kind": F.lit("late"), "transaction_count": F.lit(0).cast("long")})
    columns = ["kind", "transaction_count", "transaction_id", "customer_id", "amount"]
    return stored.select(*columns).unionByName(late.select(*columns))


# ------------------------------------------------------------------ contract


def entry(spark: SparkSession) -> DataFrame:
    """Alerts with their reasons."""
    return bursts.with_reasons(alerts(spark, "/root/testdata/sf0.001"), WINDOW)


def queries() -> dict[str, Query]:
    """All queries by name."""
    return core_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    """The same results in SQL, by name."""
    return core_sql() | (llm.oracle_sql() if llm else {})


def core_queries() -> dict[str, Query]:
    """Queries of the bank transactions."""
    return {
        "clean_transactions": on(records, cleaning.clean_transactions),
        "top_customers": on(clean, reports.top_customers),
        "top_withdrawal_customer": on(clean, reports.top_withdrawal_customer),
        "monthly_volume": on(clean, reports.monthly_volume),
        "monthly_volume_calendar": as_text("txn_month", on(clean, reports.monthly_volume, calendar=True)),
        "avg_amount_by_channel": on(clean, reports.avg_amount_by_channel),
        "success_rate_by_channel": on(raw, reports.success_rate_by_channel),
        "hourly_trend": on(clean, reports.hourly_trend),
        "hourly_trend_busiest": on(clean, reports.hourly_trend, by="volume"),
        "daily_volume": on(clean, reports.daily_volume),
        "daily_volume_calendar": as_text("txn_day", on(clean, reports.daily_volume, calendar=True)),
        "high_value_per_day": on(clean, reports.high_value_per_day),
        "failed_over_limit": on(raw, reports.failed_over_limit),
        "all_channels_in_week": on(clean, reports.all_channels_in_week),
        "all_channels_last_week": lambda spark, sf_dir: reports.all_channels_in_week(
            clean(spark, sf_dir), as_of=clean(spark, sf_dir).agg(F.max("txn_timestamp")).scalar()
        ),
        "all_channels_last_week_by_day": all_channels_last_week_by_day,
        **{f"rollup_{name}": report_from_rollups(name) for name in ROLLUP_REPORTS},
        "report_tables": report_tables,
        "incremental_reports": incremental_reports,
        "loaded_days": loaded_days,
        "csv_scan": csv_scan,
        "csv_scan_positional": csv_scan_positional,
        "csv_scan_inferred": csv_scan_inferred,
        "quarantine_counts": on(with_gaps, quality.quarantine_counts),
        "drop_incomplete": on(with_gaps, quality.drop_incomplete),
        "csv_quarantine": csv_quarantine,
        "table_roundtrip": table_roundtrip,
        "table_partitions": table_partitions,
        "built_tables": built_tables,
        "built_rejected": built_rejected,
        "distinct_channels": on(clean, summary.distinct_channels),
        "channel_sets": on(clean, summary.channel_sets),
        "describe_amount": on(raw, summary.describe_amount),
        "describe_columns": on(clean, summary.describe_columns, columns=DESCRIBED),
        "describe_fields": on(clean, summary.describe_fields, columns=[*FIELDS]),
        "fraud_windows": on(withdrawals, bursts.fraud_windows, window=WINDOW),
        "fraud_alerts": alerts,
        "fraud_alerts_reason": on(alerts, bursts.with_reasons, window=WINDOW),
        "fraud_alerts_halfopen": on(withdrawals, bursts.fraud_alerts, window=WINDOW, end_inclusive=False),
        "sliding_windows": on(withdrawals, sliding.sliding_windows, window=WINDOW, slide=SLIDE),
        "sliding_alerts": on(withdrawals, sliding.sliding_alerts, window=WINDOW, slide=SLIDE),
        "interval_alerts": on(withdrawals, intervals.interval_alerts, window=WINDOW, slide=SLIDE),
        "interval_windows": on(withdrawals, intervals.windows_by_join, window=WINDOW, slide=SLIDE),
        "alert_cells": alert_cells,
        "alert_cells_large": alert_cells_large,
        "alert_versions": on(stored_alerts, alert_table.alert_versions),
        "alert_versions_compacted": alert_versions_compacted,
        "alert_table_scan": alert_table_scan,
        "alert_latest": on(stored_alerts, alert_table.latest_alerts),
        "alert_history": alert_history,
        "stream_parse": stream_parse,
        "stream_rejects": stream_rejects,
        "stream_alerts_per_batch": stream_alerts_per_batch,
        "stream_alerts_stateful": stream_alerts_stateful,
        "stream_late": stream_late,
    }


#: Columns of the reports in order of their names, as text.
REPORT_CELLS = {
    name: ", ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in sorted(columns.split()))
    for name, columns in {
        "top_customers": "customer_id no_of_transactions",
        "top_withdrawal_customer": "customer_id total_withdrawal_amount",
        "monthly_volume": "customer_id txn_month total_no_of_transactions total_amount_transfered",
        "avg_amount_by_channel": "channel avg_amount",
        "success_rate_by_channel": "channel success_rate",
        "hourly_trend": "txn_hour no_of_transaction total_amount_transfered",
        "daily_volume": "txn_day no_of_transaction total_amount_transfered",
        "high_value_per_day": "customer_id txn_day no_of_transaction",
        "failed_over_limit": "customer_id",
        "all_channels_in_week": "customer_id",
    }.items()
}
DESCRIBED = ["amount", "txn_day", "txn_hour", "high_value_flag"]
#: Fields that are described, and whether they are numbers.
FIELDS = {"transaction_id": True, "amount": True, "txn_day": True, "channel": False, "transaction_type": False, "txn_timestamp": False}
ROLLUP_REPORTS = [
    "top_customers",
    "top_withdrawal_customer",
    "monthly_volume",
    "avg_amount_by_channel",
    "hourly_trend",
    "daily_volume",
    "all_channels_in_week",
]

# ---------------------------------------------------------------------- SQL

RECORDS = """
records AS (
  SELECT event_id AS transaction_id, user_id AS customer_id, ts AS txn_timestamp, value * 10 AS amount,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'Withdrawal' ELSE 'Deposit' END AS transaction_type,
         CASE WHEN event_id % 3 = 0 THEN 'ATM' WHEN event_id % 3 = 1 THEN 'Online' ELSE 'Branch' END AS channel,
         CASE WHEN event_type = 'error' OR event_id % 5 = 0 THEN 'failed' ELSE 'success' END AS status
  FROM events)"""

RAW = RECORDS + """,
raw AS (
  SELECT transaction_id, customer_id, txn_timestamp, amount,
         lower(transaction_type) AS transaction_type, lower(channel) AS channel, status
  FROM records)"""

DERIVED = """
         CAST(day(txn_timestamp) AS INTEGER) AS txn_day, CAST(hour(txn_timestamp) AS INTEGER) AS txn_hour,
         CASE WHEN amount > 500 THEN 1 ELSE 0 END AS high_value_flag"""

CLEAN = RAW + f""",
clean AS (SELECT *, {DERIVED} FROM raw WHERE status <> 'failed')"""

GAPS = RECORDS + """,
gaps AS (
  SELECT transaction_id, customer_id, transaction_type,
         CASE WHEN transaction_id % 17 <> 0 THEN txn_timestamp END AS txn_timestamp,
         CASE WHEN transaction_id % 7 <> 0 THEN amount END AS amount,
         CASE WHEN transaction_id % 11 <> 0 THEN channel END AS channel,
         CASE WHEN transaction_id % 13 <> 0 THEN status END AS status
  FROM records)"""

LARGE = RAW + """,
large AS (SELECT * FROM raw WHERE transaction_type = 'withdrawal' AND amount > 400)"""

FLAGGED = LARGE + """,
flagged AS (
  SELECT customer_id, date_trunc('day', txn_timestamp) AS window_start, count(transaction_id) AS transaction_count
  FROM large GROUP BY ALL HAVING count(transaction_id) > 2)"""

ALERTS = FLAGGED + """,
alerts AS (
  SELECT f.transaction_count, l.transaction_id, l.customer_id, l.txn_timestamp, l.amount, l.channel
  FROM flagged f JOIN large l ON l.customer_id = f.customer_id
   AND l.txn_timestamp >= f.window_start AND l.txn_timestamp <= f.window_start + INTERVAL 1 day)"""

SLIDING = LARGE + """,
starts AS (
  SELECT l.*, date_trunc('hour', txn_timestamp) - g.i * INTERVAL 1 hour AS window_start
  FROM large l, range(24) g(i)),
sliding AS (
  SELECT customer_id, window_start, count(transaction_id) AS transaction_count
  FROM starts GROUP BY ALL HAVING count(transaction_id) > 2),
sliding_alerts AS (
  SELECT max(s.transaction_count) AS transaction_count, t.transaction_id, t.customer_id, t.txn_timestamp,
         t.amount, t.channel
  FROM starts t JOIN sliding s USING (customer_id, window_start)
  GROUP BY t.transaction_id, t.customer_id, t.txn_timestamp, t.amount, t.channel)"""

BURSTS = SLIDING + """,
opened AS (
  SELECT *, coalesce(window_start > lag(window_start) OVER w + INTERVAL 1 day, true) AS opens
  FROM sliding WINDOW w AS (PARTITION BY customer_id ORDER BY window_start)),
numbered AS (
  SELECT *, count(*) FILTER (opens) OVER (PARTITION BY customer_id ORDER BY window_start) AS burst FROM opened),
bursts AS (
  SELECT customer_id, min(window_start) AS burst_start, max(window_start) + INTERVAL 1 day AS burst_end,
         max(transaction_count) AS transaction_count
  FROM numbered GROUP BY customer_id, burst)"""


def sliding_over(rows: str, name: str) -> str:
    """Rows under a full sliding window, with the highest count."""
    return f""",
{name}_starts AS (SELECT l.*, date_trunc('hour', txn_timestamp) - g.i * INTERVAL 1 hour AS window_start FROM {rows} l, range(24) g(i)),
{name}_full AS (
  SELECT customer_id, window_start, count(transaction_id) AS n FROM {name}_starts GROUP BY ALL HAVING count(transaction_id) > 2),
{name} AS (
  SELECT max(n) AS transaction_count, transaction_id, customer_id, any_value(amount) AS amount
  FROM {name}_starts JOIN {name}_full USING (customer_id, window_start) GROUP BY transaction_id, customer_id)"""


LATE = (
    LARGE
    + """,
punctual AS (SELECT * FROM large WHERE transaction_id % 10 <> 9),
mark AS (SELECT (epoch_us(max(txn_timestamp)) // 1000 - 10 * 86400000) * 1000 AS us FROM punctual),
tenth AS (SELECT l.*, epoch_us(txn_timestamp) < us AS late FROM large l, mark WHERE transaction_id % 10 = 9),
in_time AS (SELECT * FROM punctual UNION ALL SELECT * EXCLUDE (late) FROM tenth WHERE NOT late)"""
    + sliding_over("punctual", "first_run")
    + sliding_over("in_time", "both_runs")
)

STORED = RAW + """,
screened AS (
  SELECT b.i AS batch_id, raw.*, date_trunc('day', txn_timestamp) AS window_start
  FROM raw, range(5) b(i) WHERE transaction_type = 'withdrawal' AND amount > 400 - 100 * b.i),
flagged AS (
  SELECT batch_id, customer_id, window_start, count(transaction_id) AS transaction_count
  FROM screened GROUP BY ALL HAVING count(transaction_id) > 2),
stored AS (
  SELECT s.customer_id || '_' || s.transaction_id AS row_key, max(f.transaction_count) AS transaction_count,
         s.transaction_id, s.customer_id, s.txn_timestamp, s.amount, s.channel, s.batch_id
  FROM screened s JOIN flagged f ON f.batch_id = s.batch_id AND f.customer_id = s.customer_id
   AND s.txn_timestamp >= f.window_start AND s.txn_timestamp <= f.window_start + INTERVAL 1 day
  GROUP BY s.transaction_id, s.customer_id, s.txn_timestamp, s.amount, s.channel, s.batch_id),
versions AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row_key ORDER BY batch_id DESC) AS INTEGER) AS version
  FROM stored QUALIFY version <= 4)"""

SUM = "sum(CAST(amount AS DECIMAL(18,6)))"
TOTAL = f"CAST(round({SUM}, 2) AS DOUBLE)"
MEAN = f"CAST(round(CAST(CAST({SUM} AS DOUBLE) / count(amount) AS DECIMAL(24,6)), 2) AS DOUBLE)"
WEEK = "time_bucket(INTERVAL 7 day, txn_timestamp, TIMESTAMP '1970-01-01')"


def volume(key: str) -> str:
    return f"SELECT {key}, count(transaction_id) AS no_of_transaction, {TOTAL} AS total_amount_transfered FROM clean GROUP BY 1"


def monthly(key: str) -> str:
    return (
        f"SELECT customer_id, {key} AS txn_month, count(transaction_id) AS total_no_of_transactions, "
        f"{TOTAL} AS total_amount_transfered FROM clean GROUP BY 1, 2"
    )


def gap_reasons(source: str, first: str = "NULL") -> str:
    missing = ", ".join(
        f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in ("txn_timestamp", "amount", "channel", "status")
    )
    return (
        f"SELECT coalesce(nullif(concat_ws(',', {first}, {missing}), ''), 'valid') AS reason, count(*) AS n "
        f"FROM {source} GROUP BY 1"
    )


def core_sql() -> dict[str, str]:
    """Their results in SQL."""

    def q(ctes: str, select: str) -> str:
        return f"WITH {ctes.strip()}\n{select}"

    every_channel = (
        "SELECT customer_id FROM {rows} GROUP BY {keys} "
        "HAVING count(DISTINCT channel) = (SELECT count(DISTINCT channel) FROM clean)"
    )
    columns = ", ".join(ALERT_COLUMNS)
    alert = f"SELECT {columns} FROM "
    result = {
        "clean_transactions": q(CLEAN, "SELECT * FROM clean"),
        "top_customers": q(
            CLEAN,
            "SELECT customer_id, count(transaction_id) AS no_of_transactions FROM clean "
            "GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
        ),
        "top_withdrawal_customer": q(
            CLEAN,
            f"SELECT customer_id, CAST({SUM} AS DOUBLE) AS total_withdrawal_amount FROM clean "
            "WHERE transaction_type = 'withdrawal' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
        ),
        "monthly_volume": q(CLEAN, monthly("CAST(month(txn_timestamp) AS INTEGER)")),
        "monthly_volume_calendar": q(CLEAN, monthly("strftime(date_trunc('month', txn_timestamp), '%Y-%m-%d')")),
        "avg_amount_by_channel": q(CLEAN, f"SELECT channel, {MEAN} AS avg_amount FROM clean GROUP BY 1"),
        "success_rate_by_channel": q(
            RAW,
            "SELECT channel, CAST(round(CAST(count(*) FILTER (status = 'success') * 100 / count(transaction_id) "
            "AS DECIMAL(24,6)), 2) AS DOUBLE) AS success_rate FROM raw GROUP BY 1",
        ),
        "hourly_trend": q(CLEAN, volume("txn_hour") + " ORDER BY 1 DESC LIMIT 10"),
        "hourly_trend_busiest": q(CLEAN, volume("txn_hour") + " ORDER BY 2 DESC, 1 DESC LIMIT 10"),
        "daily_volume": q(CLEAN, volume("txn_day") + " ORDER BY 1"),
        "daily_volume_calendar": q(CLEAN, volume("strftime(txn_timestamp, '%Y-%m-%d') AS txn_day") + " ORDER BY 1"),
        "high_value_per_day": q(
            CLEAN,
            "SELECT customer_id, txn_day, count(transaction_id) AS no_of_transaction FROM clean "
            "WHERE amount > 500 GROUP BY 1, 2",
        ),
        "failed_over_limit": q(
            RAW,
            "SELECT customer_id FROM raw WHERE status = 'failed' GROUP BY customer_id, day(txn_timestamp) "
            "HAVING count(transaction_id) > 3",
        ),
        "all_channels_in_week": q(CLEAN, every_channel.format(rows="clean", keys=f"customer_id, {WEEK}")),
        "all_channels_last_week": q(
            CLEAN
            + ",\nlast_week AS (SELECT * FROM clean WHERE txn_timestamp > "
            "(SELECT max(txn_timestamp) FROM clean) - INTERVAL 7 day)",
            every_channel.format(rows="last_week", keys="customer_id"),
        ),
        "loaded_days": q(CLEAN, "SELECT *, strftime(txn_timestamp, '%Y-%m-%d') AS txn_date FROM clean"),
        "csv_scan": q(RECORDS, "SELECT * FROM records"),
        "csv_scan_positional": q(CLEAN, "SELECT * FROM clean"),
        "csv_scan_inferred": q(RECORDS, "SELECT * FROM records"),
        "quarantine_counts": q(GAPS, gap_reasons("gaps")),
        "drop_incomplete": q(
            GAPS,
            "SELECT * FROM gaps WHERE txn_timestamp IS NOT NULL AND amount IS NOT NULL "
            "AND channel IS NOT NULL AND status IS NOT NULL",
        ),
        "csv_quarantine": q(
            GAPS
            + ",\ntyped AS (SELECT * REPLACE (CASE WHEN transaction_id % 19 <> 0 THEN amount END AS amount), "
            "amount IS NOT NULL AND transaction_id % 19 = 0 AS bad FROM gaps)",
            gap_reasons("typed", "CASE WHEN bad THEN 'malformed' END"),
        ),
        "table_roundtrip": q(CLEAN, "SELECT * FROM clean"),
        "table_partitions": q(CLEAN, "SELECT DISTINCT channel FROM clean"),
        "built_tables": q(
            GAPS,
            "SELECT transaction_id, customer_id, txn_timestamp, amount, lower(transaction_type) AS transaction_type, "
            f"lower(channel) AS channel, status, {DERIVED} FROM gaps WHERE txn_timestamp IS NOT NULL "
            "AND amount IS NOT NULL AND channel IS NOT NULL AND status <> 'failed'",
        ),
        "built_rejected": q(GAPS, f"SELECT * FROM ({gap_reasons('gaps')}) WHERE reason <> 'valid'"),
        "distinct_channels": q(CLEAN, "SELECT DISTINCT channel FROM clean"),
        "channel_sets": q(
            CLEAN,
            f"SELECT customer_id, {WEEK} AS window_start, string_agg(DISTINCT channel, ',' ORDER BY channel) "
            "AS channels FROM clean GROUP BY 1, 2",
        ),
        "describe_amount": q(
            RAW,
            f"SELECT count(amount) AS n, {MEAN} AS mean, round(stddev_samp(amount), 4) AS stddev, "
            "min(amount) AS min, max(amount) AS max FROM raw",
        ),
        "describe_columns": q(
            CLEAN,
            " UNION ALL ".join(
                f"SELECT '{c}' AS field, count({c}) AS n, {MEAN.replace('amount', c)} AS mean, round(stddev_samp({c}), 4) "
                f"AS stddev, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM clean"
                for c in DESCRIBED
            ),
        ),
        "describe_fields": q(
            CLEAN,
            " UNION ALL ".join(
                f"SELECT '{c}' AS field, count({c}) AS n, "
                + (f"{MEAN.replace('amount', c)} AS mean, round(stddev_samp({c}), 4) AS stddev" if number else "NULL AS mean, NULL AS stddev")
                + f", CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM clean"
                for c, number in FIELDS.items()
            ),
        ),
        "fraud_windows": q(FLAGGED, "SELECT * FROM flagged"),
        "fraud_alerts": q(ALERTS, alert + "alerts"),
        "fraud_alerts_reason": q(
            ALERTS,
            "SELECT *, 'Withdrew amount more than 400 INR multiple times within small timeframe' AS reason, "
            "customer_id || ' has withdrawn ' || transaction_count || ' times under 1 day of amount more than "
            "400 rupees (Rs. ' || amount || ').' AS reason_detail FROM alerts",
        ),
        "fraud_alerts_halfopen": q(
            LARGE,
            "SELECT count(transaction_id) OVER (PARTITION BY customer_id, date_trunc('day', txn_timestamp)) "
            "AS transaction_count, transaction_id, customer_id, txn_timestamp, amount, channel "
            "FROM large QUALIFY transaction_count > 2",
        ),
        "sliding_windows": q(
            SLIDING, "SELECT customer_id, window_start, transaction_count FROM sliding"
        ),
        "sliding_alerts": q(SLIDING, alert + "sliding_alerts"),
        "interval_alerts": q(
            BURSTS,
            f"SELECT {columns}, burst_start, burst_end FROM bursts JOIN large USING (customer_id) "
            "WHERE txn_timestamp >= burst_start AND txn_timestamp < burst_end",
        ),
        "interval_windows": q(
            SLIDING,
            f"SELECT {columns}, window_start FROM sliding JOIN large USING (customer_id) "
            "WHERE txn_timestamp >= window_start AND txn_timestamp < window_start + INTERVAL 1 day",
        ),
        "alert_cells": q(
            ALERTS,
            " UNION ALL ".join(
                f"SELECT customer_id || '_' || transaction_id AS row_key, 'info:{c}' AS cell, "
                f"CAST({c} AS VARCHAR) AS value FROM alerts"
                for c in ALERT_COLUMNS
            ),
        ),
        "alert_cells_large": q(
            ALERTS,
            "SELECT customer_id || '_' || transaction_id AS row_key, CAST(amount * 1000000 AS VARCHAR) AS value FROM alerts",
        ),
        "alert_versions": q(STORED, "SELECT * FROM versions"),
        "alert_versions_compacted": q(STORED, "SELECT * FROM versions"),
        "alert_table_scan": q(STORED, "SELECT * FROM versions"),
        "alert_latest": q(STORED, "SELECT * EXCLUDE (version) FROM versions WHERE version = 1"),
        "alert_history": q(
            STORED,
            "SELECT row_key, CAST(count(*) AS INTEGER) AS n_versions, "
            "string_agg(transaction_count, ',' ORDER BY version) AS counts FROM versions GROUP BY 1",
        ),
        "stream_parse": q(LARGE, f"SELECT * EXCLUDE (high_value_flag) FROM (SELECT *, {DERIVED} FROM large)"),
        "stream_rejects": q(
            RAW,
            "SELECT concat_ws(',', CASE WHEN transaction_id % 19 = 0 THEN 'malformed,amount' END, "
            "CASE WHEN transaction_id % 23 = 0 THEN 'future' END) AS reason, count(*) AS n FROM raw "
            "WHERE transaction_id % 19 = 0 OR transaction_id % 23 = 0 GROUP BY 1",
        ),
        "stream_alerts_per_batch": q(
            ALERTS,
            "SELECT customer_id || '_' || transaction_id AS row_key, max(transaction_count) AS transaction_count, "
            "transaction_id, customer_id, txn_timestamp, amount, channel, CAST(0 AS BIGINT) AS batch_id "
            "FROM alerts GROUP BY ALL",
        ),
        "stream_alerts_stateful": q(
            SLIDING,
            "SELECT customer_id || '_' || transaction_id AS row_key, * FROM sliding_alerts",
        ),
        "stream_late": q(
            LATE,
            "SELECT 'late' AS kind, CAST(0 AS BIGINT) AS transaction_count, transaction_id, customer_id, amount FROM tenth WHERE late "
            "UNION ALL SELECT 'alert', transaction_count, transaction_id, customer_id, amount FROM first_run "
            "UNION ALL SELECT 'alert', transaction_count, transaction_id, customer_id, amount FROM both_runs "
            "ANTI JOIN first_run USING (transaction_id, customer_id)",
        ),
    }
    result.update({f"rollup_{name}": result[name] for name in ROLLUP_REPORTS})
    result["report_tables"] = " UNION ALL ".join(
        f"SELECT '{name}' AS report, concat_ws('|', {REPORT_CELLS[name]}) AS cells FROM ({result[name]})" for name in REPORT_TABLES
    )
    result["incremental_reports"] = result["report_tables"]
    result["all_channels_last_week_by_day"] = result["all_channels_last_week"]
    return result
