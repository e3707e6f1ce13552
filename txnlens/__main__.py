"""Runs for spark-submit: ``transform``, ``reports``, ``alerts``, ``compact`` and ``scan``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.operators.bursts import large_withdrawals
from txnlens.operators.cleaning import normalize
from txnlens.operators.quality import split_valid
from txnlens.plans.suite import run_reports
from txnlens.plans.transform import build_tables, load_days
from txnlens.schema import BURST_COUNT, BURST_SLIDE, BURST_WINDOW, LARGE_WITHDRAWAL, REJECTED_TABLE
from txnlens.session import build_session, require_utc
from txnlens.sinks.alerts import compact_alerts, latest_alerts, publish_alerts, read_alerts
from txnlens.sources.lines import parse_lines
from txnlens.sources.streams import read_kafka, read_line_files
from txnlens.streaming.alerts import stateful_alerts
from txnlens.streaming.early import early_alerts, early_handler
from txnlens.streaming.runner import COMPACT_EVERY, burst_handler, start, start_parquet, store_handler


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="txnlens", description=__doc__)
    parser.add_argument("--hive", action="store_true", help="use the Hive metastore as catalog")
    runs = parser.add_subparsers(dest="run", required=True)

    transform = runs.add_parser("transform", help="CSV files to the raw and the clean table")
    transform.add_argument("--csv", required=True)
    transform.add_argument("--quarantine-table", default=REJECTED_TABLE, help="table of the rejected records")
    transform.add_argument("--by-day", action="store_true", help="replace only the days in the files, in tables partitioned by day")
    transform.add_argument("--keep-incomplete", action="store_true", help="leave rejected records in the raw table too")

    reports = runs.add_parser("reports", help="all report tables from the saved tables")
    reports.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    for run in (transform, reports):
        run.add_argument("--db", required=True)
        run.add_argument("--location", required=True, help="folder of the tables")

    alerts = runs.add_parser("alerts", help="screen a stream of transactions")
    source = alerts.add_mutually_exclusive_group(required=True)
    source.add_argument("--kafka", metavar="SERVERS")
    source.add_argument("--folder", help="folder in which text files of messages arrive")
    alerts.add_argument("--topic")
    alerts.add_argument("--layout", choices=["raw", "clean", "stream"], default="stream")
    alerts.add_argument("--checkpoint", required=True)
    alerts.add_argument(
        "--per-batch-only",
        action="store_true",
        help="tumbling windows within each micro-batch; misses bursts that two batches share",
    )
    alerts.add_argument(
        "--early",
        action="store_true",
        help="report a row in the batch that completes a burst, and keep rows that come too late",
    )
    alerts.add_argument("--late", help="folder of those rows, by default that of the alerts with _late")
    alerts.add_argument("--window", default=BURST_WINDOW)
    alerts.add_argument("--slide", default=BURST_SLIDE, help="step of the windows; not with --per-batch-only")
    alerts.add_argument("--delay", default=BURST_WINDOW, help="how late a message may be; not with --per-batch-only")
    alerts.add_argument("--amount", type=float, default=LARGE_WITHDRAWAL, help="withdrawals above it count")
    alerts.add_argument("--count", type=int, default=BURST_COUNT, help="alert if a window has more of them")
    alerts.add_argument("--success-only", action="store_true", help="leave out failed withdrawals")
    alerts.add_argument("--rejects", help="folder of the rejected messages, by default that of the alerts with _rejected")
    alerts.add_argument("--ahead", default="1 day", help="messages dated further ahead of now are rejected")
    alerts.add_argument("--starting-offsets", default="latest", help="where a new run starts in the topic")
    alerts.add_argument("--every", help="start a micro-batch so often, such as '10 seconds'")
    alerts.add_argument("--per-batch", type=int, help="at most so many messages (Kafka) or files per micro-batch")
    alerts.add_argument("--drain", action="store_true", help="take what is there and end")

    alerts.add_argument("--compact-every", type=int, default=COMPACT_EVERY, help="batches after which the alert table is compacted, 0: never")

    compact = runs.add_parser("compact", help="compact the alert table, also while a stream fills it")
    compact.add_argument("--db", help="give the table its name in this database as well")
    scan = runs.add_parser("scan", help="print all current alerts, or write them")
    scan.add_argument("--out", help="folder to write them to as Parquet instead")
    for run in (alerts, compact, scan):
        run.add_argument("--alerts", required=True, help="folder of the alert table")
    args = parser.parse_args(argv)
    if args.run == "alerts" and args.kafka and not args.topic:
        parser.error("--kafka needs --topic")
    if args.run == "transform" and args.by_day and args.keep_incomplete:
        parser.error("--by-day keeps no incomplete records")
    if args.run == "alerts" and args.early and args.per_batch_only:
        parser.error("--early and --per-batch-only exclude each other")
    return args


def scan_alerts(alerts: DataFrame, out: str | None = None) -> None:
    """Every alert, as a line of JSON each (read a partition at a time), or written to ``out``."""
    if out:
        alerts.write.parquet(out)
        return
    for row in alerts.select(F.to_json(F.struct("*")).alias("line")).toLocalIterator():
        print(row["line"])


def read_large_splits(spark: SparkSession) -> None:
    """Fewer, larger files: a task writes one per channel, so it should read much."""
    size = "spark.sql.files.maxPartitionBytes"
    if not spark.sparkContext.getConf().contains(size):
        spark.conf.set(size, "1g")


def screen(spark: SparkSession, args: argparse.Namespace) -> None:
    """Alerts of the valid messages, and the rejected ones with their reasons, as two streams of one source."""
    require_utc(spark)
    if args.kafka:
        limit = {"maxOffsetsPerTrigger": str(args.per_batch)} if args.per_batch else {}
        lines = read_kafka(spark, args.kafka, args.topic, starting_offsets=args.starting_offsets, **limit)
    else:
        lines = read_line_files(spark, args.folder, files_per_batch=args.per_batch)
    valid, rejected = split_valid(parse_lines(lines, args.layout, keep_corrupt=True), args.ahead)
    rows = large_withdrawals(normalize(valid), args.amount, success_only=args.success_only)
    pace = {"every": args.every, "drain": args.drain}
    # Rejects start first: from the latest offsets on, they then miss no message that alerts see.
    rejects = args.rejects or f"{args.alerts.rstrip('/')}_rejected"
    running = [start_parquet(rejected, rejects, f"{args.checkpoint.rstrip('/')}_rejected", **pace)]
    if args.per_batch_only:
        handle = burst_handler(args.alerts, compact_every=args.compact_every, window=args.window, min_count=args.count)
        running.append(start(rows, handle, args.checkpoint, **pace))
    elif args.early:
        found = early_alerts(rows, args.window, args.slide, args.count, delay=args.delay)
        handle = early_handler(args.alerts, args.late or f"{args.alerts.rstrip('/')}_late", compact_every=args.compact_every)
        running.append(start(found, handle, args.checkpoint, **pace))
    else:
        found = stateful_alerts(rows, args.window, args.slide, args.count, delay=args.delay)
        running.append(start(found, store_handler(args.alerts, compact_every=args.compact_every), args.checkpoint, **pace))
    if args.drain:
        for query in running:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()  # neither goes on without the other


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session(f"txnlens-{args.run}", hive=args.hive)
    if args.run == "transform" and args.by_day:
        load_days(spark, args.csv, db=args.db, location=args.location, quarantine_table=args.quarantine_table)
    elif args.run == "transform":
        read_large_splits(spark)
        build_tables(
            spark,
            args.csv,
            db=args.db,
            location=args.location,
            quarantine_table=args.quarantine_table,
            keep_incomplete=args.keep_incomplete,
        )
    elif args.run == "reports":
        run_reports(spark, db=args.db, location=args.location, mode=args.mode)
    elif args.run == "alerts":
        screen(spark, args)
    elif args.run == "compact":
        compact_alerts(spark, args.alerts)
        if args.db:
            publish_alerts(spark, args.alerts, args.db)
    else:
        scan_alerts(latest_alerts(read_alerts(spark, args.alerts)), args.out)


if __name__ == "__main__":
    main()
