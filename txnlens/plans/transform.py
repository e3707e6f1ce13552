"""From CSV files to the raw and the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.operators.cleaning import clean, normalize
from txnlens.operators.quality import split_valid
from txnlens.schema import CLEAN_TABLE, CORRUPT, RAW_TABLE, REJECTED_TABLE, layout
from txnlens.session import require_utc
from txnlens.sinks.folders import Folder
from txnlens.sinks.tables import create_database, create_table, replace_partitions, save_table
from txnlens.sources.catalog import load_table
from txnlens.sources.files import read_transactions


def build_tables(
    spark: SparkSession,
    csv_path: str,
    *,
    db: str,
    location: str,
    quarantine_table: str | None = REJECTED_TABLE,
    keep_incomplete: bool = False,
    **read_options,
) -> None:
    """Write ``raw_transactions`` and ``transactions``, partitioned by channel.

    The text is parsed once: the clean table is derived from the raw one, whose
    columns are pruned and whose status filter reaches the Parquet scan. Records
    that are not valid go to ``quarantine_table`` with their reasons, and into the
    raw table as well with ``keep_incomplete``; the clean table is the same either
    way. The rejects take another pass over the text; None leaves them out.
    """
    require_utc(spark)
    create_database(spark, db)
    records = read_transactions(spark, csv_path, **read_options)
    valid, quarantined = split_valid(records)
    raw = records.drop(CORRUPT) if keep_incomplete else valid
    save_table(normalize(raw), RAW_TABLE, db=db, location=location, partition_by=["channel"])
    save_table(
        clean_from_raw(load_table(spark, RAW_TABLE, db), keep_incomplete),
        CLEAN_TABLE,
        db=db,
        location=location,
        partition_by=["channel"],
    )
    if quarantine_table:
        save_table(quarantined, quarantine_table, db=db, location=location)


def clean_from_raw(raw: DataFrame, has_incomplete: bool = False) -> DataFrame:
    """The clean table from the saved raw one."""
    return clean(split_valid(raw)[0] if has_incomplete else raw)


DAY = "txn_date"


def load_days(spark: SparkSession, csv_path: str, *, db: str, location: str, quarantine_table: str | None = REJECTED_TABLE, **read_options) -> list[str]:
    """Adds or replaces the days that a delivery holds, in tables partitioned by ``txn_date``; the days.

    A delivery holds its days whole: what the tables had of them goes. The text is parsed once; the raw table's
    new partitions show which days arrived, and the clean table is derived from those partitions alone. So a run
    costs what was delivered, however large the tables are. Rejects are added to ``quarantine_table``.
    """
    require_utc(spark)
    create_database(spark, db)
    for name, kind in ((RAW_TABLE, "raw"), (CLEAN_TABLE, "clean")):
        columns = T.StructType([*layout(kind), T.StructField(DAY, T.DateType())])
        create_table(spark, name, columns, db=db, location=location, partition_by=[DAY])
    records = read_transactions(spark, csv_path, **read_options)
    valid, quarantined = split_valid(records)
    dated = normalize(valid).withColumn(DAY, F.to_date("txn_timestamp"))
    days = replace_partitions(dated, RAW_TABLE, DAY, db=db, location=location)
    if days:
        arrived = load_table(spark, RAW_TABLE, db).where(F.col(DAY).isin([F.lit(day).cast("date") for day in days]))
        emptied = sorted({*days} - {*replace_partitions(clean(arrived), CLEAN_TABLE, DAY, db=db, location=location)})
        for day in emptied:  # of which no row is left
            drop_day(spark, CLEAN_TABLE, day, db=db, location=location)
    if quarantine_table:
        save_table(quarantined, quarantine_table, db=db, location=location, mode="append")
    return days


def drop_day(spark: SparkSession, table: str, day: str, *, db: str, location: str) -> None:
    spark.sql(f"ALTER TABLE {db}.{table} DROP IF EXISTS PARTITION ({DAY} = '{day}')")
    Folder(spark, f"{location.rstrip('/')}/{table}").delete(f"{DAY}={day}")
    spark.catalog.refreshTable(f"{db}.{table}")
