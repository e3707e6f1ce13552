"""Catalog databases and tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.sinks.folders import Folder


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """A database, unless there is one."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    *,
    db: str,
    location: str,
    partition_by: Sequence[str] = (),
    store_format: str = "parquet",
) -> None:
    """An external table under ``location``, unless there is one."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {db}.{table} ({columns}) "
        f"USING {store_format}{parts} LOCATION '{location}/{table}'"
    )


def save_table(
    df: DataFrame,
    table: str,
    *,
    db: str,
    location: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    store_format: str = "parquet",
    rebalance: bool = False,
) -> None:
    """Write a frame as an external table under ``location``; a rerun replaces it.

    Rows are written where they are: each task writes one file per partition
    value it meets, so a channel that holds most rows is spread over all tasks.
    ``rebalance`` shuffles first, for partition columns with many values, where
    that would make many small files; large partitions are still split.
    """
    if rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(store_format).option("path", f"{location}/{table}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"{db}.{table}")


def as_declared(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The frame's columns by name, in the order and with the types of a declared table.

    A missing or surplus column is an error, and so is a type that does not widen into the declared one.
    """
    given, wanted = {f.name.lower(): f for f in df.schema}, [f.name.lower() for f in declared]
    odd = sorted({*given} ^ {*wanted})
    if odd:
        raise ValueError(f"columns that only the rows or only the table have: {odd}")
    wrong = [f"{f.name}: {given[f.name.lower()].dataType.simpleString()} for {f.dataType.simpleString()}" for f in declared if not _widens(given[f.name.lower()].dataType, f.dataType)]
    if wrong:
        raise TypeError(f"types that the table does not take: {', '.join(wrong)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


def fill_table(df: DataFrame, table: str, *, db: str) -> None:
    """Replaces the rows of a declared table, which keeps its columns, types and partitioning."""
    as_declared(df, df.sparkSession.read.table(f"{db}.{table}").schema).write.mode("overwrite").insertInto(f"{db}.{table}")


def add_rows(df: DataFrame, table: str, *, db: str, location: str) -> None:
    """Adds rows to a table, whose columns and types stay, or makes it under ``location``."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(f"{db}.{table}"):
        return save_table(df, table, db=db, location=location)
    as_declared(df, spark.read.table(f"{db}.{table}").schema).write.mode("append").insertInto(f"{db}.{table}")


_WIDER = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _widens(given: T.DataType, to: T.DataType) -> bool:
    a, b = given.simpleString(), to.simpleString()
    return a == b or (a in _WIDER and b in _WIDER and _WIDER.index(a) <= _WIDER.index(b) and (a, b) != ("bigint", "float"))


def replace_partitions(df: DataFrame, table: str, by: str, *, db: str, location: str) -> list[str]:
    """Replaces those partitions of a declared table that ``df`` has rows of; their values.

    ``df`` is written aside in one pass; which partitions there are is read off the folders, and each is then renamed
    into the place of the old one. Files of other partitions are not touched. Run again after a failure, it
    ends in the same state.
    """
    spark = df.sparkSession
    declared = spark.read.table(f"{db}.{table}").schema
    folder = Folder(spark, f"{location.rstrip('/')}/{table}")
    draft = f"_staging/{uuid.uuid4().hex}"
    as_declared(df, declared).write.partitionBy(by).parquet(f"{folder.path}/{draft}")
    names = [name for name in folder.names(draft) if name.startswith(f"{by}=")]
    for name in names:
        folder.delete(name)
        folder.move(f"{draft}/{name}", name)
    folder.delete(draft)
    values = [name.removeprefix(f"{by}=") for name in names]
    for value in values:
        spark.sql(f"ALTER TABLE {db}.{table} ADD IF NOT EXISTS PARTITION ({by} = '{value}')")
    spark.catalog.refreshTable(f"{db}.{table}")
    return values
