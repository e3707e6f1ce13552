"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_table(spark: SparkSession, table: str, db: str) -> DataFrame:
    """A table of the catalog."""
    return spark.read.table(f"{db}.{table}")


def table_partitions(spark: SparkSession, table: str, db: str) -> DataFrame:
    """Partition values of a table, from the catalog alone: ``partition``, such as ``channel=atm``."""
    return spark.sql(f"SHOW PARTITIONS {db}.{table}").select(F.col("partition"))
