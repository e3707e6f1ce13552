"""The generated ``events`` table as bank transactions, for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def transactions_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the raw layout, in mixed case, one per event."""
    kind, number = F.col("event_type"), F.col("event_id")
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        number.alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("txn_timestamp"),
        (F.col("value") * 10).alias("amount"),
        F.when(kind.isin("purchase", "view"), "Withdrawal").otherwise("Deposit").alias("transaction_type"),
        F.when(number % 3 == 0, "ATM").when(number % 3 == 1, "Online").otherwise("Branch").alias("channel"),
        F.when((kind == "error") | (number % 5 == 0), "failed").otherwise("success").alias("status"),
    )
