"""Unbounded sources: each yields CSV lines in a ``value`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    *,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Messages of a Kafka topic; needs the ``spark-sql-kafka-0-10`` package.

    ``minPartitions`` splits a topic's large partitions over more tasks and
    ``maxOffsetsPerTrigger`` bounds a batch; both pass through ``options``.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def read_line_files(spark: SparkSession, path: str, *, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder, oldest file first."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
