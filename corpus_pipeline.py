"""The corpus pipeline: quality, near-duplicates, benchmark leaks, mix, shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlens.llm import decontamination, dedup, mixing, quality, sharding
from txnlens.llm.common import materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.drop_low_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return dedup.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with the benchmark."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their slot and shard."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Trained and similarity stages have no SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), name)
    return docs
