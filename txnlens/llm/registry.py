"""The queries of these operators by name, and the SQL that checks them."""

from __future__ import annotations

import os
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from txnlens.llm import chat, decontamination, dedup, importance, language, lm, merkle, mixing, neighbours, quality, sharding, substrings, urls

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: importable(query) for name, query in _queries().items()}


def importable(query: Callable) -> Callable:
    """Lets Python workers on this machine import the package; on a cluster, --py-files does that."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        known = environment.get("PYTHONPATH", "")
        if ROOT not in known.split(os.pathsep):
            environment["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, known]))
        return query(spark, sf_dir)

    return run


def _queries() -> dict:
    return {
        "op1_decontamination": decontamination.op1_decontamination,
        "op2_near_duplicates": dedup.op2_near_duplicates,
        "op3_language": language.op3_language,
        "op4_quality": quality.op4_quality,
        "op5_mixing": mixing.op5_mixing,
        "op6_chat": chat.op6_chat,
        "op7_lm_scores": lm.op7_lm_scores,
        "op8_urls": urls.op8_urls,
        "op9_sharding": sharding.op9_sharding,
        "op10_nearest": neighbours.op10_nearest,
        "op11_repeats": substrings.op11_repeats,
        "op12_merkle": merkle.op12_merkle,
        "op13_importance": importance.op13_importance,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontamination.oracle(),
        "op5_mixing": mixing.oracle(),
        "op6_chat": chat.oracle(),
        "op9_sharding": sharding.oracle(),
        "op11_repeats": substrings.oracle(),
        "op12_merkle": merkle.oracle(),
        "op13_importance": importance.oracle(),
    }
