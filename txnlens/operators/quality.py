"""Validation: which records are complete, and why the others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.durations import interval
from txnlens.schema import CORRUPT

REASON = "quarantine_reason"


def _missing(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        infinite = F.abs(value) == F.lit(float("inf")).cast(field.dataType)
        return value.isNull() | F.isnan(value) | infinite
    return value.isNull()


def with_reason(df: DataFrame, ahead: str | None = None) -> DataFrame:
    """Adds ``quarantine_reason``: ``malformed``, and the columns without a usable value.

    It is empty for a valid record. It looks at every column, so the CSV reader
    cannot skip one and pass a bad value by. With ``ahead``, records dated further
    than that after now are ``future``.
    """
    checks = [
        F.when(_missing(f), F.lit(f.name)) for f in df.schema.fields if f.name not in (CORRUPT, REASON)
    ]
    if CORRUPT in df.columns:
        checks.insert(0, F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")))
    if ahead:
        checks.append(F.when(F.col("txn_timestamp") > F.current_timestamp() + interval(ahead), F.lit("future")))
    return df.withColumn(REASON, F.concat_ws(",", *checks))


def split_valid(df: DataFrame, ahead: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantined)``; quarantined rows keep their line and their reason."""
    checked = with_reason(df, ahead)
    valid = checked.where(F.col(REASON) == "").drop(REASON, CORRUPT)
    return valid, checked.where(F.col(REASON) != "")


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows with a value in every column."""
    return df.dropna(how="any")


def quarantine_counts(df: DataFrame) -> DataFrame:
    """Number of records per reason; ``valid`` for those without one."""
    reason = F.when(F.col(REASON) == "", F.lit("valid")).otherwise(F.col(REASON))
    return with_reason(df).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
