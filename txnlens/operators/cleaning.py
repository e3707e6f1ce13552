"""From validated records to the raw and the clean table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.schema import FAILED, HIGH_VALUE


def normalize(df: DataFrame) -> DataFrame:
    """Type and channel in lower case; ``status`` is left as it is."""
    return df.withColumns({c: F.lower(c) for c in ("transaction_type", "channel")})


def not_failed(df: DataFrame) -> DataFrame:
    """Rows whose status is known and not ``failed``."""
    return df.where(F.col("status") != FAILED)


def high_value_flag(threshold: float = HIGH_VALUE) -> Column:
    """1 if the amount is above the threshold, else 0, also for no amount."""
    return F.when(F.col("amount") > threshold, 1).otherwise(0)


def derive(df: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """Adds day of month, hour and the high-value flag, replacing any the source carries."""
    return df.withColumns(
        {
            "txn_day": F.dayofmonth("txn_timestamp"),
            "txn_hour": F.hour("txn_timestamp"),
            "high_value_flag": high_value_flag(high_value),
        }
    )


def clean(df: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """The clean table from normalised rows of all statuses."""
    return not_failed(df).transform(derive, high_value)


def clean_transactions(df: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """The clean table from records as they arrive."""
    return normalize(df).transform(clean, high_value)
