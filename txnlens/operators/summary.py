"""Summaries of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.cells import amount_text
from txnlens.functions.money import exact_sum, mean_of
from txnlens.operators.channels import set_texts

#: Types whose values have an order and a text.
ORDERED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _measures(value: Column) -> list[Column]:
    return [
        F.count(value).alias("n"),
        mean_of(exact_sum(value), F.count(value)).alias("mean"),
        F.round(F.stddev_samp(value), 4).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def describe_amount(df: DataFrame, column: str = "amount") -> DataFrame:
    """Count, mean, standard deviation, least and greatest value, as one row."""
    return df.agg(*_measures(F.col(column)))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for several numeric columns as DOUBLE, a row per ``field``, by one aggregate over all rows."""
    fields = [F.struct(F.lit(c).alias("field"), *_measures(F.col(c).cast("double"))) for c in columns]
    return df.agg(F.array(*fields).alias("fields")).select(F.inline("fields"))


def describe_fields(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row per ``field`` of any type that has an order: count, mean and deviation of numbers, least and greatest as text.

    All such columns by default. Texts, times and truth values have NULL for mean and deviation; texts
    compare by code points. One aggregate over all rows.
    """
    kinds = {f.name: f.dataType for f in df.schema if isinstance(f.dataType, ORDERED)}
    wrong = [c for c in columns or () if c not in kinds]
    if wrong:
        raise TypeError(f"no order or no such column: {wrong}")
    none = F.lit(None).cast("double")
    fields = []
    for name in kinds if columns is None else columns:
        value = F.col(f"`{name}`")
        number = isinstance(kinds[name], T.NumericType)
        floating = isinstance(kinds[name], T.DoubleType | T.FloatType)
        n, mean, stddev = _measures(value.cast("double"))[:3] if number else (F.count(value).alias("n"), none.alias("mean"), none.alias("stddev"))
        texts = [amount_text(x) if floating else x.cast("string") for x in (F.min(value), F.max(value))]
        fields.append(F.struct(F.lit(name).alias("field"), n, mean, stddev, texts[0].alias("min"), texts[1].alias("max")))
    if not fields:
        raise TypeError("no column has an order")
    return df.agg(F.array(*fields).alias("fields")).select(F.inline("fields"))


def distinct_channels(df: DataFrame) -> DataFrame:
    """The channels in use."""
    return df.select("channel").distinct()


def channel_sets(df: DataFrame, window: str = "7 days") -> DataFrame:
    """Channels each customer used in each window, as sorted comma-separated text."""
    week = F.window("txn_timestamp", window).getField("start")
    return set_texts(df.select("customer_id", week.alias("window_start"), "channel"), "customer_id", "window_start")
