"""Record layouts and the fixed values that results depend on.

Ids are LONG: an INT cannot number the rows of a table of this size. ``id_type``
is there for sources that are declared INT.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Names, texts and thresholds that have to be exactly these.
RAW_TABLE = "raw_transactions"
CLEAN_TABLE = "transactions"
REJECTED_TABLE = "rejected_transactions"
ALERT_TABLE = "suspicious_transaction"
REPORT_TABLES = {
    "top_customers": "top_five_customers",
    "top_withdrawal_customer": "customer_with_highest_total_withdrawal",
    "monthly_volume": "monthly_txns_volume",
    "avg_amount_by_channel": "avg_txn_amt_by_channel",
    "success_rate_by_channel": "success_rate_by_channel",
    "hourly_trend": "hourly_txn_trend",
    "daily_volume": "day_wise_txn_volume",
    "high_value_per_day": "high_value_txn_per_day",
    "failed_over_limit": "customers_with_more_failed_txn",
    "all_channels_in_week": "customers_used_all_channels_in_week",
}
WITHDRAWAL = "withdrawal"
SUCCESS = "success"
FAILED = "failed"
HIGH_VALUE = 500
LARGE_WITHDRAWAL = 400
BURST_WINDOW = "1 minute"
BURST_SLIDE = "1 second"
BURST_COUNT = 2
ALERT_VERSIONS = 4
CELL_FAMILY = "info"
ALERT_REASON = "Withdrew amount more than 400 INR multiple times within small timeframe"
ALERT_SENTENCE = "%s has withdrawn %s times under {window} of amount more than {amount} rupees (Rs. %s)."

ALERT_COLUMNS = [
    "transaction_count",
    "transaction_id",
    "customer_id",
    "txn_timestamp",
    "amount",
    "channel",
]

CORRUPT = "_corrupt_record"


def layout(name: str, id_type: T.DataType = T.LongType()) -> T.StructType:
    """Schema of a record layout: ``raw``, ``clean`` or ``stream``.

    ``raw`` is the 7-column export, ``clean`` the 10-column positional file with
    the derived columns, ``stream`` the 9-column message whose partition column
    ``channel`` comes last, as a scan of the saved table yields it.
    """
    fields = {
        "transaction_id": id_type,
        "customer_id": id_type,
        "txn_timestamp": T.TimestampType(),
        "amount": T.DoubleType(),
        "transaction_type": T.StringType(),
        "channel": T.StringType(),
        "status": T.StringType(),
        "txn_day": T.IntegerType(),
        "txn_hour": T.IntegerType(),
        "high_value_flag": T.IntegerType(),
    }
    base = ["transaction_id", "customer_id", "txn_timestamp", "amount", "transaction_type"]
    order = {
        "raw": [*base, "channel", "status"],
        "clean": [*base, "channel", "status", "txn_day", "txn_hour", "high_value_flag"],
        "stream": [*base, "status", "txn_day", "txn_hour", "channel"],
    }
    if name not in order:
        raise ValueError(f"unknown layout {name!r}; expected one of {sorted(order)}")
    return T.StructType([T.StructField(c, fields[c]) for c in order[name]])


def with_corrupt_record(schema: T.StructType) -> T.StructType:
    """The same schema plus the column in which Spark keeps an unparsable line."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
