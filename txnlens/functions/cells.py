"""Keys, cells and texts of alert records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnlens.schema import (
    ALERT_COLUMNS,
    ALERT_REASON,
    ALERT_SENTENCE,
    BURST_WINDOW,
    CELL_FAMILY,
    LARGE_WITHDRAWAL,
)


def row_key() -> Column:
    """``<customer>_<transaction>``, the key under which an alert is stored."""
    return F.concat(F.col("customer_id").cast("string"), F.lit("_"), F.col("transaction_id").cast("string"))


def amount_text(amount: Column) -> Column:
    """A DOUBLE as its shortest decimal text, without an exponent from 1e-4 up to 1e16."""
    text, size = amount.cast("string"), F.abs(amount)
    digits = F.rtrim(text.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.when(F.contains(text, F.lit("E")) & (size >= 1e-4) & (size < 1e16), plain).otherwise(text)


def cell_text(name: str) -> Column:
    return amount_text(F.col(name).cast("double")) if name == "amount" else F.col(name).cast("string")


def cell_map(columns: Sequence[str] = ALERT_COLUMNS, family: str = CELL_FAMILY) -> Column:
    """All cells of a record as a map from ``family:column`` to text; NULL stays NULL."""
    pairs = []
    for name in columns:
        pairs += [F.lit(f"{family}:{name}"), cell_text(name)]
    return F.create_map(*pairs)


def reason_text() -> Column:
    """The general reason of every alert."""
    return F.lit(ALERT_REASON)


def reason_sentence(window: str = BURST_WINDOW, min_amount: float = LARGE_WITHDRAWAL) -> Column:
    """The reason of one alert, naming its customer, count and amount."""
    text = ALERT_SENTENCE.format(window=window, amount=f"{min_amount:g}")
    cells = [cell_text(c) for c in ("customer_id", "transaction_count", "amount")]
    return F.format_string(text, *cells)
