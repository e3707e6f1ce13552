"""Sums and means of amounts that do not depend on how rows are partitioned."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Amounts from here on are summed as DECIMAL; below, their paise as LONG.
LARGE = 1e12


def exact_sum(amount: str | Column) -> Column:
    """Sum of a DOUBLE amount as a DECIMAL with six decimals.

    A plain DOUBLE sum changes with partitioning and retries; a DECIMAL sum does
    not, but costs several times as much per row. So whole paise are summed as
    LONG, and what is left below a paisa as millionths, as LONG too; only amounts
    of LARGE and more go the slow way. An amount that is not finite, or a sum that
    has no room in its type, makes the sum NULL.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    small = F.abs(amount) < LARGE
    paise = F.when(small, F.rint(amount * 100)).try_cast("long")
    micros = F.when(small, F.rint((amount - paise / 100) * 1_000_000)).try_cast("long")
    large = F.when(~small, amount).try_cast("decimal(38,6)")
    zero = F.lit(0)
    units = F.coalesce(F.try_sum(paise), F.when(F.count(paise) == 0, zero)).cast("decimal(20,0)") * F.lit(Decimal("0.01"))
    rests = F.coalesce(F.try_sum(micros), F.when(F.count(micros) == 0, zero)).cast("decimal(20,0)") * F.lit(Decimal("0.000001"))
    rest_of = F.coalesce(F.try_sum(large), F.when(F.count(large) == 0, zero.cast("decimal(38,6)")))
    odd = F.count_if(F.isnan(amount) | (~small & large.isNull()))
    whole = F.try_add((units + rests).cast("decimal(38,6)"), rest_of)
    return F.when((F.count(amount) > 0) & (odd == 0), whole).try_cast("decimal(38,6)")


def rounded(value: Column) -> Column:
    """A decimal rounded half up to two places, as DOUBLE."""
    return F.round(value, 2).cast("double")


def mean_of(total: Column, count: Column) -> Column:
    """``total / count`` to two places; NULL for an empty group."""
    return rounded(F.try_divide(total.cast("double"), count).try_cast("decimal(24,6)"))


def percent(part: Column, whole: Column) -> Column:
    """``part`` in per cent of ``whole`` to two places; NULL for an empty group."""
    return rounded(F.try_divide(part * 100, whole).cast("decimal(24,6)"))
