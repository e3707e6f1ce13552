"""Durations written as in ``F.window``, such as ``'1 minute'``."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(duration: str) -> int:
    """Length in microseconds of a duration such as ``'90 seconds'``."""
    match = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", duration.lower())
    if not match or match[2] not in MICROS or int(match[1]) == 0:
        raise ValueError(f"not a duration: {duration!r}")
    return int(match[1]) * MICROS[match[2]]


def interval(duration: str, times: int = 1) -> Column:
    """The duration, or a multiple of it, as an interval column."""
    micros(duration)
    return F.expr(f"INTERVAL {duration} * {times}")


def epoch_micros(timestamp: Column) -> Column:
    """Microseconds since 1970 of either timestamp type (session zone UTC)."""
    return F.unix_micros(timestamp.cast("timestamp"))


def floor_to(value: Column, step: int) -> Column:
    """The largest multiple of ``step`` not above a LONG value, also below zero."""
    return value - F.pmod(value, F.lit(step))
