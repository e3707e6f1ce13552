"""Rows in intervals of any place and length.

Windows that start at multiples of a step are matched by equality elsewhere. Here
an interval can begin and end anywhere, and intervals may overlap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnlens.functions.durations import epoch_micros, floor_to, interval, micros
from txnlens.operators.matching import HOT_ROWS, MAX_HOT_GROUPS
from txnlens.operators.sliding import sliding_windows
from txnlens.schema import ALERT_COLUMNS, BURST_COUNT, BURST_SLIDE, BURST_WINDOW

#: Bins of a level are 2 to this power times as wide as those of the level below.
BITS = 3


def _sweep(intervals: DataFrame, by: Sequence[str], keys: Sequence[str], highest: Sequence[str]) -> DataFrame:
    """Intervals of each group in order of their starts; one that starts after all ends before it opens a new one."""
    in_order = Window.partitionBy(*by).orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") > reached, F.lit(True)).cast("long")
    numbered = intervals.withColumn("_opens", opens).withColumn(
        "_run", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        numbered.groupBy(*by, "_run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), *[F.max(c).alias(c) for c in highest])
        .select(*keys, "start", "end", *highest)
    )


def merge_intervals(
    intervals: DataFrame, keys: Sequence[str], highest: Sequence[str] = (), chunk: str = "1 day"
) -> DataFrame:
    """Overlapping and touching intervals of a key as one, from ``start`` to ``end``, with the highest of some columns.

    Intervals that start in the same ``chunk`` of time are merged first, so that a
    key with very many of them is swept by many tasks, and the sweep over a whole
    key sees what is left of each chunk. Intervals without start or end, or that
    end before they start, are left out; NULL is a key like any other.
    """
    keys, span = list(keys), micros(chunk)
    kept = intervals.where(F.col("start") <= F.col("end")).select(*keys, "start", "end", *highest)
    chunked = kept.withColumn("_chunk", floor_to(epoch_micros(F.col("start")), span))
    return _sweep(_sweep(chunked, [*keys, "_chunk"], keys, highest), keys, keys, highest)


def _bin(at: Column) -> Column:
    return F.call_function("shiftright", at, F.col("_shift"))


def interval_join(
    rows: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    *,
    end_inclusive: bool = False,
    hot_rows: int = HOT_ROWS,
    max_hot_bins: int = MAX_HOT_GROUPS,
) -> DataFrame:
    """Each row with each interval of its key that its time ``at`` lies in, from ``start`` to ``end``.

    Time is cut into bins on levels of ever wider ones. An interval belongs to the
    level whose bins are just as long as itself, so it lies in two of them at
    most; a row is looked up once on each level that intervals are on, a dozen or
    so if they are of all lengths and one if they are of one. So the range
    condition is checked only within a bin, and the join is one on equal bins.

    A bin is hot if it has more than ``hot_rows`` rows and more than one
    ``max_hot_bins``-th of all rows in bins with intervals; fewer than
    ``max_hot_bins`` can. Its rows are dealt over as many parts as that limit goes
    into them, and its intervals given to each part.

    Rows with a NULL key or time match nothing. An interval that is repeated matches
    as often. Columns of both sides are kept, but for the intervals' keys; they
    have to be of different names. Rows may not hold maps, by which they can't be dealt.
    """
    keys = list(keys)
    others = [c for c in intervals.columns if c not in keys]
    clash = sorted({c.lower() for c in others} & {c.lower() for c in rows.columns})
    if clash:
        raise ValueError(f"columns of both rows and intervals: {clash}")
    key = [f"_key{i}" for i in range(len(keys))]
    named = [F.col(k).alias(n) for k, n in zip(keys, key)]
    slot = [*key, "_shift", "_bin"]

    first, last = F.col("_first"), F.col("_last")
    bits = F.when(last > first, F.length(F.bin(last - first))).otherwise(0)
    spans = (
        intervals.select(F.struct(*others).alias("_interval"), *named)
        .withColumn("_first", epoch_micros(F.col("_interval.start")))
        .withColumn("_last", epoch_micros(F.col("_interval.end")) - (0 if end_inclusive else 1))
        .where(first <= last)
        .withColumn("_shift", (F.ceil(bits / BITS) * BITS).cast("int"))
    )
    levels = spans.agg(F.collect_set("_shift")).scalar()
    covered = spans.withColumn("_bin", F.explode(F.sequence(_bin(first), _bin(last))))
    placed = (
        rows.select(F.struct("*").alias("_row"), epoch_micros(F.col(at)).alias("_at"), *named)
        .where(F.col("_at").isNotNull())
        .withColumn("_shift", F.explode(levels))
        .withColumn("_bin", _bin(F.col("_at")))
    )

    held = covered.select(*slot).distinct()
    counts = placed.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n")).join(held, slot, "left_semi")
    limit = F.greatest(F.lit(float(hot_rows)), counts.agg(F.sum("_n")).scalar() / max_hot_bins)
    hot = F.broadcast(counts.where(F.col("_n") > limit).select(*slot, F.ceil(F.col("_n") / limit).alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = placed.join(hot, slot, "left").withColumn("_part", F.pmod(F.xxhash64("_row"), parts)).drop("_parts")
    given = covered.join(hot, slot, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    met = dealt.join(given.drop("_parts"), [*slot, "_part"]).where((F.col("_at") >= first) & (F.col("_at") <= last))
    return met.select("_row.*", "_interval.*")


def bursts(
    df: DataFrame, window: str = BURST_WINDOW, slide: str = BURST_SLIDE, min_count: int = BURST_COUNT
) -> DataFrame:
    """The stretches of time, ``start`` to ``end``, in which a customer's flagged sliding windows overlap or touch.

    ``transaction_count`` is that of the fullest window in the stretch.
    """
    flagged = sliding_windows(df, window, slide, min_count)
    start = F.col("window_start")
    spans = flagged.select("customer_id", start.alias("start"), (start + interval(window)).alias("end"), "transaction_count")
    return merge_intervals(spans, ["customer_id"], ["transaction_count"])


def interval_alerts(
    df: DataFrame,
    window: str = BURST_WINDOW,
    slide: str = BURST_SLIDE,
    min_count: int = BURST_COUNT,
    **skew: int,
) -> DataFrame:
    """The rows of ``sliding_alerts``, each with the whole burst it belongs to and the count of its fullest window.

    ``skew`` goes to ``interval_join``.
    """
    rows = df.select(*[c for c in ALERT_COLUMNS if c != "transaction_count"])
    found = interval_join(rows, bursts(df, window, slide, min_count), ["customer_id"], "txn_timestamp", **skew)
    return found.select(*ALERT_COLUMNS, F.col("start").alias("burst_start"), F.col("end").alias("burst_end"))


def windows_by_join(
    df: DataFrame,
    window: str = BURST_WINDOW,
    slide: str = BURST_SLIDE,
    min_count: int = BURST_COUNT,
    **skew: int,
) -> DataFrame:
    """Each row with each flagged sliding window that it lies in, which overlap."""
    start = F.col("window_start")
    flagged = sliding_windows(df, window, slide, min_count)
    spans = flagged.select("customer_id", start.alias("start"), (start + interval(window)).alias("end"), "transaction_count")
    rows = df.select(*[c for c in ALERT_COLUMNS if c != "transaction_count"])
    found = interval_join(rows, spans, ["customer_id"], "txn_timestamp", **skew)
    return found.select(*ALERT_COLUMNS, F.col("start").alias("window_start"))
