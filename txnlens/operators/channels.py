"""Sets of channels as bit masks: one shuffle, of a mask per group and task.

A dictionary numbers the channels in use. A set is as many LONG words of 64 bits
as that takes, built by a bitwise or, which partial aggregates can start on the
scanning tasks; collecting sets of distinct rows takes a second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
#: Channels that are numbered and broadcast. Where more are in use, sets are counted from distinct rows.
MOST_CHANNELS = 1024


def channel_dictionary(df: DataFrame, most: int = MOST_CHANNELS) -> list[str] | None:
    """The different channels in order, None if there are more than ``most``. Runs a job over that column."""
    found = df.select("channel").where(F.col("channel").isNotNull()).distinct().orderBy("channel").limit(most + 1).collect()
    return [r[0] for r in found] if len(found) <= most else None


def literal(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(name) for name in names]).cast("array<string>")


def channel_masks(df: DataFrame, names: Sequence[str], *by: str) -> DataFrame:
    """``by`` and ``words``, an array of LONG: bit ``i % 64`` of word ``i // 64`` says that ``names[i]`` occurs.

    NULL and channels without a name set no bit, but their rows make groups.
    """
    listed = df.sparkSession.range(1).select(F.posexplode(literal(names)).alias("i", "channel"))
    numbered = listed.select("channel", F.floor(F.col("i") / BITS).alias("word"), (F.col("i") % BITS).alias("bit"))
    bits = df.select(*by, "channel").join(F.broadcast(numbered), "channel", "left")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    words = [F.coalesce(F.bit_or(F.when(F.col("word") == w, one)), F.lit(0).cast("long")) for w in range(-(-len(names) // BITS))]
    return bits.groupBy(*by).agg(F.array(*words).cast("array<bigint>").alias("words"))


def has_every(n: int) -> Column:
    """Whether ``words`` has all of ``n`` bits set."""
    return F.aggregate("words", F.lit(0), lambda total, word: total + F.bit_count(word)) == n


def names_of(names: Sequence[str]) -> Column:
    """The names whose bits ``words`` has set, in order."""

    def is_set(_: Column, i: Column) -> Column:
        return F.getbit(F.get("words", F.floor(i / BITS).cast("int")), i % BITS) == 1

    return F.filter(literal(names), is_set)


def users_of_every_channel(df: DataFrame, channels: DataFrame, *by: str) -> DataFrame:
    """The groups of ``df`` that use every channel of ``channels``."""
    names = channel_dictionary(channels)
    if names is not None:
        return channel_masks(df, names, *by).where(has_every(len(names))).select(*by)
    in_use = channels.agg(F.count_distinct("channel")).scalar()
    used = df.select(*by, "channel").distinct().groupBy(*by).agg(F.count("channel").alias("used"))
    return used.where(F.col("used") == in_use).select(*by)


def set_texts(df: DataFrame, *by: str) -> DataFrame:
    """``by`` and ``channels``, the channels of each group as sorted comma-separated text."""
    names = channel_dictionary(df)
    if names is not None:
        return channel_masks(df, names, *by).select(*by, F.array_join(names_of(names), ",").alias("channels"))
    listed = F.array_join(F.sort_array(F.collect_set("channel")), ",")
    return df.select(*by, "channel").distinct().groupBy(*by).agg(listed.alias("channels"))
