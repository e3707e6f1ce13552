"""Joining rows to flagged groups when one group may hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_GROUPS = 10_000


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    weight: str,
    *,
    hot_rows: int = HOT_ROWS,
    max_hot_groups: int = MAX_HOT_GROUPS,
) -> DataFrame:
    """Inner join of ``rows`` with ``groups``, one row per key, without a hot task.

    ``weight`` is the number of rows that match a group. A group is hot if it
    weighs more than ``hot_rows`` and more than one ``max_hot_groups``-th of all
    groups together; fewer than ``max_hot_groups`` can, so broadcasting the hot
    groups is safe at any size. Their rows are matched where they are read and
    never shuffled. All other rows are matched by an ordinary join: a broadcast
    one if all groups together are below ``spark.sql.autoBroadcastJoinThreshold``,
    else they are shuffled on the key, and no group among them is large. Without
    hot groups adaptive execution drops the first branch.
    """
    keys = list(keys)
    others = [c for c in groups.columns if c not in keys]
    # The groups get a shuffle of their own, which all uses below share: neither
    # filters nor column pruning move past the aggregate. So their true size is
    # known before anything is done with the rows. With the keys in the other
    # order Spark does not leave it out for the shuffle that made the groups, and
    # without NULL keys the joins do not filter it in ways of their own.
    sized = (
        groups.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
        .repartition(*reversed(keys))
        .groupBy(*keys)
        .agg(F.max(F.struct(*others)).alias("group"))
        .select(*keys, *[F.col(f"group.{c}").alias(c) for c in others])
    )
    total = sized.agg(F.sum(weight)).scalar()
    limit = F.greatest(F.lit(float(hot_rows)), total / max_hot_groups)
    hot = sized.where(F.col(weight) > limit)
    rest = sized.where(F.col(weight) <= limit)
    in_place = rows.join(F.broadcast(hot), keys)
    others_rows = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    return in_place.unionByName(others_rows).drop(weight)
