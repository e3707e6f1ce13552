"""Placement by a permutation-filled lookup table.

Each shard has a preference order over the slots of a table of prime size: it
starts at an offset and goes on by a skip, both hashes of its name. Shards take
turns; at its turn a shard claims the first slot of its order that is free.
Every shard gets as many slots as any other, give or take one, and a shard that
comes or goes moves few slots of the others. A row's slot is a hash of its key
modulo the size of the table; the table has a fixed number of rows, so that it
can always be broadcast.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import free_names, hash60

#: Production parameters: a prime that is over 100 times the number of shards.
SHARDS = 16
TABLE_SIZE = 2039
#: The table is broadcast; its size is a parameter and never follows the data.
MAX_TABLE_SIZE = 1_000_003


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(names: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Index of the shard that owns each slot."""
    if not names or len(set(names)) < len(names) or len(names) > size:
        raise ValueError("shards need different names and at least a slot each")
    if not _is_prime(size) or size > MAX_TABLE_SIZE:
        raise ValueError(f"the table's size has to be a prime of {MAX_TABLE_SIZE} at most")
    at = [_number(f"{name}#offset") % size for name in names]
    skip = [_number(f"{name}#skip") % (size - 1) + 1 if size > 2 else 1 for name in names]
    owner = [-1] * size
    for turn in range(size):
        i = turn % len(names)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % size
        owner[at[i]] = i
    return owner


def slots(spark: SparkSession, names: list[str], size: int = TABLE_SIZE) -> DataFrame:
    """The lookup table as (_slot, _shard)."""
    owners = ",".join(map(str, lookup_table(names, size)))
    listed = spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("_slot", "_shard"))
    return listed.select("_slot", F.col("_shard").cast("int").alias("_shard"))


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    return F.pmod(hash60(key), F.lit(size)).cast("int")


def assign_shards(
    df: DataFrame,
    *,
    key: str = "doc_id",
    spread_by: str | None = "text",
    n_shards: int = SHARDS,
    size: int = TABLE_SIZE,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """All rows and columns, with the row's slot and shard.

    Rows of one key go to one shard. A row whose key is null is placed by
    ``spread_by`` (null: as empty text), so that many such rows don't meet in one
    shard. Repeated rows stay together. Columns named like the two new ones are
    replaced, all others stay as they are. An empty table gives an empty result.
    """
    text = F.col(key).cast("string")
    if spread_by in df.columns:
        text = F.coalesce(text, F.concat(F.lit("null:"), F.coalesce(F.col(spread_by).cast("string"), F.lit(""))))
    placed = df.withColumn(slot, slot_of(F.coalesce(text, F.lit("")), size)).drop(*({shard} - {slot}))
    at, owner = free_names(placed, "_slot", "_shard")
    table = F.broadcast(slots(df.sparkSession, shard_names(n_shards), size).toDF(at, owner))
    joined = placed.join(table, F.col(slot) == F.col(at))
    return joined.withColumn(shard, F.col(owner)).drop(at, owner)


def write_shards(df: DataFrame, path: str, *, shard: str = "shard", files_per_shard: int = 8) -> None:
    """One folder per shard, each of several files, so that no task writes a whole shard."""
    salt = F.pmod(F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith("map")]), F.lit(files_per_shard))
    (name,) = free_names(df, "_salt")
    spread = df.withColumn(name, salt).repartition(shard, name).drop(name)
    spread.write.partitionBy(shard).parquet(path)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_shards(docs).select("doc_id", "slot", "shard")


NUMBER = "CAST(('0x' || substr(md5({}), 1, 15)) AS UBIGINT)"


def shard_sql(n_shards: int = SHARDS, size: int = TABLE_SIZE) -> str:
    """The lookup table as SQL: a step of the recursion is a turn."""
    name = "'shard-' || lpad(CAST(i AS VARCHAR), 5, '0')"
    return f"""
prefs AS (
  SELECT list(CAST({NUMBER.format(name + " || '#offset'")} % {size} AS BIGINT) ORDER BY i) AS offs,
         list(CAST({NUMBER.format(name + " || '#skip'")} % {size - 1} + 1 AS BIGINT) ORDER BY i) AS skips
  FROM range({n_shards}) r(i)),
fill AS (
  SELECT 0 AS turn, list_transform(range({size}), lambda x: -1) AS owner,
         list_transform(range({n_shards}), lambda x: 0) AS nxt
  UNION ALL
  SELECT turn + 1,
         list_transform(range({size}), lambda s: CASE WHEN s = (off + k * skip) % {size} THEN turn % {n_shards} ELSE owner[s + 1] END),
         list_transform(range({n_shards}), lambda i: CASE WHEN i = turn % {n_shards} THEN k + 1 ELSE nxt[i + 1] END)
  FROM (
    SELECT *, list_filter(range(nxt[turn % {n_shards} + 1], {size}),
                          lambda j: owner[(off + j * skip) % {size} + 1] = -1)[1] AS k
    FROM (SELECT fill.*, offs[turn % {n_shards} + 1] AS off, skips[turn % {n_shards} + 1] AS skip FROM fill, prefs)
    WHERE turn < {size})),
lookup AS (
  SELECT CAST(s AS INTEGER) AS slot, CAST(owner[s + 1] AS INTEGER) AS shard
  FROM (SELECT owner FROM fill WHERE turn = {size}), range({size}) t(s))"""


def slot_sql(size: int = TABLE_SIZE) -> str:
    key = "coalesce(CAST(doc_id AS VARCHAR), 'null:' || coalesce(text, ''))"
    return f"CAST({NUMBER.format(key)} % {size} AS INTEGER)"


def oracle(n_shards: int = SHARDS, size: int = TABLE_SIZE) -> str:
    return f"""WITH RECURSIVE {shard_sql(n_shards, size).strip()}
SELECT doc_id, slot, shard FROM (SELECT doc_id, {slot_sql(size)} AS slot FROM documents) JOIN lookup USING (slot)"""
