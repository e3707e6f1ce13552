"""What the operators share: inputs, written intermediate tables, words and hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from txnlens.session import scratch_dir

#: Bytes of lower-cased UTF-8 that words are made of: ASCII letters, digits, every non-ASCII code point.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
#: All bytes but white space.
TOKEN_BYTES = np.ones(256, bool)
TOKEN_BYTES[[32, *range(9, 14)]] = False
#: Bytes of a text that are hashed at a time.
PIECE = 1 << 22
#: Characters that one step of vectorised work takes at a time.
CHUNK_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared scratch folder and reads it back, which cuts lineage."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many ``_`` before it as it takes to differ from all columns and from each other."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def bounded_sample(df: DataFrame, hashed: Column, n: int) -> DataFrame:
    """At most ``n`` rows, those of the smallest hashes: cut by a bound first, so that no task sends more than its part.

    ``hashed`` is a 64-bit hash that should differ by row; rows are ordered by it and by all their columns.
    """
    total = df.count()
    if total <= n:
        return df
    share = min(1.0, (n + 10 * n**0.5 + 100) / total)
    bound = min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))
    plain = [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    return df.filter(hashed <= F.lit(bound)).orderBy(hashed, *plain).limit(n)


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id's text modulo a number; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(divisor))


def hash60(text: Column) -> Column:
    """The first 60 bits of the md5, which other SQL engines can compute as well."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = np.cumprod(np.full(4096, 0xD6E8FEB86659FD93, np.uint64))


def word_hashes(text: str | None, kind: np.ndarray = WORD_BYTES, *, lower: bool = True) -> np.ndarray:
    """64-bit hashes of a text's words: the runs of bytes of one kind, A-Z lower-cased if wanted. None of a null text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(data.lower() if lower else data, np.uint8)
    if len(data) <= PIECE:
        return _piece_hashes(data, kind)
    parts, start = [], 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        while end < len(data) and kind[data[end]]:  # a piece ends with a word
            end += 1
        parts.append(_piece_hashes(data[start:end], kind))
        start = end
    return np.concatenate(parts)


def _piece_hashes(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    inside = kind[data]
    if not inside.any():
        return np.empty(0, np.uint64)
    at = np.flatnonzero(inside)
    first = np.empty(len(at), bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
    starts = np.flatnonzero(first)
    lengths = np.diff(starts, append=len(at))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    terms = (data[at].astype(np.uint64) + (place >> 12).astype(np.uint64) * np.uint64(257)) * _POWERS[place & 4095]
    return mix64(np.add.reduceat(terms, starts) + lengths.astype(np.uint64))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Order-sensitive hashes of all runs of k word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = (out ^ hashes[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return mix64(out)


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    arrays = [pa.array(c, field.type) for c, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def row_key() -> Column:
    """A key that only rows with the same id and text share."""
    return F.xxhash64("doc_id", "text").alias("row_key")


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters together; a longer text stands alone."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def positions(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """All rows with ``at``, their place in the order of their group from 0, and ``n``, the group's size.

    Rows are dealt to partitions by ranges of group and order, equal ones by where they were read, so that
    neither a large group nor many equal rows end in one task. A row's place is that within its partition plus
    what its group has in earlier partitions; there are at most as many such sums as partitions and groups.
    Keys may not be null.
    """
    by = [*keys, *order, "_tie"]
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    dealt = materialize(df.sparkSession, dealt.withColumn("_place", F.monotonically_increasing_id()), "sorted")
    dealt = dealt.withColumn("_part", F.shiftright("_place", 33))
    runs = dealt.groupBy(*keys, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*keys)
    earlier = F.sum("_rows").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shift = (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift")
    runs = runs.select(*keys, "_part", shift, F.sum("_rows").over(group).alias("n"))
    placed = dealt.join(runs, [*keys, "_part"]).withColumn("at", F.col("_place") + F.col("_shift"))
    return placed.select(*df.columns, "at", "n")
