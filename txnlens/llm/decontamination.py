"""Benchmark decontamination by winnowing.

The hash of every run of GRAM words is taken and the smallest of each
WINDOW - GRAM + 1 neighbours is kept as a fingerprint, on both sides by the same
rule. A span of WINDOW words that a document shares with an item holds one whole
neighbourhood, so both keep the same fingerprint of it: no such span is missed.
Items shorter than a window are looked up as a whole: runs of their length, each
of which is its own neighbourhood.

Each fingerprint carries the words around it as far as a window can reach, which
is all that is needed to extend a hit. A Bloom filter of bounded size, made of the
items' fingerprints, keeps nearly all other fingerprints of documents from being
shuffled; what passes it meets the items in an equi-join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import (
    arrow_schema,
    free_names,
    gram_hashes,
    materialize,
    record_batch,
    row_key,
    table,
    word_hashes,
)

WINDOW, GRAM = 10, 5
#: Bits of the filter per fingerprint, and at most (16 MB). A fuller filter passes more, it loses nothing.
BITS_EACH, MOST_BITS = 16, 1 << 27
LEAST_BITS = 1 << 16

HIT = "fp long, pos int, lead int, around array<long>"


def winnow(grams: np.ndarray, neighbours: int) -> np.ndarray:
    """Positions of the smallest hash of every run of neighbours, the first of equal ones."""
    if len(grams) < neighbours:
        return np.empty(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams, neighbours)
    return np.unique(np.arange(len(runs)) + runs.argmin(axis=1))


def fingerprints(hashes: np.ndarray, window: int, gram: int, short: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length of the run, fingerprints, positions), for runs of ``gram`` words and of each short length."""
    grams = gram_hashes(hashes, gram)
    at = winnow(grams, window - gram + 1)
    out = [(gram, grams[at], at)]
    for k in short:
        whole = gram_hashes(hashes, k) ^ np.uint64(0x5851F42D4C957F2D)
        out.append((k, whole, np.arange(len(whole))))
    return out


def hits_of(hashes: np.ndarray, window: int, gram: int, short: list[int], keep=None) -> Iterator[tuple]:
    """(fp, pos, lead, around) of the fingerprints that ``keep`` lets through."""
    signed = hashes.view(np.int64)
    for k, fps, at in fingerprints(hashes, window, gram, short):
        if keep is not None:
            passed = keep(fps)
            fps, at = fps[passed], at[passed]
        reach = window - gram if k == gram else 0
        for fp, p in zip(fps.view(np.int64).tolist(), at.tolist(), strict=True):
            start = max(0, p - reach)
            yield fp, p, p - start, signed[start : p + k + reach]


def bloom_positions(fps: np.ndarray, n_bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(n_bits - 1)
    return fps & mask, (fps >> np.uint64(32)) & mask


def bloom_filter(fps: DataFrame, n: int) -> np.ndarray:
    """Bits of the fingerprints, put together by Spark; its size is bounded whatever their number."""
    n_bits = LEAST_BITS
    while n_bits < min(n * BITS_EACH, MOST_BITS):
        n_bits *= 2
    mask = F.lit(n_bits - 1)
    places = F.array(F.col("fp").bitwiseAND(mask), F.shiftrightunsigned("fp", 32).bitwiseAND(mask))
    bits = fps.select(F.explode(places).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1), F.col("bit").bitwiseAND(F.lit(31)).cast("int"))
    words = bits.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.bit_or(one).alias("ones")).toPandas()
    out = np.zeros(n_bits // 32, np.uint32)
    out[words["word"].to_numpy()] = words["ones"].to_numpy().astype(np.int32).view(np.uint32)
    return out


def passes(bits: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each fingerprint."""
    a, b = bloom_positions(fps, len(bits) * 32)
    low = np.uint64(31)
    found = (bits[a >> np.uint64(5)] >> (a & low).astype(np.uint32)) & 1
    return (found & (bits[b >> np.uint64(5)] >> (b & low).astype(np.uint32)) & 1).astype(bool)


def item_fingerprints(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(item_id, n, fp, pos, lead, around) of all items; ``n``: words in a window of the item."""

    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                hashes = word_hashes(text)
                if len(hashes) >= window:
                    found = hits_of(hashes, window, gram, [])
                else:
                    found = hits_of(hashes, window, gram, [len(hashes)] if len(hashes) else [])
                rows += [(item, min(window, len(hashes)), *hit) for hit in found]
            yield pd.DataFrame(rows, columns=["item_id", "n", "fp", "pos", "lead", "around"])

    ids = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id")
    found = items.select(ids, "text").mapInPandas(run, f"item_id string, n int, {HIT}")
    return found.drop_duplicates(["item_id", "n", "fp", "lead", "around"])


def document_hits(docs: DataFrame, shared, window: int, gram: int, short: list[int]) -> DataFrame:
    """A row per document (its ``n_words``) and a row per fingerprint that passes the filter, of which ``shared`` is a broadcast."""
    schema = f"row_key long, doc_id long, n_words long, {HIT}"
    arrow = arrow_schema(schema)

    def run(batches):
        bits = shared.value
        for batch in batches:
            keys, ids, texts = (batch.column(i).to_pylist() for i in range(3))
            rows = []
            for key, doc, text in zip(keys, ids, texts, strict=True):
                hashes = word_hashes(text)
                rows.append((key, doc, len(hashes), None, None, None, None))
                found = hits_of(hashes, window, gram, short, lambda fps: passes(bits, fps))
                rows += [(key, doc, None, *hit) for hit in found]
            yield record_batch(rows, arrow)

    return docs.select(row_key(), F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def window_starts(window: int, gram: int) -> Column:
    """Positions in the document of the windows that both sides share around a hit."""

    def shared(s: Column) -> Column:
        ours = F.slice("around", F.col("lead") - s + 1, F.col("n"))
        theirs = F.slice("item_around", F.col("item_lead") - s + 1, F.col("n"))
        inside = (F.col("lead") >= s) & (F.col("item_lead") >= s)
        return F.when(inside, (F.size(ours) == F.col("n")) & (ours == theirs)).otherwise(False)

    steps = F.filter(F.sequence(F.lit(0), F.lit(window - gram)), shared)
    return F.transform(steps, lambda s: F.col("pos") - s)


def covered(intervals: Column) -> Column:
    """Number of positions in the union of [first, end) intervals."""
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

    def add(state: Column, x: Column) -> Column:
        new = F.greatest(F.lit(0), x["end"] - F.greatest(x["first"], state["end"]))
        return F.struct((state["n"] + new).alias("n"), F.greatest(x["end"], state["end"]).alias("end"))

    return F.aggregate(F.array_sort(intervals), start, add)["n"]


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(row_key, doc_id, n_words, spans, item_ids), a row per row of ``docs``.

    ``spans`` are the [first, end) word positions of the windows that items share,
    ``item_ids`` those items as sorted text. A null or wordless text has no words
    and is never hit; items without words are in no document. A null item id
    reads as empty text. Repeated documents get the same result, repeated items
    count once. ``docs`` needs doc_id and text, other columns are not read. Empty
    tables give no rows, or no hits.
    """
    if not 0 < gram <= window:
        raise ValueError("a window holds at least one gram")
    spark = docs.sparkSession
    fps = materialize(spark, item_fingerprints(items, window, gram), "item-fingerprints")
    short = sorted(r["n"] for r in fps.select("n").distinct().collect() if r["n"] < window)
    shared = spark.sparkContext.broadcast(bloom_filter(fps, fps.count()))
    rows = materialize(spark, document_hits(docs, shared, window, gram, short), "document-hits")
    shared.destroy()
    theirs = fps.select("fp", "n", "item_id", F.col("lead").alias("item_lead"), F.col("around").alias("item_around"))
    joined = rows.filter("fp IS NOT NULL").select("row_key", "fp", "pos", "lead", "around").join(theirs, "fp")
    starts = joined.select("row_key", "item_id", "n", F.explode(window_starts(window, gram)).alias("first"))
    span = F.struct("first", (F.col("first") + F.col("n")).alias("end"))
    hits = starts.groupBy("row_key").agg(
        F.array_sort(F.collect_set(span)).alias("spans"),
        F.array_sort(F.collect_set("item_id")).alias("item_ids"),
    )
    documents = rows.filter("n_words IS NOT NULL").select("row_key", "doc_id", "n_words")
    return documents.join(hits, "row_key", "left")


def drop_contaminated(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """The documents that share no window with an item; the columns of ``docs``."""
    (key,) = free_names(docs, "row_key")
    hit = decontaminate(docs, items, **params).filter("item_ids IS NOT NULL").select(F.col("row_key").alias(key)).distinct()
    kept = docs.withColumn(key, row_key()).join(hit, key, "left_anti")
    return kept.select(*docs.columns)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long")
    items = F.coalesce(F.col("item_ids"), F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def windows_sql(window: int = WINDOW) -> str:
    """The rule itself: all windows of items, all runs of documents of those lengths."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {words} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT *, least(len(ws), {window}) AS n FROM b WHERE len(ws) > 0))),
lengths AS (SELECT DISTINCT n FROM item_windows),
runs AS (
  SELECT r, n, i, array_to_string(ws[i : i + n - 1], ' ') AS w
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lengths)),
hits AS (SELECT r, item_id, i, n FROM runs JOIN item_windows USING (n, w)),
positions AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
found AS (
  SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY r)"""


def oracle() -> str:
    return f"""WITH {windows_sql().strip()}
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN positions USING (r) LEFT JOIN found USING (r)"""
