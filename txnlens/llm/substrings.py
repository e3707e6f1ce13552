"""Substring deduplication: spans that also stand in an earlier document, by a count-min prefilter.

A window is WINDOW consecutive words. Its anchor is the smallest hash of the runs
of GRAM words within it, so windows of the same words have the same anchor, and
neighbouring windows mostly share one: a document has about a twentieth as many
anchors as windows. Every task counts the anchors of its documents, each once a
document, in a count-min sketch whose counts stop at two; the tasks' sketches are
merged piece by piece. A window is estimated to occur as often as its anchor's least
cell says, which is never less than it does. The merged sketch is broadcast; its size follows
the input up to MOST_CELLS, beyond which it passes more windows and still loses none.

A second pass groups exactly what is estimated to be repeated. A stretch is a run
of neighbouring windows of one anchor. Stretches are grouped as wholes first, which
settles copies with a row per stretch: all windows of one that also stands in an
earlier document are covered. The windows of the first of each kind are grouped one
by one, if their anchor has several kinds of stretch.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import TOKEN_BYTES, arrow_schema, materialize, mix64, row_key, table, word_hashes
from txnlens.operators.matching import join_groups

WINDOW, GRAM = 50, 12
#: Rows of the sketch, and the cells of a row: per byte of text, at least and at most (2^28 take 64 MB in all).
DEPTH, CELLS_PER_BYTE, LEAST_CELLS, MOST_CELLS = 2, 1 / 15, 1 << 16, 1 << 28
#: Bytes of a piece of the sketch that is merged.
PIECE = 1 << 15
#: Windows of a document that are hashed at a time, and windows of a stretch, of which the first and last hold all words.
BLOCK, STRETCH = 1 << 18, 48
#: Windows that a batch of rows holds, about.
BATCH = 200_000
#: Stretches or windows of one kind that are matched where they are, from so many on.
HOT_ROWS = 2_000
#: Null ids come after all others.
LAST = (1 << 63) - 1

_BASE = np.uint64(0xD6E8FEB86659FD93)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k word hashes, from sums of words times powers of an odd number."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(words) - 1, _BASE, np.uint64))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers)))
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    back = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n - 1, inverse, np.uint64))))
    return mix64((sums[k:] - sums[:-k]) * back)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def windows_of(words: np.ndarray, window: int, gram: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first position, windows' hashes, their anchors), a block of windows at a time."""
    for start in range(0, len(words) - window + 1, BLOCK):
        part = words[start : start + BLOCK + window - 1]
        yield start, run_hashes(part, window), sliding_least(run_hashes(part, gram), window - gram + 1)


class Sketch:
    """Count-min cells that count to two, as two bits each: whether met, whether met again."""

    def __init__(self, width: int):
        self.width = width
        self.once, self.again = (np.zeros(DEPTH * width // 8, np.uint8) for _ in range(2))

    def cells(self, anchors: np.ndarray, row: int) -> np.ndarray:
        salt = np.uint64((row + 1) * int(_GOLD) % (1 << 64))
        return (mix64(anchors + salt) & np.uint64(self.width - 1)) + np.uint64(row * self.width)

    def add(self, anchors: np.ndarray) -> None:
        """Counts each of the anchors; equal ones count as often as they are there."""
        for row in range(DEPTH):
            cells, n = np.unique(self.cells(anchors, row), return_counts=True)
            at, bits = (cells >> np.uint64(3)).astype(np.int64), np.uint8(1) << (cells & np.uint64(7)).astype(np.uint8)
            first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))[: len(at)]
            met, twice = (np.bitwise_or.reduceat(x, first) if len(first) else x for x in (bits, bits * (n > 1)))
            at = at[first]
            self.again[at] |= twice | (self.once[at] & met)
            self.once[at] |= met

    def repeated(self, anchors: np.ndarray) -> np.ndarray:
        """Whether an anchor's least count is two or more."""
        out = np.ones(len(anchors), bool)
        for row in range(DEPTH):
            cells = self.cells(anchors, row)
            out &= (self.again[(cells >> np.uint64(3)).astype(np.int64)] >> (cells & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return out


def sketch_width(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = LEAST_CELLS
    while width < min(size * CELLS_PER_BYTE, MOST_CELLS):
        width *= 2
    return width


def merged_sketch(docs: DataFrame, window: int, gram: int) -> Sketch:
    """The sketch of all documents. Tasks send the pieces of theirs that hold anything; each is merged as it comes."""
    width = sketch_width(docs)
    schema = "piece long, once binary, again binary"
    arrow = arrow_schema(schema)

    def count(batches):
        sketch = Sketch(width)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = word_hashes(text, TOKEN_BYTES, lower=False)
                found = [np.unique(anchors) for _, _, anchors in windows_of(words, window, gram)]
                if found:
                    sketch.add(np.unique(np.concatenate(found)))
        for start in range(0, len(sketch.once), PIECE):
            once, again = (x[start : start + PIECE] for x in (sketch.once, sketch.again))
            if once.any():
                yield pa.RecordBatch.from_pylist([{"piece": start, "once": zlib.compress(once, 1), "again": zlib.compress(again, 1)}], arrow)

    def merge(batches):
        pieces: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                once, again = (np.frombuffer(zlib.decompress(row[c]), np.uint8) for c in ("once", "again"))
                if row["piece"] in pieces:
                    o, a = pieces[row["piece"]]
                    once, again = o | once, a | again | (o & once)
                pieces[row["piece"]] = once, again
        rows = [{"piece": k, "once": None, "again": zlib.compress(again, 1)} for k, (_, again) in pieces.items() if again.any()]
        yield pa.RecordBatch.from_pylist(rows, arrow)

    sent = docs.select("text").mapInArrow(count, schema)
    out = Sketch(width)
    out.once = np.empty(0, np.uint8)
    for row in sent.repartition("piece").mapInArrow(merge, schema).select("piece", "again").collect():
        again = np.frombuffer(zlib.decompress(row["again"]), np.uint8)
        out.again[row["piece"] : row["piece"] + len(again)] = again
    return out


def stretches(words: np.ndarray, sketch: Sketch, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchors, kinds, starts, lengths, windows) of the stretches that are estimated to be repeated."""
    most = min(STRETCH, window)
    for start, hashes, anchors in windows_of(words, window, gram):
        new = np.concatenate(([True], anchors[1:] != anchors[:-1]))
        first = np.flatnonzero(new)
        place = np.arange(len(anchors)) - np.repeat(first, np.diff(first, append=len(anchors)))
        first = np.flatnonzero(place % most == 0)
        n = np.diff(first, append=len(anchors))
        kept = sketch.repeated(anchors[first])
        windows = hashes[np.repeat(kept, n)]
        first, n = first[kept], n[kept]
        kind = mix64(hashes[first] ^ mix64(hashes[first + n - 1] + n.astype(np.uint64) * _GOLD))
        yield anchors[first], kind, first + start, n, windows


def kept_text(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The words of a text outside some spans of word positions, joined by one space."""
    if not spans:
        return _SPACE.sub(b" ", data).strip(b" ")
    inside = np.concatenate(([False], TOKEN_BYTES[np.frombuffer(data, np.uint8)], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends, parts, at = edges[::2], edges[1::2], [], 0
    for first, end in [*sorted(spans), (len(starts), len(starts))]:
        if first > at:
            parts.append(_SPACE.sub(b" ", data[starts[at] : ends[first - 1]]))
        at = max(at, end)
    return b" ".join(parts)


def union_spans(spans) -> list[tuple[int, int]]:
    """The spans put together where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def said(data: bytes, spans: list[tuple[int, int]], digest: bool) -> str:
    kept = kept_text(data, spans)
    return hashlib.sha256(kept).hexdigest() if digest else kept.decode("utf-8", "surrogatepass")


ROW = "row_key long, ord long, doc_id long, n_words long, kept string, text string"
STRETCH_ROW = "anchor long, kind long, start long, n long, windows array<long>"


def second_pass(docs: DataFrame, shared, window: int, gram: int, digest: bool) -> DataFrame:
    """A row per document, with its text if any stretch of it may be repeated, else with what is kept; a row per such stretch."""
    schema = f"{ROW}, {STRETCH_ROW}"
    arrow = arrow_schema(schema)
    order = [f.name for f in arrow]

    def as_batch(n: int, columns: dict) -> pa.RecordBatch:
        arrays = [columns[c] if c in columns else pa.nulls(n, arrow.field(c).type) for c in order]
        return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, arrow, strict=True)], schema=arrow)

    def flushed(found: list) -> pa.RecordBatch:
        key, place, *rest, windows = (np.concatenate(x) for x in zip(*found, strict=True))
        columns = dict(zip(("row_key", "ord"), map(pa.array, (key, place)), strict=True))
        anchors, kinds, starts, n = rest
        columns |= {"anchor": pa.array(anchors.view(np.int64)), "kind": pa.array(kinds.view(np.int64)), "start": pa.array(starts), "n": pa.array(n)}
        ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
        columns["windows"] = pa.ListArray.from_arrays(ends, windows.view(np.int64))
        return as_batch(len(key), columns)

    def run(batches):
        sketch = shared.value
        for batch in batches:
            keys, places, ids, texts = (batch.column(i).to_pylist() for i in range(4))
            rows, found, size = [], [], 0
            for key, place, doc, text in zip(keys, places, ids, texts, strict=True):
                words = word_hashes(text, TOKEN_BYTES, lower=False)
                open_ = False
                for part in stretches(words, sketch, window, gram):
                    if len(part[0]):
                        open_ = True
                        found.append((np.full(len(part[0]), key), np.full(len(part[0]), place), *part))
                        size += len(part[-1])
                        if size > BATCH:
                            yield flushed(found)
                            found, size = [], 0
                kept = None if open_ else said((text or "").encode("utf-8", "surrogatepass"), [], digest)
                rows.append((key, place, doc, len(words), kept, text if open_ else None))
            if found:
                yield flushed(found)
            names = [x.split()[0] for x in ROW.split(", ")]
            columns = {c: pa.array(x, arrow.field(c).type) for c, x in zip(names, zip(*rows, strict=True) if rows else [()] * 6, strict=True)}
            yield as_batch(len(rows), columns)

    place = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord")
    return docs.select(row_key(), place, F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def covered(found: DataFrame, window: int) -> DataFrame:
    """(row_key, ord, start, end): spans of the documents that also stand in one before."""
    kinds = found.groupBy("anchor", "kind").agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.count(F.lit(1)).alias("n_kind"))
    kinds = materialize(found.sparkSession, kinds, "stretch-kinds")
    known = join_groups(found.select("row_key", "ord", "anchor", "kind", "start", "n"), kinds.filter("first < last").drop("last"), ["anchor", "kind"], "n_kind", hot_rows=HOT_ROWS)
    whole = known.filter("ord > first").select("row_key", "ord", "start", (F.col("start") + F.col("n") + (window - 1)).alias("end"))

    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n_anchor"), F.min("first").alias("low"), F.max("last").alias("high"))
    several = several.filter("n_anchor > 1 AND low < high").select("anchor", "n_anchor")
    mixed = join_groups(kinds.select("anchor", "kind", "first", "n_kind"), several, ["anchor"], "n_anchor", hot_rows=HOT_ROWS)
    mixed = materialize(found.sparkSession, mixed, "mixed-kinds")
    firsts = join_groups(found, mixed, ["anchor", "kind"], "n_kind", hot_rows=HOT_ROWS)
    firsts = materialize(found.sparkSession, firsts.filter("ord = first").drop("first"), "first-stretches")
    each = firsts.select("row_key", "ord", "anchor", "start", F.posexplode("windows").alias("i", "window"))
    each = each.select("row_key", "ord", "anchor", "window", (F.col("start") + F.col("i")).alias("start"))
    groups = each.groupBy("anchor", "window").agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.count(F.lit(1)).alias("n_window"))
    again = join_groups(each, groups.filter("first < last").drop("last"), ["anchor", "window"], "n_window", hot_rows=HOT_ROWS)
    single = again.filter("ord > first").select("row_key", "ord", "start", (F.col("start") + window).alias("end"))
    return whole.unionByName(single)


def cut_repeats(docs: DataFrame, *, window: int = WINDOW, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept), a row per row of ``docs``.

    ``spans`` are the [first, end) word positions that windows cover which also start in a document of a smaller
    doc_id; ``kept`` is the text of the other words, joined by one space, or its sha256 with ``digest``. Words are
    runs of anything but ASCII white space, unchanged. A null text has no words; texts of fewer words than a window
    lose none. Rows of one doc_id take nothing from each other, nor do rows without one, which come after all
    others. Needs doc_id and text, other columns are not read. A text is one task's: it takes 8 bytes a word
    and a block's work. An empty table gives no rows.
    """
    if not 0 < gram <= window:
        raise ValueError("a window holds at least one gram")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(merged_sketch(docs, window, gram))
    rows = materialize(spark, second_pass(docs, shared, window, gram, digest), "repeats")
    shared.destroy()
    found = rows.filter("anchor IS NOT NULL").select("row_key", "ord", *[x.split()[0] for x in STRETCH_ROW.split(", ")])
    spans = covered(found, window).groupBy("row_key", "ord").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    texts = rows.filter("anchor IS NULL")
    open_ = texts.filter("kept IS NULL").join(spans, ["row_key", "ord"], "left").select("doc_id", "n_words", "text", "spans")
    schema = "doc_id long, n_words long, n_removed long, spans array<struct<first:long,end:long>>, kept string"
    arrow = arrow_schema(schema)

    def finish(batches):
        for batch in batches:
            out = []
            for doc, n, text, spans in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                joined = union_spans((x["start"], x["end"]) for x in spans or ())
                kept = said((text or "").encode("utf-8", "surrogatepass"), joined, digest)
                listed = [{"first": a, "end": b} for a, b in joined]
                out.append({"doc_id": doc, "n_words": n, "n_removed": sum(b - a for a, b in joined), "spans": listed, "kept": kept})
            yield pa.RecordBatch.from_pylist(out, arrow)

    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    shut = texts.filter("kept IS NOT NULL").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), none.alias("spans"), "kept")
    return open_.mapInArrow(finish, schema).unionByName(shut)


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cut_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def oracle(window: int = WINDOW) -> str:
    return f"""WITH
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
runs AS (
  SELECT r, coalesce(doc_id, {LAST}) AS doc, i, sha256(array_to_string(ws[i : i + {window - 1}], ' ')) AS w
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - {window - 2})) AS i FROM d)),
again AS (SELECT r, i FROM (SELECT r, doc, i, min(doc) OVER (PARTITION BY w) AS first FROM runs) WHERE doc > first),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {window})) AS p FROM again),
listed AS (SELECT r, count(*) AS n, list(p) AS ps FROM gone GROUP BY r),
words AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(w, ' ' ORDER BY p) AS kept FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)"""
