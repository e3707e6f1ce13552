"""Importance resampling towards the distribution of a target's hashed n-grams.

A feature is a run of one to LONGEST words; its bucket is its crc32 modulo BUCKETS.
A document's weight adds up how much more often the target has the buckets of its
features than the corpus has. With Gumbel noise from a hash of the id, the highest
scores are a draw without replacement by weight.

Buckets are found over a head-tail vocabulary. The corpus is counted for its most
frequent words and pairs of them; the CRC states of these words and pairs, and so
the pairs' buckets, are broadcast in tables of fixed size, which hold each entry's own
bytes or word numbers and so never mistake one for another. All other words take
their CRC from their bytes, and all other runs from the state of the run
without its last word. Which entries are in the head changes the time this takes and nothing
else: head and tail add up to exact totals of all buckets.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import WORD_BYTES, arrow_schema, materialize, mix64, positions, table

BUCKETS, LONGEST, LEAST_WORDS, SEED = 10_000, 3, 20, 42
#: Percentage of the documents of LEAST_WORDS words that is drawn.
PERCENT = 5
#: Entries of the head, at most, and of the tables that hold them.
HEAD_WORDS, HEAD_PAIRS = 1 << 13, 1 << 14
WORD_SLOTS, PAIR_SLOTS = 1 << 16, 1 << 17
#: Different words or pairs that a task counts at a time; beyond, the rarest are forgotten.
COUNTED = 1 << 18
#: Bytes of text that one step takes at a time; a longer text is cut between words.
PIECE = 1 << 20
#: Words of the head have so many bytes at most; runs with a word longer than LONG_WORD are hashed one by one.
HEAD_BYTES, LONG_WORD = 16, 254

_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Masks that keep the first 0 to 8 bytes of a little-endian number.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


@cache
def crc_table() -> np.ndarray:
    """crc32 of single bytes by the reflected polynomial."""
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> np.uint32(1)) ^ np.uint32(0xEDB88320), x >> np.uint32(1))
    return x


@cache
def shifts() -> np.ndarray:
    """What each byte of a CRC becomes when so many bytes follow: [bytes that follow, place of the byte, its value]."""
    x = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    out = [x]
    for _ in range(LONG_WORD + 1):
        x = crc_table()[x & 255] ^ (x >> np.uint32(8))
        out.append(x)
    return np.stack(out)


def follow(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The part of a run's CRC that comes from what stands before its last ``n`` bytes."""
    t = shifts()
    out = t[n, 0, crc & 255]
    for k in (1, 2, 3):
        out ^= t[n, k, (crc >> np.uint32(8 * k)) & 255]
    return out


def pieces(texts: list[str | None]) -> Iterator[tuple[int, bytes, int]]:
    """(text, lower-cased bytes, words at their start that the piece before has counted), whole words each."""
    context = LONGEST - 1
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        if len(data) <= PIECE:
            yield i, data, 0
            continue
        whole, start, begin, known = np.frombuffer(data, np.uint8), 0, 0, 0
        while start < len(data):
            end = min(start + PIECE, len(data))
            while end < len(data) and WORD_BYTES[whole[end]]:
                end += 1
            yield i, data[begin:end], known
            inside = WORD_BYTES[whole[begin:end]]
            first = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))[-context:]
            known = len(first)
            begin, start = (begin + int(first[0]) if known else end), end


def grouped(texts: list[str | None]) -> Iterator[list[tuple[int, bytes, int]]]:
    """Pieces of some PIECE bytes together."""
    group, size = [], 0
    for piece in pieces(texts):
        if group and size + len(piece[1]) > PIECE:
            yield group
            group, size = [], 0
        group.append(piece)
        size += len(piece[1])
    if group:
        yield group


class Words:
    """The words of some pieces: where they stand, their packed bytes, and whose they are."""

    def __init__(self, group: list[tuple[int, bytes, int]]):
        self.bytes = b" ".join([b"", *[data for _, data, _ in group], b" " * 24])
        self.data = np.frombuffer(self.bytes, np.uint8)
        inside = WORD_BYTES[self.data]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts = edges[::2]
        self.lengths = edges[1::2] - self.starts
        sizes = np.array([len(data) + 1 for _, data, _ in group])
        piece = np.searchsorted(np.cumsum(sizes), self.starts - 1, "right")
        first = np.searchsorted(piece, np.arange(len(group)))
        self.place = np.arange(len(piece)) - first[piece] if len(piece) else piece
        self.owner = np.array([i for i, _, _ in group])[piece]
        self.new = self.place >= np.array([known for _, _, known in group])[piece]
        wide = np.empty(len(self.data) - 7, np.uint64)
        for r in range(8):
            part = np.frombuffer(self.bytes, "<u8", (len(self.data) - r) // 8, r)
            wide[r::8] = part[: len(wide[r::8])]
        low, high = np.minimum(self.lengths, 8), np.clip(self.lengths - 8, 0, 8)
        self.low = wide[self.starts] & _KEEP[low]
        self.high = wide[self.starts + 8] & _KEEP[high]
        self.short = self.lengths <= HEAD_BYTES

    def text(self, i: int, n: int = 1) -> bytes:
        """The run of n words that ends with word i, one space between them."""
        return b" ".join(self.bytes[self.starts[j] : self.starts[j] + self.lengths[j]] for j in range(i - n + 1, i + 1))

    def direct(self, at: np.ndarray) -> np.ndarray:
        """crc32 of some words, given in order, from their bytes."""
        at = at[np.argsort(-self.lengths[at], kind="stable")]
        starts, lengths = self.starts[at], self.lengths[at]
        state, t = np.full(len(at), 0xFFFFFFFF, np.uint32), crc_table()
        longest = min(int(lengths[0]), LONG_WORD) if len(at) else 0
        left = np.searchsorted(-lengths, -np.arange(longest), "left")
        for p, m in enumerate(left):
            s = state[:m]
            state[:m] = t[(s ^ self.data[starts[:m] + p]) & 255] ^ (s >> np.uint32(8))
        state ^= np.uint32(0xFFFFFFFF)
        for j in np.flatnonzero(lengths > LONG_WORD):
            state[j] = zlib.crc32(self.text(int(at[j])))
        return state[np.argsort(at)]


def word_slot(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (mix64(low ^ mix64(high + _GOLD)) & np.uint64(WORD_SLOTS - 1)).astype(np.int64)


def pair_slot(pair: np.ndarray) -> np.ndarray:
    return (mix64(pair.astype(np.uint64) + _GOLD) & np.uint64(PAIR_SLOTS - 1)).astype(np.int64)


class Head:
    """Tables of the frequent words (their bytes and CRC) and pairs (their numbers and CRC), one entry a slot."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]]):
        self.low, self.high = np.zeros(WORD_SLOTS, np.uint64), np.zeros(WORD_SLOTS, np.uint64)
        self.crc, self.pair, self.pair_crc = np.zeros(WORD_SLOTS, np.uint32), np.zeros(PAIR_SLOTS, np.int64), np.zeros(PAIR_SLOTS, np.uint32)
        at = {}
        for word in words:  # the most frequent first; of two for one slot, the second stays in the tail
            packed = np.frombuffer(word.ljust(16, b"\0"), "<u8").astype(np.uint64)
            slot = int(word_slot(packed[:1], packed[1:])[0])
            if not self.low[slot]:
                self.low[slot], self.high[slot], self.crc[slot], at[word] = packed[0], packed[1], zlib.crc32(word), slot
        for a, b in pairs:
            if a in at and b in at:
                number = at[a] * WORD_SLOTS + at[b] + 1
                slot = int(pair_slot(np.array([number]))[0])
                if not self.pair[slot]:
                    self.pair[slot], self.pair_crc[slot] = number, zlib.crc32(a + b" " + b)


def crcs(words: Words, head: Head) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1 to LONGEST words: the words that one ends with, and its crc32."""
    n = len(words.starts)
    slot = word_slot(words.low, words.high)
    known = words.short & (head.low[slot] == words.low) & (head.high[slot] == words.high)
    crc = head.crc[slot]
    tail = np.flatnonzero(~known)
    crc[tail] = words.direct(tail)
    length = np.minimum(words.lengths, LONG_WORD)
    space = follow(np.full(LONG_WORD + 1, zlib.crc32(b" "), np.uint32), np.arange(LONG_WORD + 1))
    last = space[length] ^ crc  # of a space and the word
    out, run, long = [(np.flatnonzero(words.new), crc)], crc, words.lengths > LONG_WORD
    some_long = long
    for k in range(2, LONGEST + 1):
        before = np.empty_like(run)
        before[:1], before[1:] = 0, run[:-1]
        run = follow(before, length + 1) ^ last
        if k == 2 and n > 1:
            number = slot[:-1] * WORD_SLOTS + slot[1:] + 1
            place = pair_slot(number)
            frequent = known[:-1] & known[1:] & (head.pair[place] == number)
            run[1:][frequent] = head.pair_crc[place[frequent]]
        some_long = some_long | np.concatenate((np.zeros(min(n, k - 1), bool), long[: max(0, n - k + 1)]))
        ends = words.place >= k - 1
        for i in np.flatnonzero(some_long & ends):
            run[i] = zlib.crc32(words.text(int(i), k))
        out.append((np.flatnonzero(ends & words.new), run))
    return out


class Counts:
    """Counts of keys of whatever number in bounded memory: the rarest are forgotten."""

    def __init__(self, width: int):
        self.width, self.parts, self.size = width, [], 0

    def add(self, keys: np.ndarray, columns: list[np.ndarray]) -> None:
        found, first, n = np.unique(keys, return_index=True, return_counts=True)
        self.parts.append((found, n, [c[first] for c in columns]))
        self.size += len(found)
        if self.size > 4 * COUNTED:
            self.shrink(COUNTED)

    def shrink(self, most: int) -> None:
        if not self.parts:
            return
        keys = np.concatenate([p[0] for p in self.parts])
        found, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate([p[1] for p in self.parts])).astype(np.int64)
        columns = [np.concatenate([p[2][j] for p in self.parts])[first] for j in range(self.width)]
        top = np.sort(np.argsort(-n, kind="stable")[:most])
        self.parts, self.size = [(found[top], n[top], [c[top] for c in columns])], len(top)


def head_of(docs: DataFrame) -> Head:
    """The head's tables, by counts over all texts.

    Each task sends its most frequent words and pairs, twice as many as the tables take; their sums are
    cut where the tables are full, by a histogram of sums, so that the driver gets no more rows than that.
    """
    schema = "a binary, b binary, n long"
    arrow = arrow_schema(schema)

    def run(batches):
        single, double = Counts(2), Counts(4)
        for batch in batches:
            for group in grouped(batch.column(0).to_pylist()):
                words = Words(group)
                keys = mix64(words.low ^ mix64(words.high + _GOLD))
                fit = words.short & words.new
                single.add(keys[fit], [words.low[fit], words.high[fit]])
                both = np.flatnonzero(fit[1:] & words.short[:-1] & (words.place[1:] > 0))
                columns = [words.low[both], words.high[both], words.low[both + 1], words.high[both + 1]]
                double.add(mix64(keys[both] * _GOLD + keys[both + 1]), columns)
        for counts, most in ((single, 2 * HEAD_WORDS), (double, 2 * HEAD_PAIRS)):
            counts.shrink(most)
            for _, n, columns in counts.parts:
                texts = [np.stack(columns[j : j + 2], axis=1).astype("<u8").tobytes() for j in range(0, counts.width, 2)]
                texts = [[x[i : i + 16].rstrip(b"\0") for i in range(0, len(x), 16)] for x in texts]
                second = texts[1] if counts.width == 4 else [None] * len(n)
                yield pa.RecordBatch.from_arrays([pa.array(texts[0], pa.binary()), pa.array(second, pa.binary()), pa.array(n)], schema=arrow)

    sent = docs.select("text").mapInArrow(run, schema)
    sums = materialize(docs.sparkSession, sent.groupBy("a", "b").agg(F.sum("n").alias("n")), "frequent")
    tables = []
    for kind, most in ((F.col("b").isNull(), HEAD_WORDS), (F.col("b").isNotNull(), HEAD_PAIRS)):
        step = F.floor(F.log2("n") * 16).alias("step")
        left, least = most, None
        for row in sums.filter(kind).groupBy(step).count().orderBy(F.desc("step")).collect():
            left -= row["count"]
            if left < 0:
                break
            least = row["step"]
        kept = sums.filter(kind & (F.floor(F.log2("n") * 16) >= least)).collect() if least is not None else []
        kept.sort(key=lambda r: (-r["n"], bytes(r["a"]), bytes(r["b"] or b"")))
        tables.append(kept)
    return Head([bytes(r["a"]) for r in tables[0]], [(bytes(r["a"]), bytes(r["b"])) for r in tables[1]])


def bucket_totals(docs: DataFrame, head, buckets: int, name: str) -> DataFrame:
    """(bucket, ``name``): features of all texts by bucket, a row per bucket that has any; ``head``: a broadcast."""
    schema = "counts array<long>"
    arrow = arrow_schema(schema)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for group in grouped(batch.column(0).to_pylist()):
                for ends, crc in crcs(Words(group), head.value):
                    total += np.bincount(crc[ends] % np.uint32(buckets), minlength=buckets)
        yield pa.RecordBatch.from_pylist([{"counts": total}], arrow)

    sums = docs.select("text").mapInArrow(run, schema).select(F.posexplode("counts").alias("bucket", "n"))
    return sums.filter("n > 0").groupBy(F.col("bucket").cast("long").alias("bucket")).agg(F.sum("n").alias(name))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of how much more often the target has each bucket; ``buckets`` numbers."""
    spark = corpus.sparkSession
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(corpus, "bucket", "left").join(target, "bucket", "left")
    both = both.select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("s", "t")])
    rows = both.collect()
    total = {c: float(sum(r[c] for r in rows)) for c in ("s", "t")}
    out = np.zeros(buckets, np.int64)
    for r in rows:
        ratio = (r["t"] + 1.0) * (total["s"] + buckets) / ((r["s"] + 1.0) * (total["t"] + buckets))
        out[r["bucket"]] = math.floor(1000 * math.log(ratio))
    return out


def weights(docs: DataFrame, head, gain) -> DataFrame:
    """(doc_id, n_words, n_features, weight), a row per row of ``docs``; ``head`` and ``gain``: broadcasts."""
    schema = "doc_id long, n_words long, n_features long, weight long"
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            texts, gain_of = batch.column(1).to_pylist(), gain.value
            n_words, n_features, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for group in grouped(texts):
                words = Words(group)
                n_words += np.bincount(words.owner[words.new], minlength=len(texts))
                for ends, crc in crcs(words, head.value):
                    owner = words.owner[ends]
                    n_features += np.bincount(owner, minlength=len(texts))
                    gained = gain_of[crc[ends] % np.uint32(len(gain_of))]
                    weight += np.bincount(owner, weights=gained, minlength=len(texts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (n_words, n_features, weight))], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def gumbel(seed: int) -> Column:
    """floor(-1000 ln(-ln u)) of a u in (0, 1) from the seed and the id (null: as empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), a row per row of ``docs``; ``rank`` is null of what isn't drawn.

    ``docs`` needs doc_id and text, ``target`` text; other columns are not read. Null and wordless texts have no
    features, weight 0 and a score, but are not drawn. Texts are whole; one beyond PIECE bytes is worked off between
    words (a word is one piece). Ties go to the smaller doc_id, null ids come last; repeated rows have equal scores and
    stand one after the other. Without target texts all buckets gain by rarity alone; an empty table gives no rows.
    """
    if not 0 <= percent <= 100:
        raise ValueError("a percentage is from 0 to 100")
    spark = docs.sparkSession
    head = spark.sparkContext.broadcast(head_of(docs))
    corpus, aim = (materialize(spark, bucket_totals(df, head, buckets, c), "bucket-totals") for df, c in ((docs, "s"), (target, "t")))
    gain = spark.sparkContext.broadcast(gains(corpus, aim, buckets))
    rows = materialize(spark, weights(docs, head, gain), "importance")
    for shared in (head, gain):
        shared.destroy()
    scored = rows.withColumn("score", F.col("weight") + gumbel(seed))
    able = scored.filter(F.col("n_words") >= least_words).withColumn("_all", F.lit(0))
    placed = positions(able, ["_all"], [F.desc("score"), F.asc_nulls_last("doc_id"), "weight", "n_features"])
    rank = F.when(F.col("at") < F.floor(F.col("n") * percent / F.lit(100)), F.col("at") + 1).alias("rank")
    others = scored.filter(F.col("n_words") < least_words).select("*", F.lit(None).cast("long").alias("rank"))
    return placed.select(*scored.columns, rank).unionByName(others)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def oracle() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    byte = "CAST('0x' || substr(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)"
    state = "xor(c >> 8, t[CAST(xor(c & 255, b) AS INTEGER) + 1])"

    def features(source: str) -> str:
        return f"SELECT r, array_to_string(ws[i : i + n - 1], ' ') AS f FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM {source}, range(1, {LONGEST + 1}) g(n))"

    return f"""WITH
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
b AS (SELECT 0 AS r, {words} AS ws FROM benchmark),
crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
df AS ({features('d')}),
bf AS ({features('b')}),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(x) // 2), lambda i: {byte})),
                            lambda c, b: {state}), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM bf)), crc_table),
s AS (SELECT bucket, count(*) AS s FROM df JOIN hashed USING (f) GROUP BY 1),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN hashed USING (f) GROUP BY 1),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM df) + {BUCKETS})
                       / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bf) + {BUCKETS})))) AS gain
  FROM (SELECT range AS bucket FROM range({BUCKETS})) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weighed AS (SELECT r, count(*) AS n, sum(gain) AS weight FROM df JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, len(ws) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
              / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weighed USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place,
         count(*) OVER (PARTITION BY n_words >= {LEAST_WORDS}) AS able FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {LEAST_WORDS} AND place <= {PERCENT} * able // 100 THEN place END AS rank FROM ranked"""
