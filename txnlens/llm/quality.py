"""Quality classification with supervised subword embeddings.

A document's features are its words, its pairs of neighbouring words and its
character trigrams and 4-grams, all hashed to buckets; each bucket has a learned
vector. Their average is the document's vector, of which a softmax layer makes
probabilities. Vectors and layer are trained together by stochastic gradient
descent in numpy. As the layer is linear, a bucket's part of the outcome is one
number, so that scoring takes one lookup per feature.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import (
    TOKEN_BYTES,
    arrow_schema,
    bounded_sample,
    free_names,
    id_remainder,
    materialize,
    mix64,
    record_batch,
    row_key,
    table,
    word_hashes,
)

BUCKETS, DIMENSIONS = 1 << 18, 8
#: Labelled documents that are learned from, at most: those of the smallest hashes.
SAMPLE = 6_000
EPOCHS, RATE, SEED = 6, 0.5, 7
THRESHOLD = 0.3
#: Bytes of a text whose character n-grams are hashed at a time.
PIECE = 1 << 20

_SALTS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def features(text: str | None) -> np.ndarray:
    """Buckets of all features of the whole text, repeats included."""
    words = word_hashes(text, TOKEN_BYTES)
    parts = [words, mix64(words[:-1] * _SALTS[0] + words[1:])]
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    for start in range(0, len(data), PIECE):
        wide = data[start : start + PIECE + 3].astype(np.uint64)
        if len(wide) >= 3:
            three = wide[:-2] | wide[1:-1] << np.uint64(8) | wide[2:] << np.uint64(16)
            four = three[:-1] | wide[3:] << np.uint64(24)
            parts += [mix64(three[:PIECE] ^ _SALTS[0]), mix64(four[:PIECE] ^ _SALTS[1])]
    return (np.concatenate(parts) & np.uint64(BUCKETS - 1)).astype(np.int32)


class Classifier:
    """The folded model: a number per bucket, and the bias."""

    def __init__(self, part: np.ndarray, bias: float):
        self.part, self.bias = part, bias

    def score(self, text: str | None) -> float:
        """Probability of label 1; of a text without features, that of the bias."""
        found = features(text)
        margin = self.bias + (float(self.part[found].mean(dtype=np.float64)) if len(found) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(margin, -50, 50))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], *, epochs: int = EPOCHS, rate: float = RATE) -> Classifier:
    """Trains on (buckets, count of each, label); without both labels the score is the share of label 1."""
    y = np.array([label for _, _, label in rows], np.int64)
    if len(set(y.tolist())) < 2:
        return Classifier(np.zeros(BUCKETS, np.float32), 20.0 * (2 * int(y[0]) - 1) if len(y) else 0.0)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((2, DIMENSIONS)), np.log(np.bincount(y, minlength=2) / len(y))
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            buckets, counts, label = rows[i]
            share = (counts / counts.sum()).astype(np.float32)
            speed = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[buckets]
            logits = layer @ hidden + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ layer
            layer -= speed * np.outer(p, hidden)
            bias -= speed * 0.1 * p
            # A document's step is shared out by how much each of its features counts, up to a whole step.
            vectors[buckets] -= (speed * share / share.max())[:, None].astype(np.float32) * back.astype(np.float32)
    return Classifier((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample: int = SAMPLE) -> Classifier:
    """Learns from at most ``sample`` labelled documents, whole texts.

    Labels that are null or neither 0 nor 1 are left out, and a label counts once however often it is repeated. Of
    several rows of one doc_id, one text is learned, that of the smallest row key. Executors make the features; the
    driver gets at most ``sample`` lists of at most BUCKETS entries, and keeps them in two arrays.
    """
    chosen = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label")).distinct()
    chosen = bounded_sample(chosen, F.xxhash64("doc_id"), sample)
    texts = docs.select("doc_id", "text", row_key()).join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min_by("text", "row_key").alias("text"))
    schema = "doc_id long, label int, buckets binary, counts binary"
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            rows = []
            for doc, text, y in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                found, counts = np.unique(features(text), return_counts=True)
                if len(found):
                    rows.append((doc, y, found.tobytes(), counts.astype(np.uint32).tobytes()))
            yield record_batch(rows, arrow)

    made = texts.select(F.col("doc_id").cast("long"), "text", "label").mapInArrow(run, schema)
    # All features are made at once; the driver then takes a hundred rows at a time.
    made = materialize(docs.sparkSession, made, "features").repartition(-(-sample // 100), "doc_id")
    buckets, counts, ends = bytearray(), bytearray(), []
    for r in made.toLocalIterator():
        buckets += r["buckets"]
        counts += r["counts"]
        ends.append((r["doc_id"], r["label"], len(buckets) // 4, len(r["buckets"]) // 4))
    places, times = np.frombuffer(buckets, np.int32), np.frombuffer(counts, np.uint32)
    return fit([(places[end - n : end], times[end - n : end], y) for _, y, end, n in sorted(ends)])


def score(docs: DataFrame, model: Classifier, column: str = "quality_score") -> DataFrame:
    """All rows and columns with ``column``, from 0 to 1; a null text reads as empty. A column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts):
        return texts.map(shared.value.score, na_action=None)

    return docs.withColumn(column, scored("text"))


def not_held_out(labels: DataFrame, divisor: int = 5) -> DataFrame:
    return labels.filter(id_remainder("doc_id", divisor) != 0)


def drop_low_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold; the columns of ``docs``.

    Repeated rows are scored alike; texts are whole, in pieces of PIECE bytes, however long. With an empty table of
    labels nothing is known, and all score 0.5. Columns of any name stay as they are.
    """
    (column,) = free_names(docs, "quality_score")
    return score(docs, train(docs, not_held_out(labels)), column).filter(F.col(column) >= threshold).select(*docs.columns)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, not_held_out(table(spark, sf_dir, "labels")))
    return score(docs, model).select(
        "doc_id",
        (id_remainder("doc_id", 5) == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
