"""Buckets, totals and draws against plain ones, and odd inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F
from txnlens.llm import importance

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, rank string, at int, n_words int, weight string"


def plain_features(text):
    words = WORD.findall((text or "").encode().lower())
    return len(words), [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def plain(rows, target, percent=5, least=20, buckets=importance.BUCKETS):
    bucket = lambda f: zlib.crc32(f) % buckets
    s = Counter(bucket(f) for _, text in rows for f in plain_features(text)[1])
    t = Counter(bucket(f) for text in target for f in plain_features(text)[1])
    all_s, all_t = s.total() + buckets, t.total() + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(buckets)]
    found = []
    for doc, text in rows:
        n_words, features = plain_features(text)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in features)
        found.append([doc, n_words, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in found if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[5] = place
    return sorted(map(tuple, found), key=str)


def texts(seed, n, vocabulary):
    rng = np.random.default_rng(seed)
    return [" ".join(vocabulary[i] for i in rng.zipf(1.3, rng.integers(0, 60)) % len(vocabulary)) for _ in range(n)]


VOCABULARY = ["The", "straße", "x" * 16, "y" * 17, "o'clock", "a-b", "日本語", "ÀB", "z" * 300, *[f"w{i}" for i in range(500)]]


def rows_of(spark, rows, target, **params):
    docs = spark.createDataFrame([(*r, "r", 1, 2, "w") for r in rows], DOCS).repartition(3)
    items = spark.createDataFrame([(x, "c") for x in target], "text string, bucket string")
    return sorted((tuple(r) for r in importance.resample(docs, items, **params).collect()), key=str)


def test_equals_a_plain_draw(spark):
    rows = list(enumerate(texts(1, 150, VOCABULARY)))
    rows += [(None, rows[0][1]), (500, None), (501, ""), (502, "... !!"), (7, rows[7][1]), (7, rows[7][1]), (503, "Word " * 30)]
    target = texts(2, 20, VOCABULARY[::2]) + [None, "w1"]
    assert rows_of(spark, rows, target, percent=40) == plain(rows, target, percent=40)


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_long_texts_are_cut_between_words(monkeypatch, size):
    monkeypatch.setattr(importance, "PIECE", size)
    found = [*texts(3, 30, VOCABULARY), None, "", "one", " ...", "one " * 50, "w" * 500 + " b " + "c" * 400]
    head = importance.Head([b"the", b"w1", b"w2", b"x" * 16], [(b"the", b"w1"), (b"w1", b"the"), (b"w1", b"w1")])
    got = [Counter() for _ in found]
    for group in importance.grouped(found):
        words = importance.Words(group)
        for ends, crc in importance.crcs(words, head):
            for i in ends:
                got[words.owner[i]][int(crc[i])] += 1
    assert got == [Counter(map(zlib.crc32, plain_features(x)[1])) for x in found]


def test_forgotten_counts_only_cost_time(spark, monkeypatch):
    rows = list(enumerate(texts(4, 60, VOCABULARY)))
    want = plain(rows, ["w1 w2 w3"], percent=50)
    for words, pairs in ((1, 1), (3, 0), (0, 0)):
        monkeypatch.setattr(importance, "HEAD_WORDS", words)
        monkeypatch.setattr(importance, "HEAD_PAIRS", pairs)
        assert rows_of(spark, rows, ["w1 w2 w3"], percent=50) == want


def test_counts_forget_the_rarest(monkeypatch):
    monkeypatch.setattr(importance, "COUNTED", 10)
    counts = importance.Counts(1)
    for _ in range(50):
        keys = np.array([1, 1, 1, 2, 2, *np.random.default_rng(0).integers(10, 10**6, 30)], np.uint64)
        counts.add(keys, [keys])
    counts.shrink(2)
    assert counts.parts[0][0].tolist() == [1, 2] and counts.parts[0][1].tolist() == [150, 100]


def test_empty_tables(spark):
    rows = [(1, "a b c " * 10), (2, "d " * 30)]
    assert rows_of(spark, rows, [], percent=50) == plain(rows, [], percent=50)
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(docs, docs).isEmpty()
    with pytest.raises(ValueError):
        importance.resample(docs, docs, percent=101)


def test_noise_is_gumbel(spark):
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"))
    mean, spread = ids.select(importance.gumbel(42).alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert mean == pytest.approx(577, abs=40) and spread == pytest.approx(1282, abs=40)
