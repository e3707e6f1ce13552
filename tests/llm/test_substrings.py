"""Repeated spans against a plain search, and odd inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from txnlens.llm import substrings
from txnlens.llm.common import TOKEN_BYTES, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, row_key string, spans int, ord int, anchor string"


def plain(rows, window):
    """(doc_id, n_words, n_removed, kept text) of (doc_id, text) rows."""
    words = [WORD.findall(text or "") for _, text in rows]
    order = [float("inf") if doc is None else doc for doc, _ in rows]
    first = {}
    for place, ws in zip(order, words, strict=True):
        for i in range(len(ws) - window + 1):
            key = tuple(ws[i : i + window])
            first[key] = min(first.get(key, place), place)
    out = []
    for (doc, _), place, ws in zip(rows, order, words, strict=True):
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < place:
                gone.update(range(i, i + window))
        out.append((doc, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return sorted(out, key=str)


def cut(spark, rows, window, **params):
    df = spark.createDataFrame([(*r, "k", 1, 2, "a") for r in rows], DOCS).repartition(4)
    found = substrings.cut_repeats(df, window=window, **params).collect()
    for r in found:
        places = [(x["first"], x["end"]) for x in r.spans]
        assert places == sorted(places) and sum(b - a for a, b in places) == r.n_removed
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=str)


def corpus(seed):
    """Copies, near copies, passages that many share, repeats within a document, and few different words."""
    rng = np.random.default_rng(seed)
    some = lambda n, v: [f"w{i}" for i in rng.integers(0, v, n)]
    passage, base = some(30, 10_000), some(120, 10_000)
    texts = [base, base, base[:60] + ["x"] + base[60:], base[20:90], base[:40] + base[:40]]
    texts += [some(rng.integers(0, 30), 10_000) + passage + some(rng.integers(0, 30), 10_000) for _ in range(25)]
    texts += [some(60, 2) for _ in range(12)] + [["same"] * n for n in (5, 9, 10, 11, 80, 300)]
    texts += [passage[:15] + some(40, 10_000) + passage[15:], passage[3:] + passage[:27]]
    marks = [" ", "  ", "\n", "\t ", "\x0b", "\r\n"]
    joined = ["".join(w + marks[int(i)] for w, i in zip(t, rng.integers(0, 6, len(t)), strict=True)) for t in texts]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(joined)), joined, strict=True)]
    return rows + [rows[0], rows[5], rows[5], (rows[6][0], joined[0]), (None, joined[0]), (None, joined[6]), (900, None), (901, ""), (902, " \n "), (903, "ein wort ß ß")]


@pytest.mark.parametrize(("window", "gram"), [(10, 4), (10, 10), (10, 1), (1, 1), (25, 12)])
def test_equals_a_plain_search(spark, window, gram):
    rows = corpus(window + gram)
    assert cut(spark, rows, window, gram=gram) == plain(rows, window)


@pytest.mark.parametrize("name", ["full sketch", "small blocks", "hot groups"])
def test_nothing_depends_on_sizes(spark, monkeypatch, name):
    settings = {"full sketch": {"LEAST_CELLS": 8, "MOST_CELLS": 8}, "small blocks": {"BLOCK": 7, "STRETCH": 3, "BATCH": 20, "PIECE": 64}, "hot groups": {"HOT_ROWS": 1}}
    for key, value in settings[name].items():
        monkeypatch.setattr(substrings, key, value)
    rows = corpus(3)
    assert cut(spark, rows, 10, gram=4) == plain(rows, 10)


def test_digests_and_empty_tables(spark):
    rows = corpus(4)
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain(rows, 10)]
    assert cut(spark, rows, 10, gram=4, digest=True) == sorted(want, key=str)
    assert substrings.cut_repeats(spark.createDataFrame([], DOCS)).isEmpty()
    with pytest.raises(ValueError):
        substrings.cut_repeats(spark.createDataFrame([], DOCS), window=5, gram=6)


def test_a_long_text_and_its_copy(spark):
    words = [f"w{i * i % 99_991}" for i in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["new", *words[1000:], "end"]))]
    assert [r[:3] for r in cut(spark, rows, 50)] == [(1, 300_000, 0), (2, 299_002, 299_000)]


def test_a_sketch_never_counts_too_few():
    rng = np.random.default_rng(0)
    anchors = rng.integers(0, 2**63, 400).astype(np.uint64)
    parts = [substrings.Sketch(1 << 9) for _ in range(3)]
    for part, met in zip(parts, (anchors[:200], anchors[150:300], anchors[280:]), strict=True):
        part.add(met)
    whole = substrings.Sketch(1 << 9)
    for part in parts:
        whole.again |= part.again | (whole.once & part.once)
        whole.once |= part.once
    twice = np.concatenate((anchors[150:200], anchors[280:300]))
    assert whole.repeated(twice).all() and not whole.repeated(anchors).all()


def test_hashes_of_equal_runs_are_equal():
    words = word_hashes("a b c a b c A b c", TOKEN_BYTES, lower=False)
    got = substrings.run_hashes(words, 3)
    assert got[0] == got[3] and len(set(got.tolist())) == 6
    assert substrings.sliding_least(np.array([3, 1, 2, 5, 4], np.uint64), 3).tolist() == [1, 1, 2]
