"""The registered queries against their SQL or brute force, on the generated tables."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from tests.compare import connect, difference
from tests.conftest import SF_DIR
from txnlens.llm import dedup, quality, registry
from txnlens.llm.common import TOKEN_BYTES, word_hashes
from txnlens.llm.lm import PRIOR

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.sql("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", list(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, SF_DIR, QUERIES[name], SQL[name]) is None


def classes(texts):
    """Smallest id of each document's class, by comparing all pairs."""
    sets = {d: dedup.shingles(word_hashes(t)) for d, t in texts.items()}
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations([d for d in sets if len(sets[d])], 2):
        if len(np.intersect1d(sets[a], sets[b])) and dedup.similarity(sets[a], sets[b]) >= dedup.SIMILARITY:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: root(d) for d in texts}


def test_near_duplicates_equal_all_pairs(spark, texts):
    got = {r.doc_id: r for r in QUERIES["op2_near_duplicates"](spark, SF_DIR).collect()}
    want = classes(texts)
    assert {d: r.class_id for d, r in got.items()} == want
    assert {d for d, r in got.items() if r.kept} == set(want.values())


def test_languages_of_held_out_documents(spark, con):
    lang = dict(con.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op3_language"](spark, SF_DIR).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows) and len(rows) == len(lang)


def test_quality_of_held_out_documents(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")  # the smallest tables hold out two labels of 0
    label = dict(connect(sf_dir).sql("SELECT doc_id, quality FROM labels").fetchall())
    rows = QUERIES["op4_quality"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    good, bad = ([r.score for r in held if label[r.doc_id] == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_scores_equal_a_plain_model(spark, texts):
    tokens = {d: [*word_hashes(t, TOKEN_BYTES).tolist(), "end"] for d, t in texts.items()}
    train = [d for d in texts if zlib.crc32(str(d).encode()) % 7 != 2]
    one = Counter(w for d in train for w in tokens[d])
    two = Counter(pair for d in train for pair in zip(["begin", *tokens[d]], tokens[d], strict=False))
    n, v = one.total(), len(one)
    for r in QUERIES["op7_lm_scores"](spark, SF_DIR).collect():
        base = score = 0.0
        for h, w in zip(["begin", *tokens[r.doc_id]], tokens[r.doc_id], strict=False):
            p, c = (one[w] + 1) / (n + v + 1), len(train) if h == "begin" else one[h]
            base += math.log10(p)
            score += math.log10((two[h, w] + PRIOR[2] * p) / (c + PRIOR[2]) if c else p)
        assert (r.n_tokens, r.train_tokens) == (len(tokens[r.doc_id]), n)
        assert r.n_known == sum(one[w] > 0 for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_recall_of_neighbours(spark, con):
    data = con.sql("SELECT vec_id, embedding FROM embeddings ORDER BY 1").fetchall()
    ids, vectors = np.array([r[0] for r in data]), np.array([r[1] for r in data], np.float64)
    rows = QUERIES["op10_nearest"](spark, SF_DIR).collect()
    recall = []
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((vectors - vectors[ids == q]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert all(r.score == pytest.approx(far[ids == r.vec_id][0], abs=1e-12) for r in mine)
        recall.append(len({r.vec_id for r in mine} & set(ids[np.lexsort((ids, far))[:10]].tolist())) / 10)
    assert np.mean(recall) >= 0.9


def test_urls_follow_the_rules(spark, con):
    url = dict(con.sql("SELECT page_id, url FROM pages").fetchall())
    rows = QUERIES["op8_urls"](spark, SF_DIR).collect()
    assert len(rows) == len(url)
    for r in rows:
        rest = url[r.page_id].split("://", 1)[1].split("?")[0].split("#")[0]
        host, slash, path = rest.partition("/")
        assert (r.host, r.path) == (host.lower(), slash + path)
        under = {s: ("." + host).endswith("." + s) for s in ("net", "org", "example.net", "example.com")}
        if under["example.net"] and path.startswith("en/"):
            assert (r.rule, r.verdict) == ("example.net/en/", "allow")
        elif under["example.com"] and path.startswith("de/"):
            assert (r.rule, r.verdict) == ("example.com/de/", "block")
        elif under["org"] and path.startswith("fr/"):
            assert (r.rule, r.verdict) == ("org/fr/", "allow")
        elif under["net"]:
            assert (r.rule, r.verdict) == ("net/", "block")
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_pipeline_keeps_what_its_stages_keep(spark, con, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r.doc_id: r.text for r in corpus_pipeline.keep_quality(spark, docs, SF_DIR).collect()}
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = quality.score(docs, quality.train(docs, quality.not_held_out(labels))).where("quality_score >= 0.3")
    assert set(good) == {r.doc_id for r in scored.select("doc_id").collect()}
    first = set(classes(good).values())
    clean = {r[0] for r in con.sql(f"SELECT doc_id FROM ({SQL['op1_decontamination']}) WHERE NOT contaminated").fetchall()}
    final = corpus_pipeline.run(spark, SF_DIR)
    copies = Counter(r.doc_id for r in final.select("doc_id").collect())
    assert set(copies) <= first & clean and max(copies.values()) <= 2
    words = {d: len((texts[d] or "").split()) for d in first & clean}
    assert sum(words[d] * n for d, n in copies.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.1)
    assert final.columns == [*docs.columns, "slot", "shard"] and final.where(F.col("shard").isNull()).isEmpty()
