"""The manifest against a plain one, at sizes around those of blocks, and its odd inputs."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from pyspark.sql import functions as F
from txnlens.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, at string, path string"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes, fanout):
    """(root, path of each node) of a list of digests."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for i, at in enumerate(place):
            run, slot = runs[at // fanout], at % fanout
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        nodes, place = [h(*run) for run in runs], [at // fanout for at in place]
    return nodes[0], paths


def plain_manifest(rows, fanout):
    """{(key, leaf): set of (path, subroot, root)} of (doc_id, text, lang, source, n_chars) rows."""
    text = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = defaultdict(list)
    for doc, body, lang, source, n in rows:
        trees[b"" if lang is None else b"=" + lang.encode()].append((doc, h(*map(text, (doc, source, lang, n, body)))))
    order = sorted(trees)
    grown = {}
    for tree in order:
        leaves = sorted(trees[tree], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        grown[tree] = leaves, *plain_tree([leaf for _, leaf in leaves], fanout)
    root, tops = plain_tree([grown[tree][1] for tree in order], fanout)
    found = defaultdict(list)
    for tree, top in zip(order, tops, strict=True):
        leaves, subroot, paths = grown[tree]
        for (doc, leaf), path in zip(leaves, paths, strict=True):
            found[doc, leaf].append((tuple(path + top), subroot, root))
    return {k: sorted(v) for k, v in found.items()}


def manifest_of(df, fanout):
    found = defaultdict(list)
    for r in merkle.manifest(merkle.dataset_leaves(df), fanout=fanout).collect():
        found[r.key, r.node].append((tuple((x.before, x.after) for x in r.path), r.subroot, r.root))
    return {k: sorted(v) for k, v in found.items()}


ODD = [
    (None, "a", "en", "s", 1), (None, None, None, None, None), (7, "", "", "s", 0), (7, "", "", "s", 0), (7, "é", "", None, 1),
    (-3, "x" * 100_000, "zh", "s", 100_000), (5, "t", "Z", "s", 1), (5, "t", "é", "s", 1),
]


@pytest.mark.parametrize(("block", "fanout", "many"), [(4, 2, 37), (8, 2, 16), (27, 3, 100), (4096, 2, 5), (5, 5, 26)])
def test_equals_a_plain_manifest(spark, monkeypatch, block, fanout, many):
    monkeypatch.setattr(merkle, "BLOCK_ROWS", block)
    rows = [(i, f"text {i}", "en" if i % 3 else None, f"s{i % 4}", i) for i in range(many)] + ODD
    rows += [(1000 + i, "one", f"lang{i}", "s", 3) for i in range(block + 2)]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], DOCS).repartition(3)
    assert manifest_of(df, fanout) == plain_manifest(rows, fanout)


def test_one_row_and_no_row(spark):
    one = [(1, "a", "en", "s", 1)]
    df = spark.createDataFrame([(*r, "", "") for r in one], DOCS)
    assert manifest_of(df, 2) == plain_manifest(one, 2)
    assert merkle.manifest(merkle.dataset_leaves(df.limit(0))).isEmpty()


def test_a_change_shows(spark):
    df = spark.createDataFrame([(i, "a", "en", "s", 1, "", "") for i in range(9)], DOCS)
    changed = merkle.leaf_of([F.lit("b") if c == "text" else c for c in merkle.FIELDS])
    proved = merkle.manifest(merkle.dataset_leaves(df, changed=changed))
    root = F.col("root")
    assert proved.where(merkle.fold(F.col("node"), F.col("path")) != root).isEmpty()
    assert proved.where(merkle.fold(F.col("changed"), F.col("path")) == root).isEmpty()


def test_columns_that_cannot_be_kept(spark):
    leaves = spark.createDataFrame([("", 1, "a", 2)], "tree string, key long, node string, Path int")
    with pytest.raises(ValueError):
        merkle.manifest(leaves)
    with pytest.raises(ValueError):
        merkle.manifest(leaves.drop("Path"), fanout=1)
