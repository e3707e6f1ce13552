"""What nodes of the path tree say of the branches below them, against a plain tree."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.test_edges import verdicts
from txnlens.llm import urls


def plain_priors(counts):
    """The same by walking down a plain tree; ``counts`` has (labelled, blocked) by host and segments."""
    below = defaultdict(lambda: [0, 0])
    for (host, segs), (labelled, blocked) in counts.items():
        for d in range(1, len(segs) + 1):
            below[host, segs[:d]][0] += labelled
            below[host, segs[:d]][1] += blocked
    votes = defaultdict(lambda: [0.0, 0.0])
    for (host, segs), (labelled, blocked) in below.items():
        if labelled:
            votes[host, segs[:-1]][0] += labelled / (labelled + urls.STRENGTH)
            votes[host, segs[:-1]][1] += blocked / (labelled + urls.STRENGTH)
    out = {}
    for host, segs in counts:
        prior = urls.PRIOR
        for d in range(max(1, len(segs))):
            n, x = votes.get((host, segs[:d]), (0.0, 0.0))
            share = (x + prior * urls.STRENGTH) / (n + urls.STRENGTH)
            prior = urls.PRIOR + urls.DISCOUNT * (share - urls.PRIOR)
        out[host, segs] = prior
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_priors_equal_a_plain_tree(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(400):
        labelled = rng.choice([0, 0, 1, 3, 30])
        segs = tuple(rng.choice("abcde") for _ in range(rng.randint(0, 5)))
        rows.append((rng.choice(["h", "i", ""]), segs, labelled, rng.randint(0, labelled)))
    counts = defaultdict(lambda: [0, 0])
    for host, segs, labelled, blocked in rows:
        counts[host, segs][0] += labelled
        counts[host, segs][1] += blocked
    df = spark.createDataFrame([(h, list(s), n, x) for h, s, n, x in rows], "host string, segs array<string>, labelled long, blocked long")
    got = {(r.host, tuple(r.segs)): r.prior for r in urls.priors(df).collect()}
    assert got == pytest.approx(plain_priors(counts), abs=1e-4)


def test_priors_of_an_empty_table(spark):
    assert urls.priors(spark.createDataFrame([], "host string, segs array<string>, labelled long, blocked long")).isEmpty()


@pytest.mark.parametrize(("noise", "want"), [(0.0, "block"), (0.1, "block"), (0.6, "allow")])
def test_noisy_labels_of_many_sections_tell_of_one_without(spark, noise, want):
    rng = random.Random(5)
    sections = [f"s{chr(97 + i)}" for i in range(20)]
    paths = [f"/{s}/{i}" for s in [*sections, "new"] for i in range(100, 130)]
    rules = [("allow" if rng.random() < noise else "block", "x.de", f"/{s}/{i}") for s in sections for i in range(100, 115)]
    got = verdicts(spark, paths, rules)
    assert {v for path, (_, v) in got.items() if path.startswith("/new/")} == {want}


@pytest.mark.parametrize("n", [3, 6, 5000])
def test_one_section_of_any_size_speaks_for_no_other(spark, n):
    paths = [f"/{s}/{i}" for s, k in (("de", n), ("en", 40), ("fr", 2)) for i in range(k)]
    got = verdicts(spark, [*paths, "", "/"], [("block", "x.de", "/de/")])
    assert len(got) == 44 and {v for _, v in got.values()} == {"allow"}


def test_deep_paths(spark):
    paths = ["/" + "/".join(f"s{chr(97 + j % 26)}{'x' * (j // 26)}" for j in range(k)) for k in (1, 40, 200)]
    df = spark.createDataFrame([(f"http://x.de{p}",) for p in paths], "url string").withColumn("page_id", F.lit(1))
    assert {r.verdict for r in urls.judge(df).collect()} == {"allow"}


def test_the_first_of_rules_as_long_wins(spark):
    df = spark.createDataFrame([(1, "http://a.net/aa")], "page_id long, url string")
    rules = [("block", "net", "/aa"), ("allow", "a.net", "/")]
    assert [r.verdict for r in urls.judge(df, rules).collect()] == ["block"]
    assert [r.verdict for r in urls.judge(df, rules[::-1]).collect()] == ["allow"]
