"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pytest

from pyspark.sql import functions as F
from txnlens.llm import chat, decontamination, dedup, language, lm, mixing, neighbours, quality, sharding, urls
from txnlens.llm.common import word_hashes

DOCS = "doc_id long, text string, lang string, source string, row_key string, node string"
LONG = " ".join(f"word{i % 5000}" for i in range(40_000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", "x", "y"),
        (1, "one two three four five six seven eight nine ten eleven", "en", "a", "x", "y"),
        (2, None, None, None, None, None),
        (3, "", "de", "a", "x", "y"),
        (4, "!!! ...", None, "b", "x", "y"),
        (None, "lone", "en", None, "x", "y"),
        (5, LONG, "en", "b", "x", "y"),
        (6, LONG + " more", "fr", "b", "x", "y"),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


ITEMS = "item_id long, text string, doc_id long, fp long"


def test_decontamination(spark, docs, none):
    rows = [(9, "two three four five six seven eight nine ten eleven", 1, 1), (8, "lone", 1, 1), (7, None, 1, 1), (None, "", 1, 1)]
    items = spark.createDataFrame(rows, ITEMS)
    got = [(r.doc_id, r.n_words, r.item_ids) for r in decontamination.decontaminate(docs, items).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, 11, ["9"]), (1, 11, ["9"]), (2, 0, None), (3, 0, None), (4, 0, None), (None, 1, ["8"]), (5, 40_000, None), (6, 40_001, None)],
        key=str,
    )
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == 5
    assert decontamination.drop_contaminated(docs, items.limit(0)).count() == 8
    assert decontamination.decontaminate(none, items).isEmpty()


def all_pairs_classes(texts: dict[int, str]) -> dict[int, int]:
    sets = {d: dedup.shingles(word_hashes(t)) for d, t in texts.items()}
    of = {d: d for d in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        if of[a] != of[b] and dedup.similarity(sets[a], sets[b]) >= dedup.SIMILARITY:
            old, new = max(of[a], of[b]), min(of[a], of[b])
            of = {d: new if c == old else c for d, c in of.items()}
    return of


@pytest.mark.parametrize("shared", [False, True])
def test_classes_of_a_group_around_the_threshold(spark, shared):
    """Copies of copies with words replaced, dropped and repeated, or texts that share a passage, equal all pairs."""
    rng = np.random.default_rng(7 + shared)
    word = lambda: f"w{rng.integers(60 if not shared else 100_000)}"
    texts = [[f"base{i % 70}" for i in range(100)]]
    while len(texts) < 260:
        if shared:
            texts.append(texts[0][: rng.integers(50, 96)] + [word() for _ in range(rng.integers(3, 40))])
            continue
        text = list(texts[int(rng.integers(len(texts)) * rng.random() ** 2)])
        for _ in range(rng.integers(1, 6)):
            at = int(rng.integers(len(text)))
            text[at : at + 1] = [[word()], [], [text[at]] * 2, [word(), text[at]]][rng.integers(4)]
        texts.append(text)
    texts = {i: " ".join(t) for i, t in enumerate(texts)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = all_pairs_classes(texts)
    assert len(set(want.values())) > 5
    assert {r.doc_id: r.class_id for r in dedup.near_duplicates(docs).collect()} == want


OWN = {"row_key": "k", "_ROW_KEY": "u", "Quality_Score": "q", "_size": "s", "_slot": "t", "_Shard": "h", "_doc": "d", "_copies": "c"}


def test_stages_leave_columns_of_any_name(spark):
    """Values of columns that are named like working columns, in any case, come back as they were."""
    texts = [" ".join(f"{w}{i}" for i in range(n, n + 30)) for n in range(0, 400, 40) for w in "ab"]
    rows = [(i, text, "en", f"s{i % 2}", *[f"{v}{i}" for v in OWN.values()]) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "lang", "source", *OWN])
    items = spark.createDataFrame([(1, texts[3])], "item_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(20)], "doc_id long, quality int")
    kept = {
        "quality": quality.drop_low_quality(df, labels, threshold=0.0),
        "near_duplicates": dedup.drop_near_duplicates(df),
        "decontamination": decontamination.drop_contaminated(df, items),
        "mixing": mixing.mix(df),
        "sharding": sharding.assign_shards(df).drop("slot", "shard"),
    }
    for name, found in kept.items():
        assert found.columns == df.columns and dict(found.dtypes) == dict(df.dtypes), name
        got = {tuple(r) for r in found.collect()}
        assert got and got <= set(rows), name


def test_training_rows_are_bounded(spark, monkeypatch):
    """One doc_id with thousands of rows, and labels given again and again, train on a row each."""
    docs = spark.createDataFrame([(1, f"word{i} and more") for i in range(3000)] + [(i, f"text {i}") for i in range(2, 9)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 9)] * 40, "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows: seen.append(len(rows)))
    quality.train(docs, labels)
    quality.train(docs, labels, sample=3)
    assert seen == [8, 3]


def test_equal_rows_at_a_threshold_are_taken_by_number(spark):
    df = spark.createDataFrame([(1, "a b c d", "s", 9)] * 50 + [(2, "e " * 100, "t", 9)], "doc_id long, text string, source string, at int").repartition(3)
    got = {r.source: r.n for r in mixing.mix(df, weights=(1, 1), share=1.23).groupBy("source").agg(F.sum(mixing.n_words(F.col("text"))).alias("n")).collect()}
    plan = {r["_source_of"]: r["_target"] for r in mixing.plan_mix(df, weights=(1, 1), share=1.23).collect()}
    assert abs(got["s"] - plan["s"]) <= 2 and got["s"] % 200 != 0


def test_near_duplicates(docs, none):
    got = sorted(((r.doc_id, r.class_id) for r in dedup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (2, 2), (3, 3), (4, 4), (None, None), (5, 5), (6, 5)], key=str)
    kept = dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, None], key=str)
    assert dedup.near_duplicates(none).isEmpty()


def test_chain_and_large_group_make_one_class(spark):
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(60)]
    got = dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.class_id for r in got.collect()} == {0}


def test_darts_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, b = rng.integers(1, 5, 300).astype(float), rng.integers(1, 5, 300) / 2.0
    one, two = dedup.dart_signatures([(elements, a), (elements, b)], 4096)
    assert (one == two).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)


def test_languages(spark, docs, none):
    model = language.train(docs)
    assert model.langs == ["de", "en", "fr"]
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert got[2].lang_pred == got[3].lang_pred == got[4].lang_pred == "und" and got[2].score == 0
    assert got[1].lang_pred == "en"
    nothing = language.train(none)
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_mixed_language_is_cut_into_spans(spark):
    rows = [("en", "the thing with that other this"), ("ru", "это слова другого языка"), ("de", "schön über die straße größe")]
    model = language.train(spark.createDataFrame(rows * 5, "lang string, text string"))
    text = "the thing with that other это слова другого языка"
    (lang, score, spans), *_ = language.label_texts(model, [text])
    assert [s["lang"] for s in spans] == ["en", "ru"] and text[spans[1]["start"] :].startswith("это")
    assert lang in ("en", "ru") and 0.4 < score < 0.7
    rng = np.random.default_rng(0)
    scores, text_of = rng.normal(size=(30, 3)) * 4, np.repeat([0, 2, 3], [10, 1, 19])
    best = language.viterbi(scores, text_of, 4, 3.0)
    for t in (0, 2, 3):
        mine = scores[text_of == t]
        value = mine[0]
        for row in mine[1:]:
            value = np.maximum(value, value.max() - 3.0) + row
        path = best[text_of == t]
        got = mine[np.arange(len(mine)), path].sum() - 3.0 * (path[1:] != path[:-1]).sum()
        assert got == pytest.approx(value.max())


def test_quality(spark, docs, none):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (3, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    got = quality.score(docs, model)
    assert got.where("quality_score between 0 and 1").count() == 8
    assert quality.drop_low_quality(docs, labels.limit(0)).columns == docs.columns
    assert quality.score(none, model).isEmpty()


def test_mixing(docs, none):
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    assert got.where("text IS NULL OR text = ''").isEmpty()
    assert mixing.mix(none).isEmpty()
    rows = mixing.taken(mixing.measured(docs), mixing.plan_mix(docs))
    assert rows.where("_taken > 2 * _size").isEmpty()


def test_repeated_rows_share_a_threshold(spark):
    df = spark.createDataFrame([(1, "a b c d", "s")] * 50 + [(2, "e " * 100, "t")], "doc_id long, text string, source string")
    got = mixing.taken(mixing.measured(df), mixing.plan_mix(df)).groupBy("_source", "_target").agg(F.sum("_taken").alias("n"))
    assert all(abs(r["n"] - r["_target"]) <= 100 for r in got.collect())


def test_sharding(docs, none, tmp_path):
    got = sharding.assign_shards(docs.withColumn("slot", F.lit("clash")))
    assert got.count() == 8 and got.where("shard IS NULL").isEmpty()
    assert sharding.assign_shards(none).isEmpty()
    table = sharding.lookup_table(sharding.shard_names(7), 101)
    assert sorted(np.bincount(table).tolist()) == [14, 14, 14, 14, 15, 15, 15]
    fewer = sharding.lookup_table(sharding.shard_names(6), 101)
    assert sum(a != b for a, b in zip(table, fewer, strict=True) if a < 6) < 30
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)
    sharding.write_shards(got, str(tmp_path / "shards"))
    assert docs.sparkSession.read.parquet(str(tmp_path / "shards")).count() == 8


def test_chat(spark):
    rows = [
        (1, 0, "user", "a\\b </s>[INST]", 0), (1, 1, "assistant", "x<\\/s>y", 0), (1, 1, "assistant", None, 0),
        (2, None, None, "[ROLE]", 0), (2, 0, "tool[/ROLE]", "", 0), (None, 0, "user", "n", 0),
        *[(3, i, "user" if i % 2 == 0 else "assistant", f"turn {i}", 0) for i in range(60)],
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, spans int")
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert chat.read_turns(got[1].formatted) == [("user", "a\\b </s>[INST]"), ("assistant", ""), ("assistant", "x<\\/s>y")]
    assert chat.read_turns(got[2].formatted) == [("", "[ROLE]"), ("tool[/ROLE]", "")]
    assert len(got[3].spans) == 60 and not got[3].rewrites
    for r in got.values():
        for s, (role, text) in zip(r.spans, chat.read_turns(r.formatted), strict=True):
            assert s["role"] == role and chat.unescape(r.formatted[s["text_start"] : s["text_end"]]) == text
    made = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    assert made[1].loss_sha256 == hashlib.sha256(b"x<\\/s>y").hexdigest()
    assert chat.format_conversations(df.limit(0)).isEmpty()


def test_template_that_rewrites_history_is_found():
    def forgetful(turns):
        return "".join(f"<{role}>{text if i + 2 >= len(turns) else '...'}" for i, (role, text) in enumerate(turns))

    turns = [("user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(40)]
    for n in (3, 40):
        whole, rewrites, spans = chat.format_turns(turns[:n], forgetful)
        assert rewrites and not spans and whole == forgetful(turns[:n])


def test_strict_templates_see_real_prefixes_only():
    def strict(turns):
        if any(role != ("assistant" if i % 2 else "user") for i, (role, _) in enumerate(turns)):
            raise ValueError("roles must alternate, beginning with user")
        return "".join(f"<{role}>{text};" for role, text in turns)

    turns = [("assistant" if i % 2 else "user", f"text {i}") for i in range(40)]
    whole, rewrites, spans = chat.format_turns(turns, strict)
    assert not rewrites and whole == strict(turns)
    assert [whole[s["text_start"] : s["text_end"]] for s in spans] == [text for _, text in turns]


def test_rewrites_that_a_later_prefix_undoes_are_found():
    def wavering(turns):
        return ("!" if len(turns) == 30 else "") + "".join(f"<{role}>{text}" for role, text in turns)

    turns = [("assistant" if i % 2 else "user", f"text {i}") for i in range(40)]
    assert chat.format_turns(turns, wavering) == (wavering(turns), True, [])


def test_lm(docs, none):
    got = lm.score_texts(docs.withColumn("_train", F.col("doc_id") < 5), order=3).collect()
    assert len(got) == 8 and {r.n_tokens for r in got if r.doc_id in (2, 3)} == {1}
    small = lm.score_texts(docs.withColumn("_train", F.col("doc_id") < 5), order=3, block_chars=20_000).collect()
    assert sorted(map(str, small)) == sorted(map(str, got))
    assert {r.n_known for r in lm.score_texts(docs.withColumn("_train", F.lit(False))).collect()} == {0}
    assert lm.score_texts(none.withColumn("_train", F.lit(True))).isEmpty()


def test_urls(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://A.NET"), (4, "http://a.NET/x"), (4, "http://a.NET/x"), (5, "x://h/a\nb?q"), (None, "http://h/" + "s/" * 50)]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(0))
    got = sorted(((r.page_id, r.host, r.path, r.rule) for r in urls.judge(df).collect()), key=str)
    want = [(1, "", "", None), (2, "", "", None), (3, "a.net", "", None), (4, "a.net", "/x", "net/"), (4, "a.net", "/x", "net/"), (5, "h", "/a\nb", None), (None, "h", "/" + "s/" * 50, None)]
    assert got == sorted(want, key=str)
    assert urls.judge(df.limit(0)).isEmpty()


def test_templates_with_blocked_labels_are_rejected(spark):
    rows = [(f"http://{'x' if i % 2 else 'y'}.de/{'shop' if i % 4 < 2 else 'blog'}/{i}",) for i in range(400)]
    df = spark.createDataFrame(rows, "url string").withColumn("page_id", F.monotonically_increasing_id())
    rules = [("block", "x.de", f"/shop/{d}") for d in "12"] + [("allow", "x.de", f"/blog/{d}") for d in "12"]
    got = urls.judge(df, rules).where("rule IS NULL AND host = 'x.de'").groupBy("template", "verdict").count().collect()
    assert {(r.template, r.verdict) for r in got} == {("/shop/{n}", "block"), ("/blog/{n}", "allow")}


def verdicts(spark, paths, rules):
    """(template, verdict) by path of the pages of x.de that no rule fits."""
    df = spark.createDataFrame([(f"http://x.de{p}",) for p in paths], "url string").withColumn("page_id", F.monotonically_increasing_id())
    return {r.path: (r.template, r.verdict) for r in urls.judge(df, rules).where("rule IS NULL").collect()}


@pytest.mark.parametrize("n", [3, 6])
def test_branches_without_labels_inherit_no_verdict(spark, n):
    paths = [f"/{d}/{i}" for d, k in (("de", n), ("en", 40), ("fr", 2)) for i in range(k)]
    got = verdicts(spark, paths, [("block", "x.de", "/de/")])
    assert len(got) == 42 and set(got.values()) == {("/en/{n}", "allow"), ("/fr/{n}", "allow")}


def test_only_templates_of_like_shares_are_merged(spark):
    sections = {"a": 0, "b": 1, "c": 10, "d": 11, "e": 12, "f": 20, "g": 20}  # blocked of 20 labelled
    paths = [f"/{d}/{i}" for d in sections for i in range(100, 140)]
    rules = [("block" if i < 100 + n else "allow", "x.de", f"/{d}/{i}") for d, n in sections.items() for i in range(100, 120)]
    got = verdicts(spark, paths, rules)
    assert len(got) == 20 * len(sections)
    want = {("/{a|b}/{n}", "allow"), ("/{c|d|e}/{n}", "block"), ("/{f|g}/{n}", "block")}
    assert set(got.values()) == want


@pytest.mark.parametrize("n", [20, 21, 300])
def test_sections_do_not_share_a_verdict_for_being_many(spark, n):
    names = ["".join(chr(97 + int(c)) for c in f"{i:03}") for i in range(n)]
    paths = [*(f"/de/{i}" for i in range(3)), *(f"/{s}/{i}" for s in names for i in range(3))]
    got = verdicts(spark, paths, [("block", "x.de", "/de/")])
    assert len(got) == 3 * n and {v for _, v in got.values()} == {"allow"}
    big = verdicts(spark, [*paths, *(f"/{s}/{i}" for s in names[:2] for i in range(10, 20))], [("block", "x.de", "/de/")])
    assert {big[f"/{s}/0"] for s in names[:2]} == {(f"/{s}/{{n}}", "allow") for s in names[:2]}


@pytest.mark.parametrize("n", [12, 14, 19, 20, 21, 22, 60])
def test_labels_that_agree_speak_for_any_number_of_names(spark, n):
    names = ["".join(chr(97 + int(c)) for c in f"{i:03}") for i in range(n)]
    paths = [f"/{s}/{i}" for s in names for i in range(3)]
    got = verdicts(spark, [*paths, "/new/1"], [("block", "x.de", f"/{s}/") for s in names[:12]])
    assert len(got) == 3 * (n - 12) + 1 and set(got.values()) == {("/*/{n}", "block")}
    few = verdicts(spark, [*paths, "/new/1"], [("block", "x.de", f"/{s}/") for s in names[:8]])
    assert {v for _, v in few.values()} == {"allow"}


def test_wildcards_speak_for_names_where_labels_agree(spark):
    names = ["".join(chr(97 + int(c)) for c in f"{i:03}") for i in range(120)]
    paths = [f"/{s}/{i}" for s in names for i in range(5)]
    alike = verdicts(spark, paths, [("block", "x.de", f"/{s}/") for s in names[:40]])
    assert set(alike.values()) == {("/*/{n}", "block")}
    mixed = verdicts(spark, paths, [("block" if i < 30 else "allow", "x.de", f"/{s}/") for i, s in enumerate(names[:50])])
    assert set(mixed.values()) == {("/*/{n}", "allow")}
    outlier = verdicts(spark, paths, [("allow" if i else "block", "x.de", f"/{s}/{j}") for i, s in enumerate(names[:40]) for j in range(4)])
    assert outlier[f"/{names[0]}/4"] == (f"/{names[0]}/{{n}}", "block") and outlier[f"/{names[1]}/4"] == ("/*/{n}", "allow")


def test_paths_are_told_apart_at_any_depth(spark):
    for depth in (3, 5, 9, 40):
        top = "/a" * depth
        paths = [f"{top}/{d}/{i}" for d in ("shop", "blog") for i in range(200)]
        rules = [(v, "x.de", f"{top}/{d}/{i}") for v, d in (("block", "shop"), ("allow", "blog")) for i in "12"]
        assert set(verdicts(spark, paths, rules).values()) == {(f"{top}/shop/{{n}}", "block"), (f"{top}/blog/{{n}}", "allow")}


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist(), 0.0) for i in range(30)]
    rows += [(40, None, 0.0), (41, [0.0] * 4, 0.0), (42, [1.0, None, 0.0, 0.0], 0.0), (43, [float("nan")] * 4, 0.0), (44, [1.0], 0.0)]
    rows += [(50 + i, [1.0, 2.0, 3.0, 4.0], 0.0) for i in range(15)] + [rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    got = neighbours.nearest(df, F.col("vec_id") % 10 == 0).collect()
    assert {r.query_id for r in got} == {0, 10, 20, 50, 60}
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 60), key=lambda r: r["rank"])] == list(range(50, 60))
    assert neighbours.nearest(df.limit(0), F.col("vec_id") > 0).isEmpty()
    assert neighbours.nearest(df.where("vec_id < 3"), F.col("vec_id") == 0).count() == 2


def test_neighbours_of_two_widths(spark):
    """Each vector's neighbours are those of its own number of components."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2 if i % 2 else 3).tolist()) for i in range(1, 120)] + [(1000, [0.1, 0.2, 0.3]), (1001, [1.0] * 5), (None, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    vectors = {i: np.array(v) for i, v in rows if i is not None}
    got = neighbours.nearest(df, (F.col("vec_id") % 100 == 0) | (F.col("vec_id") % 100 == 1), recall=1.0).collect()
    for q in (1, 100, 101, 1000, 1001):
        far = sorted((float(np.sqrt(((v - vectors[q]) ** 2).sum())), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[1] for m in mine] == [i for _, i in far[:10]], q
        assert [m[2] for m in mine] == pytest.approx([d for d, _ in far[:10]])


def test_counts_beyond_32_bits():
    keys = np.array([3, 1, 3, 2, 3], np.uint64)
    counts = np.array([1 << 32, 5, (1 << 32) - 1, 0, 1 << 40], np.int64)
    want = [(1 << 33) - 1 + (1 << 40), 5, (1 << 33) - 1 + (1 << 40), 0, (1 << 33) - 1 + (1 << 40)]
    assert lm.totals(keys, counts).tolist() == want
    for part in (counts, counts[1:2], counts[:0]):
        assert lm.unpack_counts(lm.pack_counts(part), len(part)).tolist() == part.tolist()
    assert len(lm.pack_counts(counts[1:2])) == 4
