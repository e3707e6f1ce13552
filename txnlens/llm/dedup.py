"""Near-duplicates of weighted word shingles by DartMinHash.

A document is the multiset of its runs of five words; the weight of a shingle is
how often it occurs, and similarity is the sum of the smaller weights over the sum
of the larger ones. Each unit of an element's weight is a region into which darts
fall: their ranks form a Poisson process whose steps are hashes of element, unit
and number of the dart, so equal elements get equal darts in every document. Only
darts below a rank are thrown, chosen so that a few per coordinate are expected
whatever the length of the document; each lands on a coordinate, and the earliest
dart of a coordinate is its signature. Coordinates that stayed empty are thrown
for again with the rank doubled. Two documents agree in a coordinate with the
probability of their similarity.

Signatures are cut into bands; documents that share a band share a bucket. Copies
that have the same words are one node. In each bucket, all nodes are compared with
one pivot. Buckets with several components left are clusters by their largest one,
and a cluster's nodes are compared with a central node of it. A pair that is still
open has a node below the threshold to that centre; such a node differs from it by
more than from a near-duplicate, so both differ from it in the same elements. These
are joined by their rarest, by prefix and position, and what remains is compared. Every
pair of a bucket thus is compared, known to be connected, or known to be too far
apart, and no list of a bucket is ever built.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlens.llm.common import (
    chunks,
    arrow_schema,
    free_names,
    gram_hashes,
    materialize,
    mix64,
    record_batch,
    row_key,
    table,
    word_hashes,
)

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^24 = 0.000003.
BANDS, ROWS = 24, 4
#: Darts expected per coordinate beyond the logarithm of their number.
SPARE = 2.0

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of k words, repeats included; a shorter text is one shingle."""
    return gram_hashes(words, min(k, len(words))) if len(words) else np.empty(0, np.uint64)


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def throw_darts(elements: np.ndarray, weights: np.ndarray, most: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, ...]:
    """(set, rank, hash) of the darts that hit the elements' weights, up to a rank per element; ``of``: an element's set."""
    units = np.ceil(weights).astype(np.int64)
    at = np.repeat(np.arange(len(elements)), units)
    unit = np.arange(len(at)) - np.repeat(np.cumsum(units) - units, units)
    state = mix64(elements[at] + mix64(unit.astype(np.uint64) * _GOLD))
    part = None if (units == weights).all() else weights[at] - unit  # of the region that the weight fills
    most, of = most[at], of[at]
    rank, i = np.zeros(len(state)), np.arange(len(state))
    found = []
    while len(state):
        state = mix64(state + _GOLD)
        rank = rank - np.log(_uniform(state))
        near = np.flatnonzero(rank <= most[i])
        state, rank, i = state[near], rank[near], i[near]
        hit = slice(None) if part is None else (part[i] >= 1) | (_uniform(mix64(state ^ _GOLD)) <= part[i])
        found.append((of[i[hit]], rank[hit], state[hit]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def dart_signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int = BANDS * ROWS) -> np.ndarray:
    """The earliest dart of each coordinate, a row per set of different elements and their positive weights.

    Darts of many sets are thrown together; a set that has an empty coordinate
    goes on to the next round alone.
    """
    out = np.zeros((len(sets), size), np.uint64)
    totals = np.array([float(w.sum()) for _, w in sets])
    ranks = size * (math.log(size) + SPARE) / totals
    todo = np.arange(len(sets))
    while len(todo):
        lengths = [len(sets[i][0]) for i in todo]
        of = np.repeat(todo, lengths)
        elements, weights = (np.concatenate([sets[i][k] for i in todo]) for k in (0, 1))
        owner, rank, dart = throw_darts(elements, weights.astype(np.float64), ranks[of], of)
        place = owner * size + (mix64(dart) % np.uint64(size)).astype(np.int64)
        late_first = np.argsort(rank)[::-1]  # so that the earliest dart of a coordinate is written last
        out.reshape(-1)[place[late_first]] = dart[late_first]
        seen = np.zeros(out.size, bool)
        seen[place] = True
        filled = seen.reshape(out.shape).all(axis=1)
        todo = todo[~filled[todo]]
        ranks[todo] *= 2
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A hash of each band's coordinates and its number."""
    parts = signature.reshape(bands, rows)
    key = mix64(np.arange(bands, dtype=np.uint64) * _GOLD)
    for j in range(rows):
        key = mix64((key ^ parts[:, j]) * _GOLD)
    return key.view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller over sum of larger weights of two multisets of shingles."""
    a, m = np.unique(a, return_counts=True)
    b, n = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = int(np.minimum(m[i], n[j]).sum())
    return shared / (int(m.sum()) + int(n.sum()) - shared)


def _signed(words: np.ndarray) -> int:
    """A signed 64-bit hash of a sequence of words."""
    return xxhash.xxh64_intdigest(words.tobytes()) - (1 << 63)


def signatures(docs: DataFrame) -> DataFrame:
    """(row_key, doc_id, node, bands): ``node`` is a hash of the words, null without any, and ``bands`` their buckets."""
    schema = "row_key long, doc_id long, node long, bands array<long>"
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            keys, ids, texts = (batch.column(i).to_pylist() for i in range(3))
            for start, end in chunks(texts):
                words = [word_hashes(x) for x in texts[start:end]]
                full = [i for i, x in enumerate(words) if len(x)]
                sets = [np.unique(shingles(words[i]), return_counts=True) for i in full]
                rows = [(key, doc, None, []) for key, doc in zip(keys[start:end], ids[start:end], strict=True)]
                for i, signature in zip(full, dart_signatures(sets) if sets else (), strict=True):
                    rows[i] = (*rows[i][:2], _signed(words[i]), band_keys(signature))
                yield record_batch(rows, arrow)

    return docs.select(row_key(), F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs of nodes; ``texts`` has (node, text)."""
    schema = "a long, b long, similarity double"
    arrow = arrow_schema(schema)

    def run(batches):
        kept: tuple = (None, None)
        for batch in batches:
            rows = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if kept[0] != b:
                    kept = b, shingles(word_hashes(y))
                rows.append((a, b, similarity(shingles(word_hashes(x)), kept[1])))
            yield record_batch(rows, arrow)

    left = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each node's component, for all nodes with an edge.

    Large-star and small-star steps in turn, as joins: a node's neighbours are
    never listed. Ends after about the logarithm of the longest path.
    """
    spark = edges.sparkSession
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).select(high, low).filter("u <> v").distinct()
    now, before = materialize(spark, now, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("label"))
            ).distinct()
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v"))
        now = materialize(spark, small.filter("u <> v").distinct(), "edges")


def mixed_buckets(members: DataFrame, label: DataFrame) -> DataFrame:
    """(cluster, node, label): nodes of buckets that hold several components beside the pivot; a cluster is a bucket's largest one."""
    placed = (
        members.filter("node <> pivot")
        .join(label, "node", "left")
        .select("bucket", "node", F.coalesce("label", "node").alias("label"))
    )
    sizes = placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "label")).getField("label").alias("cluster"), F.count(F.lit(1)).alias("parts")
    )
    found = placed.join(largest.filter("parts > 1").drop("parts"), "bucket")
    met = found.groupBy("cluster", "node", "label").agg(F.count(F.lit(1)).alias("met"))
    return materialize(members.sparkSession, met, "clusters")


def elements(words: np.ndarray) -> np.ndarray:
    """The multiset of shingles as a sorted set: an element is a shingle and the number of its occurrence."""
    found, counts = np.unique(shingles(words), return_counts=True)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix64(np.repeat(found, counts) + nth.astype(np.uint64) * _GOLD))


def differences(clusters: DataFrame, texts: DataFrame) -> DataFrame:
    """(cluster, node, pivot, size, similarity, diff): what a node's elements and those of its cluster's pivot don't share.

    The pivot is the node of the cluster's own component that most of its buckets hold.
    """
    schema = "cluster long, node long, pivot long, size long, similarity double, diff array<long>"
    arrow = arrow_schema(schema)

    def run(batches):
        kept: tuple = (None, None)
        for batch in batches:
            cluster, node, pivot, text, pivot_text = (batch.column(i).to_pylist() for i in range(5))
            for start, end in chunks(text):
                rows = []
                for i in range(start, end):
                    if kept[0] != pivot[i]:
                        kept = pivot[i], elements(word_hashes(pivot_text[i]))
                    own = elements(word_hashes(text[i]))
                    diff = np.setxor1d(own, kept[1], assume_unique=True)
                    shared = (len(own) + len(kept[1]) - len(diff)) // 2
                    alike = shared / (shared + len(diff))
                    rows.append((cluster[i], node[i], pivot[i], len(own), alike, diff.view(np.int64)))
                yield record_batch(rows, arrow)

    central = F.max(F.struct(F.expr("label = cluster").alias("own"), "met", "node")).getField("node").alias("pivot")
    pivots = clusters.groupBy("cluster").agg(central).join(
        texts.select(F.col("node").alias("pivot"), F.col("text").alias("pivot_text")), "pivot"
    )
    both = clusters.select("cluster", "node").join(texts, "node").join(pivots, "cluster")
    return both.select("cluster", "node", "pivot", "text", "pivot_text").mapInArrow(run, schema)


def open_pairs(diffs: DataFrame, label: DataFrame, threshold: float) -> DataFrame:
    """(a, b): pairs of a cluster that may be near-duplicates without being connected yet.

    Let x be below the threshold t to the pivot, y near x, and D their differences to the pivot.
    As x and y differ in what D(x) and D(y) don't share, which is at most (1 - t) of their union,
    they share over t / (1 + t) of D(y), at least |D(x)| - (1 - t) / t |x|, and at least
    half of |D(x)| + |D(y)| - (1 - t) / t min(|x|, |y|). So the first shared element, rare ones first,
    lies within a prefix of both, and enough elements follow it.
    """
    slack, eps = (1 - threshold) / threshold, 1e-9
    now = diffs.join(label, "node", "left").select(
        "cluster", "node", "size", "diff", F.size("diff").alias("n"),
        F.coalesce("label", "node").alias("label"), (F.col("similarity") < threshold).alias("outside"),
    )
    several = now.groupBy("cluster").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    each = now.join(several.select("cluster"), "cluster").withColumn("element", F.explode("diff")).drop("diff")
    held = each.groupBy("cluster", "element").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    order = Window.partitionBy("cluster", "node").orderBy(F.coalesce("held", F.lit(1)), "element")
    ranked = each.join(held, ["cluster", "element"], "left").withColumn("at", F.row_number().over(order))
    y_needs = F.floor(F.col("n") * (threshold / (1 + threshold)) - eps)
    x_needs = F.greatest(F.lit(0), F.ceil(F.col("n") - F.col("size") * slack - eps) - 1)
    ranked = ranked.filter("held > 1").withColumn("as_y", F.col("at") <= F.col("n") - y_needs)
    ranked = ranked.withColumn("as_x", F.col("outside") & (F.col("at") <= F.col("n") - x_needs)).filter("as_x OR as_y")
    ranked = materialize(diffs.sparkSession, ranked.drop("held", "outside"), "prefixes")

    def side(role: str, s: str) -> DataFrame:
        named = [F.col(c).alias(f"{c}_{s}") for c in ("node", "size", "n", "label", "at")]
        return ranked.filter(role).select("cluster", "element", *named)

    needs = (F.col("n_a") + F.col("n_b") - F.least("size_a", "size_b") * slack) / 2 - eps
    follow = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) + 1
    found = side("as_x", "a").join(side("as_y", "b"), ["cluster", "element"]).filter((F.col("label_a") != F.col("label_b")) & (follow >= needs))
    return found.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def with_pivots(buckets: DataFrame) -> DataFrame:
    """(bucket, node, pivot) of buckets with several nodes; the pivot is the node whose buckets hold most nodes in total."""
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = buckets.join(sizes, "bucket")
    central = shared.join(shared.groupBy("node").agg(F.sum("n").alias("met")), "node")
    pivots = central.groupBy("bucket").agg(F.max(F.struct("met", "node")).getField("node").alias("pivot"))
    return shared.select("bucket", "node").join(pivots, "bucket")


def links(docs: DataFrame, rows: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """(node, label) of all nodes that are near-duplicates of another node."""
    spark = docs.sparkSession
    nodes = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.min("row_key").alias("row_key"), F.first("bands").alias("bands")
    )
    buckets = materialize(spark, nodes.select(F.explode("bands").alias("bucket"), "node"), "buckets")
    members = materialize(spark, with_pivots(buckets), "members")
    keys = nodes.select("node", "row_key").join(members.select("node").distinct(), "node")
    texts = docs.select(row_key(), "text").join(keys, "row_key").dropDuplicates(["node"]).select("node", "text")
    texts = materialize(spark, texts, "member-texts")

    pairs = members.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    first = materialize(spark, compare(pairs, texts), "compared")
    near = first.filter(F.col("similarity") >= threshold)
    label = components(near)

    diffs = materialize(spark, differences(mixed_buckets(members, label), texts), "differences")
    to_pivot = diffs.select(F.col("node").alias("a"), F.col("pivot").alias("b"), "similarity")
    near = near.unionByName(to_pivot.filter((F.col("similarity") >= threshold) & F.expr("a <> b")))
    label = components(near)

    rest = materialize(spark, compare(open_pairs(diffs, label, threshold), texts), "compared")
    more = rest.filter(F.col("similarity") >= threshold)
    return label if more.isEmpty() else components(near.unionByName(more))


def near_duplicates(docs: DataFrame, *, threshold: float = SIMILARITY) -> DataFrame:
    """(row_key, doc_id, node, class_id, class_key), a row per row of ``docs``.

    Documents are in one class if a chain of pairs of similarity ``threshold`` or
    more connects them; ``class_id`` is the smallest doc_id of the class and
    ``class_key`` the row key of that document. Words are lower-cased runs of ASCII
    letters, digits and other code points; copies have the same words. Documents
    without words (null, empty or only marks) have no shingles and are similar to
    nothing: repeated rows apart, each is a class of its own. Null ids come after
    all others. Needs doc_id and text, reads no other columns.
    """
    spark = docs.sparkSession
    rows = materialize(spark, signatures(docs), "signatures")
    label = links(docs, rows, threshold)
    # The two kinds of label never meet: a wordless row is its own class.
    kind, of = F.col("node").isNull().alias("wordless"), F.coalesce("label", "node", "row_key").alias("class")
    labelled = rows.select("row_key", "doc_id", "node").join(label, "node", "left").select("row_key", "doc_id", "node", kind, of)
    labelled = materialize(spark, labelled, "labels")
    first = labelled.groupBy("wordless", "class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first"))
    return labelled.join(first, ["wordless", "class"]).select(
        "row_key", "doc_id", "node", F.col("first.doc_id").alias("class_id"), F.col("first.row_key").alias("class_key")
    )


def drop_near_duplicates(docs: DataFrame, **params) -> DataFrame:
    """One document of each class, the one of the smallest doc_id; the columns of ``docs``.

    Of repeated rows with that id and text one stays.
    """
    (key,) = free_names(docs, "row_key")
    kept = near_duplicates(docs, **params).filter("row_key = class_key").select(F.col("row_key").alias(key)).distinct()
    found = docs.withColumn(key, row_key()).join(kept, key)
    return found.dropDuplicates([key]).select(*docs.columns)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", (F.col("row_key") == F.col("class_key")).alias("kept"))
