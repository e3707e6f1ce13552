"""Approximate nearest neighbours by a hash-prefix forest.

A tree is the sorted array of its vectors' hash strings: 64 signs of projections on
random directions, as one integer. A query descends to the vectors that share the
longest prefix with its own string, in all trees at once, and then the trees ascend
together, a bit at a time, until enough vectors have been met; those are measured
exactly. How many are enough is a share of the rows, tuned on a bounded sample to
the recall that is asked for. It behaves alike at every size, and sets no cap: at
an ascent's last level every vector that shares that prefix is measured.

Rows stay where they are read: each task makes forests of its own rows, in pieces of
bounded size, and looks up the queries, which come in blocks of bounded size. Only
the nearest few of each piece are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlens.llm.common import arrow_schema, bounded_sample, materialize, record_batch, table

NEIGHBOURS, TREES, BITS, SEED = 10, 16, 64, 11
#: Rows of a forest, queries of a block.
PIECE, BLOCK = 20_000, 2_000
#: The tuning sample, the recall it has to reach, and the shares that are tried.
SAMPLE, SAMPLE_QUERIES, RECALL = 10_000, 200, 0.96
SHARES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)


def directions(dimensions: int, trees: int = TREES) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimensions, trees * BITS))


def hash_strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """A column of 64-bit strings per tree, the first bit highest."""
    signs = (vectors @ planes) > 0
    packed = np.packbits(signs.reshape(len(vectors), -1, BITS), axis=2)
    return packed.view(">u8")[:, :, 0].astype(np.uint64)


class Forest:
    """Sorted hash strings of some vectors, per tree."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, planes: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        strings = hash_strings(self.vectors, planes)
        self.order = [np.argsort(strings[:, t], kind="stable") for t in range(strings.shape[1])]
        self.sorted = [strings[o, t] for t, o in enumerate(self.order)]

    def ranges(self, strings: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree, the run of vectors that share the first ``level`` bits."""
        rest = np.uint64((1 << (BITS - level)) - 1)
        low = strings & ~rest
        first = np.stack([np.searchsorted(s, low[:, t], "left") for t, s in enumerate(self.sorted)], axis=1)
        last = np.stack([np.searchsorted(s, low[:, t] | rest, "right") for t, s in enumerate(self.sorted)], axis=1)
        return first, last

    def search(self, query_ids, queries, strings, enough: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, ids, distances) of the k nearest among what each query met."""
        todo = np.arange(len(queries))
        for level in range(BITS, -1, -1):
            if not len(todo):
                return
            first, last = self.ranges(strings[todo], level)
            ready = ((last - first).sum(axis=1) >= enough) | (level == 0)
            if level:  # several trees meet the same vector: count different ones where that may matter
                for i in np.flatnonzero(ready):
                    ready[i] = len(self._met(first[i], last[i])) >= enough
            for i in np.flatnonzero(ready):
                q = todo[i]
                met = self._met(first[i], last[i])
                met = met[self.ids[met] != query_ids[q]]
                far = ((self.vectors[met] - queries[q]) ** 2).sum(axis=1)
                near = np.lexsort((self.ids[met], far))[:k] if len(met) <= 4 * k else _nearest(far, self.ids[met], k)
                yield q, self.ids[met[near]], np.sqrt(far[near])
            todo = todo[~ready]

    def _met(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(self.ids), bool)
        for order, a, b in zip(self.order, first.tolist(), last.tolist(), strict=True):
            seen[order[a:b]] = True
        return np.flatnonzero(seen)


def _nearest(far: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest, ties to smaller ids."""
    among = np.flatnonzero(far <= np.partition(far, k - 1)[k - 1])
    return among[np.lexsort((ids[among], far[among]))[:k]]


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of doubles, without null or zero ones and those that hold null or non-finite components."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    return df.select("vec_id", v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & some)


def _arrays(rows: list) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([r["vec_id"] for r in rows], np.int64)
    return ids, np.array([r["v"] for r in rows], np.float64)


def tuned_share(rows: DataFrame, planes: np.ndarray, k: int, recall: float = RECALL) -> float:
    """The smallest share of rows to meet that reaches the recall on the sample (rows of the smallest hashes)."""
    ids, vectors = _arrays(bounded_sample(rows, F.xxhash64("vec_id", "v"), SAMPLE).collect())
    if len(ids) <= 4 * k:
        return 1.0
    forest, queries = Forest(ids, vectors, planes), slice(0, SAMPLE_QUERIES)
    query_ids, query_vectors = ids[queries], vectors[queries]
    strings = hash_strings(query_vectors, planes)

    def found(share: float) -> dict[int, set]:
        return {q: set(x.tolist()) for q, x, _ in forest.search(query_ids, query_vectors, strings, round(share * len(ids)), k)}

    exact = found(1.0)
    for share in SHARES:
        got = found(share)
        if np.mean([len(got[q] & exact[q]) / len(exact[q]) for q in exact]) >= recall:
            return share
    return 1.0


def nearest(df: DataFrame, queries: Column, *, k: int = NEIGHBOURS, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows by Euclidean distance of each query row.

    ``queries`` is a condition on vec_id. A query's own row is no candidate; ties go
    to the smaller vec_id, and fewer candidates give fewer rows. Rows that can't be
    measured take no part, nor those without a vec_id. Only vectors of one number of
    components can be measured against each other, so each such number has forests of its own. Repeated
    rows of one id and vector count once. An empty table gives no rows. Reads vec_id and embedding only.
    """
    spark = df.sparkSession
    rows = usable(df)
    widths = sorted(r["d"] for r in rows.filter(queries).select(F.size("v").alias("d")).distinct().collect())
    found = [part for d in widths for part in _search(rows.filter(F.size("v") == d), queries, d, k, trees, recall)]
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = out.distinct().withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(rows: DataFrame, queries: Column, dimensions: int, k: int, trees: int, recall: float) -> Iterator[DataFrame]:
    """What each piece found for a block of queries, a written table per block: one block is on the driver at a time."""
    spark = rows.sparkSession
    schema = "query_id long, vec_id long, score double"
    arrow = arrow_schema(schema)
    planes = directions(dimensions, trees)
    share = tuned_share(rows, planes, k, recall)
    asked = materialize(spark, rows.filter(queries).distinct(), "queries")
    n_blocks = -(-asked.count() // BLOCK)
    for block in range(n_blocks):
        mine = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block)
        shared = spark.sparkContext.broadcast((*_arrays(mine.collect()), planes, share))

        def run(batches, shared=shared):
            query_ids, vectors, planes, share = shared.value
            strings = hash_strings(vectors, planes) if len(vectors) else None
            for ids, mine in _pieces(batches, dimensions):
                if strings is None:
                    continue
                forest = Forest(ids, mine, planes)
                out = []
                for q, near, far in forest.search(query_ids, vectors, strings, max(k, round(share * len(ids))), k):
                    out += zip([int(query_ids[q])] * len(near), near.tolist(), far.tolist(), strict=True)
                yield record_batch(out, arrow)

        yield materialize(spark, rows.mapInArrow(run, schema), "nearest")
        shared.destroy()


def _pieces(batches, dimensions: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The task's rows, so many at a time."""
    ids: list[np.ndarray] = []
    vectors: list[np.ndarray] = []
    for batch in batches:
        ids.append(batch.column(0).to_numpy(zero_copy_only=False))
        vectors.append(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions))
        if sum(map(len, ids)) >= PIECE:
            yield np.concatenate(ids), np.concatenate(vectors)
            ids, vectors = [], []
    if sum(map(len, ids)):
        yield np.concatenate(ids), np.concatenate(vectors)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
