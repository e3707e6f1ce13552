"""Language-model scoring by a weighted backoff automaton.

The states of the automaton are the known contexts of up to ORDER - 1 tokens, down
to the empty one. A state has an arc for each token that followed its context,
with the token's smoothed probability; for any other token its failure arc leads
to the next shorter context, at the weight of what smoothing set aside. The empty
state has an arc for every token, unknown ones too. From left to right, a text's
state is the longest known context, and the weights of the arcs taken add up.

Counts grow with the corpus, so no task holds them all. Texts are dealt into
blocks of bounded size. Each block sends its different n-grams, with their counts
in its training texts, to partitions by hash; these sum and send back the counts of
just those n-grams, so that a block has every arc its texts can take.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import TOKEN_BYTES, arrow_schema, chunks, id_remainder, mix64, record_batch, table, word_hashes

#: Longest n-grams, and the weight in tokens of the next shorter context, by length of the n-gram.
ORDER = 2
PRIOR = (0.0, 0.0, 60.0, 5.0, 5.0, 5.0)
#: Characters of text per block and of n-grams per partition, about.
BLOCK_CHARS = 6_000_000

END, BEGIN = np.uint64(0x7E4D1F0A5B3C2E11), np.uint64(0x3B9AC9FF12345677)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def text_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, an end after each text, and the number of tokens of each text."""
    parts = [np.append(word_hashes(x, TOKEN_BYTES), END) for x in texts]
    lengths = np.array([len(x) for x in parts], np.int64)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), lengths


def ngram_keys(tokens: np.ndarray, lengths: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1: keys of the n-grams that end at each token, and where there is one.

    A text begins with a mark that is a context but not a token.
    """
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    keys = [(mix64(tokens ^ _GOLD), np.ones(len(tokens), bool))]
    for n in range(2, order + 1):
        before = np.empty_like(tokens)
        before[1:] = keys[-1][0][:-1]
        before[place == 0] = BEGIN
        keys.append((mix64(before * _GOLD + tokens), place >= n - 2))
    return keys


def block_ngrams(texts: list[str | None], order: int):
    """(tokens per text, different keys in order, index of each n-gram's key by length, where there is one)."""
    tokens, lengths = text_tokens(texts)
    by_length = ngram_keys(tokens, lengths, order)
    unique, inverse = np.unique(np.concatenate([k[ok] for k, ok in by_length]), return_inverse=True)
    places, start = [], 0
    for keys, ok in by_length:
        at = np.full(len(keys), -1, np.int64)
        at[ok] = inverse[start : start + int(ok.sum())]
        start += int(ok.sum())
        places.append(at)
    return lengths, unique, places


def partition_of(keys: np.ndarray, partitions: int) -> np.ndarray:
    """Partitions by range of key, so that sorted keys stay in order."""
    return ((keys >> np.uint64(40)) * np.uint64(partitions) >> np.uint64(24)).astype(np.int64)


def pack(keys: np.ndarray) -> bytes:
    """The low 48 bits of keys. Of m different n-grams in a partition, two share them with a chance of m^2 / 2^49: one in
    1,400 at 600,000, as many as BLOCK_CHARS lets in; they then get each other's counts as well."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts in 32 bits each if all fit, else in 64."""
    return counts.astype("<u4" if not len(counts) or counts.max() < 1 << 32 else "<u8").tobytes()


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u4" if len(data) == 4 * n else "<u8").astype(np.int64)


def totals(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each key, the sum of the counts of all its occurrences, exact up to 63 bits."""
    order = np.argsort(keys, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))[: len(keys)]
    out = np.empty(len(keys), np.int64)
    out[order] = np.repeat(np.add.reduceat(counts[order], first), np.diff(first, append=len(keys))) if len(keys) else 0
    return out


class Automaton:
    """Arcs of the n-grams of a block, by their counts in the whole training corpus."""

    def __init__(self, counts: np.ndarray, training: dict, order: int):
        self.counts, self.order = counts.astype(np.float64), order
        self.tokens, self.types, self.texts = training["tokens"], training["types"], training["texts"]

    def root(self, count: np.ndarray) -> np.ndarray:
        """log10 probabilities of the empty state's arcs; a count of 0 is an unknown token."""
        return np.log10(count + 1.0) - math.log10(self.tokens + self.types + 1)

    def traverse(self, places: list[np.ndarray], lengths: np.ndarray) -> np.ndarray:
        """log10 probability of each token from the state that the tokens before it lead to.

        The state after some tokens is their longest suffix that is a context, so
        each step's state is read off the n-grams that end before it.
        """
        first = np.zeros(len(places[0]), bool)
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        weight = self.root(self.counts[places[0]])
        for n in range(2, self.order + 1):
            context = np.zeros(len(first))
            context[1:] = np.where(places[n - 2][:-1] >= 0, self.counts[places[n - 2][:-1]], 0.0)
            context[first] = self.texts if n == 2 else 0.0
            known = (context > 0) & (places[n - 1] >= 0)
            seen = np.where(known, self.counts[places[n - 1]], 0.0)
            prior = PRIOR[n]
            with np.errstate(divide="ignore"):
                failure = np.log10(prior / (context + prior))
            # An arc carries the token's probability; without one, the failure arc's weight comes before the lower state's.
            arc = np.log10((seen + prior * 10.0**weight) / (context + prior))
            weight = np.where(known, np.where(seen > 0, arc, failure + weight), weight)
        return weight


def training_size(docs: DataFrame, partitions: int) -> dict:
    """Tokens, different tokens and texts of the training documents (those with ``_train``)."""
    schema = "part long, n_tokens long, n_texts long, keys binary"
    arrow = arrow_schema(schema)

    def run(batches):
        known, n_tokens, n_texts = np.empty(0, np.uint64), 0, 0

        def rows():
            bounds = np.searchsorted(partition_of(known, partitions), np.arange(partitions + 1))
            found = [(p, 0, 0, known[a:b].tobytes()) for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if b > a]
            return record_batch([(0, n_tokens, n_texts, b""), *found], arrow)

        for batch in batches:
            texts = batch.column(0).to_pylist()
            for start, end in chunks(texts):
                tokens, lengths = text_tokens(texts[start:end])
                n_tokens, n_texts = n_tokens + len(tokens), n_texts + len(lengths)
                known = np.union1d(known, mix64(tokens ^ _GOLD))
            if len(known) > 2_000_000:
                yield rows()
                known, n_tokens, n_texts = np.empty(0, np.uint64), 0, 0
        yield rows()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.unique(np.frombuffer(b"".join(pdf["keys"]), np.uint64))
        return pd.DataFrame({"types": [len(keys)], "tokens": [pdf["n_tokens"].sum()], "texts": [pdf["n_texts"].sum()]})

    sent = docs.filter("_train").select("text").mapInArrow(run, schema)
    sums = sent.groupBy("part").applyInPandas(merge, "types long, tokens long, texts long")
    found = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "types", "texts")]).first()
    return found.asDict()


def score_texts(docs: DataFrame, *, order: int = ORDER, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row per row of ``docs``.

    ``docs`` has doc_id, text and a boolean ``_train`` that says which texts are
    learned from. A null or empty text is its end token alone. Repeated rows count
    as often as they occur. Without training texts every token is unknown. An empty
    table gives no rows.
    """
    if not 1 <= order < len(PRIOR):
        raise ValueError(f"order has to be from 1 to {len(PRIOR) - 1}")
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)) + 2 * F.count(F.lit(1))).first()[0]
    n = max(1, math.ceil(size / block_chars))
    training = training_size(docs, n)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("block")
    blocked = docs.select(block, F.col("doc_id").cast("long").alias("doc_id"), "text", "_train").repartition(n, "block")

    def ask(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths, keys, places = block_ngrams(pdf["text"].tolist(), order)
        train = np.repeat(pdf["_train"].to_numpy(bool), lengths)
        counts = np.zeros(len(keys), np.int64)
        for at in places:
            counts += np.bincount(at[train & (at >= 0)], minlength=len(keys))
        bounds = np.searchsorted(partition_of(keys, n), np.arange(n + 1))
        rows = [
            (int(pdf["block"].iat[0]), p, pack(keys[a:b]), pack_counts(counts[a:b]))
            for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))
            if b > a
        ]
        return pd.DataFrame(rows, columns=["block", "part", "keys", "counts"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack(x) for x in pdf["keys"]]
        counts = [unpack_counts(x, len(k)) for x, k in zip(pdf["counts"], keys, strict=True)]
        total = totals(np.concatenate(keys), np.concatenate(counts))
        parts = np.split(total, np.cumsum([len(k) for k in keys])[:-1])
        return pd.DataFrame({"block": pdf["block"], "part": pdf["part"], "n": [len(k) for k in keys], "counts": list(map(pack_counts, parts))})

    def score(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        lengths, keys, places = block_ngrams(texts["text"].tolist(), order)
        answers = answers.sort_values("part")
        counts = [unpack_counts(x, n) for x, n in zip(answers["counts"], answers["n"], strict=True)]
        counts = np.concatenate(counts) if counts else np.empty(0, np.int64)
        if len(counts) != len(keys):
            raise RuntimeError(f"{len(counts)} counts for {len(keys)} n-grams")
        automaton = Automaton(counts, training, order)
        starts = np.cumsum(lengths) - lengths

        def per_text(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, starts) if len(starts) else x

        single = automaton.counts[places[0]]
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"],
                "held_out": ~texts["_train"].to_numpy(bool),
                "n_tokens": lengths,
                "n_known": per_text((single > 0).astype(np.int64)),
                "train_tokens": training["tokens"],
                "base_score": per_text(automaton.root(single)),
                "score": per_text(automaton.traverse(places, lengths)),
            }
        )

    asked = blocked.groupBy("block").applyInPandas(ask, "block long, part long, keys binary, counts binary")
    answered = asked.repartition(n, "part").groupBy("part").applyInPandas(answer, "block long, part long, n long, counts binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocked.groupBy("block").cogroup(answered.groupBy("block")).applyInPandas(score, schema)


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_texts(docs.withColumn("_train", id_remainder("doc_id", 7) != 2))
