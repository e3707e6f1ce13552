"""Language identification of mixed-language text.

Training counts letter trigrams (the neighbours of a letter count, other
characters read as space) by language, in hashed buckets, and letters by script.
A word's score in a language is the sum of its letters' log-probabilities. Scripts
come first: a language is a candidate for a word only if it uses the word's script.
Over the words of a document, Viterbi's best path of languages, with a penalty for
each switch, labels spans; the language of most letters is the document's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import CHUNK_CHARS, arrow_schema, chunks, id_remainder, mix64, record_batch, table

#: Buckets of trigrams (each holds a count per language), and counts added to each.
BUCKETS, SMOOTHING = 1 << 16, 0.1
#: Cost of a switch, in natural logarithms.
PENALTY = 8.0
#: A language uses a script if at least this share of its letters is of it.
SCRIPT_SHARE = 0.02
UNKNOWN = "und"

# First code points of ranges, and their script.
SCRIPTS = (
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Other"),
    (0x0E00, "Thai"),
    (0x0E80, "Other"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Other"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "Other"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xAC00, "Hangul"),
    (0xD7B0, "Other"),
    (0xF900, "Han"),
    (0xFB00, "Other"),
    (0x20000, "Han"),
)
SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_OF = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS], np.int64)

_LETTERS: dict[int, np.ndarray] = {}


def is_letter(points: np.ndarray) -> np.ndarray:
    """Which code points are letters, looked up by pages of 4,096."""
    out = np.zeros(len(points), bool)
    pages = points >> 12
    for page in np.flatnonzero(np.bincount(pages)):
        if page not in _LETTERS:
            first = int(page) << 12
            _LETTERS[page] = np.array([chr(first + i).isalpha() for i in range(4096)])
        here = pages == page
        out[here] = _LETTERS[page][points[here] & 4095]
    return out


class Words:
    """Letters of a chunk of texts, the trigram and word of each, and the text and place of each word."""

    def __init__(self, texts: list[str | None]):
        lowered = [(x or "").lower() for x in texts]
        joined = "\n".join(["", *lowered, ""])
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letters = is_letter(points)
        spaced = np.where(letters, points, 32).astype(np.uint64)
        at = np.flatnonzero(letters)
        mixed = (spaced[at - 1] << np.uint64(42)) ^ (spaced[at] << np.uint64(21)) ^ spaced[at + 1]
        self.bucket = (mix64(mixed) & np.uint64(BUCKETS - 1)).astype(np.int64)
        self.script = SCRIPT_OF[np.searchsorted(SCRIPT_STARTS, points[at], side="right") - 1]
        begins = ~letters[at - 1]
        self.first = np.flatnonzero(begins)
        self.n_letters = np.diff(self.first, append=len(at))
        lengths = np.array([len(x) for x in lowered], np.int64)
        offsets = np.cumsum(lengths + 1) - lengths
        self.text = np.searchsorted(offsets, at[self.first], side="right") - 1
        self.start = at[self.first] - offsets[self.text]
        self.n_texts = len(texts)
        self.letter_text = np.repeat(self.text, self.n_letters)


class Model:
    """Log-probabilities of trigram buckets by language, and the scripts of each."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=0, keepdims=True)
        self.logs = np.log((counts + SMOOTHING) / (total + SMOOTHING * len(counts))).astype(np.float32)
        self.uses = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0, keepdims=True), 1)

    def scores(self, words: Words) -> np.ndarray:
        """A row per word, a column per language; -inf rules a language out by its script."""
        if not len(words.first):
            return np.empty((0, len(self.langs)))
        out = np.add.reduceat(self.logs[words.bucket], words.first, axis=0).astype(np.float64)
        allowed = self.uses[words.script[words.first]]
        allowed = allowed | ~allowed.any(axis=1, keepdims=True)
        return np.where(allowed, out, -np.inf)


def forward(scores: np.ndarray, first: np.ndarray, alive: np.ndarray, value: np.ndarray, penalty: float) -> np.ndarray:
    """From which language each word's best path to each language came; brings ``value`` forward.

    Texts stand in order of falling length ``alive`` and advance together, a word at a time. Staying costs nothing and
    every switch the same, so a step needs only the best language so far besides each language's own path.
    """
    n_langs = scores.shape[1]
    came = np.empty(scores.shape, np.int16 if n_langs < 32_000 else np.int32)
    own = np.arange(n_langs)
    active = len(alive)
    for t in range(int(alive[0]) if active else 0):
        while active and alive[active - 1] <= t:
            active -= 1
        rows = first[:active] + t
        v = value[:active]
        best = v.argmax(axis=1)
        switched = v[np.arange(active), best][:, None] - penalty
        stay = v >= switched
        came[rows] = np.where(stay, own, best[:, None])
        value[:active] = np.where(stay, v, switched) + scores[rows]
    return came


def backward(came: np.ndarray, first: np.ndarray, alive: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The language of each word on the best path of its text."""
    label = np.empty(len(came), np.int64)
    state = value.argmax(axis=1) if len(alive) else np.empty(0, np.int64)
    active = 0
    for t in range(int(alive[0]) - 1 if len(alive) else -1, -1, -1):
        while active < len(alive) and alive[active] > t:
            active += 1
        rows = first[:active] + t
        label[rows] = state[:active]
        state[:active] = came[rows, state[:active]]
    return label


def viterbi(scores: np.ndarray, text: np.ndarray, n_texts: int, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word."""
    n = np.bincount(text, minlength=n_texts)
    order = np.argsort(-n, kind="stable")
    first, alive = (np.cumsum(n) - n)[order], n[order]
    value = np.zeros((n_texts, scores.shape[1]))
    came = forward(scores, first, alive, value, penalty)
    return backward(came, first, alive, value)


def pieces(text: str, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of a text of about so many characters, cut beside characters that are no letters."""
    start = 0
    while start < len(text):
        end = min(start + limit, len(text))
        while end < len(text) and text[end - 1].isalpha() and text[end].isalpha():
            end += 1
        yield start, end
        start = end


class Pieces:
    """What ``label_texts`` reads of Words, and labels, of one long text: a piece at a time, keeping a few numbers a word."""

    def __init__(self, model: Model, text: str, penalty: float):
        lowered = text.lower()
        value = np.zeros((1, len(model.langs)))
        zero, parts = np.zeros(1, np.int64), []
        for start, end in pieces(lowered):
            words = Words([lowered[start:end]])
            came = forward(model.scores(words), zero, np.array([len(words.first)]), value, penalty)
            parts.append((came, words.start + start, words.n_letters))
        came, self.start, self.n_letters = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.label = backward(came, zero, np.array([len(came)]), value)
        self.text, self.n_texts = np.zeros(len(came), np.int64), 1


def train(docs: DataFrame) -> Model:
    """Counts of all texts with a lang. What reaches the driver is bounded by buckets and languages."""
    langs = sorted(r[0] for r in docs.filter("lang IS NOT NULL").select("lang").distinct().collect())
    code = {lang: i for i, lang in enumerate(langs)}
    schema = "lang int, bucket int, n long"
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Bucket BUCKETS + s counts letters of script s.
        counts = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES)), np.int64)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in chunks(texts):
                part, of = texts[start:end], np.array([code[x] for x in names[start:end]], np.int64)
                if len(part) == 1 and len(part[0] or "") > CHUNK_CHARS:
                    lowered = part[0].lower()
                    each = (Words([lowered[a:b]]) for a, b in pieces(lowered))
                else:
                    each = (Words(part),)
                for words in each:
                    lang, width = of[words.letter_text], counts.shape[1]
                    for places in (words.bucket, BUCKETS + words.script):
                        counts += np.bincount(lang * width + places, minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        arrays = [pa.array(x, field.type) for x, field in zip((lang, bucket, counts[lang, bucket]), arrow, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    counts = np.zeros((BUCKETS + len(SCRIPT_NAMES), len(langs)))
    if langs:
        sums = docs.filter("lang IS NOT NULL").select("lang", "text").mapInArrow(run, schema)
        found = sums.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
        counts[found["bucket"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy()
    return Model(langs, counts[:BUCKETS], counts[BUCKETS:])


def label_texts(model: Model, texts: list[str | None], penalty: float = PENALTY) -> Iterator[tuple[str, float, list[dict]]]:
    """(language, share of the letters in it, spans of one language) of each text."""
    if not model.langs:
        yield from ((UNKNOWN, 0.0, []) for _ in texts)
        return
    if len(texts) == 1 and len(texts[0] or "") > CHUNK_CHARS:
        words = Pieces(model, texts[0], penalty)
        label = words.label
    else:
        words = Words(texts)
        label = viterbi(model.scores(words), words.text, words.n_texts, penalty)
    n_langs = len(model.langs)
    letters = np.bincount(words.text * n_langs + label, words.n_letters, words.n_texts * n_langs)
    letters = letters.reshape(words.n_texts, n_langs)
    changes = np.ones(len(label), bool)
    changes[1:] = (label[1:] != label[:-1]) | (words.text[1:] != words.text[:-1])
    begin = np.flatnonzero(changes)
    last = np.append(begin, len(label))[1:] - 1
    spans: list[list[dict]] = [[] for _ in texts]
    ends = words.start + words.n_letters
    for b, e in zip(begin.tolist(), last.tolist(), strict=True):
        spans[words.text[b]].append({"start": int(words.start[b]), "end": int(ends[e]), "lang": model.langs[label[b]]})
    for i in range(words.n_texts):
        total = letters[i].sum()
        best = int(letters[i].argmax())
        yield (model.langs[best], float(letters[i, best] / total), spans[i]) if total else (UNKNOWN, 0.0, [])


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """(doc_id, lang_pred, score, spans) of every row.

    ``spans`` are [start, end) characters of the lower-cased text with a lang. A
    null text, one without letters, or a model without languages gives ``und``,
    score 0 and no spans; ties go to the first language by name. Repeated rows
    each get their result. Columns besides doc_id and text are not read. A text of more than CHUNK_CHARS
    characters is taken in pieces cut at word borders, along which the paths go on.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>"
    arrow = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in chunks(texts):
                found = label_texts(shared.value, texts[start:end], penalty)
                yield record_batch([(i, *x) for i, x in zip(ids[start:end], found, strict=True)], arrow)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = train(docs.filter(~held_out))
    found = identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
