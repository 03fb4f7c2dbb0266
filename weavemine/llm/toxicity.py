"""Operator 9: toxicity by a classifier chain.

The categories are predicted in order: ``poor`` (quality label 0), ``toxic``,
and ``toxic_poor`` (both). Each is a logistic model over word and word-prefix
counts of the document plus the probabilities of the categories before it. So
that a later model learns from predictions like those it will see, the earlier
probabilities it is trained on are out of fold: made by models that did not see
the document, neither when they were fitted nor when their features were chosen.
Scoring runs the chain of the models fitted to the whole sample.

The models are fitted on the driver to at most ``SAMPLE`` labelled documents
(those with the least hash of their id, so the choice does not depend on
partitioning; also where ids repeat). What reaches the driver of a text is its
counts, in one of ``2 ** SLOT_BITS`` slots a feature, never the text. Scoring reads
every document whole and moves nothing between machines.

Defined results: null or empty text has no features and gets the models' base
rate; null ids and repeated rows are scored like any row; labels that are null
are not used; repeated labels count each; with no labelled document or only one
class, a category's probability is its smoothed share; a document is toxic at
``THRESHOLD`` and above; texts of any length are counted whole; an empty table
gives no rows. Other columns are carried along unread by ``reject`` and ignored
by ``score``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weavemine.session import materialize, release, table

NAME = "op9_toxicity_chain"
CATEGORIES = ("poor", "toxic", "toxic_poor")
SAMPLE, FOLDS, FEATURES, THRESHOLD = 6000, 5, 1500, 0.5
PREFIXES = (4, 5, 6, 7)
SLOT_BITS, LEAST = 20, 3
WORD = re.compile(r"\w+")


def word_features(word: str) -> list[str]:
    return [word, *{f"{n}^{word[:n]}" for n in PREFIXES if len(word) >= n}]


def counts(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def slots(word: str) -> list[int]:
    """Where the features of a word are counted."""
    return [crc32(f.encode("utf-8", "surrogatepass")) & ((1 << SLOT_BITS) - 1) for f in word_features(word)]


def features(words: Counter) -> dict[int, int]:
    """Counts by slot."""
    out: dict[int, int] = {}
    for w, n in words.items():
        for s in slots(w):
            out[s] = out.get(s, 0) + n
    return out


@dataclass
class Linear:
    """Logistic model over chosen slots (log of 1 + count), the document's log length and earlier probabilities."""

    vocabulary: dict[int, int]
    weights: list[float]
    bias: float


@dataclass
class Chain:
    models: list[Linear] = field(default_factory=list)

    def __post_init__(self):
        self._words: dict[str, tuple] = {}

    def _hits(self, word: str) -> tuple:
        """(model, weight index) pairs of a word; memo of bounded size."""
        if len(self._words) >= 50_000:
            self._words.clear()
        at = slots(word)
        hit = self._words[word] = tuple((m, i) for m, model in enumerate(self.models) for s in at if (i := model.vocabulary.get(s)) is not None)
        return hit

    def probabilities(self, text: str | None) -> list[float]:
        words = counts(text)
        found: list[dict[int, int]] = [{} for _ in self.models]
        get = self._words.get
        for w, n in words.items():
            hits = get(w)
            for m, i in self._hits(w) if hits is None else hits:
                seen = found[m]
                seen[i] = seen.get(i, 0) + n
        size, log = math.log1p(sum(words.values())), math.log1p
        out: list[float] = []
        for model, seen in zip(self.models, found):
            k, w = len(model.vocabulary), model.weights
            z = model.bias + w[k] * size
            for i, n in sorted(seen.items()):
                z += w[i] * log(n)
            for j, p in enumerate(out):
                z += w[k + 1 + j] * p
            out.append(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))
        return out


class Hits:
    """Counts of all documents of the sample as flat arrays: document, slot, count; and their numbers of words.

    Slots that fewer than ``LEAST`` of the documents hold say nothing of others and are left out.
    """

    def __init__(self, rows: np.ndarray, found: np.ndarray, counted: np.ndarray, words: np.ndarray):
        kept = (np.bincount(found, minlength=1 << SLOT_BITS) >= LEAST)[found]
        self.r, self.f, self.n, self.size = rows[kept].astype(np.int32), found[kept].astype(np.int32), counted[kept].astype(np.float32), np.log1p(words)

    @classmethod
    def of(cls, texts: list[str | None]) -> "Hits":
        words = [counts(t) for t in texts]
        each = [features(w) for w in words]
        rows = np.repeat(np.arange(len(each)), [len(e) for e in each])
        return cls(rows, *_flat(each), np.array([sum(w.values()) for w in words], float))

    def choose(self, y: np.ndarray, use: np.ndarray, most: int) -> np.ndarray:
        """The slots whose presence tells the classes apart best (chi squared), over the documents in ``use``."""
        on = use[self.r]
        f, label = self.f[on], y[self.r[on]]
        a = np.bincount(f, label, 1 << SLOT_BITS)
        b = np.bincount(f, 1 - label, 1 << SLOT_BITS)
        n_pos, n_neg = max(1.0, y[use].sum()), max(1.0, (1 - y[use]).sum())
        share = (a + b) / (n_pos + n_neg)
        score = (a / n_pos - b / n_neg) ** 2 / (share * (1 - share) + 1e-3)
        best = np.argsort(-score, kind="stable")[:most]
        return best[score[best] > 0]


def _flat(each: list[dict[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([k for e in each for k in e], np.int64), np.array([n for e in each for n in e.values()], np.int64)


class _Rows:
    """Sparse rows of chosen columns of the documents' hits, with dense columns after them."""

    def __init__(self, hits: Hits, chosen: np.ndarray, dense: np.ndarray):
        column = np.full(1 << SLOT_BITS, -1)
        column[chosen] = np.arange(len(chosen))
        c = column[hits.f]
        at = c >= 0
        self.r, self.c, self.x = hits.r[at], c[at], np.log1p(hits.n[at])
        self.k, self.n, self.dense = len(chosen), len(hits.size), dense

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.r, self.x * w[self.c], self.n) + self.dense @ w[self.k :]

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.c, self.x * g[self.r], self.k), self.dense.T @ g])


def _fit(rows: _Rows, y: np.ndarray, use: np.ndarray, steps: int = 120, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on the rows in ``use`` by Adam; deterministic."""
    p = rows.k + rows.dense.shape[1]
    n = int(use.sum())
    rate = (y[use].sum() + 0.5) / (n + 1)
    w, b = np.zeros(p), float(np.log(rate / (1 - rate)))
    if not use.any() or y[use].min() == y[use].max():
        return w, b
    m, v = np.zeros(p + 1), np.zeros(p + 1)
    for t in range(1, steps + 1):
        g = (1 / (1 + np.exp(-np.clip(rows.times(w) + b, -30, 30))) - y) * use
        grad = np.append((rows.back(g) + ridge * w) / n, g.sum() / n)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def train(hits: Hits, labels: dict[str, list[int]], folds: list[int], most: int = FEATURES) -> Chain:
    """Fit the chain; ``labels`` by category in chain order, ``folds`` a fold number for each document."""
    fold = np.array(folds, np.int64)
    every = np.ones(len(fold), bool)
    dense = hits.size.reshape(len(fold), 1)
    chain = Chain()
    for y in (np.array(v, float) for v in labels.values()):

        def fitted(use: np.ndarray) -> tuple[np.ndarray, _Rows, np.ndarray, float]:
            chosen = hits.choose(y, use, most) if use.any() else np.zeros(0, int)
            rows = _Rows(hits, chosen, dense)
            return chosen, rows, *_fit(rows, y, use)

        chosen, _, w, b = fitted(every)
        chain.models.append(Linear({int(s): i for i, s in enumerate(chosen)}, w.tolist(), b))
        out_of_fold = np.zeros(len(fold))
        for k in range(FOLDS):
            if (fold == k).any():
                _, rows, w, b = fitted(fold != k)
                out_of_fold[fold == k] = (1 / (1 + np.exp(-np.clip(rows.times(w) + b, -30, 30))))[fold == k]
        dense = np.hstack([dense, out_of_fold[:, None]])
    return chain


def sample_counts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, quality, toxic, words, slots, counts) of the labelled sample: ``sample`` rows at most."""
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", F.col("quality").cast("long").alias("quality"), F.col("toxic").cast("long").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(sample)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # the chosen labels, ``sample`` rows
    place = [F.xxhash64("doc_id").alias("place"), F.xxhash64("text").alias("tie")]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [counts(t.as_py()) for t in b.column(5)]
            each = [features(w) for w in words]
            more = [pa.array([sum(w.values()) for w in words], pa.int64()), *[pa.array(x, pa.list_(pa.int32())) for x in ([list(e) for e in each], [list(e.values()) for e in each])]]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *more], ["doc_id", "quality", "toxic", "place", "tie", "words", "slots", "counts"])

    counted = found.select("doc_id", "quality", "toxic", *place, "text").mapInArrow(run, f"doc_id {kind}, quality long, toxic long, place long, tie long, words long, slots array<int>, counts array<int>")
    counted = materialize(counted, "toxicity-counts")
    kept = counted.select("place", "doc_id", "tie", "quality", "toxic").orderBy("place", "doc_id", "tie", "quality", "toxic")
    if counted.count() > sample:  # ids repeat
        last = kept.limit(sample).agg(F.max(F.struct("place", "doc_id", "tie", "quality", "toxic")).alias("last")).first()["last"]
        key = F.struct("place", "doc_id", "tie", "quality", "toxic")
        counted = counted.where(key <= F.struct(*[F.lit(last[c]).cast(counted.schema[c].dataType) for c in ("place", "doc_id", "tie", "quality", "toxic")])).limit(sample)
    return counted


def without_rare(counted: DataFrame, least: int = LEAST) -> DataFrame:
    """The same with only those slots that ``least`` rows or more hold; there are ``2 ** SLOT_BITS`` slots at most."""
    held = counted.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("slot").toArrow()
    often = np.zeros(1 << SLOT_BITS, bool)
    often[held.column("slot").to_numpy()] = True
    bits = np.packbits(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = np.unpackbits(bits).astype(bool)
        for b in batches:
            at = b.schema.get_field_index("slots")
            lists = [b.column(at), b.column(at + 1)]
            keep = often[lists[0].flatten().to_numpy()]
            ends = np.cumsum([0, *lists[0].value_lengths().to_pylist()])
            ends = pa.array(np.concatenate([[0], np.cumsum(keep)])[ends].astype(np.int32))
            yield pa.RecordBatch.from_arrays([*b.columns[:at], *[pa.ListArray.from_arrays(ends, x.flatten().filter(pa.array(keep))) for x in lists]], b.schema.names)

    return counted.mapInArrow(run, counted.schema)


def fit_chain(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Chain:
    """The chain fitted to the bounded labelled sample."""
    counted = sample_counts(docs, labels, sample)
    t = without_rare(counted).orderBy("place", "doc_id", "tie", "quality", "toxic").toArrow().combine_chunks()
    release(counted)
    flat = lambda name: pa.concat_arrays([c.flatten() for c in t.column(name).chunks]).to_numpy() if t.num_rows else np.zeros(0, np.int32)
    sizes = np.array(pc.list_value_length(t.column("slots")), np.int64)
    hits = Hits(np.repeat(np.arange(t.num_rows, dtype=np.int32), sizes), flat("slots"), flat("counts"), t.column("words").to_numpy().astype(float))
    quality, toxic = t.column("quality").to_numpy(), t.column("toxic").to_numpy()
    poor, toxic = (quality == 0).astype(int), (toxic != 0).astype(int)
    folds = ((t.column("place").to_numpy() & 0xFFFF) % FOLDS).tolist()
    del t
    return train(hits, dict(zip(CATEGORIES, (poor, toxic, poor & toxic))), folds)


def _scorer(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = np.array([chain.probabilities(t.as_py()) for t in b.column(1)]).reshape(b.num_rows, len(CATEGORIES))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[:, j]) for j in range(len(CATEGORIES)))], ["k", *CATEGORIES])

    return run


def score(docs: DataFrame, chain: Chain, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, p_poor, p_toxic, p_toxic_poor) for every row."""
    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("k"), docs[text].alias("t")).mapInArrow(_scorer(chain), f"k {kind}, " + ", ".join(f"{c} double" for c in CATEGORIES))
    return out.select(F.col("k").alias(key), *[F.col(c).alias(f"p_{c}") for c in CATEGORIES])


def reject(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, unchanged."""
    place, toxic = docs.columns.index(text), CATEGORIES.index("toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([chain.probabilities(t.as_py())[toxic] < threshold for t in b.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit_chain(docs, table(spark, sf_dir, "labels")))
    toxic = F.col("p_toxic") >= THRESHOLD
    return scored.withColumns({"toxic": toxic, "kept": ~toxic})
