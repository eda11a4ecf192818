"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are a text's words and the beginnings of its words (4 to 6 bytes, so that
inflected and compound forms of a stem meet), as 64-bit hashes.  Of the features whose
rows in the labelled sample are toxic for the most part (``PURITY``), the ``FEATURES`` with
the strongest association are kept; weaker ones would add up in very long clean texts.

Grades run from 0 (clean) to 3.  The labels only say toxic or not; a toxic row's grade is
the third that it belongs to by the amount of features that are (almost) never
clean.  The model is P(grade > j) = s(w.x - t_j) with rising thresholds t_j and weights w
shared by all of them, fitted by accelerated proximal gradient steps with an L1
penalty, so that accidental features get no weight.  The expected severity is the
sum of P(grade > j); documents with P(grade > 0) >= 0.5 are rejected.

Fitting uses at most ``PER_CLASS`` labelled rows of each kind; scoring covers every word
of every text.  The model is at most ``FEATURES`` weights, which is all that is broadcast.

Defined results: null and empty texts have no features and are scored by the thresholds;
without labels of both kinds nothing is toxic (severity 0); repeated rows get equal scores;
other columns are carried along by ``keep_clean``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, labelled
from .decontaminate import words_of

PER_CLASS = 3000
FEATURES = 4000
PREFIXES = (4, 5, 6)
GRADES = 3
#: A feature is in this many different toxic texts, and in this share of them, at least.
LEAST_ROWS, LEAST_SHARE = 4, 0.01
PURITY = 0.8
PENALTY = 5e-5
STEPS = 1000


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def word_features(word: bytes) -> list[int]:
    """Hashes of a word and its beginnings."""
    named = [word, *(b"^" + word[:n] for n in PREFIXES if len(word) >= n)]
    return [signed(xxhash.xxh3_64_intdigest(x)) for x in named]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every, amounts = [], []
        for text in batch.column("text"):
            counts: Counter = Counter()
            for word, n in Counter(words_of(text.as_py())).items():
                for feature in word_features(word):
                    counts[feature] += n
            every.append(list(counts))
            amounts.append(list(counts.values()))
        arrays = [batch.column("label"), pa.array(every, pa.list_(pa.int64())), pa.array(amounts, pa.list_(pa.int64()))]
        yield pa.record_batch(arrays, names=["label", "features", "amounts"])


@dataclass
class Model:
    index: dict[int, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, hits: list[dict[int, int]]) -> np.ndarray:
        """P(grade > j) by row and j for rows of feature counts."""
        scores = np.array([sum(self.weights[i] * np.log1p(n) for i, n in row.items()) for row in hits])
        return _sigmoid(scores[:, None] - self.thresholds)


class Lookup(dict):
    """Word -> the kept features it has, remembered up to a bound."""

    LIMIT = 200_000

    def __init__(self, model: Model):
        super().__init__()
        weights = model.weights
        self.index = {f: i for f, i in model.index.items() if weights[i]}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = tuple(self.index[f] for f in word_features(word) if f in self.index)
        return value


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_grades(rows: list[dict[int, float]], grades: np.ndarray, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of the cumulative-link model."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([i for r in rows for i in r], int)
    value = np.array([v for r in rows for v in r.values()], float)
    above = grades[:, None] > np.arange(GRADES)
    # each kind of row weighs the same, whatever the sample holds
    kind = (grades > 0).astype(int)
    weight = (0.5 / np.maximum(np.bincount(kind, minlength=2), 1))[kind]
    weights, thresholds = np.zeros(features), np.linspace(0, 1, GRADES)
    point, bars, pace = weights, thresholds, 1.0
    # the steepest curvature, by power iteration, sets the step
    along, steep = np.ones(features), 1.0
    for _ in range(30):
        along = along / max(np.linalg.norm(along), 1e-12)
        shown = np.bincount(at, value * along[column], minlength=len(rows)) * weight
        along = np.bincount(column, value * shown[at], minlength=features)
        steep = np.linalg.norm(along)
    step = 4 / (1.2 * GRADES * steep + GRADES)
    for _ in range(STEPS):
        scores = np.bincount(at, value * point[column], minlength=len(rows))
        error = (_sigmoid(scores[:, None] - bars) - above) * weight[:, None]
        slope = np.bincount(column, value * error.sum(axis=1)[at], minlength=features)
        new = point - step * slope
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        new_bars = np.maximum.accumulate(bars + step * error.sum(axis=0))
        pace_next = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        momentum = (pace - 1) / pace_next
        point, bars = new + momentum * (new - weights), new_bars + momentum * (new_bars - thresholds)
        weights, thresholds, pace = new, new_bars, pace_next
    return weights, thresholds


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    ids = labelled.sample_ids(labels.select("doc_id", "toxic"), "toxic", PER_CLASS)
    texts = labelled.sample_texts(docs, ids).select("label", "text")
    schema = "label int, features array<long>, amounts array<long>"
    # copies of one text say nothing about its words
    sample = common.map_batches(texts, _features, schema).dropDuplicates(["label", "features"])
    sample = common.stored(sample, "features")
    rows, toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not toxic or toxic == rows:
        return None
    # chi-squared of presence against the label, for features of toxic rows
    counts = sample.select("label", F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")).where(F.col("bad") >= max(LEAST_ROWS, LEAST_SHARE * toxic))
    lean = F.col("bad") / F.col("n") - toxic / rows
    strength = F.col("n") * lean * lean / (1 - F.col("n") / (rows + 1))
    pure = (lean > 0) & (F.col("bad") >= PURITY * F.col("n"))
    kept = counts.where(pure).orderBy(strength.desc(), "feature").limit(FEATURES)
    # features in toxic rows only: they tell how much of it there is
    kept = [(r["feature"], r["n"] <= r["bad"] * 1.02) for r in kept.collect()]
    index = {f: i for i, (f, _) in enumerate(kept)}
    sure = np.array([s for _, s in kept], bool)
    found = common.map_batches(sample, _selected(index), "label int, at array<int>, amounts array<long>").collect()
    found.sort(key=lambda r: (r["label"], r["at"], r["amounts"]))
    hits = [dict(zip(r["at"], np.log1p(r["amounts"]).tolist(), strict=True)) for r in found]
    bad = np.array([r["label"] for r in found])
    amount = np.array([sum(n for i, n in zip(r["at"], r["amounts"], strict=True) if sure[i]) for r in found], float)
    cuts = np.quantile(amount[bad == 1], [k / GRADES for k in range(1, GRADES)])
    grades = np.where(bad == 1, 1 + (amount[:, None] > cuts).sum(axis=1), 0)
    weights, thresholds = fit_grades(hits, grades, len(index))
    return Model(index, weights, thresholds)


def _selected(index: dict[int, int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, amounts = [], []
            for features, counts in zip(batch.column("features"), batch.column("amounts"), strict=True):
                own = sorted((index[f], n) for f, n in zip(features.as_py(), counts.as_py(), strict=True) if f in index)
                at.append([i for i, _ in own])
                amounts.append([n for _, n in own])
            arrays = [batch.column("label"), pa.array(at, pa.list_(pa.int32())), pa.array(amounts, pa.list_(pa.int64()))]
            yield pa.record_batch(arrays, names=["label", "at", "amounts"])

    return work


def graded(model: Model | None, texts: pa.Array, lookup: Lookup | None) -> np.ndarray:
    """P(grade > j) of texts."""
    if model is None:
        return np.zeros((len(texts), GRADES))
    hits = []
    for text in texts:
        row: dict[int, int] = {}
        for own in filter(None, map(lookup.__getitem__, words_of(text.as_py()))):
            for i in own:
                row[i] = row.get(i, 0) + 1
        hits.append(row)
    return model.probabilities(hits)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, rejected) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value) if shared.value else None
        for batch in batches:
            p = graded(shared.value, batch.column("text"), lookup)
            arrays = [
                batch.column("doc_id"),
                pa.array(p.sum(axis=1)),
                pa.array((p >= 0.5).sum(axis=1), pa.int32()),
                pa.array(p[:, 0]),
                pa.array(p[:, 0] >= 0.5),
            ]
            yield pa.record_batch(arrays, names=["doc_id", "severity", "grade", "p_toxic", "rejected"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, severity double, grade int, p_toxic double, rejected boolean"
    return common.map_batches(docs.select("doc_id", "text"), work, schema)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that are rejected; rows stay where they are."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(shared.value) if shared.value else None
        for batch in batches:
            p = graded(shared.value, batch.column("text"), lookup)
            yield batch.filter(pa.array(p[:, 0] < 0.5))

    return common.map_batches(docs, work, docs.schema)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (common.table(spark, folder, t) for t in ("documents", "labels"))
    return score(docs, train(docs, labels))
