"""Quality classifier: random-indexing word vectors, a two-layer network, temperature.

A text becomes a sequence of tokens: words, runs of signs, numbers, and marks for capitals
and for a word said twice in a row.  Every token falls into one of ``BUCKETS`` buckets, and
every bucket has a sparse random index vector.  A token's word vector is the sum of the
index vectors of its neighbours in the labelled sample, those to the left and to the right
permuted differently; a token without neighbours there keeps its own index vector.  A document
is the mean and the spread of its tokens' vectors and its share of different tokens.

A network of one hidden layer is trained on the sample in numpy; a fifth of the
sample is kept back to choose the temperature that makes its probabilities fit, with the
classes weighed as in all training labels.

Fitting uses at most ``PER_CLASS`` labelled rows of each class with at most ``MAX_TOKENS``
tokens each, in one task; scoring covers whole texts.  The model has a fixed size (8 MB).

Defined results: null and empty texts get the score of a text without tokens; labels of one
class only give that class's score, 1 or 0, to all, no labels give 1; repeated rows get
equal scores; other columns are carried along by ``keep_good``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, labelled

PER_CLASS = 2000
MAX_TOKENS = 20_000
BUCKETS, DIMENSIONS, NONZERO, REACH = 1 << 15, 128, 8, 2
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 24, 40, 64, 3e-3, 1e-4
THRESHOLD = 0.3

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


class Buckets(dict):
    """Token -> its buckets: that of its lower-case form, and a mark for capitals."""

    LIMIT = 300_000

    def __missing__(self, token: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        if token.isdigit():
            name = "<number>"
        elif token[0].isalpha():
            name = token.lower()
        else:
            name = token[:4]
        # capitals throughout are another token than the word itself
        loud = len(token) > 1 and token.isupper()
        value = zlib.crc32(("<loud>" if loud else name).encode("utf-8", "surrogatepass")) % BUCKETS
        self[token] = value
        return value


AGAIN = zlib.crc32(b"<again>") % BUCKETS


def token_buckets(text: str | None, buckets: Buckets) -> np.ndarray:
    tokens = TOKEN.findall(text or "")
    found = np.fromiter(map(buckets.__getitem__, tokens), np.int32, len(tokens))
    if len(found) > 1:
        found[1:][found[1:] == found[:-1]] = AGAIN
    return found


def index_vectors() -> np.ndarray:
    random = np.random.default_rng(7)
    out = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    places = random.integers(0, DIMENSIONS, (BUCKETS, NONZERO))
    signs = random.choice(np.array([-1, 1], np.float32), (BUCKETS, NONZERO))
    np.add.at(out, (np.arange(BUCKETS)[:, None], places), signs)
    return out


def word_vectors(texts: list[np.ndarray]) -> np.ndarray:
    """Sums of the neighbours' index vectors, each of length one."""
    index = index_vectors()
    total = np.zeros((BUCKETS, DIMENSIONS), np.float32)
    for offset in range(1, REACH + 1):
        left = np.concatenate([t[:-offset] for t in texts if len(t) > offset] or [np.zeros(0, np.int32)])
        right = np.concatenate([t[offset:] for t in texts if len(t) > offset] or [np.zeros(0, np.int32)])
        for word, near, turn in ((left, right, offset), (right, left, -offset)):
            pairs, counts = np.unique(word.astype(np.int64) * BUCKETS + near, return_counts=True)
            for start in range(0, len(pairs), 50_000):
                part = slice(start, start + 50_000)
                own, other = np.divmod(pairs[part], BUCKETS)
                vectors = np.roll(index[other], turn, axis=1) * np.log1p(counts[part, None]).astype(np.float32)
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                total[own[first]] += np.add.reduceat(vectors, first, axis=0)
    unseen = ~total.any(axis=1)
    total[unseen] = index[unseen]
    return (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)).astype(np.float16)


def pooled(found: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the token vectors, share of different tokens."""
    if not len(found):
        return np.zeros(2 * DIMENSIONS + 1, np.float32)
    which, counts = np.unique(found, return_counts=True)
    own, weight = vectors[which].astype(np.float32), (counts / len(found)).astype(np.float32)
    mean = weight @ own
    spread = np.sqrt(np.maximum(weight @ (own * own) - mean * mean, 0))
    return np.concatenate([mean, spread, [len(which) / len(found)]]).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    shift: float

    def score(self, texts: pa.Array, buckets: Buckets) -> np.ndarray:
        rows = np.stack([pooled(token_buckets(t.as_py(), buckets), self.vectors) for t in texts])
        return _sigmoid(_logits(self.layers, (rows - self.centre) / self.scale) / self.temperature + self.shift)


@dataclass
class Constant:
    """What labels of one class teach."""

    value: float

    def score(self, texts: pa.Array, buckets: Buckets) -> np.ndarray:
        return np.full(len(texts), self.value)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logits(layers: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    hidden = np.tanh(x @ layers[0] + layers[1])
    return (hidden @ layers[2] + layers[3])[:, 0]


def fit_network(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Two layers, trained with Adam on mini-batches."""
    random = np.random.default_rng(11)
    layers = [
        random.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, (HIDDEN, 1)),
        np.zeros(1),
    ]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    step = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(x))
        for start in range(0, len(x), BATCH):
            rows = order[start : start + BATCH]
            hidden = np.tanh(x[rows] @ layers[0] + layers[1])
            error = (_sigmoid((hidden @ layers[2] + layers[3])[:, 0]) - y[rows])[:, None] / len(rows)
            back = (error @ layers[2].T) * (1 - hidden * hidden)
            slopes = [x[rows].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]
            step += 1
            for w, g, a, b in zip(layers, slopes, first, second, strict=True):
                g = g + DECAY * w
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    return layers


def fit(texts: list[np.ndarray], labels: np.ndarray, share: float) -> Model | Constant:
    """share: of label 1 in all training labels, which the calibration restores."""
    if not len(labels) or labels.min() == labels.max():
        return Constant(float(labels[0]) if len(labels) else 1.0)
    vectors = word_vectors(texts)
    x = np.stack([pooled(t, vectors) for t in texts])
    kept_back = np.random.default_rng(3).random(len(x)) < 0.2
    if min(labels[kept_back].sum(), (1 - labels[kept_back]).sum(), labels[~kept_back].sum(), (1 - labels[~kept_back]).sum()) < 1:
        kept_back = np.zeros(len(x), bool)
    centre, scale = x[~kept_back].mean(axis=0), x[~kept_back].std(axis=0) + 1e-3
    x = (x - centre) / scale
    layers = fit_network(x[~kept_back], labels[~kept_back].astype(float))
    judged = kept_back if kept_back.any() else np.ones(len(x), bool)
    y, z = labels[judged], _logits(layers, x[judged])
    weight = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    in_sample = labels[~kept_back].mean()
    shift = float(np.log(share / (1 - share)) - np.log(in_sample / (1 - in_sample))) if 0 < share < 1 else 0.0

    def loss(temperature: float) -> float:
        p = _sigmoid(z / temperature + shift)
        return float(-(weight * np.where(y == 1, np.log(p), np.log(1 - p))).sum())

    return Model(vectors, centre, scale, layers, min(np.geomspace(0.5, 8, 60), key=loss), shift)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets = Buckets()
    for batch in batches:
        found = [token_buckets(t.as_py(), buckets) for t in batch.column("text")]
        short = [len(f) <= MAX_TOKENS for f in found]
        rows = [f.tobytes() if keep else None for f, keep in zip(found, short, strict=True)]
        yield pa.record_batch([batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], names=["doc_id", "label", "tokens"])


def train(docs: DataFrame, labels: DataFrame) -> Model | Constant:
    labels = labels.select("doc_id", "quality")
    ids = labelled.sample_ids(labels, "quality", PER_CLASS)
    texts = labelled.sample_texts(docs, ids)
    sample = common.stored(common.map_batches(texts, _tokens, "doc_id long, label int, tokens binary"), "tokens")
    share = labelled.shares(labels, "quality")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r["doc_id"], r["tokens"]))
        found = [np.frombuffer(r["tokens"], np.int32) for r in rows]
        model = fit(found, np.array([r["label"] for r in rows], int), share)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    import pickle

    # the bounded sample is learned from in one task
    return pickle.loads(common.map_batches(sample.where("tokens is not null").repartition(1), work, "model binary").first()[0])


def score(docs: DataFrame, model: Model | Constant) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            if batch.num_rows:
                found = shared.value.score(batch.column("text"), buckets)
                yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return common.map_batches(docs.select("doc_id", "text"), work, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            if batch.num_rows:
                found = shared.value.score(batch.column("text"), buckets)
                yield batch.filter(pa.array(found >= threshold))

    return common.map_batches(docs, work, docs.schema)


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (common.table(spark, folder, t) for t in ("documents", "labels"))
    scored = score(docs, train(docs, labels))
    held_out = F.coalesce(labelled.remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
