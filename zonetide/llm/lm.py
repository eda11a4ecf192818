"""Gated recurrent language model with a class-factored output softmax, in numpy.

Vocabulary: every word of every training text is counted.  The ``SHORT`` most frequent
words are in classes of ``CLASS_WORDS``, with a softmax over the classes and one within
the class, both on the recurrent state.  Frequent words beyond form ``MIDDLE`` classes of
about equal weight and all others one class, whose words share the class's probability by
their counts, so that the model is a distribution over all words and one unknown.

Learning: a first model is learned from a bounded sample of runs of ``RUN`` words.  It is
where the replicas start: every word of every training text trains one of them, which get
about ``REPLICA_RUNS`` runs each, and the replicas are averaged by their share of words.
Backpropagation is truncated to one window; the state is carried on from window to window
to the end of the text.  Texts of more than ``STRETCH`` words are dealt in stretches, and a
later stretch starts from the state that the first model has after all words before it.

Scoring: the texts of a batch run side by side, window by window, each carrying its state
to its end; the log-likelihood is that of the complete text.  Only frequent words (at most
``FREQUENT``, the bound of what is broadcast) are known to the tasks; the other words of
a text are joined with their counts.

Defined results: a null or empty text is its end token; texts without id are held out;
without training texts every token has probability 1, as in the base; repeated rows get
a row each, and count each as a training text; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PARTS, HELD_OUT = 5, 1
SHORT, CLASS_WORDS, MIDDLE = 512, 8, 16
FREQUENT = 1 << 17
HIDDEN, WINDOW, RUN = 16, 24, 48
#: Words of a text that one replica takes in a row, a multiple of WINDOW.
STRETCH = 512 * WINDOW
FIRST_RUNS, FIRST_EPOCHS, REPLICA_RUNS, BATCH, RATE = 4000, 6, 16_384, 128, 4e-3
#: Models that are added up by one task, and most that reach the driver (20 MB).
SUMS = 64
END = b""
#: Texts that are scored side by side, and rows of the output softmax computed at once.
LANES, ROWS = 512, 2048
#: Bytes of texts that are split into words at once; a longer text is split by itself.
SPLIT_BYTES = 8 << 20


def word_hash(word: bytes) -> int:
    value = xxhash.xxh3_64_intdigest(word)
    return value - (1 << 64) if value >= 1 << 63 else value


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


def held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % PARTS == HELD_OUT


@dataclass
class Split:
    """The words of consecutive texts, as ``common.spaced_words`` takes them, and an end after
    each text's last, in one array."""

    rows: slice  # of the texts
    hashes: np.ndarray  # of the distinct words, each once
    codes: np.ndarray  # places in ``hashes``, text after text
    starts: np.ndarray  # where a text begins in ``codes``, and the end of all: one more than texts


def split_texts(texts: pa.Array) -> Iterator[Split]:
    """Every text's words, in blocks of about ``SPLIT_BYTES``.  Arrow's functions for ASCII work
    on bytes and leave other scripts as they are."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = upto[at - 1] if at else 0
        to = max(int(np.searchsorted(upto, before + SPLIT_BYTES, "right")), at + 1)
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts[at:to]))
        coded = pc.dictionary_encode(lists.flatten())
        words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        codes, starts = coded.indices.to_numpy(), lists.offsets.to_numpy()
        real = codes != (words.index(b"") if b"" in words else -1)  # what is beside outer white space
        starts = np.concatenate([[0], np.cumsum(real)])[starts - starts[0]]
        codes = np.insert(codes[real], starts[1:], len(words))
        yield Split(slice(at, to), word_hashes([*words, END]), codes, starts + np.arange(len(starts)))
        at = to


# --- counts ---------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        learned = pa.array([not held_out(i) for i in batch.column("doc_id").to_pylist()], pa.bool_())
        for split in split_texts(batch.column("text").filter(learned)):
            times = np.bincount(split.codes, minlength=len(split.hashes))
            used = times > 0
            yield pa.record_batch([pa.array(split.hashes[used]), pa.array(times[used], pa.int64())], names=["hash", "n"])


def vocabulary(docs: DataFrame) -> DataFrame:
    """(hash, n) of every word of the training texts, the end token among them."""
    counted = common.map_batches(docs.select("doc_id", "text"), _count, "hash long, n long")
    return common.stored(counted.groupBy("hash").agg(F.sum("n").alias("n")), "vocabulary")


@dataclass
class Classes:
    """The frequent words and the classes of all words."""

    index: dict[int, int]  # hash -> rank among the frequent
    counts: np.ndarray  # of the frequent, falling
    tokens: int
    words: int
    of: np.ndarray = field(init=False)  # class by rank, the last entry being the rare class
    symbols: np.ndarray = field(init=False)  # input symbol by rank
    within: np.ndarray = field(init=False)  # log10 share in the class, for words not in the short list
    short: int = field(init=False)
    classes: int = field(init=False)
    rare_mass: float = field(init=False)

    def __post_init__(self) -> None:
        n = len(self.counts)
        self.short = min(SHORT, n)
        lists = -(-self.short // CLASS_WORDS)
        mass = self.counts[self.short :] + 0.5
        upto = np.cumsum(mass)
        middle = np.minimum((upto - mass / 2) * MIDDLE // max(upto[-1] if len(upto) else 1, 1), MIDDLE - 1).astype(int)
        self.of = np.concatenate([np.arange(self.short) // CLASS_WORDS, lists + middle, [lists + MIDDLE]]).astype(np.int64)
        self.symbols = np.concatenate([np.arange(self.short), self.of[self.short :] + self.short])
        by_class = np.bincount(middle, mass, minlength=MIDDLE).astype(float)
        self.within = np.zeros(n + 1)
        self.within[self.short : n] = np.log10(mass / by_class[middle])
        self.classes = lists + MIDDLE + 1
        self.rare_mass = (self.tokens - self.counts.sum()) + 0.5 * (self.words - n + 1)

    @property
    def base_mass(self) -> float:
        return self.tokens + 0.5 * (self.words + 1)

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        """The input symbol of a word: itself in the short list, else its class."""
        return self.symbols[ids]


def classes_of(vocabulary: DataFrame) -> Classes:
    tokens, words = vocabulary.agg(F.sum("n"), F.count(F.lit(1))).first()
    # a histogram on a log scale finds the count from which words are frequent
    step = F.floor(F.log2("n") * 16)
    steps = sorted(vocabulary.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True)
    total, least = 0, None
    for row in steps:
        total += row["n"]
        if total > FREQUENT:
            break
        least = row["step"]
    frequent = vocabulary.where(step >= least).collect() if least is not None else []
    frequent.sort(key=lambda r: (-r["n"], r["hash"]))
    counts = np.array([r["n"] for r in frequent], float)
    return Classes({r["hash"]: i for i, r in enumerate(frequent)}, counts, tokens or 0, words)


class Ids:
    """Word -> rank among the frequent, or their number."""

    def __init__(self, classes: Classes):
        self.index, self.rare = classes.index, len(classes.counts)

    def __getitem__(self, word: bytes) -> int:
        return self.index.get(word_hash(word), self.rare)

    def each(self, hashes: np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.index.get, hashes.tolist(), repeat(self.rare)), np.int64, len(hashes))

    def of(self, words: list[bytes]) -> np.ndarray:
        """Ids of a text's words and its end."""
        return self.each(word_hashes([*words, END]))


# --- the network ----------------------------------------------------------------------


def _add_by_key(out: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
    """``np.add.at`` for short keys, with the rows of a key added up first."""
    if not len(keys):
        return
    keys = keys.astype(np.uint16)  # which sort by their digits
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    out[keys[starts]] += np.add.reduceat(rows[order], starts)


def _by_gate(w: np.ndarray) -> np.ndarray:
    """(3, rows, HIDDEN) of (rows, 3 * HIDDEN)."""
    return np.ascontiguousarray(w.reshape(-1, 3, HIDDEN).swapaxes(0, 1))


def _softmax(x: np.ndarray, chosen: np.ndarray, bias: np.ndarray, reach: np.ndarray, of=None) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of the chosen column by row of ``x + bias`` (the bias of row ``of[i]``,
    if given).  ``x`` becomes the unscaled terms, whose sums by row are the second result.

    Terms are kept in range by what no row can exceed, ``x`` being within ``reach``, and by
    each row's own maximum where the bounds are too far apart for that."""
    high, low = ((bias + side).max(axis=-1, keepdims=True, initial=-1e30) for side in (reach, -reach))
    bounded = bool((high - low < 80).all())
    bias = (bias - high if bounded else bias).astype(x.dtype)
    x += bias if of is None else bias[of]
    if not bounded:
        x -= x.max(axis=1, keepdims=True)
    log_p = x[np.arange(len(x)), chosen]
    np.exp(x, out=x)
    sums = x @ np.ones(x.shape[1], x.dtype)
    log_p -= np.log(sums)
    return log_p, sums


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """A gated recurrent unit; ``w`` are its weights."""

    NAMES = ("input", "state", "out", "out_bias", "word", "word_bias")

    def __init__(self, classes: Classes, w: dict[str, np.ndarray] | None = None):
        self.classes = classes
        lists = -(-classes.short // CLASS_WORDS)
        if w is None:
            random = np.random.default_rng(5)
            # of no words at all, bincount would make integers
            mass = np.bincount(classes.of[:-1], classes.counts + 0.5, minlength=classes.classes).astype(float)
            mass[-1] = classes.rare_mass
            bias = np.full(lists * CLASS_WORDS, -1e4)
            bias[: classes.short] = np.log(classes.counts[: classes.short] + 0.5)
            w = {
                "input": random.normal(0, 0.3, (classes.short + classes.classes, 3 * HIDDEN)),
                "state": random.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)),
                "out": random.normal(0, 0.05, (HIDDEN, classes.classes)),
                "out_bias": np.log(np.maximum(mass, 1e-9)),
                "word": random.normal(0, 0.05, (lists, CLASS_WORDS, HIDDEN)),
                "word_bias": bias.reshape(lists, CLASS_WORDS),
            }
        self.w = {k: v.astype(np.float32) for k, v in w.items()}

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Next state from input symbols and state, and what its gradient needs."""
        a, b = self.w["input"][x], h @ self.w["state"]
        gates = _sigmoid(a[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN])
        reset, keep = gates[:, :HIDDEN], gates[:, HIDDEN:]
        new = np.tanh(a[:, 2 * HIDDEN :] + reset * b[:, 2 * HIDDEN :])
        return new + keep * (h - new), (x, h, b[:, 2 * HIDDEN :], reset, keep, new)

    def output(self, h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Natural log-probability of the classes of ``ids`` and, in the short list, of the
        words within them, whose rows are worked on class by class.  Also what the gradient
        needs: terms of both softmaxes with their sums by row."""
        c, w = self.classes.of[ids], self.w
        size = max(1.0, np.abs(h).max(initial=0))
        p = h @ w["out"]
        log_p, sums = _softmax(p, c, w["out_bias"], np.abs(w["out"]).sum(axis=0) * size)
        listed = np.flatnonzero(ids < self.classes.short)
        listed = listed[np.argsort(c[listed].astype(np.uint16), kind="stable")]
        own, lists = h[listed], c[listed]
        edges = np.searchsorted(lists, np.arange(len(w["word"]) + 1)).tolist()
        parts = [(k, slice(i, j)) for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)) if j > i]
        q = np.empty((len(listed), CLASS_WORDS), h.dtype)
        for k, rows in parts:
            np.matmul(own[rows], w["word"][k].T, out=q[rows])
        place = ids[listed] % CLASS_WORDS
        inner, inner_sums = _softmax(q, place, w["word_bias"], np.abs(w["word"]).sum(axis=2) * size, lists)
        log_p[listed] += inner
        return log_p, (p, sums, c, listed, place, q, inner_sums, parts)

    def _forward(self, x: np.ndarray, live: list[int], h: np.ndarray) -> tuple[np.ndarray, ...]:
        """``step`` over packed input symbols: those of the ``live[0]`` lanes at the first
        time, then those of the ``live[1]`` first lanes, and so on.  In the same order
        the states before and after, gates (2), state terms and new values; the last states."""
        n, kind = len(x), h.dtype
        # a part for either gate and the new value; the gates' are negative, for exp(-x)
        turn = np.array([-1, -1, 1], kind)[:, None, None]
        given = np.take(_by_gate(self.w["input"]) * turn, x, axis=1)
        state = _by_gate(self.w["state"]) * turn
        before, after, new = (np.empty((n, HIDDEN), kind) for _ in range(3))
        terms = np.empty((3, n, HIDDEN), kind)
        last, at = h.copy(), 0
        for lanes in live:
            rows = slice(at, at + lanes)
            at += lanes
            h, b, v, out = before[rows], terms[:, rows], new[rows], after[rows]
            h[:] = last[:lanes]
            np.matmul(h, state, out=b)
            g = b[:2]
            g += given[:2, rows]
            np.exp(g, out=g)
            g += 1
            np.reciprocal(g, out=g)
            np.multiply(g[0], b[2], out=v)
            v += given[2, rows]
            np.tanh(v, out=v)
            np.subtract(h, v, out=out)
            out *= g[1]
            out += v
            last[:lanes] = out
        return before, after, terms[:2], terms[2], new, last

    def gradients(self, runs: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray, float]:
        """Gradients of one window for a batch: (batch, time + 1) ids, the first being
        input only; -1 pads at the end.  Also the state after the window, which is not
        carried on through padding, and the loss."""
        w = self.w
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        lengths = (runs[:, 1:] >= 0).sum(axis=1)
        order = np.argsort(-lengths, kind="stable")  # so that the live lanes are the first ones
        real = np.arange(runs.shape[1] - 1)[:, None] < lengths[order]
        live = [n for n in real.sum(axis=1).tolist() if n]
        if not live:
            return grads, h, 0.0
        x, ids = self.classes.inputs(runs[order, :-1].T[real]), runs[order, 1:].T[real]
        before, after, (reset, keep), terms, new, last = self._forward(x, live, h[order])
        log_p, (p, sums, c, listed, place, q, inner_sums, parts) = self.output(after, ids)
        share = 1 / len(ids)
        p *= (share / sums)[:, None]
        p[np.arange(len(ids)), c] -= share
        grads["out"], grads["out_bias"] = after.T @ p, np.ones(len(p), p.dtype) @ p
        back = p @ w["out"].T
        q *= (share / inner_sums)[:, None]
        q[np.arange(len(listed)), place] -= share
        own, inner = after[listed], np.empty((len(listed), HIDDEN), after.dtype)
        for k, rows in parts:
            np.matmul(q[rows].T, own[rows], out=grads["word"][k])
            np.matmul(q[rows], w["word"][k], out=inner[rows])
        if parts:
            grads["word_bias"][[k for k, _ in parts]] = np.add.reduceat(q, [rows.start for _, rows in parts])
        back[listed] += inner
        by_new = (1 - keep) * (1 - new * new)
        moves = np.empty((len(ids), 3, HIDDEN), after.dtype)  # what a unit of ``back`` moves
        moves[:, 0] = by_new * terms * reset * (1 - reset)
        moves[:, 1] = (before - new) * keep * (1 - keep)
        moves[:, 2] = by_new * reset
        turned, at = np.ascontiguousarray(w["state"].T), len(ids)
        carried = np.zeros((0, HIDDEN), after.dtype)
        for lanes in reversed(live):
            rows = slice(at - lanes, at)
            at -= lanes
            d, m = back[rows], moves[rows]
            d[: len(carried)] += carried
            m *= d[:, None]
            carried = m.reshape(lanes, -1) @ turned
            carried += d * keep[rows]
        moved = moves.reshape(len(ids), -1)
        grads["state"] = before.T @ moved
        np.multiply(back, by_new, out=moves[:, 2])
        _add_by_key(grads["input"], x, moved)
        state = np.empty_like(last)
        state[order] = last
        return grads, state, float(-log_p.sum())

    def train(self, stretches: list[tuple[np.ndarray, np.ndarray]], epochs: int, rate: float, seed: int) -> None:
        """Adam over windows of ``BATCH`` stretches side by side, each carrying its state to
        its end, where the next one takes its place.  A stretch is the ids of consecutive
        words, the first being input only, and the state before them.  Words weigh the same,
        however many are in a window."""
        random = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        lengths = np.array([len(ids) - 1 for ids, _ in stretches])
        step, done, total = 0, 0, epochs * int(lengths.sum())
        for _ in range(epochs):
            waiting = random.permutation(len(stretches))
            long = lengths[waiting] > total / epochs / BATCH / 4  # first, so that they don't go on alone
            waiting = [*sorted(waiting[long].tolist(), key=lambda i: -lengths[i]), *waiting[~long].tolist()]
            lanes, h = [], np.zeros((0, HIDDEN), np.float32)
            while lanes or waiting:
                new = waiting[: BATCH - len(lanes)]
                waiting = waiting[len(new) :]
                lanes += [(i, 0) for i in new]
                h = np.concatenate([h, *(stretches[i][1][None, :] for i in new)])
                batch = np.full((len(lanes), WINDOW + 1), -1)
                for row, (i, at) in enumerate(lanes):
                    part = stretches[i][0][at : at + WINDOW + 1]
                    batch[row, : len(part)] = part
                grads, h, _ = self.gradients(batch, h)
                words = int((batch[:, 1:] >= 0).sum())
                step, done = step + 1, done + words
                now = rate * (1 - 0.9 * done / total)
                for k, g in grads.items():
                    one, two = first[k], second[k]
                    np.clip(g, -0.5, 0.5, out=g)
                    g *= 0.1 * words / (BATCH * WINDOW)
                    one *= 0.9
                    one += g
                    np.square(g, out=g)  # of a tenth: a hundredth of the square
                    two *= 0.99
                    two += g
                    np.multiply(two, 1 / (1 - 0.99**step), out=g)
                    np.sqrt(g, out=g)
                    g += 1e-6
                    np.divide(one, g, out=g)
                    g *= now / (1 - 0.9**step)
                    self.w[k] -= g
                going = [row for row, (i, at) in enumerate(lanes) if at + WINDOW + 1 < len(stretches[i][0])]
                lanes, h = [(lanes[row][0], lanes[row][1] + WINDOW) for row in going], h[going]

    def states(self, inputs: np.ndarray) -> np.ndarray:
        """The states before every ``STRETCH``-th word of a text, from ids with the one
        before the text."""
        h, out = np.zeros((1, HIDDEN), np.float32), []
        symbols = self.classes.inputs(inputs[:-1])
        for at in range(len(symbols)):
            if at % STRETCH == 0:
                out.append(h[0])
            if at + STRETCH - at % STRETCH >= len(symbols):
                break  # no stretch begins after this one
            h, _ = self.step(symbols[at : at + 1], h)
        return np.stack(out)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10-likelihood of whole texts (ids with their end); the counts' share of words
        outside the frequent is left to the caller.  ``LANES`` texts of about equal length run
        side by side, the longest first."""
        out = np.zeros(len(texts))
        if not self.classes.tokens:  # nothing was learned: one class, of probability 1
            return out
        end = [self.classes.index.get(word_hash(END), len(self.classes.counts))]
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(-lengths, kind="stable")
        times = np.arange(WINDOW)[:, None]
        for group in (order[i : i + LANES] for i in range(0, len(order), LANES)):
            ids = np.concatenate([part for i in group.tolist() for part in (end, texts[i])])
            left, h = lengths[group], np.zeros((len(group), HIDDEN), np.float32)
            place = np.concatenate([[0], np.cumsum(left[:-1] + 1)])  # of the word before the window
            while len(group):
                real = times < left
                at = (place + times)[real]
                _, after, *_, h = self._forward(self.classes.inputs(ids[at]), [n for n in real.sum(axis=1).tolist() if n], h)
                words, whose = ids[at + 1], np.broadcast_to(np.arange(len(group)), real.shape)[real]
                for first in range(0, len(words), ROWS):
                    part = slice(first, first + ROWS)
                    log_p, _ = self.output(after[part], words[part])
                    log_p = log_p.astype(float) / np.log(10) + self.classes.within[words[part]]
                    out[group] += np.bincount(whose[part], log_p, minlength=len(group))
                going = int((left > WINDOW).sum())
                group, left, place, h = group[:going], left[:going] - WINDOW, place[:going] + WINDOW, h[:going]
        return out


# --- learning -------------------------------------------------------------------------


def _place(doc_id, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(str(doc_id).encode(), seed) >> 1


def _first_runs(shared, most: int):
    """A run of ``RUN`` words of each training text whose hash is at most ``most``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = Ids(shared.value)
        for batch in batches:
            places, rows = [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                place = _place(doc_id.as_py(), 1)
                if held_out(doc_id.as_py()) or place > most:
                    continue
                ids = np.concatenate([[ids_of[END]], ids_of.of(common.spaced_words(text.as_py()))])
                start = place % max(len(ids) - RUN, 1)
                places.append(place)
                rows.append(ids[start : start + RUN + 1].astype(np.int32).tobytes())
            yield _stretch_batch(places, [0] * len(places), [b""] * len(places), rows)

    return work


def _stretches(shared, start):
    """All words of all training texts, in stretches of ``STRETCH``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, network = Ids(shared.value), Network(shared.value)
        network.w = _weights(start.value, network.w)
        for batch in batches:
            learned = pa.array([not held_out(i) for i in batch.column("doc_id").to_pylist()], pa.bool_())
            doc_ids = batch.column("doc_id").filter(learned).to_pylist()
            for split in split_texts(batch.column("text").filter(learned)):
                places, parts, states, rows = [], [], [], []
                every, starts = ids_of.each(split.hashes)[split.codes], split.starts.tolist()
                for doc_id, i, j in zip(doc_ids[split.rows], starts, starts[1:], strict=False):
                    ids = np.concatenate([[ids_of[END]], every[i:j]], dtype=np.int32)
                    for part, state in enumerate(network.states(ids)):
                        places.append(_place(doc_id, 2 + part))
                        parts.append(part)
                        states.append(state.astype(np.float32).tobytes() if part else b"")
                        rows.append(ids[part * STRETCH : (part + 1) * STRETCH + 1].tobytes())
                yield _stretch_batch(places, parts, states, rows)

    return work


STRETCHES = "place long, part int, state binary, ids binary"


def _stretch_batch(places: list, parts: list, states: list, rows: list) -> pa.RecordBatch:
    arrays = [pa.array(places, pa.int64()), pa.array(parts, pa.int32()), pa.array(states, pa.binary()), pa.array(rows, pa.binary())]
    return pa.record_batch(arrays, names=["place", "part", "state", "ids"])


def _read_stretches(batches: Iterator[pa.RecordBatch]) -> list[tuple[np.ndarray, np.ndarray]]:
    found = [(r["place"], r["part"], r["ids"], r["state"]) for b in batches for r in b.to_pylist()]
    found.sort()  # so that training doesn't depend on the order of arrival
    none = np.zeros(HIDDEN, np.float32)
    return [(np.frombuffer(ids, np.int32), np.frombuffer(state, np.float32) if state else none) for _, _, ids, state in found]


def _packed(w: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([w[k].ravel().astype(np.float64) for k in Network.NAMES]).tobytes()


def _unpacked(data: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in Network.NAMES:
        out[k] = data[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def _weights(packed: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {k: v.astype(np.float32) for k, v in _unpacked(np.frombuffer(packed), like).items()}


def learn(docs: DataFrame, classes: Classes, shared, n_texts: int) -> Network:
    texts = docs.select("doc_id", "text")
    schema = "weights binary, n long"

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, own = Network(shared.value), _read_stretches(batches)
        network.train(own, FIRST_EPOCHS, RATE, 1)
        yield pa.record_batch([pa.array([_packed(network.w)], pa.binary()), pa.array([len(own)], pa.int64())], names=["weights", "n"])

    # place is a hash: its lowest values are a sample, of FIRST_RUNS runs or nearly so
    most = (2**63 - 1) * FIRST_RUNS // max(n_texts, FIRST_RUNS)
    sample = common.map_batches(texts, _first_runs(shared, most), STRETCHES)
    network = Network(classes)
    weights = common.map_batches(sample.repartition(1), first, schema).first()["weights"]
    start = docs.sparkSession.sparkContext.broadcast(weights)
    replicas = -(-classes.tokens // (REPLICA_RUNS * RUN)) or 1

    def replica(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(shared.value)
        own.w = _weights(start.value, own.w)
        for key, rows in common.runs(batches, ("replica",)):
            mine = Network(shared.value, own.w)
            found = _read_stretches(iter(rows.to_batches()))
            mine.train(found, 1, RATE / 4, 2 + key[0])
            words = sum(len(ids) - 1 for ids, _ in found)
            yield pa.record_batch([pa.array([_packed(mine.w)], pa.binary()), pa.array([words], pa.int64())], names=["weights", "n"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for batch in batches:
            for row in batch.to_pylist():
                total, n = total + np.frombuffer(row["weights"]) * row["n"], n + row["n"]
        if n:
            yield pa.record_batch([pa.array([(total / n).tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["weights", "n"])

    dealt = common.map_batches(texts, _stretches(shared, start), STRETCHES).withColumn("replica", F.pmod("place", F.lit(replicas)).cast("int"))
    dealt = dealt.repartition(replicas, "replica").sortWithinPartitions("replica")
    trained = common.stored(common.map_batches(dealt, replica, schema), "replicas")
    # replicas are added up in groups, round by round, until few enough for the driver are left
    left = replicas
    while left > SUMS:
        left = -(-left // SUMS)
        trained = common.stored(common.map_batches(trained.repartition(left), summed, schema), "sums")
    sums = trained.collect()
    if sums:
        sums.sort(key=lambda r: (r["n"], bytes(r["weights"])))
        n = sum(r["n"] for r in sums)
        network.w = _unpacked(sum(np.frombuffer(r["weights"]) * (r["n"] / n) for r in sums), network.w)
        network.w = {k: v.astype(np.float32) for k, v in network.w.items()}
    return network


# --- scoring --------------------------------------------------------------------------

PARTIAL = (
    "row_id long, doc_id long, held_out boolean, n_tokens long, known long, rare long, base double, score double, "
    "hashes array<long>, times array<long>"
)


def _partial(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network: Network = shared.value
        classes = network.classes
        ids_of = Ids(classes)
        rare = ids_of.rare
        share = np.concatenate([np.log10((classes.counts + 0.5) / classes.base_mass), [0.0]])
        row_id = TaskContext.get().partitionId() << 33
        for batch in batches:
            doc_ids = batch.column("doc_id").cast(pa.int64())
            for split in split_texts(batch.column("text")):
                own, lengths = doc_ids[split.rows], np.diff(split.starts)
                ids, of_text = ids_of.each(split.hashes)[split.codes], np.repeat(np.arange(len(own)), lengths)
                base = np.bincount(of_text, share[ids], minlength=len(own))
                # the words of each text that are not among the frequent, with their counts in it
                other = np.flatnonzero(ids == rare)
                pairs, times = np.unique(of_text[other] * len(split.hashes) + split.codes[other], return_counts=True)
                whose, which = np.divmod(pairs, len(split.hashes))
                hashes = split.hashes[which]
                edges = np.searchsorted(whose, np.arange(len(own) + 1))
                unlisted = np.bincount(whose, times, minlength=len(own)).astype(np.int64)
                scores = network.score(np.split(ids, split.starts[1:-1]))
                yield pa.record_batch(
                    [
                        pa.array(range(row_id, row_id + len(own)), pa.int64()),
                        own,
                        pa.array([held_out(i) for i in own.to_pylist()]),
                        pa.array(lengths, pa.int64()),
                        pa.array(lengths - unlisted, pa.int64()),
                        pa.array(unlisted, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(scores, pa.float64()),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(hashes, pa.int64())),
                        pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(times, pa.int64())),
                    ],
                    names=["row_id", "doc_id", "held_out", "n_tokens", "known", "rare", "base", "score", "hashes", "times"],
                )
                row_id += len(own)

    return work


def score(docs: DataFrame) -> DataFrame:
    """The model learned from the training texts of ``docs``, applied to all of them."""
    context = docs.sparkSession.sparkContext
    words = vocabulary(docs)
    classes = classes_of(words)
    n_texts = words.where(F.col("hash") == word_hash(END)).agg(F.sum("n")).first()[0] or 0
    network = learn(docs, classes, context.broadcast(classes), n_texts)
    partial = common.map_batches(docs.select("doc_id", "text"), _partial(context.broadcast(network)), PARTIAL)
    partial = common.stored(partial, "scores")
    each = partial.select("row_id", F.explode(F.arrays_zip("hashes", "times")).alias("e"))
    each = each.select("row_id", F.col("e.hashes").alias("hash"), F.col("e.times").alias("times")).join(words, "hash", "left")
    each = each.groupBy("row_id").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("met"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("logs"),
    )
    rows = partial.drop("hashes", "times").join(each, "row_id", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(classes.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("rare") * F.lit(float(np.log10(classes.base_mass)))).alias("base_score"),
        (F.col("score") + logs - F.col("rare") * F.lit(float(np.log10(classes.rare_mass)))).alias("score"),
    )


def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return score(common.table(spark, folder, "documents"))
