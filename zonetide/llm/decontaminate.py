"""Benchmark decontamination by suffix arrays over the training texts.

Every Arrow batch of documents is a training shard.  Its words become numbers (0 for a
word that no benchmark item has, which ends every match), stretches too short for any
window are left out, and the suffixes that remain are sorted into a suffix array.  Each
suffix of each benchmark item is looked up in it by binary search; the range it finds are
the places that share its window.  Each of them is extended with every place of the
benchmark that has the window, so that every item with a longest verbatim match is named.

A window is ``window`` consecutive words of an item, or a whole shorter item.  Texts never
leave their tasks: a batch gives one row per document, and removal filters the batch.

The benchmark travels to the tasks in blocks of at most about ``BLOCK_BYTES`` of text;
a larger benchmark takes several blocks, one pass of the same plan after the other, each
adding to what the passes before have found.

Defined results: null and empty texts have no words and no hits; an item without words
matches nothing; items without an id are looked up and hit words, but are not listed; an
item id that repeats is listed once, its rows are matched one by one; repeated documents give repeated rows; an empty table
on either side gives no hits; other columns are carried along by ``remove_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WINDOW = 10
BLOCK_BYTES = 4_000_000
#: Pairs of a place in a document and one in an item that are extended at once.
PAIRS = 1 << 18
#: A-Z in lower case; ASCII but for digits and letters parts words; all else belongs to them.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
MATCH = "struct<item_id:long,item_start:int,doc_start:int,length:int>"
FOUND = f"struct<n_words:long,n_hit:long,item_ids:array<long>,spans:array<struct<start:int,end:int>>,matches:array<{MATCH}>>"


def words_of(text: str | None) -> list[bytes]:
    return common.utf8(text).translate(LETTERS).split()


@dataclass
class Benchmark:
    """A block of items: its words, its suffixes by window length, and who has them."""

    numbers: dict[bytes, int]
    words: np.ndarray  # numbers of all items, 0 between them
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    items: np.ndarray  # item index at each place of words
    starts: np.ndarray  # place of each item in words
    ids: list[int | None]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]], window: int) -> Benchmark:
        numbers: dict[bytes, int] = {}
        flat, items, starts, lengths = [0], [-1], [], []
        for i, (_, text) in enumerate(rows):
            found = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
            starts.append(len(flat))
            lengths.append(len(found))
            flat += [*found, 0]
            items += [i] * (len(found) + 1)
        words = np.array(flat + [0] * window, np.int64)
        owner, begun, long = np.array(items), np.array(starts, int), np.array(lengths, int)
        windows = {}
        for length in sorted({min(n, window) for n in lengths if n}):
            mine = np.flatnonzero(np.minimum(long, window) == length)
            places = np.concatenate([begun[i] + np.arange(long[i] - length + 1) for i in mine])
            keys = keys_at(words, places, length)
            # each different window once, with all of its places and the items that have it
            keys, which = np.unique(keys, return_inverse=True)
            order = np.argsort(which.ravel(), kind="stable")
            begin = np.searchsorted(which.ravel()[order], np.arange(len(keys) + 1))
            pairs = np.unique(np.stack([which.ravel(), owner[places]], axis=1), axis=0)
            windows[length] = keys, begin, places[order], np.searchsorted(pairs[:, 0], np.arange(len(keys) + 1)), pairs[:, 1]
        return cls(numbers, words, windows, owner, begun, [r[0] for r in rows])


def keys_at(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """The next ``length`` words at each place as byte strings that sort like the words."""
    taken = words[places[:, None] + np.arange(length)]
    taken *= np.logical_and.accumulate(taken > 0, axis=1)
    return np.ascontiguousarray(taken.astype(">u4")).view(f"S{4 * length}").ravel()


def shard_matches(bench: Benchmark, words: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For a shard's word numbers: (window length, window, place) of all window matches."""
    if not bench.windows:
        return []
    least = min(bench.windows)
    inside = np.concatenate([[False], words > 0, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = turns[::2], turns[1::2]
    long = ends - begins >= least
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return []
    sizes = ends - begins
    # places of the suffix array: all of the stretches that are long enough
    places = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    depth = max(bench.windows)
    padded = np.concatenate([words, np.zeros(depth, words.dtype)])
    suffixes = keys_at(padded, places, depth)
    order = np.argsort(suffixes, kind="stable")
    suffixes = suffixes[order]
    found = []
    for length, (keys, *_) in bench.windows.items():
        # a shorter window starts a range: up to the same words followed by the largest
        high = np.char.add(keys, b"") if length == depth else _followed(keys, length, depth)
        low = np.searchsorted(suffixes, keys.astype(suffixes.dtype), "left")
        end = np.searchsorted(suffixes, high.astype(suffixes.dtype), "right")
        count = end - low
        window = np.repeat(np.arange(len(keys)), count)
        at = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        found.append((length, window, places[order[at]]))
    return found


def _followed(keys: np.ndarray, length: int, depth: int) -> np.ndarray:
    raw = np.frombuffer(keys.astype(f"S{4 * length}").tobytes(), np.uint8).reshape(len(keys), 4 * length)
    rest = np.full((len(keys), 4 * (depth - length)), 255, np.uint8)
    return np.concatenate([raw, rest], axis=1).view(f"S{4 * depth}").ravel()


def shard_results(bench: Benchmark, texts: list[str | None]) -> Iterator[dict]:
    """What each document of a shard has in common with a block of items."""
    number = bench.numbers.get
    parts, offsets, counts = [np.zeros(1, np.int64)], [], []
    total = 1
    for text in texts:
        own = words_of(text)
        offsets.append(total)
        counts.append(len(own))
        parts += [np.fromiter((number(w, 0) for w in own), np.int64, len(own)), parts[0]]
        total += len(own) + 1
    words = np.concatenate(parts)
    found = shard_matches(bench, words)
    per_doc: dict[int, tuple[list, set, set]] = {}
    for length, window, place in found:
        _, begin, item_places, where, owners = bench.windows[length]
        doc = np.searchsorted(offsets, place, "right") - 1
        for d, w, p in zip(doc.tolist(), window.tolist(), place.tolist(), strict=True):
            spans, items, _ = per_doc.setdefault(d, ([], set(), set()))
            spans.append((p - offsets[d], p - offsets[d] + length))
            items.update(owners[where[w] : where[w + 1]].tolist())
        for i, item_at in _pairs(window, begin, item_places):
            longest = longest_matches(bench.words, words, item_at, place[i], length)
            for j in np.flatnonzero(longest).tolist():
                d, p = int(doc[i[j]]), int(place[i[j]])
                owner = int(bench.items[item_at[j]])
                start = int(item_at[j] - bench.starts[owner])
                per_doc[d][2].add((p - offsets[d], int(longest[j]), start, owner))
    for d, n in enumerate(counts):
        spans, items, matches = per_doc.get(d, ((), (), ()))
        yield {
            "n_words": n,
            "spans": spans,
            "item_ids": {bench.ids[i] for i in items} - {None},
            "matches": [
                {"item_id": bench.ids[owner], "item_start": start, "doc_start": at, "length": length} for at, length, start, owner in sorted(matches)
            ],
        }


def _pairs(window: np.ndarray, begin: np.ndarray, item_places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the hit, item place) of every hit with every place of its window, ``PAIRS``
    or so at a time."""
    upto = np.cumsum(begin[window + 1] - begin[window])
    first = 0
    while first < len(window):
        done = upto[first - 1] if first else 0
        last = max(int(np.searchsorted(upto, done + PAIRS, "right")), first + 1)
        count = np.diff(upto[first:last], prepend=done)
        i = np.repeat(np.arange(first, last), count)
        yield i, item_places[begin[window[i]] + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)]
        first = last


def longest_matches(item_words, doc_words, item_at, place, length) -> np.ndarray:
    """Lengths of the matches that cannot be extended to the left, 0 for the others."""
    before = doc_words[place - 1]
    size = np.where((before > 0) & (before == item_words[item_at - 1]), 0, length)
    grow = np.flatnonzero(size)
    while len(grow):
        end = place[grow] + size[grow]
        in_doc = np.where(end < len(doc_words), doc_words[np.minimum(end, len(doc_words) - 1)], 0)
        in_item = item_words[item_at[grow] + size[grow]]
        grow = grow[(in_doc > 0) & (in_doc == in_item)]
        size[grow] += 1
    return size


def merged(result: dict, earlier: dict | None) -> dict:
    """Joined with what earlier blocks found, spans united."""
    spans = [*result["spans"], *((s["start"], s["end"]) for s in (earlier or {}).get("spans", ()))]
    joined: list[list[int]] = []
    for start, end in sorted(spans):
        if joined and start <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], end)
        else:
            joined.append([start, end])
    return {
        "n_words": result["n_words"],
        "n_hit": sum(end - start for start, end in joined),
        "item_ids": sorted({*result["item_ids"], *(earlier or {}).get("item_ids", ())}),
        "spans": [{"start": s, "end": e} for s, e in joined],
        "matches": [*(earlier or {}).get("matches", ()), *result["matches"]],
    }


def blocks(benchmark: DataFrame, window: int = WINDOW) -> Iterator:
    """Broadcast blocks of the benchmark, each of a checked size."""
    rows = benchmark.select("item_id", "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // BLOCK_BYTES + 1
    for i in range(count):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == i)
        listed = sorted(((r[0], r[1]) for r in own.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        yield benchmark.sparkSession.sparkContext.broadcast(Benchmark.of(listed, window))


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, found) per document: words, hit words, items, hit spans, longest matches."""
    rows = docs.select("doc_id", "text", F.lit(None).cast(FOUND).alias("found"))
    for block in blocks(benchmark, window):
        rows = common.map_batches(rows, _annotate(block), rows.schema)
    return rows.select("doc_id", "found")


def _annotate(block):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("found").type
            earlier = batch.column("found").to_pylist()
            results = shard_results(block.value, batch.column("text").to_pylist())
            found = [merged(r, e) for r, e in zip(results, earlier, strict=True)]
            yield batch.set_column(2, "found", pa.array(found, kind))

    return work


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents in which an item's window occurs."""
    for block in blocks(benchmark, window):

        def keep(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                results = shard_results(block.value, batch.column("text").to_pylist())
                yield batch.filter(pa.array([not r["spans"] for r in results], pa.bool_()))

        docs = common.map_batches(docs, keep, docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    found = find_matches(docs, common.table(spark, folder, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("found.item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.item_ids").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )
