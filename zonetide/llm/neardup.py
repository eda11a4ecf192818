"""Near-duplicates: b-bit MinHash for candidates, exact confirmation on full shingle sets.

1. Every text becomes its set of ``width``-word shingles (64-bit hashes), ``PERMUTATIONS``
   minima, one bucket per band of ``BAND_ROWS`` minima, and a packed signature of the low
   ``BITS`` bits of each minimum.  Equal sets are one node from here on, the smallest
   ``doc_id`` standing for all.
2. In every bucket each node is compared with the bucket's leader, its smallest id, by bit
   counts on the packed signatures, corrected for chance collisions of the low bits.  Pairs
   that seem similar above ``LOOSE`` join a cluster.  By the triangle inequality of the
   Jaccard distance two linked nodes are either both near the leader or both far from it;
   where a bucket has members that failed, the far ones are compared among themselves, in
   pairs of small blocks that give a spanning forest each.  So no linked pair that shares a
   bucket is separated, and no group is ever expanded into all its pairs.
3. The clusters hold every link.  Their members' full sets are read once more from the
   texts, and clusters are worked on in pairs of small blocks, each giving a spanning
   forest of its confirmed links.  Connected components of those links are the answer.

Of 192 minima 190 make 38 bands of 5: a pair at 0.8 is in no common bucket with a chance of
3e-7, falling quickly above.  Hot groups are split: equal sets by map-side aggregation,
buckets by joins that adaptive execution splits, clusters into blocks.

Defined results: a text with fewer words than a shingle is one shingle; null and empty texts
have no shingle and no link; repeated rows are equal sets; rows without ``doc_id`` are
linked to equal sets only, take the id found there, and stay only if there is none;
``doc_id`` should be unique, rows that share one are one node; an empty table gives no rows;
``keep_first`` carries all other columns along, and leaves one of several rows with the kept
``doc_id``, or with none, that are equal sets (any one of them; different texts stay).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PERMUTATIONS, BANDS, BAND_ROWS, BITS = 192, 38, 5, 2
PER_LONG = 64 // BITS
LONGS = PERMUTATIONS // PER_LONG
#: Estimated similarity from which a node joins its leader's cluster, and up to which it
#: still counts as far from the leader; the gap covers the distance of two linked nodes
#: (0.2) and over four standard errors of two estimates.
LOOSE, FAR = 0.35, 0.85
#: Rows of a block; a task holds two.
BLOCK = 128
#: Columns of the dense matrix that a block pair is multiplied in.
COLUMNS = 1 << 16

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_random = np.random.default_rng(20250101)
_SCALE = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word met, remembered up to a bound."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles."""
    words = common.spaced_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    own = min(width, len(words))
    out = np.full(len(words) - own + 1, own, np.uint64)
    for i in range(own):
        out = mix(out * _M1 + each[i : i + len(out)])
    return np.unique(out)


def minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 1024):
        part = shingles[start : start + 1024, None] * _SCALE + _SHIFT
        np.minimum(least, part.min(axis=0), out=least)
    return least


def buckets_of(least: np.ndarray) -> np.ndarray:
    rows = least[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        out = mix(out * _M1 + rows[:, i])
    return out.view(np.int64)


def signature_of(least: np.ndarray) -> np.ndarray:
    """The low bits of the (mixed) minima, packed into longs."""
    low = (mix(least) & np.uint64(2**BITS - 1)).reshape(LONGS, PER_LONG)
    return (low << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64).view(np.int64)


def _lists(rows: list, kind: pa.DataType) -> pa.Array:
    return pa.array(rows, pa.list_(kind))


def _sketch(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, signatures, buckets = [], [], [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py(), width, hashes)
                sizes.append(len(found))
                if not len(found):
                    keys.append(None), signatures.append(None), buckets.append(None)
                    continue
                least = minima(found)
                keys.append(xxhash.xxh3_128_hexdigest(found.tobytes()))
                signatures.append(signature_of(least))
                buckets.append(buckets_of(least))
            yield pa.record_batch(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.string()), _lists(signatures, pa.int64()), _lists(buckets, pa.int64())],
                names=["doc_id", "n_shingles", "key", "signature", "buckets"],
            )

    return work


def sketches(docs: DataFrame, width: int) -> DataFrame:
    schema = "doc_id long, n_shingles long, key string, signature array<long>, buckets array<long>"
    return common.stored(common.map_batches(docs.select("doc_id", "text"), _sketch(width), schema), "sketches")


_ODD = int("01" * 32, 2)


def estimate(one: str, other: str) -> Column:
    """Similarity of two packed signatures: share of equal bit groups, less the share that
    agrees by chance."""
    differ = F.lit(0)
    for i in range(LONGS):
        x = F.col(one)[i].bitwiseXOR(F.col(other)[i])
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(_ODD)))
    chance = 2.0**-BITS
    return (1 - differ / PERMUTATIONS - chance) / (1 - chance)


def estimates(signatures: np.ndarray) -> np.ndarray:
    """The same for all rows of a small block against each other."""
    x = signatures[:, None, :] ^ signatures[None, :, :]
    differ = np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(_ODD)).sum(axis=2)
    chance = 2.0**-BITS
    return (1 - differ / PERMUTATIONS - chance) / (1 - chance)


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links in a boolean matrix."""
    tree, left = [], set(range(len(linked)))
    while left:
        reach = [left.pop()]
        while reach:
            at = reach.pop()
            for new in [j for j in np.flatnonzero(linked[at]).tolist() if j in left]:
                left.discard(new)
                reach.append(new)
                tree.append((at, new))
    return tree


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = np.array(found, np.int64).reshape(-1, 2)
    return pa.record_batch([pa.array(columns[:, 0]), pa.array(columns[:, 1])], names=["a", "b"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests of what seems similar, for pairs of blocks of a bucket."""
    found = []
    for (_, left, right), rows in common.runs(batches, ("bucket", "left", "right")):
        ids, block = rows["id"].to_numpy(), rows["block"].to_numpy()
        signatures = rows["signature"].combine_chunks().flatten().to_numpy().reshape(-1, LONGS).view(np.uint64)
        near = estimates(signatures) >= LOOSE
        if left != right:
            near &= block[:, None] != block[None, :]
        found += [(ids[i], ids[j]) for i, j in forest(near)]
        if len(found) > 10_000:
            yield _pairs(found)
            found = []
    yield _pairs(found)


def in_block_pairs(rows: DataFrame, group: str, carried: str) -> DataFrame:
    """Rows (group, id, carried) dealt to every pair of blocks of their group: any two rows
    of a group meet in one task, which holds two blocks, and tasks are sorted by pair."""
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select(group, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(sizes, group).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    left, right = F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right")
    key = (group, "left", "right")
    return rows.select(group, left, right, "block", "id", carried).repartition(*key).sortWithinPartitions(*key)


def clusters(nodes: DataFrame) -> DataFrame:
    """(id, component) of nodes (id, signature, buckets) that may be linked."""
    signatures = nodes.select("id", "signature")
    members = nodes.select("id", F.explode("buckets").alias("bucket"))
    led = members.groupBy("bucket").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = members.join(led, "bucket").where("id <> leader").select("bucket", "id", "leader")
    pairs = common.stored(pairs, "members")
    # each pair is compared once, however many buckets it shares
    theirs = signatures.select(F.col("id").alias("leader"), F.col("signature").alias("theirs"))
    once = pairs.select("id", "leader").distinct().join(signatures, "id").join(theirs, "leader")
    once = common.stored(once.select("id", "leader", estimate("signature", "theirs").alias("near")), "pairs")
    failed = once.where(F.col("near") < LOOSE).select("id", "leader")
    open_buckets = pairs.join(failed, ["id", "leader"], "left_semi").select("bucket").distinct()
    far = once.where(F.col("near") < FAR).select("id", "leader")
    rest = pairs.join(far, ["id", "leader"]).join(open_buckets, "bucket").select("bucket", "id")
    rest = common.stored(rest.join(signatures, "id").select("bucket", "id", "signature"), "rest")
    among = common.map_batches(in_block_pairs(rest, "bucket", "signature"), _similar, "a long, b long")
    # a node has a leader per band at most; what its leaders share is told once
    near = once.where(F.col("near") >= LOOSE).groupBy("id")
    near = near.agg(F.min("leader").alias("b"), F.array_append(F.collect_set("leader"), F.col("id")).alias("a"))
    return common.components(near.select(F.explode("a").alias("a"), "b").unionByName(among))


def _sets(width: int, wanted: common.IdFilter):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            rows = pa.array(wanted.passing(ids))
            found = [shingle_set(t.as_py(), width, hashes).tobytes() for t in batch.column("text").filter(rows)]
            yield pa.record_batch([ids.filter(rows), pa.array(found, pa.binary())], names=["id", "shingles"])

    return work


def links_between(one: list[np.ndarray], other: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: 100 * intersection >= percent * union, exactly."""
    every = np.unique(np.concatenate([*one, *other]))
    sizes = [np.array([len(s) for s in side], np.int64) for side in (one, other)]
    places = [[np.searchsorted(every, s) for s in side] for side in (one, other)]
    shared = np.zeros((len(one), len(other)), np.int64)
    for start in range(0, len(every), COLUMNS):
        end = min(start + COLUMNS, len(every))
        dense = []
        for side in places:
            part = np.zeros((len(side), end - start), np.float32)
            for row, at in enumerate(side):
                lo, hi = np.searchsorted(at, (start, end))
                part[row, at[lo:hi] - start] = 1
            dense.append(part)
        # sums of at most COLUMNS ones are exact in single precision
        shared += (dense[0] @ dense[1].T).astype(np.int64)
    union = sizes[0][:, None] + sizes[1][None, :] - shared
    return 100 * shared >= percent * union


def _confirm(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for (_, left, right), rows in common.runs(batches, ("component", "left", "right")):
            ids, block = rows["id"].to_numpy(), rows["block"].to_numpy()
            sets = [np.frombuffer(s.as_py(), np.uint64) for s in rows["shingles"]]
            first, second = np.flatnonzero(block == left), np.flatnonzero(block == right)
            if left == right:
                linked = links_between([sets[i] for i in first], [sets[i] for i in first], percent)
                order = first
            elif len(first) and len(second):
                across = links_between([sets[i] for i in first], [sets[i] for i in second], percent)
                order = np.concatenate([first, second])
                linked = np.zeros((len(order), len(order)), bool)
                linked[: len(first), len(first) :] = across
                linked |= linked.T
            else:
                continue
            found += [(ids[order[i]], ids[order[j]]) for i, j in forest(linked)]
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        yield _pairs(found)

    return work


def confirmed(docs: DataFrame, grouped: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): confirmed links that connect what the links within clusters connect."""
    grouped = common.stored(grouped, "clusters")
    work = _sets(width, common.IdFilter(grouped, "id"))
    sets = common.stored(common.map_batches(docs.select("doc_id", "text"), work, "id long, shingles binary"), "sets")
    sets = sets.join(grouped, "id")
    rows = in_block_pairs(sets, "component", "shingles")
    return common.stored(common.map_batches(rows, _confirm(percent), "a long, b long"), "links")


def _found(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, key, component_id, kept) for every row of ``docs``."""
    sketched = sketches(docs, width)
    equal = sketched.where("key is not null").groupBy("key")
    equal = equal.agg(F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("buckets").alias("buckets"))
    equal = common.stored(equal, "equal")
    links = confirmed(docs, clusters(equal.where("id is not null")), width, percent)
    grouped = common.components(links)
    named = equal.select("key", "id").join(grouped, "id", "left").select("key", F.coalesce("component", "id").alias("component"))
    rows = sketched.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component = F.coalesce("component", "doc_id")
    kept = F.when(F.col("doc_id").isNull(), component.isNull()).otherwise(F.col("doc_id") == component)
    return rows.select("doc_id", "n_shingles", "key", component.alias("component_id"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    return _found(docs, width, percent).drop("key")


def _keys(width: int):
    """Rows with the key of their shingle set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = (shingle_set(t.as_py(), width, hashes) for t in batch.column("text"))
            keys = [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets]
            yield pa.record_batch([*batch.columns, pa.array(keys, pa.string())], names=[*batch.schema.names, "_key"])

    return work


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component; texts without a shingle have no link and stay."""
    found = _found(docs, width, percent)
    gone = found.where("doc_id is not null and not kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
    # ids don't tell rows apart that share one or have none: those are told by their sets
    alike = found.where("key is not null and (doc_id is null or kept)").groupBy("doc_id", "key")
    alike = alike.agg(F.count(F.lit(1)).alias("n"), F.first("kept").alias("kept")).where("n > 1 or doc_id is null")
    alike = common.stored(alike.select("doc_id", "key", "kept"), "alike")
    if alike.isEmpty():
        return left
    shared = alike.where("doc_id is not null").select(F.col("doc_id").alias("_shared")).distinct()
    marked = left.join(shared, left["doc_id"] == shared["_shared"], "left")
    marked = marked.withColumn("_alike", F.col("_shared").isNotNull() | F.col("doc_id").isNull()).drop("_shared")
    marked = common.stored(marked, "marked")
    rows = marked.where("_alike").drop("_alike")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", _key string"
    keyed = common.map_batches(rows, _keys(width), schema)
    copies = alike.where("doc_id is null and not kept").select(F.col("key").alias("_copied"))
    there = (keyed["_key"] == copies["_copied"]) & keyed["doc_id"].isNull()
    keyed = common.stored(keyed.join(copies, there, "left_anti"), "keyed")
    single = keyed.where("_key is not null").dropDuplicates(["doc_id", "_key"])
    every = marked.where("not _alike").drop("_alike")
    return every.unionByName(single.drop("_key")).unionByName(keyed.where("_key is null").drop("_key"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(common.table(spark, folder, "documents"), width=4, percent=80)
