"""Hard-negative mining with scores by subset-sum tables (the Four Russians' method).

An anchor's score with a candidate is an inner product of integers.  A candidate's
components are written in two's complement and cut into bit planes; for every group of
eight dimensions, one plane of the group is a byte.  An anchor has a table of 256 entries
for each group: the sums of its components over all subsets of the eight.  A score is then

    sum over planes of 2^plane * (sum over groups of table[group][byte])

with the sign plane counting negative, computed from the highest plane down by doubling and adding
lookups.  Tables are built by doubling too, each of eight components adding itself to the
sums before.  All scores are exact: the sums are held in the narrowest integers that they fit.

Candidates are packed once and stored by label.  Anchors are taken in blocks of at most ``BLOCK``, whose vectors,
of a proven size, are broadcast; every task passes over its own candidates only, so
candidates are never copied or shuffled, whatever the number of anchors.  A first pass finds
an anchor's positives, scoring candidates of its own label; a second one has these scores
and finds, for each positive, the best candidates of other labels inside its range.  A task
keeps the few best of each anchor (and positive) and hands on only those.

Defined results: rows with a null id or label, a null vector, or any null or non-finite component
take no part; an empty vector scores 0 with all; shorter vectors count as filled up with
zeros; rows that repeat an id are rows of their own, as anchors too; ties go to the smaller
id; an anchor without positives, and a positive without negatives, give no row; a score must fit
a long; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SCALE, POSITIVES, NEGATIVES = 256, 5, 3
#: Per cent of the positive's score, between which a negative's must be.
LOW, HIGH = 50, 95
#: Most anchors of a block and most components of all of them, which bounds what is broadcast
#: (2 MB) and a task's tables (17 MB with scores of 16 bits, 67 MB with 64).
BLOCK, COMPONENTS = 4096, 1 << 18
#: Anchors of one table, candidates of one step.
TABLE, STEP = 256, 1024
NONE = np.iinfo(np.int64).min


def whole_vector(vector: Column) -> Column:
    """floor(SCALE * x) of every component, or null for a vector that takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


# --- bit planes and tables -------------------------------------------------------------------


def matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def planes_of(vectors: np.ndarray, bits: int) -> np.ndarray:
    """(plane, group, row) bytes of two's complement components, lowest plane first."""
    rows, width = vectors.shape
    wide = np.zeros((rows, -(-max(width, 1) // 8) * 8), np.int64)
    wide[:, :width] = vectors
    out = np.empty((bits, wide.shape[1] // 8, rows), np.uint8)
    for plane in range(bits):
        out[plane] = np.packbits(((wide >> plane) & 1).astype(np.uint8), axis=1, bitorder="little").T
    return out


def bits_of(vectors: np.ndarray) -> int:
    """Planes that the components need, the sign among them."""
    return int(np.maximum(vectors, ~vectors).max(initial=0)).bit_length() + 1


def narrowest(most: int) -> type:
    return next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)


class Tables:
    """Subset sums of a block of anchors, by groups of eight dimensions."""

    def __init__(self, anchors: np.ndarray, most: int):
        """most: the largest absolute component of any candidate, for the width of scores."""
        rows, width = anchors.shape
        groups = -(-max(width, 1) // 8)
        wide = np.zeros((rows, groups * 8), np.int64)
        wide[:, :width] = anchors
        reach = int(np.abs(wide).sum(axis=1).max(initial=0))
        self.plane_type = narrowest(reach)
        # a partial sum of planes can be twice as large as the score
        self.score_type = narrowest(min(reach * (2 * most + 2), np.iinfo(np.int64).max))
        self.sums = np.zeros((groups, 256, rows), self.plane_type)
        for group in range(groups):
            for d in range(8):
                self.sums[group, 1 << d : 2 << d] = self.sums[group, : 1 << d] + wide[:, group * 8 + d].astype(self.plane_type)

    def scores(self, planes: np.ndarray) -> np.ndarray:
        """(candidate, anchor) inner products, from the highest plane down."""
        bits, groups, rows = planes.shape
        total = np.zeros((rows, self.sums.shape[2]), self.score_type)
        for plane in range(bits - 1, -1, -1):
            total += total  # shift
            looked_up = self.sums[0][planes[plane, 0]]
            for group in range(1, groups):
                looked_up += self.sums[group][planes[plane, group]]
            if plane == bits - 1:
                total -= looked_up
            else:
                total += looked_up
        return total


class Best:
    """The k best (score, id, row) of each slot, a slot being an anchor or a positive."""

    def __init__(self, slots: int, k: int):
        self.scores = np.full((slots, k), NONE)
        self.ids = np.full((slots, k), np.iinfo(np.int64).max)
        self.rows = np.full((slots, k), -1)

    def floor(self) -> np.ndarray:
        """What a score must reach to come in; ties may, by a smaller id."""
        return self.scores[:, -1]

    def add(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if not len(slots):
            return
        k = self.scores.shape[1]
        order = np.lexsort((rows, ids, ~scores, slots))
        slots, scores, ids, rows = slots[order], scores[order], ids[order], rows[order]
        starts = np.flatnonzero(np.concatenate([[True], slots[1:] != slots[:-1]]))
        place = np.arange(len(slots)) - np.repeat(starts, np.diff([*starts, len(slots)]))
        near = place < k
        own = slots[starts]
        new = [np.full((len(own), k), fill) for fill in (NONE, np.iinfo(np.int64).max, -1)]
        at = (np.repeat(np.arange(len(own)), np.diff([*starts, len(slots)]))[near], place[near])
        for target, values in zip(new, (scores, ids, rows), strict=True):
            target[at] = values[near]
        both = [np.concatenate([old[own], n], axis=1) for old, n in zip((self.scores, self.ids, self.rows), new, strict=True)]
        first = np.lexsort((both[2], both[1], ~both[0]), axis=1)[:, :k]
        for target, values in zip((self.scores, self.ids, self.rows), both, strict=True):
            target[own] = np.take_along_axis(values, first, axis=1)

    def table(self) -> tuple[np.ndarray, ...]:
        slot, col = np.nonzero(self.scores != NONE)
        return slot, self.rows[slot, col], self.ids[slot, col], self.scores[slot, col]


# --- the two passes ----------------------------------------------------------------------------

MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
HITS = "slot long, other long, vec_id long, score long"


def _batch(best: Best, names: np.ndarray) -> pa.RecordBatch:
    slot, row, ids, scores = best.table()
    return pa.record_batch([pa.array(names[slot]), pa.array(row), pa.array(ids), pa.array(scores)], names=["slot", "other", "vec_id", "score"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Candidates in steps: rows, ids, labels, planes."""
    for batch in batches:
        for start in range(0, batch.num_rows, STEP):
            part = batch.slice(start, STEP)
            bits, groups = part.column("bits")[0].as_py(), part.column("groups")[0].as_py()
            flat = np.frombuffer(b"".join(part.column("planes").to_pylist()), np.uint8)
            planes = np.ascontiguousarray(flat.reshape(part.num_rows, bits, groups).transpose(1, 2, 0))
            yield (*(part.column(c).to_numpy() for c in ("row", "vec_id", "label")), planes)


def positives(block, most: int, k: int):
    """The k best other rows of each anchor's label; a slot is an anchor's row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = block.value
        # anchors of a label side by side: a step's candidates are scored with their own only
        groups = [np.flatnonzero(anchors["label"] == label) for label in np.unique(anchors["label"])]
        tables = [(g[i : i + TABLE], Tables(anchors["v"][g[i : i + TABLE]], most)) for g in groups for i in range(0, len(g), TABLE)]
        best = Best(len(anchors["row"]), k)
        for rows, ids, labels, planes in _packed(batches):
            for own, table in tables:
                mine = np.flatnonzero(labels == anchors["label"][own[0]])
                if not len(mine):
                    continue
                scores = table.scores(planes[:, :, mine]).T
                hit = (scores >= best.floor()[own, None]) & (rows[mine] != anchors["row"][own, None])
                a, c = np.nonzero(hit)
                best.add(own[a], scores[a, c].astype(np.int64), ids[mine[c]], rows[mine[c]])
        yield _batch(best, anchors["row"])

    return work


def negatives(block, wanted, most: int, k: int):
    """The k best rows of other labels in the range of each positive; a slot is a positive's place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, (slots, owner, positive) = block.value, wanted.value
        # places of each anchor's positives, best first
        rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
        low, high = -(-LOW * positive // 100), HIGH * positive // 100
        best = Best(len(slots), k)
        for start in range(0, len(anchors["row"]), TABLE):
            own = slice(start, start + TABLE)
            anchors.setdefault("tables", {})[start] = Tables(anchors["v"][own], most)
        for rows, ids, labels, planes in _packed(batches):
            for start, table in anchors["tables"].items():
                own_labels = anchors["label"][start : start + TABLE]
                scores = table.scores(planes).T
                other = own_labels[:, None] != labels
                mine = np.flatnonzero((owner >= start) & (owner < start + TABLE))
                for r in range(int(rank[mine].max(initial=-1)) + 1):
                    at = mine[rank[mine] == r]
                    line = owner[at] - start
                    least = np.maximum(best.floor()[at], low[at])
                    hit = (scores[line] >= least[:, None]) & (scores[line] <= high[at, None]) & other[line]
                    a, c = np.nonzero(hit)
                    best.add(at[a], scores[line[a], c].astype(np.int64), ids[c], rows[c])
        yield _batch(best, slots)

    return work


def packed(vectors: DataFrame, width: int) -> DataFrame:
    """Candidates (row, vec_id, label, bits, groups, planes), a row's planes being one binary."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                v = matrix(part.column("v"), width)
                planes = planes_of(v, part.column("bits")[0].as_py())
                own = planes.transpose(2, 0, 1).reshape(part.num_rows, -1)
                columns = [part.column(c) for c in ("row", "vec_id", "label", "bits")]
                groups = pa.array(np.full(part.num_rows, planes.shape[1], np.int32))
                yield pa.record_batch([*columns, groups, pa.array([r.tobytes() for r in own], pa.binary())], names=["row", "vec_id", "label", "bits", "groups", "planes"])

    return common.map_batches(vectors, work, "row long, vec_id long, label int, bits int, groups int, planes binary")


def mine(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows
    (vec_id, label, v: array<long>)."""
    clean = rows.where("vec_id is not null and label is not null and v is not null")
    clean = clean.withColumns({"anchor": F.coalesce(is_anchor, F.lit(False)), "row": F.monotonically_increasing_id()})
    clean = common.stored(clean, "vectors")
    spark = clean.sparkSession
    widest = F.greatest(F.array_max("v"), -F.array_min("v"))
    width, most, queries = clean.agg(F.max(F.size("v")), F.max(widest), F.count_if("anchor")).first()
    width, most = max(width or 0, 1), max(most or 0, 1)
    bits = int(most).bit_length() + 1
    candidates = common.stored(packed(clean.select("row", "vec_id", "label", F.lit(bits).alias("bits"), "v"), width), "planes")
    most_rows = max(min(BLOCK, COMPONENTS // width), 1)
    blocks = -(-2 * (queries or 0) // most_rows)
    # dealt by hash to blocks of half the size; a block above the size is cut further below
    asked = clean.where("anchor").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1))).cast("int"))
    asked = common.stored(asked.repartition("block").sortWithinPartitions("block"), "anchors")
    out = common.scratch_path(spark, "mined")
    spark.createDataFrame([], MINED).write.parquet(out)
    for number in range(blocks):
        own = asked.where(F.col("block") == number).select("row", "vec_id", "label", "v").toArrow()
        for start in range(0, own.num_rows, most_rows):
            _mine_block(spark, candidates, own.slice(start, most_rows).combine_chunks(), width, most, out)
    return spark.read.schema(MINED).parquet(out)


def _mine_block(spark: SparkSession, candidates: DataFrame, own: pa.Table, width: int, most: int, out: str) -> None:
    """The negatives of one block of anchors, appended to the result."""
    anchors = {c: own[c].to_numpy() for c in ("row", "vec_id", "label")} | {"v": matrix(own["v"].combine_chunks(), width)}
    block = spark.sparkContext.broadcast(anchors)

    def best(work, k: int) -> DataFrame:
        hits = common.map_batches(candidates, work, HITS)
        ranked = Window.partitionBy("slot").orderBy(F.col("score").desc(), "vec_id", "other")
        return hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    # at most POSITIVES rows of four numbers for each anchor of the block
    near = best(positives(block, most, POSITIVES), POSITIVES).select("slot", "other", "vec_id", "score").toArrow()
    place = {r: i for i, r in enumerate(anchors["row"].tolist())}
    owner = np.array([place[r] for r in near["slot"].to_pylist()], np.int64)
    ids, scores = near["vec_id"].to_numpy(), near["score"].to_numpy()
    order = np.lexsort((near["other"].to_numpy(), ids, ~scores, owner))
    owner, ids, scores = owner[order], ids[order], scores[order]
    slots = np.arange(len(owner), dtype=np.int64)
    wanted = spark.sparkContext.broadcast((slots, owner, scores))
    far = best(negatives(block, wanted, most, NEGATIVES), NEGATIVES)
    named = pa.table({"slot": slots, "anchor_id": anchors["vec_id"][owner], "positive_id": ids, "positive_score": scores})
    mined = spark.createDataFrame(named).join(far, "slot")
    mined = mined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    mined.write.mode("append").parquet(out)
    wanted.destroy()
    block.destroy()


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = common.table(spark, folder, "embeddings")
    rows = rows.select("vec_id", label.cast("int").alias("label"), whole_vector(F.col("embedding")).alias("v"))
    return mine(rows, F.col("vec_id") % 50 == 0)
