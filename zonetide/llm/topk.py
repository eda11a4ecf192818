"""Exact top-k search by inner product: ball trees per shard, branch and bound.

Candidates are dealt to shards of about ``shard_rows`` by a hash of their id, queries to
blocks of about ``block_rows``.  A task works on one (shard, block) pair at a time: it
builds a ball tree over the shard and takes the block's queries down it together.  By
Cauchy-Schwarz no point of a ball scores more than q.centre + |q| * radius, so children
are only opened where that bound reaches the query's kth score so far; leaves are then
visited in order of falling bound, and a query is finished when the next bound is lower.

The kth score is shared between shards: the first round searches each query in its own
home shard, the next ones in ``GROWTH`` times as many shards each.  The kth score found so
far is a lower limit of the final one; it prunes the shards of a round, and what they hand
on.  Ties are kept (a node is only skipped when its bound is
below the kth score) and go to the smaller id.

Scores are integers: components become floor(scale * x).  Sums of products below 2^53 are
computed in exact floating point, others in 64-bit integers; a score must fit a long.

Defined results: vectors that are null or hold null or non-finite components, and rows
without an id, take no part; an empty vector scores 0 with all; shorter vectors count as
filled up with zeros; rows that repeat an id count once, with the smallest vector;
fewer candidates than k give fewer rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SCALE = 64
K = 20
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS, GROWTH = 2048, 1024, 128, 4
HITS = "query_id long, vec_id long, score long"
NONE = np.iinfo(np.int64).min


def whole_vector(vector: Column) -> Column:
    """floor(SCALE * x) of every component, or null for a vector that takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE)))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


class BallTree:
    """A balanced tree: level by level the centres and radii of 2^level balls."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.leaves = [np.arange(len(points))]
        while True:
            centres = np.stack([points[i].mean(axis=0) for i in self.leaves])
            radii = np.array([np.sqrt(((points[i] - c) ** 2).sum(axis=1).max()) for i, c in zip(self.leaves, centres, strict=True)])
            self.levels.append((centres, radii))
            if max(map(len, self.leaves)) <= leaf_rows:
                return
            self.leaves = [half for i in self.leaves for half in self._halves(points, i)]

    @staticmethod
    def _halves(points: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Split at the median along the line between two far points."""
        own = points[rows]
        one = own[((own - own.mean(axis=0)) ** 2).sum(axis=1).argmax()]
        other = own[((own - one) ** 2).sum(axis=1).argmax()]
        along = np.argsort(own @ (other - one), kind="stable")
        return rows[along[: len(rows) // 2]], rows[along[len(rows) // 2 :]]

    def bounds(self, queries: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Upper bound of each query in each leaf; -inf below a node under ``least``."""
        norms = np.sqrt((queries**2).sum(axis=1))[:, None]
        alive = np.ones((len(queries), 1), bool)
        for level, (centres, radii) in enumerate(self.levels):
            alive = np.repeat(alive, 2, axis=1) if level else alive
            # the slack covers rounding of centres and radii
            size = np.sqrt((centres**2).sum(axis=1)) + radii
            bound = queries @ centres.T + norms * radii + 1e-9 * norms * size + 1e-6
            alive &= bound >= least[:, None]
        return np.where(alive, bound, -np.inf)


def search(points, ids, queries, query_ids, floor, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (scores, ids) of each query at or above its ``floor``; NONE where fewer."""
    reach = max(np.abs(points).max(initial=0), np.abs(queries).max(initial=0))
    exact = float if points.shape[1] * float(reach) ** 2 < 2**52 else np.int64
    tree = BallTree(points.astype(float))
    bound = tree.bounds(queries.astype(float), floor.astype(float))
    points, queries = points.astype(exact), queries.astype(exact)
    order = np.argsort(-bound, axis=1, kind="stable")
    scores = np.full((len(queries), k), NONE)
    found = np.full((len(queries), k), np.iinfo(np.int64).max)
    for step in range(bound.shape[1]):
        leaf = order[:, step]
        kth = np.maximum(scores[:, -1], floor)
        active = np.flatnonzero(bound[np.arange(len(queries)), leaf] >= np.maximum(kth, -2.0**62))
        if not len(active):
            break
        for node in np.unique(leaf[active]):
            asked = active[leaf[active] == node]
            rows = tree.leaves[node]
            got = (queries[asked] @ points[rows].T).astype(np.int64)
            hit = (got >= kth[asked, None]) & (ids[rows] != query_ids[asked, None])
            some = hit.any(axis=1)
            asked, got, hit = asked[some], got[some], hit[some]
            if not len(asked):
                continue
            most = min(hit.sum(axis=1).max(), hit.shape[1])
            # hits first, so that the merge sorts few columns
            front = np.argsort(~hit, axis=1, kind="stable")[:, :most]
            got = np.take_along_axis(np.where(hit, got, NONE), front, axis=1)
            new_ids = np.where(got == NONE, np.iinfo(np.int64).max, ids[rows][front])
            all_scores = np.concatenate([scores[asked], got], axis=1)
            all_ids = np.concatenate([found[asked], new_ids], axis=1)
            # ascending keys: ~score falls as score rises and cannot overflow
            best = np.lexsort((all_ids, ~all_scores), axis=1)[:, :k]
            scores[asked] = np.take_along_axis(all_scores, best, axis=1)
            found[asked] = np.take_along_axis(all_ids, best, axis=1)
    return scores, found


def _search_pairs(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in common.runs(batches, ("shard", "block")):
            asked = rows["asked"].to_numpy()
            width = int(rows["width"][0].as_py())
            vectors, ids = matrix(rows["v"], width), rows["vec_id"].to_numpy()
            floor = rows["floor"].to_numpy()
            # in the first round the rows of a shard are asked and searched at once
            own = rows["searched"].to_numpy()
            if not asked.any() or not own.any():
                continue
            queries = ids[asked]
            scores, found = search(vectors[own], ids[own], vectors[asked], queries, floor[asked], k)
            at, col = np.nonzero(scores != NONE)
            yield pa.record_batch([pa.array(queries[at]), pa.array(found[at, col]), pa.array(scores[at, col])], names=["query_id", "vec_id", "score"])

    return work


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for (vec_id, v: array<long>) and the rows asked."""
    clean = vectors.where("vec_id is not null and v is not null").groupBy("vec_id").agg(F.min("v").alias("v"))
    clean = common.stored(clean.withColumn("asked", F.coalesce(is_query, F.lit(False))), "vectors")
    total, queries, width = clean.agg(F.count(F.lit(1)), F.count_if("asked"), F.max(F.size("v"))).first()
    shards, blocks = -(-total // SHARD_ROWS) or 1, -(-queries // BLOCK_ROWS) or 1
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    rows = clean.withColumns({"width": F.lit(max(width or 0, 1)), "home": shard})
    nothing = F.lit(int(NONE)).cast("long")
    fields = ("shard", "block", "vec_id", "v", "width", "asked", "searched", "floor")

    def run(pairs: DataFrame) -> DataFrame:
        sorted_pairs = pairs.select(*fields).repartition("shard", "block").sortWithinPartitions("shard", "block")
        return common.map_batches(sorted_pairs, _search_pairs(k), HITS)

    def best(hits: DataFrame) -> DataFrame:
        ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        return common.stored(hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), "best")

    home = rows.withColumns({"shard": F.col("home"), "block": F.lit(0), "searched": F.lit(True), "floor": nothing})
    found = best(run(home))
    searched = rows.withColumns({"shard": F.col("home"), "asked": F.lit(False), "searched": F.lit(True), "floor": nothing})
    searched = searched.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    start = 1
    while start < shards:
        end = min(start * GROWTH, shards)
        limits = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor"))
        asked = rows.where("asked").join(limits, "vec_id", "left")
        asked = asked.withColumns({"floor": F.coalesce("floor", nothing), "block": block, "searched": F.lit(False)})
        asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(start), F.lit(end - 1))))
        asked = asked.withColumn("shard", ((F.col("home") + F.col("shard")) % shards).cast("int"))
        found = best(found.drop("rank").unionByName(run(asked.select(*fields).unionByName(searched.select(*fields)))))
        start = end
    return found.select("query_id", "rank", "vec_id", "score")


def op10_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.table(spark, folder, "embeddings").select("vec_id", whole_vector(F.col("embedding")).alias("v"))
    return top_k(rows, F.col("vec_id") % 20 == 0)
