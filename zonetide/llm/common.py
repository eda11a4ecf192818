"""What the operators share: scratch tables, word splitting, grouped Arrow streams."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words between ASCII white space, as a pattern for Spark's regular expressions.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is (``lower`` would change other scripts)."""
    return F.translate(text, UPPER, UPPER.lower())


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a plain local master, where driver and executors are one process, gets a folder
    of its own if none is set; a cluster without one is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="zonetide-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, so neither a
    lost executor nor a second use computes it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(files) if files else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Remove the files behind a ``stored`` table that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for parent in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)


_shipped: set[str] = set()


def map_batches(df: DataFrame, work: Callable, schema) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the workers once per application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        with tempfile.NamedTemporaryFile(prefix="zonetide-", suffix=".zip", delete=False) as file, zipfile.ZipFile(file, "w") as archive:
            for folder in (package, os.path.join(package, "llm")):
                for name in sorted(os.listdir(folder)):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(file.name)
        _shipped.add(context.applicationId)
    return df.mapInArrow(work, schema)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def spaced_words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case: both bytes methods know
    ASCII only."""
    return utf8(text).lower().split()


def runs(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each key, from batches sorted by the (non-null) keys."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        edges = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            key = tuple(c[start].item() if hasattr(c[start], "item") else c[start] for c in cols)
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)


#: Bits of an id filter: this many for each id, up to a fixed size of 8 MB.
BITS_PER_ID, MOST_BITS, PROBES = 16, 1 << 26, 4


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    """The bits (a power of two many) that stand for each id, by row."""
    x = ids.astype(np.int64).view(np.uint64)[:, None] + np.arange(1, PROBES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & np.uint64(bits - 1)


class IdFilter:
    """A Bloom filter over ids: no id is missed, few others pass.

    Texts of chosen documents are read with it, without shuffling all texts for a join.
    Its size has a fixed bound; with more ids more others pass, and a join on
    what has passed makes the result exact at any size.
    """

    def __init__(self, ids: DataFrame, column: str):
        wanted = max(ids.count() * BITS_PER_ID, 1024)
        bits = min(1 << (wanted - 1).bit_length(), MOST_BITS)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(bits // 64, np.uint64)
            for batch in batches:
                at = _places(batch.column(0).to_numpy(zero_copy_only=False), bits).ravel()
                np.bitwise_or.at(own, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
            words = np.flatnonzero(own)
            yield pa.record_batch([pa.array(words, pa.int64()), pa.array(own[words].view(np.int64))], names=["word", "mask"])

        parts = map_batches(ids.select(column), work, "word long, mask long")
        rows = parts.groupBy("word").agg(F.bit_or("mask").alias("mask")).collect()
        table = np.zeros(bits // 64, np.int64)
        table[[r["word"] for r in rows]] = [r["mask"] for r in rows]
        self.bits = bits
        self.shared = ids.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def passing(self, ids: pa.Array) -> np.ndarray:
        """Boolean by row; null ids don't pass."""
        known = np.array(ids.is_valid())
        at = _places(ids.fill_null(0).to_numpy(zero_copy_only=False), self.bits)
        hit = (self.shared.value[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return known & (hit > 0).all(axis=1)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long, not null): one row (id, component) for
    every id on an edge, the component being its smallest id.

    Alternating large-star and small-star steps: every step joins each id with the smallest
    of its neighbours, in data-parallel joins whose hot ids adaptive execution can split.
    The steps end when the edge list no longer changes, which takes a number of steps
    that is logarithmic in the longest path.
    """
    low, high = F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    now, mark = _marked(edges.where("a <> b").select(high, low).distinct())
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = now.select(F.col("v").alias("u"), F.col("u").alias("far")).join(least, "u")
        large = large.select(F.col("far").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        new, new_mark = _marked(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        drop_stored(now)
        now = new
        if new_mark == mark:
            break
        mark = new_mark
    roots = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges, with a count and a digest of what was written."""
    written = stored(edges, "edges")
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return written, tuple(written.agg(F.count(F.lit(1)), digest).first())
