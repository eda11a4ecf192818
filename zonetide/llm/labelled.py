"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common


def remainder(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for no id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)).cast("int")


def sample_ids(labels: DataFrame, name: str, per_class: int, held_out: int = 0) -> DataFrame:
    """(doc_id, label): for each label 0 and 1 the ``per_class`` training ids with the
    smallest hashes.  Training ids are those whose remainder is not ``held_out``.

    Rows without id or label are left out; an id with several labels has the smallest.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1) & (remainder(F.col("doc_id")) != held_out))
    known = known.groupBy("doc_id").agg(F.min(name).cast("int").alias("label"))
    order = (F.xxhash64("doc_id"), "doc_id")
    one, zero = (known.where(F.col("label") == k).orderBy(*order).limit(per_class) for k in (1, 0))
    return one.unionByName(zero)


def shares(labels: DataFrame, name: str, held_out: int = 0) -> float:
    """Share of label 1 among all training labels."""
    known = labels.where(F.col(name).isin(0, 1) & (remainder(F.col("doc_id")) != held_out))
    return float(known.agg(F.avg(name)).first()[0] or 0.0)


def sample_texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, label, text) of sampled ids: two short columns for at most twice
    ``per_class`` rows, which is the bound of the broadcast."""
    ids = common.stored(ids, "sample", 1)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
