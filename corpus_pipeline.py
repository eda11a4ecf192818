"""A training corpus from raw documents, in five stages that each work on what the one
before has kept.  ``run`` writes every stage as Parquet to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonetide.llm import common, decontaminate, mixing, neardup, quality, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, common.table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_first(docs, width=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, ``repetition`` counting from 1."""
    return mixing.repeat_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# The first two stages are trained models, which SQL cannot express; tests compare the
# stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
