"""Raw file readers."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .schemas import ARRIVAL, RAW


def read_raw(spark: SparkSession, path: str, table: str, infer: bool = False) -> DataFrame:
    """CSV with a header row.  Unreadable cells become null.

    ``infer`` costs a second pass over the file and lets the content pick the types.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(RAW[table]).csv(path)


def read_raw_text(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The same file with every column as text, for ``quality.split_by_schema``."""
    text = StructType([StructField(f.name, StringType()) for f in RAW[table].fields])
    return spark.read.option("header", True).schema(text).csv(path)


def number_arrivals(
    rows: DataFrame, keep: Callable[[str, DataFrame], DataFrame], name: str = ARRIVAL, by_time: bool = False
) -> DataFrame:
    """Rows as they were read, with their number ``name`` from 0 in order of arrival: by file
    name (or first by the time of the file), then by place in the file.

    Nothing is sorted.  Reading a split numbers its rows in one go; the rows of all splits
    before are added from one count per split.  ``keep`` writes the rows once, because
    another reading could cut the files otherwise.  ``rows`` must come straight from files.
    """
    place = {
        "_path": F.col("_metadata.file_path"),
        "_start": F.col("_metadata.file_block_start"),
        "_time": F.col("_metadata.file_modification_time"),
        "_row": F.monotonically_increasing_id(),
    }
    written = keep("arrivals", rows.select("*", *(c.alias(n) for n, c in place.items())))
    splits = written.groupBy("_path", "_start").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"), F.min("_time").alias("_time")
    )
    # one row per split of the files, a few hundred thousand for 100 TB
    order = Window.orderBy(*(["_time"] if by_time else []), "_path", "_start")
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("_path", "_start", "_first", before.alias("_before"))
    number = (F.col("_before") + F.col("_row") - F.col("_first")).alias(name)
    return written.drop("_time").join(splits, ["_path", "_start"]).select(*rows.columns, number)


def file_manifest(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Name and size of the landing files.  File contents are never read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", "length")
    )
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.round(F.col("length") / F.lit(1024.0 * 1024.0), 1).alias("size_mb"),
    )


class LandingFiles:
    """The five raw inputs as ``<table>.csv`` files or folders under one landing folder."""

    def __init__(self, spark: SparkSession, folder: str, infer: bool = False):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.infer = infer

    def read(self, table: str, infer: bool = False) -> DataFrame:
        return read_raw(self.spark, f"{self.folder}/{table}.csv", table, infer)

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    def text(self, table: str) -> DataFrame:
        """An input with every column as text, for ``quality.split_by_schema``."""
        return read_raw_text(self.spark, f"{self.folder}/{table}.csv", table)

    @cached_property
    def restaurants(self) -> DataFrame:
        return self.read("restaurants", self.infer)

    @cached_property
    def delivery_partners(self) -> DataFrame:
        return self.read("delivery_partners", self.infer)

    @cached_property
    def weather_hourly(self) -> DataFrame:
        return self.read("weather_hourly", self.infer)

    @cached_property
    def local_events(self) -> DataFrame:
        return self.read("local_events", self.infer)
