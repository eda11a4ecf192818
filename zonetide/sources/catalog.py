"""Catalog tables: schemas, replacement in one step, refreshed partitions, comments, counts.

Where the catalog cannot replace a table by itself, a table is an external one over a
*version*: a folder of its own next to the others.  A new version is written whole before
one change of the table's location makes it the current one, so readers find the old or
the new rows, never none.  Partitions of such tables are found in their folder; the catalog
holds no list of them that would have to change too.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_folder

TABLE_COMMENTS = {
    "zone_demand_hourly": "Key: order_date, order_hour, zone, is_weekend. Built from silver.orders_clean; "
    "weather and event columns hold defaults where that hour or day has none.",
    "demand_supply_ratio": "Key: order_date, order_hour, zone, is_weekend. zone_demand_hourly with "
    "partner_availability; ratio columns are null without active partners.",
    "customer_360": "Key: customer_id, null included. Built from silver.orders_clean; money in INR, days in calendar days.",
    "partner_availability": "Key: zone. Built from silver.delivery_partners_clean; counts of partners, not of shifts.",
    "restaurant_performance": "Key: restaurant_id. Restaurants of the master with at least one order; money in INR.",
    "demand_predictions": "Key: zone. Output of the trained model for hour 20 with rain and an event; "
    "rounded half-even; missing partners count as 0.",
}

COLUMN_COMMENTS = {
    ("demand_supply_ratio", "demand_supply_ratio"): "total_orders / active_partners, two digits; null if no partner is active.",
    ("demand_supply_ratio", "recommended_surge"): "Factor on the fee, 1.0 to 3.0, from the unrounded ratio.",
    ("demand_supply_ratio", "partner_rebalance_count"): "Partners, signed: above 0 missing, below 0 spare, 0 between ratios 0.5 and 2.5.",
    ("demand_supply_ratio", "zone_status"): "Text by unrounded ratio: > 3, > 2, > 1, rest (null ratio included).",
    ("zone_demand_hourly", "cancellation_rate_pct"): "100 * total_cancellations / total_orders, one digit.",
    ("zone_demand_hourly", "avg_eta_overshoot"): "Mean of actual minus estimated minutes over delivered orders, one digit.",
}


def use(spark: SparkSession, schema: str | None = None, catalog: str | None = None) -> None:
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    if schema:
        spark.catalog.setCurrentDatabase(schema)


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:s)", args={"s": schema})


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def overwrite_table(
    df: DataFrame, name: str, *, fmt: str = "parquet", partition_by: str | None = None
) -> int:
    """Replace a managed table and return its row count.

    The count comes from the written files' footers: the plan runs once, and rows that a
    repeated task wrote twice before a loss are not counted twice.  Rows are rebalanced
    to even file sizes; a hot partition value is split over several files.
    """
    if partition_by:
        writer = df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by)
    else:
        writer = df.hint("rebalance").write
    writer.mode("overwrite").option("overwriteSchema", True).format(fmt).saveAsTable(name)
    return df.sparkSession.table(name).count()


#: Hours for which a replaced version stays readable for those who started before.
KEEP_HOURS = 24.0


def create_or_replace(
    df: DataFrame, name: str, *, fmt: str = "parquet", partition_by: str | None = None, keep_hours: float = KEEP_HOURS
) -> int:
    """Replace a table in one step and return its row count.

    A failing query leaves the table as it was.  Only the error that says so counts as a
    catalog that cannot replace tables.  A table whose columns change, or that was
    not written by this function, is dropped and created anew.
    """
    spark = df.sparkSession
    writer = df.writeTo(name).using(fmt)
    try:
        (writer.partitionedBy(F.col(partition_by)) if partition_by else writer).createOrReplace()
    except AnalysisException as e:
        if e.getCondition() != "UNSUPPORTED_FEATURE.TABLE_OPERATION":
            raise
        _swap(df, name, fmt, partition_by)
        drop_old_versions(spark, name, keep_hours)
    return spark.table(name).count()


def _versions(spark: SparkSession, name: str) -> str:
    schema, _, table = name.rpartition(".")
    return f"{spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri}/{table}-versions"


def location(spark: SparkSession, name: str) -> str:
    detail = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": name})
    return detail.filter("col_name = 'Location'").first()["data_type"]


@contextmanager
def _partitions_in_folders(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _swap(df: DataFrame, name: str, fmt: str, partition_by: str | None) -> None:
    spark, root = df.sparkSession, _versions(df.sparkSession, name)
    path = f"{root}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if partition_by:
        df.hint("rebalance", F.col(partition_by)).write.partitionBy(partition_by).format(fmt).save(path)
    else:
        df.hint("rebalance").write.format(fmt).save(path)
    there = path.replace("'", "''")
    if _same_shape(df, name, root, partition_by):
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION '{there}'", args={"t": name})
        spark.catalog.refreshTable(name)
        return
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    with _partitions_in_folders(spark):
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})
        spark.sql(f"CREATE TABLE IDENTIFIER(:t) ({columns}) USING {fmt} {parts} LOCATION '{there}'", args={"t": name})


def _same_shape(df: DataFrame, name: str, root: str, partition_by: str | None) -> bool:
    spark = df.sparkSession
    if not spark.catalog.tableExists(name) or not _plain(location(spark, name)).startswith(_plain(root)):
        return False
    has = {(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(name)}
    return has == {(f.name, f.dataType.simpleString(), f.name == partition_by) for f in df.schema.fields}


def _plain(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def drop_old_versions(spark: SparkSession, name: str, keep_hours: float = KEEP_HOURS) -> None:
    """Remove versions that a newer, complete one replaced over ``keep_hours`` ago."""
    jvm, root = spark.sparkContext._jvm, _versions(spark, name)
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = sorted(f.getPath().getName() for f in fs.listStatus(path))
    current = location(spark, name).rstrip("/").rpartition("/")[2]
    done = [f for f in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root}/{f}/_SUCCESS"))]
    limit = time.time_ns() - int(keep_hours * 3600e9)
    for folder in folders:
        newer = [f for f in done if f > folder]
        if folder != current and newer and int(newer[0].partition("-")[0]) < limit:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}"), True)


def overwrite_partitions(df: DataFrame, name: str, column: str, touched: DataFrame, *, fmt: str = "parquet") -> None:
    """Replace the partitions ``touched`` (one column, each value once) of a table by ``df``,
    which must not read from it.  Other partitions keep their files; a touched one without
    rows in ``df`` goes.  Readers may see some partitions new and others old meanwhile."""
    spark, path = df.sparkSession, location(df.sparkSession, name)
    even = df.hint("rebalance", F.col(column)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    even.partitionBy(column).format(fmt).save(path)
    filled = df.select(F.col(column).alias("_filled")).distinct()
    gone = touched.join(filled, F.col(column).eqNullSafe(F.col("_filled")), "left_anti")
    for row in gone.collect():
        value = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else row[0]
        delete_folder(spark, f"{path}/{column}={value}")
    spark.catalog.refreshTable(name)


def scalar(df: DataFrame):
    """First value of a one-row result."""
    return df.first()[0]


def comment_table(spark: SparkSession, name: str, text: str) -> None:
    spark.sql("COMMENT ON TABLE IDENTIFIER(:t) IS '" + text.replace("'", "''") + "'", args={"t": name})


def comment_column(spark: SparkSession, name: str, column: str, text: str) -> None:
    spark.sql(
        f"ALTER TABLE IDENTIFIER(:t) ALTER COLUMN `{column}` COMMENT '" + text.replace("'", "''") + "'",
        args={"t": name},
    )


def comment_gold(spark: SparkSession, schema: str) -> None:
    """Describe every analytic table that exists in ``schema``."""
    for table, text in TABLE_COMMENTS.items():
        if spark.catalog.tableExists(f"{schema}.{table}"):
            comment_table(spark, f"{schema}.{table}", text)
    for (table, column), text in COLUMN_COMMENTS.items():
        if spark.catalog.tableExists(f"{schema}.{table}"):
            comment_column(spark, f"{schema}.{table}", column, text)


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
