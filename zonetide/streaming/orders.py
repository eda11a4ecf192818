"""Order stream: watermark, dedup, windowed demand, live zone status, late rows.

Streams run with ``availableNow``: they read what is there, advance the watermark and
stop.  Results go to files, never to driver memory; state and progress live in the
checkpoint folder, so a restarted run continues where the last one ended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from ..functions import rules
from ..functions.measures import exact_sum, flag
from ..operators.cleaning import backfill_zone
from ..session import exists
from ..sources import catalog

EVENT_TIME = "order_timestamp"
DELAY = "4 hours"


def read_orders(
    spark: SparkSession,
    path: str,
    schema: StructType,
    delay: str = DELAY,
    files_per_batch: int | None = None,
) -> DataFrame:
    """File stream of orders with a watermark on the order time.

    Rows later than ``delay`` behind the newest event are dropped by the operators
    downstream.  A stream has one watermark, so it is set here and nowhere else.  The
    order time must be ``timestamp``, not ``timestamp_ntz``.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withWatermark(EVENT_TIME, delay)


def dedup(orders: DataFrame, *, spread: bool = True) -> DataFrame:
    """First arrival of every order id.  Copies must arrive within the delay.

    Streaming dedup sends all copies of an id to one task.  With ``spread`` the copies
    are first reduced per id and input partition, so that one much-repeated id reaches
    the final step as one row per partition.  This costs a second shuffle and state.
    """
    known = orders.filter(F.col("order_id").isNotNull())
    if spread:
        known = (
            known.withColumn("_part", F.spark_partition_id())
            .dropDuplicatesWithinWatermark(["order_id", "_part"])
            .drop("_part")
        )
    return known.dropDuplicatesWithinWatermark(["order_id"])


def _windowed(orders: DataFrame, *window: str) -> DataFrame:
    w = F.window(EVENT_TIME, *window)
    counted = orders.groupBy(w.alias("w"), "zone").agg(
        F.count("order_id").alias("total_orders"),
        F.sum(flag(F.col("status") == "cancelled")).alias("total_cancellations"),
        exact_sum("order_value_inr").alias("order_value"),
    )
    return counted.select(
        "zone",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "total_orders",
        "total_cancellations",
        "order_value",
    )


def hourly_demand(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Arrived rows per zone and hour; missing zones come from the static master.

    Put ``dedup`` in front where copies must not count.
    """
    return _windowed(backfill_zone(orders, restaurants), "1 hour")


def velocity(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Orders of the last 60 minutes, every 10 minutes, per zone."""
    return _windowed(backfill_zone(orders, restaurants), "60 minutes", "10 minutes").select(
        "zone", "window_start", "window_end", "total_orders"
    )


#: Sketches keep 2^12 registers; the standard error of their estimates is 1.04 / 2^6.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def hourly_uniques(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Sketches of the customers and restaurants of every zone and hour.

    An exact distinct count of a stream holds every value of every open window as state, and
    counts of hours cannot be added up to days.  A sketch is 4 kB at most and merges:
    ``uniques`` rolls stored hours up to any period.  Copies of an order change nothing.
    """
    placed = backfill_zone(orders, restaurants)
    hours = placed.groupBy(F.window(EVENT_TIME, "1 hour").alias("w"), "zone").agg(
        F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("customers"),
        F.hll_sketch_agg("restaurant_id", SKETCH_BITS).alias("restaurants"),
    )
    return hours.select("zone", F.col("w.start").alias("window_start"), "customers", "restaurants")


def uniques(hours: DataFrame, *by: Column | str) -> DataFrame:
    """Estimated distinct customers and restaurants, of sketched hours merged by ``by``."""
    merged = hours.groupBy(*by)
    return merged.agg(
        F.count_distinct("window_start").alias("hours"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("unique_customers"),
        F.hll_sketch_estimate(F.hll_union_agg("restaurants")).alias("active_restaurants"),
    )


def enriched_status(hourly: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """``zone_status`` with the weather of the hour and the strongest event of the day."""
    weather = dims["weather_clean"].groupBy(
        "zone", F.date_trunc("hour", "timestamp").alias("window_start")
    ).agg(F.max("is_rainy").alias("is_rainy"), F.min("condition").alias("condition"))
    events = dims["local_events_clean"].groupBy("zone", F.col("date").alias("_day")).agg(
        F.max(F.struct("demand_multiplier", "event_name")).alias("_event")
    )
    status = zone_status(hourly, dims["partner_availability"]).withColumn("_day", F.to_date("window_start"))
    joined = status.join(weather, ["zone", "window_start"], "left").join(events, ["zone", "_day"], "left")
    return joined.select(
        *[c for c in status.columns if c != "_day"],
        F.coalesce("is_rainy", F.lit(0)).alias("is_rainy"),
        "condition",
        F.coalesce(F.col("_event.event_name"), F.lit("None")).alias("event_name"),
        F.coalesce(F.col("_event.demand_multiplier"), F.lit(1.0)).alias("demand_multiplier"),
    )


def zone_status(hourly: DataFrame, availability: DataFrame) -> DataFrame:
    """Ratio, status, surge and alert of finished zone-hours."""
    supply = availability.select("zone", "active_partners")
    r = F.col("_r")
    return (
        hourly.join(supply, "zone", "left")
        .withColumn("_r", rules.ratio("total_orders", "active_partners"))
        .select(
            "zone",
            "window_start",
            "total_orders",
            "active_partners",
            F.round(r, 2).alias("demand_supply_ratio"),
            rules.zone_status(r).alias("zone_status"),
            rules.recommended_surge(r).alias("recommended_surge"),
            flag(F.col("total_orders") > 2 * F.coalesce("active_partners", F.lit(0))).alias(
                "is_alert"
            ),
        )
    )


@contextmanager
def state_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Shuffle width of streams started inside; a stream keeps it for its lifetime."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_to_files(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to parquet files, exactly once."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_batches(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Apply a batch transform to every micro-batch and write it under its batch id.

    A repeated batch replaces its own folder, so a retry does not duplicate rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_with_dimensions(
    stream: DataFrame,
    transform: Callable[[DataFrame, dict[str, DataFrame]], DataFrame],
    dimensions: dict[str, str],
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """``run_batches`` with dimension tables as they are when a batch starts.

    dimensions  name -> table that ``catalog.create_or_replace`` writes

    The version of every dimension is noted before the batch works with it, under the
    batch id, and a batch that runs again after a loss takes the noted ones: a version stays
    readable for ``catalog.KEEP_HOURS`` after it is replaced.  Rows carry the versions they
    were made with in ``dimensions``, a map.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        note = f"{out}/versions/batch={batch_id}"
        if not exists(spark, note):
            rows = [(name, catalog.location(spark, table)) for name, table in dimensions.items()]
            spark.createDataFrame(rows, "name string, path string").coalesce(1).write.parquet(note)
        paths = {r["name"]: r["path"] for r in spark.read.parquet(note).collect()}
        schemas = {name: spark.table(table).schema for name, table in dimensions.items()}
        dims = {name: spark.read.schema(schemas[name]).parquet(path) for name, path in paths.items()}
        versions = F.create_map(*(F.lit(x) for n, p in paths.items() for x in (n, p.rstrip("/").rpartition("/")[2])))
        rows = transform(batch, dims).withColumn("dimensions", versions)
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    query = (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def land(delivery: DataFrame, folder: str, number: int) -> None:
    """Put a delivery into the landing folder; a repeated one replaces itself."""
    delivery.write.mode("overwrite").parquet(f"{folder}/delivery-{number:06d}")


def run_deliveries(
    feed: DataFrame, number: str, folder: str, run: Callable[[str], StreamingQuery]
) -> list[StreamingQuery]:
    """Land the deliveries of ``feed`` one after the other, running the stream after each.

    ``run`` gets the path to read and continues from its own checkpoint, as a job does
    that is started whenever something has arrived.  All files of a delivery are one
    batch, however many there are and whatever times the store gives them.
    """
    found = [r[0] for r in feed.select(number).distinct().sort(number).collect()]
    runs = []
    for n in found:
        land(feed.filter(F.col(number) == n).drop(number), folder, n)
        runs.append(run(f"{folder}/*"))
    return runs


def run_with_late_rows(stream: DataFrame, out: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """Write every row under its batch, the late ones apart: ``late_rows`` reads them back.

    The watermark of a batch is the newest order time of all batches before, less ``delay``,
    which is what the stateful operators use; a row at or below it is late.  The newest time
    so far is kept next to the rows of each batch, so it survives a restart, and a repeated
    batch finds the mark of the batch before and replaces its own rows.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        own = f"batch={batch_id}"
        before = F.lit(None).cast("timestamp")
        if batch_id:
            mark = spark.read.parquet(f"{out}/marks/batch={batch_id - 1}").first()
            before = F.lit(mark["newest"]).cast("timestamp")
        # watermarks have milliseconds
        watermark = F.date_trunc("millisecond", before) - F.expr(f"interval {delay}")
        late = F.coalesce(F.col(EVENT_TIME) <= watermark, F.lit(False))
        rows = batch.withColumns({"watermark": watermark, "is_late": flag(late)})
        rows.write.mode("overwrite").partitionBy("is_late").parquet(f"{out}/rows/{own}")
        written = spark.read.schema(rows.schema).parquet(f"{out}/rows/{own}")
        newest = F.greatest(F.max(EVENT_TIME), before).alias("newest")
        written.agg(newest).write.mode("overwrite").parquet(f"{out}/marks/{own}")

    query = (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def late_rows(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """All rows of ``run_with_late_rows`` with their batch, its watermark and ``is_late``;
    kept and late rows together are the input."""
    extra = {"watermark": TimestampType(), "batch": IntegerType(), "is_late": IntegerType()}
    fields = [*schema.fields, *(StructField(name, kind) for name, kind in extra.items())]
    return spark.read.schema(StructType(fields)).parquet(f"{out}/rows")


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows the watermark rejected, over all batches kept in the progress log."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for op in progress["stateOperators"]
    )
