"""Data-quality audits and repairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import exact_avg, flag, flag_count
from ..functions.rules import static_period, static_surge
from ..sources.schemas import ARRIVAL, ORDER_STATES, RAW
from .cleaning import is_blank


def audit(orders: DataFrame) -> DataFrame:
    """Counts of known defects in one pass over the raw orders.

    Null ids count as one id, as ``dropDuplicates`` has it.
    """
    ids = F.count_distinct("order_id") + F.max(F.col("order_id").isNull().cast("int"))
    totals = orders.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count(F.lit(1)) - ids).alias("dup"),
        flag_count(is_blank("zone")).alias("zone"),
        flag_count(is_blank("partner_id")).alias("partner"),
        flag_count(F.col("order_value_inr").isNull()).alias("value"),
    )
    lines = [
        ("Total rows", "total"),
        ("Duplicate order_ids", "dup"),
        ("Missing zone", "zone"),
        ("Missing partner_id", "partner"),
        ("Missing order_value", "value"),
    ]
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("metric"), F.col(c).cast("bigint").alias("count"))
            for label, c in lines
        ]
    )
    return totals.select("total", F.inline(rows)).select(
        "metric", "count", (F.col("count") / F.nullif("total", F.lit(0)) * 100.0).alias("percentage")
    )


def remaining_null_zones(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        flag_count(F.col("zone").isNull()).alias("remaining_null_zones"),
    )


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per group and value; nulls of ``value`` are left out."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n")
    )


def exact_medians(
    counts: DataFrame, keys: list[str], value: str, bucket: float = 1.0
) -> DataFrame:
    """Exact median per group from ``value_counts``, without gathering a group in one task.

    A running count over buckets of width ``bucket`` finds the one or two buckets that
    hold the middle ranks, and only their values are ranked.  With two-decimal prices a
    bucket of width 1 has at most 100 values, and the bucket count is the price range.
    """
    hist = counts.withColumn("_b", F.floor(F.col(value) / bucket))
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lo_rank = F.expr("(_total + 1) div 2")
    hi_rank = F.expr("(_total + 2) div 2")
    middle = (
        hist.groupBy(*keys, "_b")
        .agg(F.sum("n").alias("_bn"))
        .withColumns({"_cum": F.sum("_bn").over(upto), "_total": F.sum("_bn").over(group)})
        .filter((F.col("_cum") >= lo_rank) & (F.col("_cum") - F.col("_bn") < hi_rank))
        .select(*keys, "_b", "_total", (F.col("_cum") - F.col("_bn")).alias("_below"))
    )
    inside = (
        Window.partitionBy(*keys, "_b")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = hist.join(middle, [*keys, "_b"]).withColumn(
        "_rank", F.col("_below") + F.sum("n").over(inside)
    )
    lo = F.min(F.when(F.col("_rank") >= lo_rank, F.col(value)))
    hi = F.min(F.when(F.col("_rank") >= hi_rank, F.col(value)))
    return ranked.groupBy(*keys).agg(((lo + hi) / 2.0).alias("median"))


def _lazy(name: str, df: DataFrame) -> DataFrame:
    return df


def impute_order_value(
    orders: DataFrame,
    restaurants: DataFrame,
    keep: Callable[[str, DataFrame], DataFrame] = _lazy,
) -> DataFrame:
    """Missing order values become the zone and cuisine median, else the overall median.

    One pass over the orders gives the value counts both medians come from.  ``keep``
    may write the counts and medians, which are small, so they are made once and the
    final join sees their real size.
    """
    group, value = ["zone", "cuisine_type"], "order_value_inr"
    cuisine = (
        restaurants.filter(F.col("restaurant_id").isNotNull())
        .groupBy("restaurant_id")
        .agg(F.min("cuisine_type").alias("cuisine_type"))
    )
    known = orders.join(cuisine, "restaurant_id", "left")
    counts = keep("order_value_counts", value_counts(known, group, value))
    named = counts.filter(F.col("zone").isNotNull() & F.col("cuisine_type").isNotNull())
    by_group = keep("order_value_medians", exact_medians(named, group, value))
    total = counts.groupBy(F.lit(0).alias("_all"), value).agg(F.sum("n").alias("n"))
    overall = exact_medians(total, ["_all"], value).select("median")
    return (
        known.join(by_group, group, "left")
        .withColumn("value_imputed", flag(F.col(value).isNull()))
        .withColumn(value, F.coalesce(value, "median", overall.scalar()))
        .select(*orders.columns, "cuisine_type", "value_imputed")
    )


def exclude_missing_value(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_value_inr").isNotNull())


def flag_late_rows(
    orders: DataFrame, seq: str = ARRIVAL, ts: str = "order_timestamp", block: int = 1 << 20
) -> DataFrame:
    """``is_late`` = 1 when an earlier arrival carries a later timestamp.

    A running maximum over the whole load would need one task.  Instead copies of a
    sequence number collapse to their maximum, the running maximum is taken inside
    blocks of ``block`` numbers, and a second running maximum over one row per block
    carries the state from block to block.  Rows without a number are never late.
    """
    block_of = F.expr(f"{seq} div {block}")
    before = (Window.unboundedPreceding, -1)
    arrivals = orders.groupBy(seq).agg(F.max(ts).alias("_ts")).withColumn("_block", block_of)
    in_block = Window.partitionBy("_block").orderBy(seq).rowsBetween(*before)
    # One row per block: rows / 2**20, about 200 thousand for 200 billion orders.
    over_blocks = Window.orderBy("_block").rowsBetween(*before)
    carried = (
        orders.groupBy(block_of.alias("_block"))
        .agg(F.max(ts).alias("_block_ts"))
        .select("_block", F.max("_block_ts").over(over_blocks).alias("_carried"))
    )
    high_water = (
        arrivals.withColumn("_inside", F.max("_ts").over(in_block))
        .join(carried, "_block")
        .select(seq, F.greatest("_inside", "_carried").alias("_seen"))
    )
    return (
        orders.join(high_water, seq, "left")
        .withColumn("is_late", flag(F.col(ts) < F.col("_seen")))
        .select(*orders.columns, "is_late")
    )


def surge_consistency(orders: DataFrame) -> DataFrame:
    """Applied surge against the static table, per period and flags."""
    expected = static_surge("order_hour", "rain_at_order_time", "event_active")
    return (
        orders.withColumns({"period": static_period("order_hour"), "expected_surge": expected})
        .groupBy("period", "rain_at_order_time", "event_active", "expected_surge")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            flag_count(F.col("surge_multiplier") == F.col("expected_surge")).alias("consistent"),
            flag_count(F.col("surge_multiplier") < F.col("expected_surge")).alias("too_low"),
            flag_count(F.col("surge_multiplier") > F.col("expected_surge")).alias("too_high"),
            F.round(exact_avg("surge_multiplier"), 2).alias("avg_applied_surge"),
        )
    )


def orphans(orders: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Keys of the orders that the master does not have.

    Orders collapse to one row per key before the join.
    """
    used = orders.filter(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key)
    return (
        used.agg(F.count(F.lit(1)).alias("_n"))
        .join(master.select(key), key, "left_anti")
        .agg(
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphan_orders"),
        )
        .select(F.lit(key).alias("foreign_key"), "orphan_keys", "orphan_orders")
    )


def duplicate_keys(master: DataFrame, key: str) -> DataFrame:
    """Keys that a master table lists more than once; empty when the key is unique."""
    counted = master.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > 1)


def fk_orphans(orders: DataFrame, restaurants: DataFrame, partners: DataFrame) -> DataFrame:
    return orphans(orders, restaurants, "restaurant_id").unionByName(
        orphans(orders, partners, "partner_id")
    )


#: Columns a row cannot do without, by raw input.
KEYS = {
    "orders": ("order_id",),
    "restaurants": ("restaurant_id",),
    "delivery_partners": ("partner_id",),
    "weather_hourly": ("timestamp", "zone"),
    "local_events": ("event_id",),
}


def _reasons(table: str) -> Column:
    typed = [f for f in RAW[table].fields if f.dataType.simpleString() != "string"]
    checks = [F.when(is_blank(key), f"missing {key}") for key in KEYS[table]]
    checks += [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
            f"bad {f.name}",
        )
        for f in typed
    ]
    if table == "orders":
        checks.append(F.when(~F.col("status").isin(*ORDER_STATES), "unknown status"))
    return F.concat_ws("; ", *checks)


def split_by_schema(text: DataFrame, table: str = "orders") -> tuple[DataFrame, DataFrame]:
    """Typed rows that satisfy the schema of a raw input, and the others with their reasons."""
    judged = text.withColumn("reason", _reasons(table))
    good = judged.filter(F.col("reason") == "")
    fields = RAW[table].fields
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]
    names = {f.name for f in fields}
    extra = [c for c in text.columns if c not in names]
    return good.select(*typed, *extra), judged.filter(F.col("reason") != "")
