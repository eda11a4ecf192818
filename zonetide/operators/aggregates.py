"""Aggregate and filter forms used across the analytics, one at a time, over all orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import (
    LATE_NIGHT_FROM,
    LATE_NIGHT_TO,
    LUNCH_HOURS,
    WEEKEND_DAYS,
)
from ..functions.measures import exact_avg, percent


def count_variants(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("partner_id").alias("with_partner"),
        F.count("order_value_inr").alias("with_value"),
    )


def multi_distinct(orders: DataFrame) -> DataFrame:
    return orders.groupBy("zone").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_distinct("restaurant_id").alias("restaurants"),
        F.count_distinct("partner_id").alias("partners"),
    )


def sum_flags(orders: DataFrame) -> DataFrame:
    flags = ["is_cancelled", "is_weekend", "is_lunch_hour", "is_dinner_hour", "is_late_night"]
    return orders.groupBy("zone").agg(*[F.sum(c).alias(f"sum_{c}") for c in flags])


def avg_rounded(orders: DataFrame) -> DataFrame:
    return orders.groupBy("payment_mode").agg(
        F.round(exact_avg("order_value_inr"), 2).alias("avg_order_value"),
        F.round(F.avg("actual_delivery_mins"), 1).alias("avg_delivery_mins"),
        F.round(F.avg("eta_overshoot_mins"), 1).alias("avg_eta_overshoot"),
    )


def minmax_types(orders: DataFrame) -> DataFrame:
    """Extremes of a number, a date and a string; strings compare byte by byte.

    Spark sorts its input to aggregate strings, so the string is a group key first: the
    orders are hash-aggregated and only one row per zone and status is sorted.
    """
    ends = {"min": F.min, "max": F.max}
    fixed = {"value": "order_value_inr", "date": "order_date"}
    per_status = orders.groupBy("zone", "status").agg(
        *[f(c).alias(f"{e}_{n}") for n, c in fixed.items() for e, f in ends.items()]
    )
    return per_status.groupBy("zone").agg(
        *[f(f"{e}_{n}").alias(f"{e}_{n}") for n in fixed for e, f in ends.items()],
        *[f("status").alias(f"{e}_status") for e, f in ends.items()],
    )


def cancel_pct(orders: DataFrame) -> DataFrame:
    return orders.groupBy("zone").agg(
        percent(F.sum("is_cancelled"), F.count(F.lit(1))).alias("cancel_rate_pct")
    )


def in_lunch_hours(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_hour").between(*LUNCH_HOURS))


def on_weekend(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("day_of_week").isin(*WEEKEND_DAYS))


def at_late_night(orders: DataFrame) -> DataFrame:
    hour = F.col("order_hour")
    return orders.filter((hour >= LATE_NIGHT_FROM) | (hour <= LATE_NIGHT_TO))
