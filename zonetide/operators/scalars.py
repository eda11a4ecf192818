"""Scalar functions of the analytics, applied to every order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import rupees



def dates(orders: DataFrame) -> DataFrame:
    """Parsing and date parts; text that is no time gives null."""
    text = F.date_format("order_timestamp", "yyyy-MM-dd HH:mm:ss")
    parsed = F.try_to_timestamp(text)
    return orders.select(
        "order_id",
        F.to_date(parsed).alias("order_date"),
        F.hour(parsed).alias("order_hour"),
        F.dayofweek(parsed).alias("day_of_week"),
        F.datediff(F.to_date("delivery_timestamp"), F.to_date(parsed)).alias("days_to_deliver"),
        F.try_to_timestamp(F.concat(F.lit("on "), text)).isNull().cast("int").alias("bad_text"),
    )


def nulls(orders: DataFrame) -> DataFrame:
    value = F.col("order_value_inr")
    return orders.select(
        "order_id",
        F.coalesce(value, F.lit(0.0)).alias("value_or_zero"),
        F.nullif(F.col("discount_inr"), F.lit(0.0)).alias("discount_or_null"),
        (value / F.nullif(F.col("discount_inr"), F.lit(0.0))).alias("value_per_discount"),
    )


def cases(orders: DataFrame) -> DataFrame:
    """Searched CASE: a null condition falls through to the default."""
    value = F.col("order_value_inr")
    band = F.when(value > 100, "high").when(value > 20, "medium").otherwise("low or unknown")
    return orders.select(
        "order_id",
        band.alias("value_band"),
        F.when(F.col("status") != "delivered", F.col("status")).alias("open_status"),
    )


def rounds(orders: DataFrame) -> DataFrame:
    """Half-up rounding, and rounding to a whole number."""
    value = F.col("order_value_inr")
    return orders.select(
        "order_id",
        F.round(value / 3.0, 2).alias("third_r2"),
        F.round(value, 1).alias("value_r1"),
        F.round(value).cast("int").alias("value_int"),
    )


def brounds(orders: DataFrame) -> DataFrame:
    """Half-even rounding."""
    value = F.col("order_value_inr")
    return orders.select(
        "order_id",
        F.bround(value, 1).alias("value_b1"),
        F.bround(F.col("estimated_eta_mins") / 2).cast("bigint").alias("half_eta"),
    )


def caps(orders: DataFrame) -> DataFrame:
    value = F.col("order_value_inr")
    return orders.select(
        "order_id",
        F.least(F.col("surge_multiplier") * 2, F.lit(2.5)).alias("capped_surge"),
        F.greatest(F.coalesce(F.col("eta_overshoot_mins"), F.lit(0)), F.lit(0)).alias("late_mins"),
        F.abs(value - 50.0).alias("distance_to_50"),
    )


def strings(orders: DataFrame) -> DataFrame:
    """Concatenation with a number, where null gives null, and thousands separators."""
    return orders.select(
        "order_id",
        F.concat(F.col("zone"), F.lit("@"), F.col("order_hour")).alias("zone_hour"),
        rupees(F.col("estimated_eta_mins") * 1000).alias("eta_label"),
        F.trim(F.concat(F.lit("  "), F.col("payment_mode"), F.lit(" "))).alias("payment_mode"),
    )


def casts(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        F.col("estimated_eta_mins").cast("string").alias("eta_text"),
        F.col("estimated_eta_mins").cast("double").alias("eta_double"),
        F.substring("order_id", 5, 20).try_cast("bigint").alias("order_number"),
        F.col("order_date").cast("string").alias("date_text"),
    )


def arithmetic(orders: DataFrame) -> DataFrame:
    eta, value = F.col("estimated_eta_mins"), F.col("order_value_inr")
    return orders.select(
        "order_id",
        (eta / F.lit(7)).alias("eta_over_7"),
        (-eta).alias("minus_eta"),
        (value * 2 - F.col("discount_inr")).alias("double_net"),
        (eta + F.col("actual_delivery_mins")).alias("eta_sum"),
    )
