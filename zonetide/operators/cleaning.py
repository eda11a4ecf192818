"""Typed, deduplicated and repaired tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import RAINY_CONDITIONS, calendar_columns
from ..functions.measures import flag
from ..sources.schemas import ORDERS

ORDER_COLUMNS = [
    *ORDERS.names,
    "partner_status",
    "order_date",
    "order_hour",
    "day_of_week",
    "is_weekend",
    "is_lunch_hour",
    "is_dinner_hour",
    "is_late_night",
    "eta_overshoot_mins",
    "is_cancelled",
    "net_order_value",
]


def is_blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def first_per_key(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """First row of every non-null key.

    Ranking stays next to its filter, so Spark keeps one row per key and map task
    before the shuffle: copies of one key never travel, however many there are.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return (
        df.filter(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedup_orders(orders: DataFrame) -> DataFrame:
    """Earliest row per order.  Rows without an id belong to the quarantine.

    Rows with a timestamp beat rows without; a digest of the row breaks ties.
    """
    digest = F.xxhash64(*[F.col(c) for c in ORDERS.names])
    return first_per_key(orders, "order_id", F.asc_nulls_last("order_timestamp"), digest)


def master_zones(restaurants: DataFrame) -> DataFrame:
    """One zone per restaurant, so that a lookup cannot multiply orders."""
    return (
        restaurants.filter(F.col("restaurant_id").isNotNull())
        .groupBy("restaurant_id")
        .agg(F.min("zone").alias("_master_zone"))
    )


def backfill_zone(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Missing zones come from the restaurant master.

    One join, whatever the size of the master: Spark broadcasts it if it is measured to
    be small, and otherwise splits a hot restaurant's orders.
    """
    own = F.when(~is_blank("zone"), F.col("zone"))
    return (
        orders.join(master_zones(restaurants), "restaurant_id", "left")
        .withColumn("zone", F.coalesce(own, "_master_zone"))
        .select(*orders.columns)
    )


def with_partner_status(orders: DataFrame) -> DataFrame:
    status = F.when(is_blank("partner_id"), "unassigned").otherwise("assigned")
    return orders.withColumn("partner_status", status)


def with_calendar(orders: DataFrame) -> DataFrame:
    return orders.withColumns(calendar_columns("order_timestamp"))


def with_order_measures(orders: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    return orders.withColumns(
        {
            "eta_overshoot_mins": F.col("actual_delivery_mins") - F.col("estimated_eta_mins"),
            "is_cancelled": flag(F.col("status") == "cancelled"),
            "net_order_value": F.coalesce("order_value_inr", zero)
            - F.coalesce("discount_inr", zero),
        }
    )


def clean_orders(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    once = backfill_zone(dedup_orders(orders), restaurants)
    return with_order_measures(with_calendar(with_partner_status(once))).select(*ORDER_COLUMNS)


def _typed(df: DataFrame, **types: str) -> DataFrame:
    """Cast columns; text that does not parse becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def clean_restaurants(restaurants: DataFrame) -> DataFrame:
    return _typed(
        restaurants,
        avg_prep_time_mins="int",
        rating="double",
        is_premium="int",
        lat="double",
        lng="double",
    )


def clean_partners(partners: DataFrame) -> DataFrame:
    return _typed(
        partners, avg_rating="double", total_deliveries="int", experience_months="int"
    ).withColumn("is_active", flag(F.col("status") == "active"))


def clean_weather(weather: DataFrame) -> DataFrame:
    return _typed(weather, timestamp="timestamp").withColumns(
        {
            "weather_date": F.to_date("timestamp"),
            "weather_hour": F.hour("timestamp"),
            "is_rainy": flag(F.col("condition").isin(*RAINY_CONDITIONS)),
        }
    )


def clean_local_events(events: DataFrame) -> DataFrame:
    """One row per event and impacted zone."""
    typed = _typed(events, date="date", expected_crowd="int", demand_multiplier="double")
    each = typed.withColumn("zone", F.explode(F.split("zones_impacted", ",")))
    return each.withColumn("zone", F.trim("zone"))
