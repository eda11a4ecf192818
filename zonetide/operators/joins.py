"""Row-level joins of orders with weather, events, restaurants and partners.

No side is broadcast by hint: Spark broadcasts what it measures below its threshold.
Beyond that the join is shuffled, and a hot key on the order side is split at run time.
The interval join is always shuffled, as Spark measures its events before they are listed
by hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orders_weather(orders: DataFrame, weather: DataFrame) -> DataFrame:
    """Orders with the weather of their zone, date and hour."""
    w = weather.select(
        "zone",
        F.col("weather_date").alias("order_date"),
        F.col("weather_hour").alias("order_hour"),
        "temperature_c",
        "condition",
        "rain_mm",
        "is_rainy",
    )
    return orders.join(w, ["zone", "order_date", "order_hour"], "left")


def orders_weather_by_hour_start(orders: DataFrame, weather: DataFrame) -> DataFrame:
    """The same match on the timestamp cut to the hour."""
    w = weather.select(
        "zone", F.col("timestamp").alias("weather_hour_start"), "temperature_c", "condition"
    )
    hour = F.date_trunc("hour", "order_timestamp")
    return orders.withColumn("weather_hour_start", hour).join(
        w, ["zone", "weather_hour_start"], "left"
    )


def orders_events(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders with every event of their zone and date; one row per match."""
    e = events.select(
        "zone",
        F.col("date").alias("order_date"),
        "event_id",
        "event_name",
        F.col("event_type").alias("local_event_type"),
        "demand_multiplier",
    )
    return orders.join(e, ["zone", "order_date"], "left")


def orders_in_event_zones(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders whose zone is listed by an event of that day, each order once.

    ``events`` is the exploded list, which turns "zone in list" into an equi-join.
    """
    listed = events.select("zone", F.col("date").alias("order_date"))
    return orders.join(listed, ["zone", "order_date"], "left_semi")


def orders_during_events(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders placed between the start and the end of an event in their zone.

    An event that ends before it starts ends the day after.  Every event is listed under
    each hour it touches, 25 at most, and an order has one hour: zone and hour are equi-keys
    that find each pair once, and the interval is checked on what is left.  The hours of an
    event are not in Spark's size estimate, so a small table of events could become a
    broadcast that no driver holds: both sides are sorted and merged at every size.
    """

    def moment(c: str):
        return F.try_to_timestamp(F.concat_ws(" ", F.col("date").cast("string"), c))

    start, end = moment("start_time"), moment("end_time")
    end = F.when(end < start, end + F.expr("interval 1 day")).otherwise(end)
    e = events.select("zone", "event_id", "event_name", start.alias("event_start"), end.alias("event_end"))
    e = e.filter(F.col("event_start") < F.col("event_end"))
    hours = F.sequence(F.date_trunc("hour", "event_start"), F.col("event_end"), F.expr("interval 1 hour"))
    e = e.withColumn("_hour", F.explode(hours))
    inside = (F.col("order_timestamp") >= F.col("event_start")) & (
        F.col("order_timestamp") < F.col("event_end")
    )
    placed = orders.withColumn("_hour", F.date_trunc("hour", "order_timestamp"))
    return placed.join(e.hint("merge"), ["zone", "_hour"]).filter(inside).drop("_hour")


def orders_partners(orders: DataFrame, partners: DataFrame) -> DataFrame:
    """Orders with the master data of their partner."""
    p = partners.select(
        "partner_id",
        F.col("zone").alias("partner_zone"),
        "vehicle_type",
        F.col("status").alias("partner_state"),
        "is_active",
    )
    return orders.join(p, "partner_id", "left")
