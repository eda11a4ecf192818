"""Schemas of the five raw inputs.  Column names and types are fixed values."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def _schema(columns: str) -> StructType:
    """Schema from "name type, name type"; usable before a session exists."""
    pairs = [c.split() for c in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


ORDERS = _schema(
    """
    order_id string, customer_id string, restaurant_id string, partner_id string,
    zone string, order_timestamp timestamp, delivery_timestamp timestamp,
    order_value_inr double, discount_inr double, payment_mode string, status string,
    cancel_reason string, estimated_eta_mins int, actual_delivery_mins int,
    surge_multiplier double, rain_at_order_time int, event_active int
    """
)

RESTAURANTS = _schema(
    """
    restaurant_id string, restaurant_name string, zone string, cuisine_type string,
    avg_prep_time_mins int, rating double, is_premium int, lat double, lng double
    """
)

DELIVERY_PARTNERS = _schema(
    """
    partner_id string, partner_name string, zone string, vehicle_type string,
    avg_rating double, total_deliveries int, status string, experience_months int,
    lat double, lng double
    """
)

WEATHER_HOURLY = _schema(
    """
    timestamp timestamp, zone string, temperature_c double, humidity_pct int,
    condition string, wind_speed_kmh double, rain_mm double, visibility_km double
    """
)

# Times of day stay text: inferred they would become timestamps on today's date.
LOCAL_EVENTS = _schema(
    """
    event_id string, event_name string, event_type string, date date,
    start_time string, end_time string, expected_crowd int, zones_impacted string,
    demand_multiplier double
    """
)

RAW = {
    "orders": ORDERS,
    "restaurants": RESTAURANTS,
    "delivery_partners": DELIVERY_PARTNERS,
    "weather_hourly": WEATHER_HOURLY,
    "local_events": LOCAL_EVENTS,
}

# Load order of a row, added by loaders that know it.
ARRIVAL = "arrival_seq"

# Legal order states.
ORDER_STATES = ("delivered", "cancelled", "in_transit", "preparing")
