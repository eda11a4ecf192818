"""Hand-made rows for unit tests."""

from __future__ import annotations

from datetime import datetime

from zonetide.sources.schemas import DELIVERY_PARTNERS, LOCAL_EVENTS, ORDERS, RESTAURANTS, WEATHER_HOURLY


def ts(text: str | None):
    return datetime.fromisoformat(text) if text else None


def _rows(spark, schema, rows, defaults):
    data = [tuple({**defaults, **row}.get(n) for n in schema.names) for row in rows]
    return spark.createDataFrame(data, schema)


def orders(spark, *rows):
    defaults = {
        "order_id": "O1",
        "customer_id": "C1",
        "restaurant_id": "R1",
        "partner_id": "P1",
        "zone": "Z1",
        "order_timestamp": ts("2024-01-03 12:30:00"),
        "order_value_inr": 100.0,
        "discount_inr": 0.0,
        "payment_mode": "UPI",
        "status": "delivered",
        "estimated_eta_mins": 30,
        "actual_delivery_mins": 30,
        "surge_multiplier": 1.0,
        "rain_at_order_time": 0,
        "event_active": 0,
    }
    return _rows(spark, ORDERS, rows, defaults)


def restaurants(spark, *rows):
    defaults = {"restaurant_id": "R1", "zone": "Z1", "cuisine_type": "A", "avg_prep_time_mins": 10}
    return _rows(spark, RESTAURANTS, rows, defaults)


def partners(spark, *rows):
    defaults = {"partner_id": "P1", "zone": "Z1", "status": "active", "avg_rating": 4.0}
    return _rows(spark, DELIVERY_PARTNERS, rows, defaults)


def weather(spark, *rows):
    defaults = {"timestamp": ts("2024-01-03 12:00:00"), "zone": "Z1", "condition": "Clear"}
    return _rows(spark, WEATHER_HOURLY, rows, defaults)


def events(spark, *rows):
    defaults = {
        "event_id": "E1",
        "event_name": "Match",
        "event_type": "IPL Match",
        "date": ts("2024-01-03").date(),
        "start_time": "12:00",
        "end_time": "13:00",
        "zones_impacted": "Z1",
        "demand_multiplier": 1.5,
    }
    return _rows(spark, LOCAL_EVENTS, rows, defaults)
