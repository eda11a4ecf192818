"""Date and hour expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .measures import col, flag

# Inclusive hour ranges of the analytic calendar flags.
LUNCH_HOURS = (11, 14)
DINNER_HOURS = (19, 22)
LATE_NIGHT_FROM = 23
LATE_NIGHT_TO = 5
WEEKEND_DAYS = (1, 7)  # dayofweek: 1 = Sunday, 7 = Saturday

# Weather conditions counted as rain.
RAINY_CONDITIONS = ("Light Rain", "Heavy Rain", "Thunderstorm", "Drizzle")


def is_lunch(hour: str | Column) -> Column:
    return col(hour).between(*LUNCH_HOURS)


def is_dinner(hour: str | Column) -> Column:
    return col(hour).between(*DINNER_HOURS)


def is_late_night(hour: str | Column) -> Column:
    """The range wraps around midnight."""
    return (col(hour) >= LATE_NIGHT_FROM) | (col(hour) <= LATE_NIGHT_TO)


def is_weekend_day(day_of_week: str | Column) -> Column:
    return col(day_of_week).isin(*WEEKEND_DAYS)


def calendar_columns(ts: str | Column) -> dict[str, Column]:
    """Calendar columns of an order, keyed by output name."""
    t = col(ts)
    hour = F.hour(t)
    return {
        "order_date": F.to_date(t),
        "order_hour": hour,
        "day_of_week": F.dayofweek(t),
        "is_weekend": flag(is_weekend_day(F.dayofweek(t))),
        "is_lunch_hour": flag(is_lunch(hour)),
        "is_dinner_hour": flag(is_dinner(hour)),
        "is_late_night": flag(is_late_night(hour)),
    }


def hour_start(date: str | Column, hour: str | Column) -> Column:
    """Timestamp of the hour given as a date and an hour number."""
    return col(date).cast("timestamp") + F.make_dt_interval(hours=col(hour))
