"""Fixed, parameterised answers to the ops team's standing questions.

"Now" is the latest date and hour in the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import DINNER_HOURS, is_dinner
from ..functions.measures import exact_avg, flag, percent
from .dashboards import rate_avg

# Days of the month taken as match days.
MATCH_DAYS = (5, 12, 18, 25)


def latest_hour(df: DataFrame) -> DataFrame:
    """Rows of the last date and hour.  Only the last date's partition is read for it."""
    day = df.agg(F.max("order_date")).scalar()
    last_day = df.filter(F.col("order_date") == day)
    return last_day.filter(F.col("order_hour") == last_day.agg(F.max("order_hour")).scalar())


def top_demand_now(demand: DataFrame, top: int = 10) -> DataFrame:
    return (
        latest_hour(demand)
        .filter(F.col("zone").isNotNull())
        .select("zone", "order_date", "order_hour", "total_orders")
        .orderBy(F.desc("total_orders"), "zone")
        .limit(top)
    )


def zone_trend(demand: DataFrame, zone: str) -> DataFrame:
    return (
        demand.filter(F.col("zone") == zone)
        .groupBy("zone", "order_hour")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.round(F.avg("total_orders"), 2).alias("avg_orders"),
        )
        .orderBy("order_hour")
    )


def weekday_weekend_by_zone(demand: DataFrame) -> DataFrame:
    return (
        demand.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .pivot("is_weekend", [0, 1])
        .agg(F.sum("total_orders"))
        .select("zone", F.col("0").alias("weekday_orders"), F.col("1").alias("weekend_orders"))
    )


def peak_hour(demand: DataFrame) -> DataFrame:
    return (
        demand.groupBy("order_hour")
        .agg(F.sum("total_orders").alias("total_orders"))
        .orderBy(F.desc("total_orders"), "order_hour")
        .limit(1)
    )


def critical_now(ratio: DataFrame, status: str = "CRITICAL") -> DataFrame:
    return (
        latest_hour(ratio)
        .filter(F.col("zone_status") == status)
        .select("zone", "order_date", "order_hour", "total_orders", "demand_supply_ratio")
    )


def need_partners(ratio: DataFrame) -> DataFrame:
    wanted = F.sum(F.greatest("partner_rebalance_count", F.lit(0)))
    return (
        ratio.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(wanted.alias("partners_wanted"))
        .filter(F.col("partners_wanted") > 0)
        .orderBy(F.desc("partners_wanted"), "zone")
    )


def zone_dinner_ratio(ratio: DataFrame, zone: str) -> DataFrame:
    return (
        ratio.filter((F.col("zone") == zone) & F.col("order_hour").between(*DINNER_HOURS))
        .groupBy("zone", "order_hour")
        .agg(rate_avg("demand_supply_ratio", 2).alias("ds_ratio"))
        .orderBy("order_hour")
    )


def _true_rates():
    return [
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_cancellations").alias("total_cancellations"),
        percent(F.sum("total_cancellations"), F.sum("total_orders"), 2).alias("cancel_rate_pct"),
    ]


def rain_cancellations(demand: DataFrame) -> DataFrame:
    return demand.groupBy("is_rainy").agg(*_true_rates())


def match_days(demand: DataFrame, days: tuple[int, ...] = MATCH_DAYS) -> DataFrame:
    match = flag(F.dayofmonth("order_date").isin(*days))
    return demand.groupBy(match.alias("is_match_day")).agg(
        F.count_distinct("order_date").alias("days"),
        *_true_rates(),
        rate_avg("avg_eta_overshoot", 2).alias("avg_eta_overshoot"),
        rate_avg("avg_surge", 2).alias("avg_surge"),
    )


def rain_dinner_eta(demand: DataFrame) -> DataFrame:
    dinner = flag(is_dinner("order_hour"))
    return demand.groupBy("is_rainy", dinner.alias("is_dinner")).agg(
        rate_avg("avg_delivery_mins", 2).alias("avg_delivery_mins"),
        rate_avg("avg_eta_overshoot", 2).alias("avg_eta_overshoot"),
    )


def weather_sensitivity(demand: DataFrame) -> DataFrame:
    """Zones by the difference rain makes to ETA overshoot and cancellations."""

    def when_rain(c: str, rainy: int):
        return exact_avg(F.when(F.col("is_rainy") == rainy, F.col(c)))

    def effect(c: str):
        return F.round(when_rain(c, 1) - when_rain(c, 0), 2)

    return (
        demand.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(
            effect("avg_eta_overshoot").alias("eta_effect"),
            effect("cancellation_rate_pct").alias("cancel_effect"),
        )
        .filter(F.col("eta_effect").isNotNull())
        .orderBy(F.desc("eta_effect"), "zone")
    )


def surge_too_low(ratio: DataFrame) -> DataFrame:
    return ratio.filter(F.col("recommended_surge") > F.col("avg_surge")).select(
        "zone",
        "order_date",
        "order_hour",
        "avg_surge",
        "recommended_surge",
        F.round(F.col("recommended_surge") - F.col("avg_surge"), 2).alias("gap"),
    )


def surge_over(ratio: DataFrame, limit: float = 2.0) -> DataFrame:
    return ratio.filter(F.col("recommended_surge") > limit).select(
        "zone", "order_date", "order_hour", "demand_supply_ratio", "recommended_surge"
    )


def power_users(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("customer_segment") == "Power User").agg(
        F.count(F.lit(1)).alias("power_users")
    )


def segment_spend(customers: DataFrame) -> DataFrame:
    return customers.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.round(exact_avg("total_spend"), 2).alias("avg_spend"),
    )


def segment_cancellations(customers: DataFrame) -> DataFrame:
    """The segment that cancels most: cancelled orders over all its orders."""
    rate = percent(F.sum("total_cancellations"), F.sum("total_orders"), 2)
    return (
        customers.groupBy("customer_segment")
        .agg(rate.alias("cancel_rate_pct"))
        .orderBy(F.desc("cancel_rate_pct"), "customer_segment")
        .limit(1)
    )


def predicted_rebalancing(predictions: DataFrame) -> DataFrame:
    return predictions.filter(F.col("partners_needed") > 0).orderBy(
        F.desc("partners_needed"), "zone"
    )


def rank_zones(demand: DataFrame) -> DataFrame:
    """Zones ranked by volume and by cancellation rate.  One row per zone is ranked."""
    zones = demand.filter(F.col("zone").isNotNull()).groupBy("zone").agg(*_true_rates())
    volume = Window.orderBy(F.desc("total_orders"))
    worst = Window.orderBy(F.desc("cancel_rate_pct"))
    return zones.withColumns(
        {"volume_rank": F.rank().over(volume), "cancel_rank": F.rank().over(worst)}
    )


def distinct_zones(demand: DataFrame) -> DataFrame:
    return demand.filter(F.col("zone").isNotNull()).select("zone").distinct()


def target_stats(demand: DataFrame) -> DataFrame:
    return demand.filter(F.col("zone").isNotNull()).agg(
        F.count("total_orders").alias("rows"),
        F.round(F.avg("total_orders"), 4).alias("mean_orders"),
        F.round(F.stddev_samp("total_orders"), 4).alias("std_orders"),
    )
