"""Claims about the business, restated as queries that test them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.calendar import LATE_NIGHT_FROM
from ..functions.measures import flag, percent
from .questions import MATCH_DAYS

# The evening hours of the match-day claim, 17:00 to 23:00.
MATCH_HOURS = (17, 22)


def _per_day(orders: Column, days: Column) -> Column:
    return orders.cast("double") / F.nullif(days, F.lit(0))


def match_day_lift(demand: DataFrame, days: tuple[int, ...] = MATCH_DAYS) -> DataFrame:
    """Evening orders per match day over those per other day."""
    daily = (
        demand.filter(F.col("order_hour").between(*MATCH_HOURS))
        .groupBy("order_date")
        .agg(F.sum("total_orders").alias("n"))
    )
    match = F.dayofmonth("order_date").isin(*days)
    per = {
        name: _per_day(F.sum(F.when(cond, F.col("n"))), F.count(F.when(cond, F.lit(1))))
        for name, cond in (("match_orders_per_day", match), ("normal_orders_per_day", ~match))
    }
    return daily.agg(*[F.round(c, 2).alias(n) for n, c in per.items()], F.round(
        per["match_orders_per_day"] / per["normal_orders_per_day"], 4
    ).alias("lift"))


def rain_dinner_cancellations(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("rain_at_order_time", "is_dinner_hour")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("is_cancelled").alias("cancellations"),
            percent(F.sum("is_cancelled"), F.count(F.lit(1)), 2).alias("cancel_rate_pct"),
        )
        .orderBy(F.desc("cancel_rate_pct"))
    )


def weekend_lift(demand: DataFrame) -> DataFrame:
    daily = (
        demand.filter(F.col("order_date").isNotNull())
        .groupBy("order_date", "is_weekend")
        .agg(F.sum("total_orders").alias("n"))
    )
    return daily.groupBy("is_weekend").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("n").alias("total_orders"),
        F.round(F.avg("n"), 2).alias("orders_per_day"),
    )


def zone_imbalance(ratio: DataFrame) -> DataFrame:
    """Share of a zone's hours in which demand exceeds supply."""
    over = flag(rules.ratio("total_orders", "active_partners") > 1)
    return (
        ratio.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(
            F.count(F.lit(1)).alias("hours"),
            F.sum(over).alias("hours_over"),
            percent(F.sum(over), F.count(F.lit(1)), 2).alias("over_pct"),
        )
        .orderBy(F.desc("over_pct"), "zone")
    )


def late_night_zones(demand: DataFrame, availability: DataFrame) -> DataFrame:
    """A zone's share of late orders against its share of active partners."""
    late = (
        demand.filter((F.col("order_hour") >= LATE_NIGHT_FROM) & F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(F.sum("total_orders").alias("late_orders"))
    )
    zones = availability.select("zone", "active_partners").join(late, "zone", "left")
    zones = zones.withColumn("late_orders", F.coalesce("late_orders", F.lit(0).cast("bigint")))
    all_late = zones.agg(F.sum("late_orders")).scalar()
    all_active = zones.agg(F.sum("active_partners")).scalar()
    return zones.select(
        "zone",
        "late_orders",
        "active_partners",
        percent("late_orders", F.nullif(all_late, F.lit(0)), 2).alias("late_share_pct"),
        percent("active_partners", F.nullif(all_active, F.lit(0)), 2).alias("partner_share_pct"),
    )


def zone_peak_hour(demand: DataFrame) -> DataFrame:
    """Busiest hour of day per zone; the earlier hour wins a tie."""
    hours = (
        demand.filter(F.col("zone").isNotNull() & F.col("order_hour").isNotNull())
        .groupBy("zone", "order_hour")
        .agg(F.sum("total_orders").alias("n"))
    )
    best = F.max(F.struct("n", (-F.col("order_hour")).alias("neg")))
    return (
        hours.groupBy("zone")
        .agg(best.alias("b"))
        .select("zone", (-F.col("b.neg")).alias("peak_hour"), F.col("b.n").alias("peak_orders"))
    )
