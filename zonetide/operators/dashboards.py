"""Dashboard queries over the analytic tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.measures import exact_avg, exact_sum, percent, rupees


def rate_avg(c: str, digits: int = 1) -> Column:
    """Average of group values that are already rounded: each group weighs the same."""
    return F.round(exact_avg(c), digits)


def kpi_cards(orders: DataFrame, *, unique_ids: bool = False) -> DataFrame:
    """Overall figures.  ``unique_ids`` says that no order id repeats, as after
    ``cleaning.dedup_orders``; counting then needs no shuffle of all ids."""
    order_count = F.count("order_id") if unique_ids else F.count_distinct("order_id")
    return orders.agg(
        order_count.alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        rupees(exact_sum("net_order_value")).alias("total_revenue"),
        F.round(F.avg("actual_delivery_mins"), 1).alias("avg_delivery_mins"),
        percent(F.sum("is_cancelled"), F.count(F.lit(1))).alias("cancel_rate_pct"),
        F.round(F.avg("eta_overshoot_mins"), 1).alias("avg_eta_overshoot"),
    )


def zone_leaderboard(demand: DataFrame) -> DataFrame:
    return (
        demand.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            rupees(exact_sum("total_revenue")).alias("total_revenue"),
            rate_avg("cancellation_rate_pct").alias("cancel_rate_pct"),
            rate_avg("avg_eta_overshoot").alias("avg_eta_overshoot"),
            rate_avg("avg_surge", 2).alias("avg_surge"),
        )
        .orderBy(F.desc("total_orders"), "zone")
    )


def hourly_by_day_type(demand: DataFrame) -> DataFrame:
    day_type = F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday")
    return (
        demand.groupBy("order_hour", day_type.alias("day_type"))
        .agg(
            F.round(F.avg("total_orders"), 0).alias("avg_orders"),
            rate_avg("cancellation_rate_pct").alias("cancel_rate"),
        )
        .orderBy("order_hour", "day_type")
    )


def rain_event_impact(demand: DataFrame) -> DataFrame:
    """Four overlapping cohorts in one scan: every row is counted under its labels."""
    weather = F.when(F.col("is_rainy") == 0, "Clear").when(F.col("is_rainy") == 1, "Rainy")
    event = F.when(F.col("event_flag") == 0, "No Event").when(
        F.col("event_flag") == 1, "Event Active"
    )
    return (
        demand.withColumn("condition", F.explode(F.array(weather, event)))
        .filter(F.col("condition").isNotNull())
        .groupBy("condition")
        .agg(
            F.round(F.avg("total_orders"), 0).alias("avg_orders"),
            rate_avg("cancellation_rate_pct").alias("cancel_rate"),
            rate_avg("avg_eta_overshoot").alias("eta_overshoot"),
        )
    )


def ds_heatmap(ratio: DataFrame, *, by_severity: bool = False) -> DataFrame:
    """Zone by hour.  The status is the last label in alphabetical order, or with
    ``by_severity`` the most severe one."""
    if by_severity:
        level = F.array_position(F.array(*[F.lit(s) for s in rules.SEVERITY]), F.col("zone_status"))
        status = F.max_by("zone_status", level)
    else:
        status = F.max("zone_status")
    return (
        ratio.groupBy("zone", "order_hour")
        .agg(rate_avg("demand_supply_ratio", 2).alias("ds_ratio"), status.alias("status"))
        .orderBy("zone", "order_hour")
    )


def critical_alerts(ratio: DataFrame, top: int = 25) -> DataFrame:
    raining = F.when(F.col("is_rainy") == 1, "Yes").otherwise("No")
    return (
        ratio.filter(F.col("zone_status") == "CRITICAL")
        .select(
            "zone",
            "order_date",
            "order_hour",
            "total_orders",
            "active_partners",
            "demand_supply_ratio",
            "zone_status",
            "cancellation_rate_pct",
            "avg_eta_overshoot",
            "recommended_surge",
            "partner_rebalance_count",
            raining.alias("raining"),
            "event_name",
        )
        .orderBy(F.desc("demand_supply_ratio"), "zone", "order_date", "order_hour")
        .limit(top)
    )


def _surge_by_zone(ratio: DataFrame) -> DataFrame:
    current, wanted = exact_avg("avg_surge"), exact_avg("recommended_surge")
    return ratio.groupBy("zone").agg(
        F.round(current, 2).alias("current_avg_surge"),
        F.round(wanted, 2).alias("recommended_avg_surge"),
        F.round(wanted - current, 2).alias("surge_gap"),
        F.sum("total_orders").alias("total_orders"),
        rate_avg("cancellation_rate_pct").alias("cancel_rate"),
        wanted.alias("_wanted"),
    )


def surge_compare(ratio: DataFrame) -> DataFrame:
    """Current against recommended surge per zone."""
    return _surge_by_zone(ratio).drop("_wanted").orderBy(F.desc("surge_gap"), "zone")


def surge_gap(ratio: DataFrame) -> DataFrame:
    """The same, for zones whose average recommended surge is above 1.0."""
    return (
        _surge_by_zone(ratio)
        .filter(F.col("_wanted") > 1.0)
        .drop("_wanted")
        .orderBy(F.desc("surge_gap"), "zone")
    )


def partner_rebalancing(ratio: DataFrame, availability: DataFrame) -> DataFrame:
    """Load per zone with a readable instruction."""
    load = ratio.groupBy("zone").agg(
        rate_avg("demand_supply_ratio", 2).alias("avg_ds_ratio"),
        F.round(F.avg("total_orders"), 0).alias("avg_hourly_orders"),
        rate_avg("cancellation_rate_pct").alias("cancel_rate"),
        F.sum("partner_rebalance_count").alias("total_rebalance_needed"),
    )
    need = F.col("total_rebalance_needed")
    # Label texts.
    action = (
        F.when(F.col("avg_ds_ratio") > 2.5, F.concat(F.lit("🔴 NEEDS +"), need, F.lit(" partners")))
        .when(F.col("avg_ds_ratio") < 0.5, F.concat(F.lit("🟢 EXCESS: move "), F.abs(need), F.lit(" out")))
        .otherwise("🟡 Balanced")
    )
    return (
        load.join(availability.select("zone", "active_partners"), "zone")
        .select(
            "zone",
            "avg_ds_ratio",
            "active_partners",
            "avg_hourly_orders",
            "cancel_rate",
            "total_rebalance_needed",
            action.alias("action"),
        )
        .orderBy(F.desc("avg_ds_ratio"), "zone")
    )


def daily_trend(demand: DataFrame) -> DataFrame:
    named = F.when(F.col("event_name") != "None", F.col("event_name"))
    return (
        demand.groupBy("order_date")
        .agg(
            F.sum("total_orders").alias("daily_orders"),
            F.round(exact_sum("total_revenue"), 0).alias("daily_revenue"),
            rate_avg("cancellation_rate_pct").alias("cancel_rate"),
            F.max(named).alias("event"),
        )
        .orderBy("order_date")
    )


def cuisine_performance(performance: DataFrame) -> DataFrame:
    return (
        performance.groupBy("cuisine_type")
        .agg(
            F.count(F.lit(1)).alias("restaurants"),
            F.sum("total_orders").alias("total_orders"),
            rupees(exact_sum("total_revenue")).alias("total_revenue"),
            rate_avg("avg_order_value", 0).alias("avg_order_value"),
            rate_avg("cancel_rate_pct").alias("cancel_rate"),
            rate_avg("avg_delivery_mins").alias("avg_delivery_mins"),
        )
        .orderBy(F.desc("total_orders"), "cuisine_type")
    )


def customer_segments(customers: DataFrame) -> DataFrame:
    dinner = F.avg("dinner_orders") * 100.0 / F.nullif(F.avg("total_orders"), F.lit(0.0))
    return (
        customers.groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            rate_avg("total_spend", 0).alias("avg_spend"),
            rate_avg("avg_order_value", 0).alias("avg_order_value"),
            F.round(F.avg("total_orders"), 1).alias("avg_orders"),
            rate_avg("cancel_rate_pct").alias("cancel_rate"),
            F.round(dinner, 0).alias("dinner_pct"),
        )
        .orderBy(F.desc("avg_spend"), "customer_segment")
    )


def tonight_forecast(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy(F.desc("ds_ratio"), "zone")


def daily_cancellations(demand: DataFrame) -> DataFrame:
    return (
        demand.groupBy("order_date")
        .agg(
            F.sum("total_orders").alias("daily_orders"),
            F.round(exact_sum("total_revenue"), 0).alias("daily_revenue"),
            F.sum("total_cancellations").alias("daily_cancellations"),
        )
        .orderBy("order_date")
    )


def zone_cancel_rate(orders: DataFrame) -> DataFrame:
    """Cancelled orders over all orders of the zone."""
    return (
        orders.groupBy("zone")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("is_cancelled").alias("cancellations"),
            percent(F.sum("is_cancelled"), F.count(F.lit(1)), 2).alias("cancel_rate_pct"),
        )
        .orderBy(F.desc("cancel_rate_pct"), "zone")
    )
