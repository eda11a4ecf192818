"""Analytic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.measures import exact_avg, exact_sum, flag, flag_count, percent

HOUR_KEYS = ["order_date", "order_hour", "zone", "is_weekend"]

DEMAND_COLUMNS = [
    *HOUR_KEYS,
    "total_orders",
    "unique_customers",
    "avg_order_value",
    "total_revenue",
    "avg_delivery_mins",
    "avg_estimated_eta",
    "avg_eta_overshoot",
    "total_cancellations",
    "cancellation_rate_pct",
    "avg_surge",
    "rain_flag",
    "event_flag",
    "unassigned_orders",
    "active_restaurants",
    "temperature_c",
    "humidity_pct",
    "weather_condition",
    "rain_mm",
    "is_rainy",
    "event_name",
    "event_type",
    "demand_multiplier",
]


def hourly_orders(orders: DataFrame) -> DataFrame:
    """Order measures per date, hour and zone, before any enrichment.

    Distinct counts are spread over (group, value) pairs first, so a zone that holds
    most of the orders is not counted by one task.
    """
    return orders.groupBy(*HOUR_KEYS).agg(
        F.count("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.round(exact_avg("order_value_inr"), 2).alias("avg_order_value"),
        exact_sum("net_order_value").alias("_revenue"),
        F.round(F.avg("actual_delivery_mins"), 1).alias("avg_delivery_mins"),
        F.round(F.avg("estimated_eta_mins"), 1).alias("avg_estimated_eta"),
        F.round(F.avg("eta_overshoot_mins"), 1).alias("avg_eta_overshoot"),
        F.sum("is_cancelled").alias("total_cancellations"),
        percent(F.sum("is_cancelled"), F.count("order_id")).alias("cancellation_rate_pct"),
        F.round(exact_avg("surge_multiplier"), 2).alias("avg_surge"),
        F.max("rain_at_order_time").alias("rain_flag"),
        F.max("event_active").alias("event_flag"),
        flag_count(F.col("partner_status") == "unassigned").alias("unassigned_orders"),
        F.count_distinct("restaurant_id").alias("active_restaurants"),
    )


def hourly_weather(weather: DataFrame) -> DataFrame:
    return weather.groupBy(
        F.col("weather_date").alias("order_date"), F.col("weather_hour").alias("order_hour"), "zone"
    ).agg(
        F.count(F.lit(1)).alias("_weather_rows"),
        F.max("temperature_c").alias("temperature_c"),
        F.max("humidity_pct").alias("humidity_pct"),
        F.max("condition").alias("weather_condition"),
        F.max("rain_mm").alias("rain_mm"),
        F.max("is_rainy").alias("is_rainy"),
    )


def daily_events(events: DataFrame) -> DataFrame:
    """Event columns per date and zone: independent maxima, and the strongest event."""
    strongest = F.max_by(
        F.struct("event_name", "event_type"), F.struct("demand_multiplier", "event_id")
    )
    return events.groupBy(F.col("date").alias("order_date"), "zone").agg(
        F.count(F.lit(1)).alias("_event_rows"),
        F.max("event_name").alias("_max_name"),
        F.max("event_type").alias("_max_type"),
        F.max("demand_multiplier").alias("_multiplier"),
        strongest.alias("_strongest"),
    )


def zone_demand_hourly(
    orders: DataFrame,
    weather: DataFrame,
    events: DataFrame,
    *,
    fan_out: bool = False,
    hourly: DataFrame | None = None,
) -> DataFrame:
    """Hourly demand per zone with weather and events.

    ``hourly`` are the ``hourly_orders`` of the orders, where they are written already.

    Weather and events are joined to the aggregate, not to the orders.  Joined to the
    orders they repeat every order of a group equally often, which multiplies sums and
    counts and leaves averages, ratios, maxima and distinct counts alone.  ``fan_out``
    returns exactly those multiplied sums; the default counts each order once and names
    the strongest event of the day.
    """
    hourly = (
        (hourly_orders(orders) if hourly is None else hourly)
        .join(hourly_weather(weather), ["order_date", "order_hour", "zone"], "left")
        .join(daily_events(events), ["order_date", "zone"], "left")
    )
    if fan_out:
        times = F.coalesce("_weather_rows", F.lit(1)) * F.coalesce("_event_rows", F.lit(1))
        sums = ("total_orders", "_revenue", "total_cancellations", "unassigned_orders")
        hourly = hourly.withColumns({c: F.col(c) * times for c in sums})
        name, kind = F.col("_max_name"), F.col("_max_type")
    else:
        name, kind = F.col("_strongest.event_name"), F.col("_strongest.event_type")
    known = flag(F.col("_weather_rows").isNotNull())
    out = hourly.withColumns(
        {
            "total_revenue": F.round("_revenue", 2),
            "weather_known": known,
            "rain_mm": F.coalesce("rain_mm", F.lit(0.0)),
            "is_rainy": F.coalesce("is_rainy", F.lit(0)),
            "event_name": F.coalesce(name, F.lit("None")),
            "event_type": F.coalesce(kind, F.lit("None")),
            "demand_multiplier": F.coalesce("_multiplier", F.lit(1.0)),
        }
    )
    return out.select(*DEMAND_COLUMNS, *([] if fan_out else ["weather_known"]))


def zone_demand_basic(orders: DataFrame) -> DataFrame:
    """Reduced hourly demand: three keys, seven measures, unrounded."""
    return orders.groupBy("order_date", "order_hour", "zone").agg(
        F.count("order_id").alias("total_orders"),
        exact_avg("order_value_inr").alias("avg_order_value"),
        F.avg("actual_delivery_mins").alias("avg_delivery_mins"),
        F.sum("is_cancelled").alias("total_cancellations"),
        exact_avg("surge_multiplier").alias("avg_surge"),
        F.max("rain_at_order_time").alias("rain_flag"),
        F.max("event_active").alias("event_flag"),
    )


def partner_availability(partners: DataFrame) -> DataFrame:
    return partners.groupBy("zone").agg(
        F.count("partner_id").alias("total_partners"),
        F.sum("is_active").alias("active_partners"),
        flag_count(F.col("status") == "on_break").alias("on_break_partners"),
        flag_count(F.col("status") == "inactive").alias("inactive_partners"),
        F.round(exact_avg("avg_rating"), 2).alias("avg_partner_rating"),
        F.round(F.avg("total_deliveries"), 0).alias("avg_lifetime_deliveries"),
        F.round(F.avg("experience_months"), 1).alias("avg_experience_months"),
        flag_count(F.col("vehicle_type") == "ev_scooter").alias("ev_partners"),
        percent(F.sum("is_active"), F.count("partner_id")).alias("active_pct"),
    )


RATIO_COLUMNS = [
    "order_date",
    "order_hour",
    "zone",
    "is_weekend",
    "total_orders",
    "total_cancellations",
    "cancellation_rate_pct",
    "avg_surge",
    "avg_eta_overshoot",
    "avg_delivery_mins",
    "total_revenue",
    "rain_flag",
    "event_flag",
    "event_name",
    "is_rainy",
    "weather_condition",
    "demand_multiplier",
    "active_partners",
    "total_partners",
    "demand_supply_ratio",
    "zone_status",
    "recommended_surge",
    "partner_rebalance_count",
]


def demand_supply_ratio(
    demand: DataFrame, availability: DataFrame, *, no_supply: str = rules.STATUS_DEFAULT
) -> DataFrame:
    """Orders against active partners, with status, surge and rebalancing advice."""
    supply = availability.select("zone", "active_partners", "total_partners")
    r = F.col("_r")
    return (
        demand.join(supply, "zone", "left")
        .withColumn("_r", rules.ratio("total_orders", "active_partners"))
        .withColumns(
            {
                "demand_supply_ratio": F.round(r, 2),
                "zone_status": rules.zone_status(r, no_supply),
                "recommended_surge": rules.recommended_surge(r),
                "partner_rebalance_count": rules.rebalance_count(
                    r, "total_orders", "active_partners"
                ),
            }
        )
        .select(*RATIO_COLUMNS)
    )


def customer_360(orders: DataFrame) -> DataFrame:
    per_customer = orders.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_distinct("zone").alias("zones_ordered_from"),
        F.count_distinct("restaurant_id").alias("unique_restaurants"),
        F.round(exact_sum("net_order_value"), 2).alias("total_spend"),
        F.round(exact_avg("net_order_value"), 2).alias("avg_order_value"),
        F.round(F.avg("actual_delivery_mins"), 1).alias("avg_delivery_time"),
        F.sum("is_cancelled").alias("total_cancellations"),
        percent(F.sum("is_cancelled"), F.count(F.lit(1))).alias("cancel_rate_pct"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("customer_tenure_days"),
        F.sum("is_weekend").alias("weekend_orders"),
        F.sum("is_lunch_hour").alias("lunch_orders"),
        F.sum("is_dinner_hour").alias("dinner_orders"),
        F.sum("is_late_night").alias("late_night_orders"),
        F.sum("rain_at_order_time").alias("rainy_day_orders"),
    )
    return per_customer.withColumn("customer_segment", rules.segment("total_orders"))


def restaurant_performance(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Restaurant measures.  Orders are aggregated by id before the master is joined."""
    measures = (
        orders.filter(F.col("restaurant_id").isNotNull())
        .groupBy("restaurant_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.round(exact_sum("net_order_value"), 2).alias("total_revenue"),
            F.round(exact_avg("net_order_value"), 2).alias("avg_order_value"),
            F.round(F.avg("actual_delivery_mins"), 1).alias("avg_delivery_mins"),
            F.sum("is_cancelled").alias("total_cancellations"),
            percent(F.sum("is_cancelled"), F.count(F.lit(1))).alias("cancel_rate_pct"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.count_distinct("order_date").alias("active_days"),
        )
    )
    master = [
        F.col("restaurant_id"),
        F.col("restaurant_name"),
        F.col("zone"),
        F.col("cuisine_type"),
        F.col("avg_prep_time_mins"),
        F.col("rating").alias("restaurant_rating"),
        F.col("is_premium"),
    ]
    known = restaurants.select(*master).dropDuplicates()
    return known.join(measures, "restaurant_id").select(
        *known.columns, *[c for c in measures.columns if c != "restaurant_id"]
    )
