"""Operations: alerts, rebalancing plan, console slice, utilisation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.calendar import hour_start
from ..functions.measures import flag, percent, scaled
from .cleaning import is_blank
from .forecast import spike_hours


def slice_rows(
    df: DataFrame,
    zones: list[str] | None = None,
    dates: tuple[date, date] | None = None,
    hours: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows of the chosen zones, date range and hour window; bounds are inclusive."""
    if zones:
        df = df.filter(F.col("zone").isin(*zones))
    if dates:
        df = df.filter(F.col("order_date").between(F.lit(dates[0]), F.lit(dates[1])))
    if hours:
        df = df.filter(F.col("order_hour").between(*hours))
    return df


def console_slice(ratio: DataFrame, forecast: DataFrame, **chosen) -> DataFrame:
    """Forecast, surge and rebalancing advice for the chosen slice."""
    expected = forecast.select("zone", "hour_ts", "forecast")
    return (
        slice_rows(ratio, **chosen)
        .withColumn("hour_ts", hour_start("order_date", "order_hour"))
        .join(expected, ["zone", "hour_ts"], "left")
        .select(
            "zone",
            "order_date",
            "order_hour",
            "total_orders",
            F.col("forecast").alias("predicted_orders"),
            "active_partners",
            "demand_supply_ratio",
            "zone_status",
            "recommended_surge",
            "partner_rebalance_count",
            flag(F.col("forecast") > 2 * F.coalesce("active_partners", F.lit(0))).alias("is_alert"),
        )
    )


def demand_alerts(forecast: DataFrame, availability: DataFrame, factor: float = 2.0) -> DataFrame:
    """Zone-hours whose forecast exceeds ``factor`` times the active partners.

    A zone without a row of partners has none, which is the worst shortage.
    """
    none = F.lit(0).cast("bigint")
    return (
        forecast.join(availability.select("zone", "active_partners"), "zone", "left")
        .withColumn("active_partners", F.coalesce("active_partners", none))
        .filter(F.col("forecast") > factor * F.col("active_partners"))
        .select("zone", "hour_ts", "forecast", "active_partners")
    )


def rebalance_plan(ratio: DataFrame) -> DataFrame:
    """Moves of partners between zones, per date and hour.

    Deficits and surpluses of an hour are laid end to end on two rulers, larger first.
    Between two neighbouring marks exactly one deficit zone meets one surplus zone, so
    sorting the marks gives the plan in one pass: no pairing of zones with zones.
    """
    hour = ["order_date", "order_hour"]
    n = F.col("partner_rebalance_count")
    need = (
        ratio.filter(F.col("zone").isNotNull() & (n != 0))
        .select(*hour, "zone", F.abs(n).cast("bigint").alias("size"), (n > 0).alias("wants"))
    )
    laid = Window.partitionBy(*hour, "wants").orderBy(F.desc("size"), "zone")
    marks = (
        need.withColumn(
            "mark", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(*hour, "mark")
        .agg(
            F.max(F.when(F.col("wants"), F.col("zone"))).alias("to_zone"),
            F.max(F.when(~F.col("wants"), F.col("zone"))).alias("from_zone"),
        )
    )
    # A segment belongs to the zones whose marks come next, so read from the far end.
    from_end = Window.partitionBy(*hour).orderBy(F.desc("mark"))
    reach = from_end.rowsBetween(Window.unboundedPreceding, 0)
    before = F.coalesce(F.lead("mark", 1).over(from_end), F.lit(0).cast("bigint"))
    segments = marks.select(
        *hour,
        F.last("from_zone", ignorenulls=True).over(reach).alias("from_zone"),
        F.last("to_zone", ignorenulls=True).over(reach).alias("to_zone"),
        (F.col("mark") - before).alias("_length"),
    )
    return (
        segments.filter(F.col("from_zone").isNotNull() & F.col("to_zone").isNotNull())
        .groupBy(*hour, "from_zone", "to_zone")
        .agg(F.sum("_length").alias("partners_moved"))
    )


def idle_partner_share(ratio: DataFrame) -> DataFrame:
    """Partners in quiet zones (ratio below 0.5) per hour, next to starved zones (above 2)."""
    r = rules.ratio("total_orders", "active_partners")
    idle = F.coalesce(F.sum(F.when(r < 0.5, F.col("active_partners"))), F.lit(0))
    hours = ratio.groupBy("order_date", "order_hour").agg(
        idle.cast("bigint").alias("idle_partners"),
        F.coalesce(F.sum("active_partners"), F.lit(0)).cast("bigint").alias("active_partners"),
        F.sum(flag(r > 2)).alias("starved_zones"),
    )
    return hours.withColumn(
        "idle_share_pct", percent("idle_partners", F.nullif("active_partners", F.lit(0)))
    )


def spike_kpis(demand: DataFrame) -> DataFrame:
    """ETA overshoot and cancellations in spike hours and in the others, by order."""
    late_orders = F.when(F.col("avg_eta_overshoot").isNotNull(), F.col("total_orders"))
    tenths = scaled("avg_eta_overshoot", 1) * F.col("total_orders")
    return (
        spike_hours(demand)
        .groupBy("is_spike")
        .agg(
            F.count(F.lit(1)).alias("zone_hours"),
            F.sum("total_orders").alias("total_orders"),
            percent(F.sum("total_cancellations"), F.sum("total_orders"), 2).alias("cancel_rate_pct"),
            F.round(F.sum(tenths) / 10.0 / F.sum(late_orders), 2).alias("avg_eta_overshoot"),
        )
    )


def partner_utilisation(
    orders: DataFrame, partners: DataFrame, availability: DataFrame
) -> DataFrame:
    """Share of a zone's active partners with at least one order in the hour.

    Every zone-hour with demand has a row, and every one with a busy partner, whatever the
    partners' share.  Orders collapse to one row per hour and partner before the join.
    """
    hour = ["order_date", "order_hour"]
    active = partners.filter(F.col("is_active") == 1).select("partner_id", "zone")
    busy = orders.filter(~is_blank("partner_id")).select(*hour, "partner_id").distinct()
    busy = busy.join(active, "partner_id").select(*hour, "zone", F.lit(1).alias("busy"))
    demand = orders.select(*hour, "zone").distinct().withColumn("busy", F.lit(0))
    supply = availability.select("zone", "active_partners")
    return (
        demand.unionByName(busy)
        .filter(F.col("zone").isNotNull())
        .groupBy(*hour, "zone")
        .agg(F.sum("busy").alias("busy_partners"))
        .join(supply, "zone", "left")
        .withColumn("active_partners", F.coalesce("active_partners", F.lit(0).cast("bigint")))
        .withColumn(
            "utilisation_pct", percent("busy_partners", F.nullif("active_partners", F.lit(0)))
        )
    )
