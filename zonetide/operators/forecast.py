"""Dense time series, lag features and the heuristic forecast.

Hours without orders have no row in the demand table but count as 0 orders, so every
series is put on a dense spine first.  A spine has zones x hours rows, every hour from the
first to the last known one: it grows with the calendar, not with the number of orders, and
one wrong date in 1970 adds fifty years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.calendar import hour_start
from ..functions.measures import flag
from ..functions.rules import with_prediction_rules

# Weights and multipliers of the heuristic forecast.
WEIGHT_LAST_WEEK = 0.7
WEIGHT_YESTERDAY = 0.2
WEIGHT_WEEK_MEAN = 0.1
RAIN_FACTOR = 1.4
EVENT_FACTOR = 1.8
HOURS_PER_DAY = 24
HOURS_PER_WEEK = 168
QUIET_DAYS = 8


def zone_series(demand: DataFrame) -> DataFrame:
    """Known zone-hours: zone, hour_ts, total_orders, rain_flag, event_flag."""
    known = demand.filter(F.col("zone").isNotNull() & F.col("order_date").isNotNull())
    return known.select(
        "zone",
        hour_start("order_date", "order_hour").alias("hour_ts"),
        "total_orders",
        "rain_flag",
        "event_flag",
    )


def dense(
    series: DataFrame, ts: str, step: str, values: list[str], quiet_days: int | None = None
) -> DataFrame:
    """``series`` with a row for every zone and time step, absent values as 0.

    The steps run from the first to the last known one.  ``quiet_days`` leaves out the days
    that come later than that after the last day with any row.

    Known rows and empty steps meet in one aggregation, and the shuffle by zone also
    serves the windows that follow.
    """
    bounds = series.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    zeros = [F.lit(0).cast(series.schema[v].dataType).alias(v) for v in values]
    # one value per day of the calendar; the hours of a day are made next to their zone
    if quiet_days is None:
        calendar = F.sequence(F.to_date(lo), F.to_date(hi))
    else:
        some = series.select(F.to_date(ts).alias("day")).distinct()
        each = F.explode(F.sequence("day", F.date_add("day", quiet_days))).alias("day")
        calendar = some.select(each).distinct().agg(F.collect_list("day")).scalar()
    start = F.col("day").cast("timestamp")
    width = F.expr(f"interval {step}")
    within = F.sequence(start, start + F.expr("interval 1 day") - width, width)
    steps = (
        series.select("zone")
        .distinct()
        .select("zone", F.explode(calendar).alias("day"))
        .select("zone", F.explode(within).alias(ts), *zeros)
        .filter(F.col(ts).between(lo, hi))
    )
    return (
        series.select("zone", ts, *values)
        .unionByName(steps)
        .repartition("zone")
        .groupBy("zone", ts)
        .agg(*[F.max(v).alias(v) for v in values])
    )


def hourly_spine(demand: DataFrame, quiet_days: int | None = None) -> DataFrame:
    values = ["total_orders", "rain_flag", "event_flag"]
    return dense(zone_series(demand), "hour_ts", "1 hour", values, quiet_days)


def _by_hour() -> WindowSpec:
    return Window.partitionBy("zone").orderBy("hour_ts")


def _hours_ago(value: str, hours: int) -> Column:
    """``value`` of the row ``hours`` before; null where the calendar breaks in between."""
    w, gap = _by_hour(), F.make_dt_interval(hours=F.lit(hours))
    near = F.lag("hour_ts", hours).over(w) == F.col("hour_ts") - gap
    return F.when(near, F.lag(value, hours).over(w))


def _with_running_total(spine: DataFrame) -> DataFrame:
    """``spine`` with ``_before``: all orders of the zone before the hour."""
    earlier = _by_hour().rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("total_orders").over(earlier), F.lit(0))
    return spine.withColumn("_before", total)


def _mean_before(hours: int) -> Column:
    """Mean of the previous ``hours`` hours; null until that many exist.

    The difference of two running totals: a frame of rows would be summed anew for each row.
    """
    return (F.col("_before") - _hours_ago("_before", hours)).cast("double") / hours


def rolling_average(demand: DataFrame, hours: int = HOURS_PER_DAY) -> DataFrame:
    return _with_running_total(hourly_spine(demand)).select(
        "zone", "hour_ts", "total_orders", _mean_before(hours).alias("rolling_avg")
    )


def lag_features(demand: DataFrame, quiet_days: int | None = QUIET_DAYS) -> DataFrame:
    """Same hour last week, same hour yesterday, and the mean of the last seven days.

    ``quiet_days=None`` has every hour; all queries and forecasts use that.  Otherwise longer
    silences are left out, and the lags are unknown until a week has passed after one.
    """
    known = _with_running_total(hourly_spine(demand, quiet_days)).withColumns(
        {
            "lag_168": _hours_ago("total_orders", HOURS_PER_WEEK),
            "lag_24": _hours_ago("total_orders", HOURS_PER_DAY),
            "rolling_168": _mean_before(HOURS_PER_WEEK),
        }
    )
    return known.drop("_before")


def weighted_average_forecast(demand: DataFrame) -> DataFrame:
    """Weighted moving average with rain and event multipliers.

    Zone-hours without a full week of history have no forecast and are left out.
    """
    base = (
        F.col("lag_168") * WEIGHT_LAST_WEEK
        + F.col("lag_24") * WEIGHT_YESTERDAY
        + F.col("rolling_168") * WEIGHT_WEEK_MEAN
    )
    rain = F.when(F.col("rain_flag") == 1, RAIN_FACTOR).otherwise(1.0)
    event = F.when(F.col("event_flag") == 1, EVENT_FACTOR).otherwise(1.0)
    return (
        lag_features(demand, quiet_days=None)
        .filter(F.col("lag_168").isNotNull())
        .withColumn("base_forecast", base)
        .select(
            "zone",
            "hour_ts",
            "total_orders",
            "rain_flag",
            "event_flag",
            "base_forecast",
            (F.col("base_forecast") * rain * event).alias("forecast"),
        )
    )


def prediction_rules(forecast: DataFrame, availability: DataFrame) -> DataFrame:
    """Ratio, status, surge and partners needed for every forecast zone-hour."""
    joined = forecast.join(availability.select("zone", "active_partners"), "zone", "left")
    return with_prediction_rules(joined, "forecast", "active_partners").select(
        "zone",
        "hour_ts",
        "predicted_orders",
        "active_partners",
        "ds_ratio",
        "status",
        "recommended_surge",
        "partners_needed",
    )


def predicted_vs_actual(forecast: DataFrame, days: int = 7) -> DataFrame:
    """Forecast and actual orders of the last ``days`` days."""
    last = forecast.agg(F.max("hour_ts")).scalar()
    since = last - F.make_dt_interval(days=F.lit(days))
    return forecast.filter(F.col("hour_ts") > since).select(
        "zone",
        "hour_ts",
        F.col("total_orders").alias("actual_orders"),
        F.col("forecast").alias("predicted_orders"),
        (F.col("forecast") - F.col("total_orders")).alias("error"),
    )


def interval_orders(orders: DataFrame, minutes: int = 30) -> DataFrame:
    """Orders per zone and interval that had any."""
    width = minutes * 60
    start = F.timestamp_seconds(F.expr(f"(unix_seconds(order_timestamp) div {width}) * {width}"))
    known = orders.filter(F.col("zone").isNotNull() & F.col("order_timestamp").isNotNull())
    return known.groupBy("zone", start.alias("interval_ts")).agg(
        F.count(F.lit(1)).alias("orders")
    )


def next_interval_target(counts: DataFrame, minutes: int = 30) -> DataFrame:
    """``interval_orders`` on every interval, with the counts of the next two."""
    w = Window.partitionBy("zone").orderBy("interval_ts")
    return dense(counts, "interval_ts", f"{minutes} minutes", ["orders"]).withColumns(
        {
            "orders_next_30": F.lead("orders", 1).over(w),
            "orders_next_60": F.lead("orders", 2).over(w),
        }
    )


def spike_hours(demand: DataFrame, factor: float = 2.0) -> DataFrame:
    """Zone-hours with more than ``factor`` times the zone's average hourly orders."""
    mean = F.avg("total_orders").over(Window.partitionBy("zone"))
    return (
        demand.filter(F.col("zone").isNotNull())
        .withColumn("zone_avg_orders", mean)
        .withColumn("is_spike", flag(F.col("total_orders") > factor * F.col("zone_avg_orders")))
    )


def latest_zone_row(demand: DataFrame) -> DataFrame:
    """The row of the last date and hour of every zone."""
    kept = [c for c in demand.columns if c != "zone"]
    return (
        demand.filter(F.col("zone").isNotNull())
        .groupBy("zone")
        .agg(F.max_by(F.struct(*kept), F.struct("order_date", "order_hour")).alias("_last"))
        .select("zone", "_last.*")
        .select(*demand.columns)
    )


def order_velocity(orders: DataFrame, demand: DataFrame, window_seconds: int = 3600) -> DataFrame:
    """Orders of the last hour at every moment an order came in, against the baseline.

    One row per zone and second with orders.  A zone's seconds are windowed in chunks
    of one window length; each second is copied into the next chunk as its history.  So
    no window holds more than two window lengths of seconds, however hot the zone is.
    The baseline is the zone's mean for the hour of day, with empty hours as 0.
    """
    second = F.unix_seconds("order_timestamp")
    per_second = (
        orders.filter(F.col("zone").isNotNull() & F.col("order_timestamp").isNotNull())
        .groupBy("zone", second.alias("second"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_home", F.expr(f"second div {window_seconds}"))
        .withColumn("_chunk", F.explode(F.array(F.col("_home"), F.col("_home") + 1)))
    )
    last_hour = (
        Window.partitionBy("zone", "_chunk").orderBy("second").rangeBetween(-window_seconds, 0)
    )
    recent = (
        per_second.withColumn("orders_last_60m", F.sum("_n").over(last_hour))
        .filter(F.col("_chunk") == F.col("_home"))
        .withColumn("order_ts", F.timestamp_seconds("second"))
        .withColumn("order_hour", F.hour("order_ts"))
    )
    baseline = (
        hourly_spine(demand)
        .groupBy("zone", F.hour("hour_ts").alias("order_hour"))
        .agg(F.avg("total_orders").alias("baseline_orders"))
    )
    return recent.join(baseline, ["zone", "order_hour"], "left").select(
        "zone",
        "order_ts",
        "order_hour",
        "orders_last_60m",
        "baseline_orders",
        (F.col("orders_last_60m") / F.nullif("baseline_orders", F.lit(0.0))).alias("velocity"),
    )
