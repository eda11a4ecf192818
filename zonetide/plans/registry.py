"""Every registered query: a name and how it is made from the layers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.calendar import calendar_columns
from ..operators import (
    aggregates,
    cleaning,
    dashboards,
    forecast,
    gold,
    insights,
    joins,
    ml,
    ops,
    quality,
    questions,
    scalars,
)
from ..sources.catalog import layer_counts
from ..sources.files import file_manifest, number_arrivals, read_raw
from ..sources.schemas import ORDERS
from ..streaming import orders as streams
from .layers import BRONZE, GOLD, SILVER, Layers, sample_layers

Query = Callable[[Layers], DataFrame]

ZONE = "NATION_3"
SLICE = {
    "zones": ["NATION_3", "NATION_7"],
    "dates": (date(2024, 1, 9), date(2024, 1, 25)),
    "hours": (17, 22),
}


def _keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("order_id", *columns)


# -- models and predictions, fitted once per set of layers --------------------------


def _training_rows(t: Layers) -> DataFrame:
    return t.remember(
        "training_rows",
        lambda: ml.training_rows(t.table("zone_demand_hourly"), t.table("partner_availability")),
    )


def gbt_model(t: Layers):
    return t.keep(
        "gbt", lambda: ml.fit(ml.gbt(), ml.split(_training_rows(t))[0], ml.FEATURES)
    )


def rf_model(t: Layers):
    return t.keep(
        "rf",
        lambda: ml.fit(ml.random_forest(), ml.split(_training_rows(t))[0], ml.FEATURES),
    )


def metrics(t: Layers, model) -> DataFrame:
    return ml.regression_metrics(ml.score(model, ml.split(_training_rows(t))[1]))


def demand_predictions(t: Layers) -> DataFrame:
    return t.remember(
        "demand_predictions",
        lambda: ml.demand_predictions(ml.scenario_scores(gbt_model(t), _training_rows(t))),
    )


def _compare(t: Layers) -> DataFrame:
    rows = t.remember(
        "training_rows_prep",
        lambda: ml.with_prep_time(_training_rows(t), t.table("restaurants_clean")),
    )
    train, test = ml.split(rows)
    sets = {
        "calendar": ml.CALENDAR_FEATURES,
        "calendar and signals": ml.SIGNAL_FEATURES,
        "starter": ml.STARTER_FEATURES,
    }
    models = {
        ("forest", name): t.keep(f"rf {name}", lambda c=columns: ml.fit(ml.random_forest(), train, c))
        for name, columns in sets.items()
    }
    models |= {("forest", "all"): rf_model(t), ("boosted", "all"): gbt_model(t)}
    return ml.compare_models(models, test)


def _fold_rows(t: Layers) -> DataFrame:
    return t.remember("fold_rows", lambda: ml.walk_forward(_training_rows(t)))


def _backtest(t: Layers) -> DataFrame:
    def model(fold: int, train: DataFrame):
        return t.keep(f"forest of fold {fold}", lambda: ml.fit(ml.random_forest(), train, ml.FEATURES))

    return ml.backtest(_fold_rows(t), model)


def _wma_backtest(t: Layers) -> DataFrame:
    """The heuristic forecast on the test stretches of the same folds."""
    day = F.to_date("hour_ts")
    tagged = ml.walk_forward(_wma(t), day=day, calendar=_training_rows(t))
    tested = tagged.filter(F.col("part") == "test")
    return ml.regression_metrics(tested, prediction="forecast", by=("fold",))


def _next_hour(t: Layers) -> DataFrame:
    rows = t.remember("next_hour_rows", lambda: ml.next_hour_rows(t.table("zone_demand_hourly")))
    return ml.next_hour_predictions(
        rows, t.keep("next hour", lambda: ml.next_hour_model(rows))
    )


def _wma(t: Layers) -> DataFrame:
    """The heuristic forecast as a written table: several queries start from it."""
    return t.remember(
        "wma_forecast", lambda: forecast.weighted_average_forecast(t.table("zone_demand_hourly"))
    )


# -- streams ------------------------------------------------------------------------


def _stream(t: Layers, name: str, make, transform=None) -> DataFrame:
    """Run a stream over the written bronze orders and read its output files.

    Bronze files are written in parallel, so their order says nothing about arrival; all
    of them form one batch.  A landing folder in arrival order can be read in small
    batches with ``files_per_batch``.
    """
    out, checkpoint = t.folder(name), t.folder(f"{name}-checkpoint")
    bronze = t.table("orders_raw")
    spark = t.spark
    source = streams.read_orders(spark, t.path("orders_raw"), bronze.schema)
    result = make(source)
    if transform is None:
        streams.run_to_files(result, out, checkpoint)
        return spark.read.schema(result.schema).parquet(out)
    streams.run_batches(result, transform, out, checkpoint)
    schema = transform(spark.createDataFrame([], result.schema)).schema
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)


#: Deliveries of the registered feed and how far behind the newest order a row may be.
DELIVERIES, FEED_DELAY = 5, "24 hours"


def _feed(t: Layers, name: str, run) -> str:
    """Run a stream over the orders as they are delivered, and name its output folder.

    ``run`` gets the stream, the output and the checkpoint folder, once per delivery.
    """
    out, checkpoint = t.folder(name), t.folder(f"{name}-checkpoint")
    feed = t.remember("orders_feed", lambda: t.raw.orders_feed(DELIVERIES))
    schema = feed.drop("delivery").schema
    spark = t.spark
    with streams.state_partitions(spark, min(spark.sparkContext.defaultParallelism, 64)):
        streams.run_deliveries(
            feed,
            "delivery",
            t.folder(f"{name}-landing"),
            lambda path: run(streams.read_orders(spark, path, schema, FEED_DELAY), out, checkpoint),
        )
    return out


def _feed_to_files(t: Layers, name: str, make) -> DataFrame:
    shape = make(t.table("orders_raw")).schema
    out = _feed(t, name, lambda s, out, cp: streams.run_to_files(make(s), out, cp))
    return t.spark.read.schema(shape).parquet(out)


def _stream_hourly(t: Layers) -> DataFrame:
    master = t.table("restaurants_clean")
    return _feed_to_files(t, "stream_hourly", lambda s: streams.hourly_demand(_deduped(s), master))


def _stream_dedup(t: Layers) -> DataFrame:
    kept = ("order_id", "customer_id", "restaurant_id", "status")
    return _feed_to_files(t, "stream_dedup", lambda s: _deduped(s).select(*kept))


def _deduped(orders: DataFrame) -> DataFrame:
    return streams.dedup(orders) if orders.isStreaming else orders


def _stream_late_rows(t: Layers) -> DataFrame:
    out = _feed(
        t, "stream_late", lambda s, out, cp: streams.run_with_late_rows(s, out, cp, FEED_DELAY)
    )
    rows = streams.late_rows(t.spark, out, t.table("orders_raw").schema)
    return _keys(rows, "arrival_seq", "order_timestamp", "batch", "watermark", "is_late")


def _stream_daily_uniques(t: Layers) -> DataFrame:
    master = t.table("restaurants_clean")
    hours = _feed_to_files(t, "stream_uniques", lambda s: streams.hourly_uniques(s, master))
    return streams.uniques(hours, "zone", F.to_date("window_start").alias("order_date"))


def _stream_velocity(t: Layers) -> DataFrame:
    master = t.table("restaurants_clean")
    return _stream(t, "stream_velocity", lambda s: streams.velocity(streams.dedup(s), master))


def _stream_zone_status(t: Layers) -> DataFrame:
    master, supply = t.table("restaurants_clean"), t.table("partner_availability")
    return _stream(
        t,
        "stream_zone_status",
        lambda s: streams.hourly_demand(streams.dedup(s), master),
        lambda batch: streams.zone_status(batch, supply),
    )


def _late_rows_landing(t: Layers) -> DataFrame:
    """The orders as CSV files in order of arrival, and the late rows of those files."""
    path = t.folder("landing") + "/orders.csv"
    orders = t.table("orders_raw")
    text = orders.repartitionByRange("arrival_seq", "order_timestamp")
    text = text.sortWithinPartitions("arrival_seq", "order_timestamp")
    text = text.select(*(F.col(f.name).cast("string") for f in ORDERS.fields))
    text.write.option("header", True).csv(path)
    numbered = number_arrivals(read_raw(t.spark, path, "orders"), lambda n, df: t.write(f"{n}-csv", df))
    return _keys(quality.flag_late_rows(numbered), "arrival_seq", "order_timestamp", "is_late")


# -- sources, cleaning and quality ----------------------------------------------------

LAYERS_AND_CLEANING: dict[str, Query] = {
    "raw_file_manifest": lambda t: file_manifest(t.spark, t.raw.folder, "*.parquet"),
    "layer_counts_bronze": lambda t: layer_counts({n: t.plan(n) for n in BRONZE}),
    "layer_counts_silver": lambda t: layer_counts({n: t.table(n) for n in SILVER}),
    "layer_counts_gold": lambda t: layer_counts({n: t.table(n) for n in GOLD}),
    "orders_dedup": lambda t: cleaning.dedup_orders(t.plan("orders_raw")),
    "zone_backfill": lambda t: _keys(
        cleaning.backfill_zone(
            cleaning.dedup_orders(t.plan("orders_raw")), t.plan("restaurants_raw")
        ),
        "restaurant_id",
        "zone",
    ),
    "partner_status_flag": lambda t: _keys(
        cleaning.with_partner_status(cleaning.dedup_orders(t.plan("orders_raw"))),
        "partner_id",
        "partner_status",
    ),
    "orders_calendar": lambda t: _keys(
        cleaning.with_calendar(cleaning.dedup_orders(t.plan("orders_raw"))),
        "order_timestamp",
        *calendar_columns("order_timestamp"),
    ),
    "orders_clean": lambda t: t.plan("orders_clean"),
    "restaurants_clean": lambda t: t.plan("restaurants_clean"),
    "delivery_partners_clean": lambda t: t.plan("delivery_partners_clean"),
    "weather_clean": lambda t: t.plan("weather_clean"),
    "local_events_clean": lambda t: t.plan("local_events_clean"),
    "dq_audit": lambda t: quality.audit(t.plan("orders_raw")),
    "null_zone_remaining": lambda t: quality.remaining_null_zones(t.table("orders_clean")),
    "impute_order_value_median": lambda t: _keys(
        quality.impute_order_value(
            t.table("orders_clean"), t.table("restaurants_clean"), keep=t.store
        ),
        "zone",
        "cuisine_type",
        "order_value_inr",
        "value_imputed",
    ),
    "exclude_missing_value": lambda t: _keys(
        quality.exclude_missing_value(t.table("orders_clean")), "order_value_inr"
    ),
    "late_rows_flag": lambda t: _keys(
        quality.flag_late_rows(t.arrivals()), "arrival_seq", "order_timestamp", "is_late"
    ),
    "late_rows_landing": _late_rows_landing,
    "surge_consistency_audit": lambda t: quality.surge_consistency(t.table("orders_clean")),
    "fk_orphans": lambda t: quality.fk_orphans(
        t.table("orders_clean"), t.table("restaurants_clean"), t.table("delivery_partners_clean")
    ),
    "quarantine_bad_rows": lambda t: quality.split_by_schema(t.raw.orders_text)[1].select(
        "arrival_seq", "order_id", "reason"
    ),
}

# -- filters, joins, aggregates and scalar functions ----------------------------------

PARTS: dict[str, Query] = {
    "filter_hour_between": lambda t: _keys(
        aggregates.in_lunch_hours(t.table("orders_clean")), "zone", "order_hour"
    ),
    "filter_isin": lambda t: _keys(
        aggregates.on_weekend(t.table("orders_clean")), "zone", "day_of_week"
    ),
    "filter_late_night": lambda t: _keys(
        aggregates.at_late_night(t.table("orders_clean")), "zone", "order_hour"
    ),
    "join_orders_weather": lambda t: _keys(
        joins.orders_weather(t.table("orders_clean"), t.table("weather_clean")),
        "zone",
        "temperature_c",
        "condition",
        "rain_mm",
        "is_rainy",
    ),
    "join_orders_weather_trunc": lambda t: _keys(
        joins.orders_weather_by_hour_start(t.table("orders_clean"), t.table("weather_clean")),
        "weather_hour_start",
        "temperature_c",
        "condition",
    ),
    "join_orders_events": lambda t: _keys(
        joins.orders_events(t.table("orders_clean"), t.table("local_events_clean")),
        "zone",
        "event_id",
        "event_name",
        "demand_multiplier",
    ),
    "join_zone_contains": lambda t: _keys(
        joins.orders_in_event_zones(t.table("orders_clean"), t.table("local_events_clean")),
        "zone",
        "order_date",
    ),
    "join_event_interval": lambda t: _keys(
        joins.orders_during_events(t.table("orders_clean"), t.table("local_events_clean")),
        "event_id",
        "event_start",
        "event_end",
    ),
    "orders_with_partner": lambda t: _keys(
        joins.orders_partners(t.table("orders_clean"), t.table("delivery_partners_clean")),
        "partner_id",
        "partner_zone",
        "vehicle_type",
        "partner_state",
    ),
    "agg_count_variants": lambda t: aggregates.count_variants(t.table("orders_clean")),
    "agg_multi_distinct": lambda t: aggregates.multi_distinct(t.table("orders_clean")),
    "agg_sum_flags": lambda t: aggregates.sum_flags(t.table("orders_clean")),
    "agg_avg_rounded": lambda t: aggregates.avg_rounded(t.table("orders_clean")),
    "agg_minmax_types": lambda t: aggregates.minmax_types(t.table("orders_clean")),
    "agg_pct": lambda t: aggregates.cancel_pct(t.table("orders_clean")),
    "target_stats": lambda t: questions.target_stats(t.table("zone_demand_hourly")),
    "distinct_zones": lambda t: questions.distinct_zones(t.table("zone_demand_hourly")),
    "fn_date": lambda t: scalars.dates(t.table("orders_clean")),
    "fn_null": lambda t: scalars.nulls(t.table("orders_clean")),
    "fn_case": lambda t: scalars.cases(t.table("orders_clean")),
    "fn_round": lambda t: scalars.rounds(t.table("orders_clean")),
    "fn_bround": lambda t: scalars.brounds(t.table("orders_clean")),
    "fn_cap": lambda t: scalars.caps(t.table("orders_clean")),
    "fn_string": lambda t: scalars.strings(t.table("orders_clean")),
    "fn_cast": lambda t: scalars.casts(t.table("orders_clean")),
    "fn_arith": lambda t: scalars.arithmetic(t.table("orders_clean")),
}

# -- analytic tables ------------------------------------------------------------------

TABLES: dict[str, Query] = {
    "zone_demand_hourly": lambda t: t.plan("zone_demand_hourly"),
    "zone_demand_hourly_exact": lambda t: t.plan("zone_demand_hourly"),
    "zone_demand_hourly_literal": lambda t: t.plan("zone_demand_hourly_literal"),
    "zone_demand_basic": lambda t: gold.zone_demand_basic(t.table("orders_clean")),
    "partner_availability": lambda t: t.plan("partner_availability"),
    "demand_supply_ratio": lambda t: t.plan("demand_supply_ratio"),
    "demand_supply_ratio_literal": lambda t: t.plan("demand_supply_ratio_literal"),
    "customer_360": lambda t: t.plan("customer_360"),
    "restaurant_performance": lambda t: t.plan("restaurant_performance"),
}


# -- dashboards, once over the exact demand and once with repeated event rows -----------


def _dashboards(demand: str, ratio: str) -> dict[str, Query]:
    return {
        "q_zone_leaderboard": lambda t: dashboards.zone_leaderboard(t.table(demand)),
        "q_hourly_weekday_weekend": lambda t: dashboards.hourly_by_day_type(t.table(demand)),
        "q_rain_event_impact": lambda t: dashboards.rain_event_impact(t.table(demand)),
        "q_ds_heatmap": lambda t: dashboards.ds_heatmap(t.table(ratio)),
        "q_critical_alerts": lambda t: dashboards.critical_alerts(t.table(ratio)),
        "q_surge_gap": lambda t: dashboards.surge_gap(t.table(ratio)),
        "q_partner_rebalancing": lambda t: dashboards.partner_rebalancing(
            t.table(ratio), t.table("partner_availability")
        ),
        "q_daily_trend": lambda t: dashboards.daily_trend(t.table(demand)),
    }


DASHBOARDS: dict[str, Query] = {
    "q_kpi_cards": lambda t: dashboards.kpi_cards(t.table("orders_clean"), unique_ids=True),
    **_dashboards("zone_demand_hourly", "demand_supply_ratio"),
    **{
        f"{name}_literal": query
        for name, query in _dashboards(
            "zone_demand_hourly_literal", "demand_supply_ratio_literal"
        ).items()
    },
    "q_ds_heatmap_severity": lambda t: dashboards.ds_heatmap(
        t.table("demand_supply_ratio"), by_severity=True
    ),
    "q_cuisine_performance": lambda t: dashboards.cuisine_performance(
        t.table("restaurant_performance")
    ),
    "q_customer_segments": lambda t: dashboards.customer_segments(t.table("customer_360")),
    "q_predictions": lambda t: dashboards.tonight_forecast(demand_predictions(t)),
    "q_daily_cancellations": lambda t: dashboards.daily_cancellations(
        t.table("zone_demand_hourly")
    ),
    "q_zone_cancel_rate": lambda t: dashboards.zone_cancel_rate(t.table("orders_clean")),
}

# -- time series and models -------------------------------------------------------------

FORECASTS: dict[str, Query] = {
    "latest_zone_row": lambda t: forecast.latest_zone_row(
        t.table("zone_demand_hourly").select("zone", "order_date", "order_hour", "total_orders")
    ),
    "rolling_avg_demand": lambda t: forecast.rolling_average(t.table("zone_demand_hourly")),
    "lag_features": lambda t: forecast.lag_features(
        t.table("zone_demand_hourly"), quiet_days=None
    ),
    "order_velocity": lambda t: forecast.order_velocity(
        t.table("orders_clean"), t.table("zone_demand_hourly")
    ),
    "spike_zone_hours": lambda t: forecast.spike_hours(t.table("zone_demand_hourly"))
    .filter(F.col("is_spike") == 1)
    .select("zone", "order_date", "order_hour", "total_orders", "zone_avg_orders"),
    "next_interval_target": lambda t: forecast.next_interval_target(
        t.remember("interval_orders", lambda: forecast.interval_orders(t.table("orders_clean")))
    ),
    "rank_zones": lambda t: questions.rank_zones(t.table("zone_demand_hourly")),
    "wma_forecast": lambda t: forecast.weighted_average_forecast(t.table("zone_demand_hourly")),
    "ml_features": lambda t: ml.features(
        t.table("zone_demand_hourly"), t.table("partner_availability")
    ),
    "ml_zone_encoded": lambda t: ml.with_zone_code(
        ml.features(t.table("zone_demand_hourly"), t.table("partner_availability"))
    ).select("zone", "order_date", "order_hour", "zone_encoded"),
    "ml_interactions": lambda t: ml.with_interactions(
        ml.features(t.table("zone_demand_hourly"), t.table("partner_availability"))
    ).select(
        "zone",
        "order_date",
        "order_hour",
        "rain_x_dinner",
        "event_x_evening",
        "weekend_x_lunch",
    ),
    "ml_features_prep": lambda t: ml.with_prep_time(
        ml.features(t.table("zone_demand_hourly"), t.table("partner_availability")),
        t.table("restaurants_clean"),
    ).select("zone", "order_date", *ml.STARTER_FEATURES, "total_orders"),
    "ml_split_counts": lambda t: ml.split_counts(
        ml.features(t.table("zone_demand_hourly"), t.table("partner_availability"))
    ),
    "regression_metrics": lambda t: ml.regression_metrics(_wma(t), prediction="forecast"),
    "fold_counts": lambda t: ml.fold_counts(_fold_rows(t)),
    "wma_backtest": _wma_backtest,
    "ml_backtest": _backtest,
    "ml_gbt_metrics": lambda t: metrics(t, gbt_model(t)),
    "ml_rf_metrics": lambda t: metrics(t, rf_model(t)),
    "ml_feature_importance": lambda t: ml.feature_importance(t.spark, gbt_model(t)),
    "ml_scenario_predictions": lambda t: ml.scenario_scores(gbt_model(t), _training_rows(t)),
    "ml_pred_vs_actual": lambda t: ml.predicted_vs_actual(
        gbt_model(t), ml.split(_training_rows(t))[1]
    ),
    "ml_model_comparison": _compare,
    "ml_next_hour": _next_hour,
    "demand_predictions": demand_predictions,
}

# -- decision rules and operations --------------------------------------------------------

OPERATIONS: dict[str, Query] = {
    "static_surge": lambda t: t.table("orders_clean").select(
        "order_id",
        "order_hour",
        "surge_multiplier",
        rules.static_surge("order_hour", "rain_at_order_time", "event_active").alias("static_surge"),
    ),
    "prediction_rules": lambda t: forecast.prediction_rules(
        _wma(t), t.table("partner_availability")
    ),
    "demand_alerts": lambda t: ops.demand_alerts(_wma(t), t.table("partner_availability")),
    "rebalance_plan": lambda t: ops.rebalance_plan(t.table("demand_supply_ratio")),
    "ops_console_slice": lambda t: ops.console_slice(
        t.table("demand_supply_ratio"), _wma(t), **SLICE
    ),
    "idle_partner_share": lambda t: ops.idle_partner_share(t.table("demand_supply_ratio")),
    "spike_kpis": lambda t: ops.spike_kpis(t.table("zone_demand_hourly")),
    "partner_utilisation": lambda t: ops.partner_utilisation(
        t.table("orders_clean"),
        t.table("delivery_partners_clean"),
        t.table("partner_availability"),
    ),
}

# -- named questions and insights -----------------------------------------------------------

QUESTIONS: dict[str, Query] = {
    "nq_top_demand_now": lambda t: questions.top_demand_now(t.table("zone_demand_hourly")),
    "nq_zone_trend": lambda t: questions.zone_trend(t.table("zone_demand_hourly"), ZONE),
    "nq_weekday_weekend_by_zone": lambda t: questions.weekday_weekend_by_zone(
        t.table("zone_demand_hourly")
    ),
    "nq_peak_hour": lambda t: questions.peak_hour(t.table("zone_demand_hourly")),
    "nq_critical_now": lambda t: questions.critical_now(t.table("demand_supply_ratio")),
    "nq_need_partners": lambda t: questions.need_partners(t.table("demand_supply_ratio")),
    "nq_zone_dinner_ds": lambda t: questions.zone_dinner_ratio(
        t.table("demand_supply_ratio"), ZONE
    ),
    "nq_rain_cancel": lambda t: questions.rain_cancellations(t.table("zone_demand_hourly")),
    "nq_match_days": lambda t: questions.match_days(t.table("zone_demand_hourly")),
    "nq_rain_dinner_eta": lambda t: questions.rain_dinner_eta(t.table("zone_demand_hourly")),
    "nq_weather_sensitivity": lambda t: questions.weather_sensitivity(
        t.table("zone_demand_hourly")
    ),
    "nq_surge_compare": lambda t: dashboards.surge_compare(t.table("demand_supply_ratio")),
    "nq_surge_too_low": lambda t: questions.surge_too_low(t.table("demand_supply_ratio")),
    "nq_surge_over_2": lambda t: questions.surge_over(t.table("demand_supply_ratio")),
    "nq_power_users": lambda t: questions.power_users(t.table("customer_360")),
    "nq_segment_spend": lambda t: questions.segment_spend(t.table("customer_360")),
    "nq_segment_cancel": lambda t: questions.segment_cancellations(t.table("customer_360")),
    "nq_pred_rebalance": lambda t: questions.predicted_rebalancing(demand_predictions(t)),
    "nq_pred_vs_actual": lambda t: forecast.predicted_vs_actual(_wma(t)),
    "in_match_day_lift": lambda t: insights.match_day_lift(t.table("zone_demand_hourly")),
    "in_rain_dinner_cancel": lambda t: insights.rain_dinner_cancellations(t.table("orders_clean")),
    "in_weekend_lift": lambda t: insights.weekend_lift(t.table("zone_demand_hourly")),
    "in_zone_imbalance": lambda t: insights.zone_imbalance(t.table("demand_supply_ratio")),
    "in_late_night_dead": lambda t: insights.late_night_zones(
        t.table("zone_demand_hourly"), t.table("partner_availability")
    ),
    "in_zone_peak_hour": lambda t: insights.zone_peak_hour(t.table("zone_demand_hourly")),
}

STREAMS: dict[str, Query] = {
    "stream_hourly_demand": _stream_hourly,
    "stream_dedup": _stream_dedup,
    "stream_late_rows": _stream_late_rows,
    "stream_daily_uniques": _stream_daily_uniques,
    "stream_velocity": _stream_velocity,
    "stream_zone_status": _stream_zone_status,
}

ALL: dict[str, Query] = {
    **LAYERS_AND_CLEANING,
    **PARTS,
    **TABLES,
    **DASHBOARDS,
    **FORECASTS,
    **OPERATIONS,
    **QUESTIONS,
    **STREAMS,
}


def bind(name: str) -> Callable[[SparkSession, str], DataFrame]:
    query = ALL[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(sample_layers(spark, sf_dir))

    run.__name__ = name
    return run
