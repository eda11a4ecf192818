"""DuckDB SQL per registered query.  Queries without an entry have no SQL equivalent."""

from __future__ import annotations

from .compose import with_tables
from .tables import big, int_avg, money_avg, money_sum, pct, r


def half_even(x: str, digits: int) -> str:
    """Half-even rounding of the shortest decimal form of a double."""
    unit = 10**digits
    d = f"(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)) * {unit})"
    f = f"FLOOR({d})"
    return (
        f"CAST((CASE WHEN {d} - {f} > 0.5 THEN {f} + 1 WHEN {d} - {f} < 0.5 THEN {f} "
        f"WHEN {f} % 2 = 0 THEN {f} ELSE {f} + 1 END) AS DOUBLE) / {unit}.0::DOUBLE"
    )


def rupees(x: str) -> str:
    return f"'₹' || format('{{:,.0f}}', {x})"


def _counts(*pairs: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS tbl, COUNT(*) AS rows FROM {table}" for label, table in pairs
    )


def _dashboards(demand: str, ratio: str) -> dict[str, str]:
    cancel = f"{r(money_avg('cancellation_rate_pct'), 1)}"
    cohort = (
        f"{r(int_avg('total_orders'), 0)} AS avg_orders, {cancel} AS cancel_rate, "
        f"{r(money_avg('avg_eta_overshoot'), 1)} AS eta_overshoot FROM {demand}"
    )
    return {
        "q_zone_leaderboard": f"""
SELECT zone, {big('SUM(total_orders)')} AS total_orders, {rupees(money_sum('total_revenue'))} AS total_revenue,
       {cancel} AS cancel_rate_pct, {r(money_avg('avg_eta_overshoot'), 1)} AS avg_eta_overshoot,
       {r(money_avg('avg_surge'), 2)} AS avg_surge
FROM {demand} WHERE zone IS NOT NULL GROUP BY zone""",
        "q_hourly_weekday_weekend": f"""
SELECT order_hour, CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
       {r(int_avg('total_orders'), 0)} AS avg_orders, {cancel} AS cancel_rate
FROM {demand} GROUP BY 1, 2""",
        "q_rain_event_impact": f"""
SELECT 'Clear' AS condition, {cohort} WHERE is_rainy = 0
UNION ALL SELECT 'Rainy', {cohort} WHERE is_rainy = 1
UNION ALL SELECT 'No Event', {cohort} WHERE event_flag = 0
UNION ALL SELECT 'Event Active', {cohort} WHERE event_flag = 1""",
        "q_ds_heatmap": f"""
SELECT zone, order_hour, {r(money_avg('demand_supply_ratio'), 2)} AS ds_ratio, MAX(zone_status) AS status
FROM {ratio} GROUP BY zone, order_hour""",
        "q_critical_alerts": f"""
SELECT zone, order_date, order_hour, total_orders, active_partners, demand_supply_ratio, zone_status,
       cancellation_rate_pct, avg_eta_overshoot, recommended_surge, partner_rebalance_count,
       CASE is_rainy WHEN 1 THEN 'Yes' ELSE 'No' END AS raining, event_name
FROM {ratio} WHERE zone_status = 'CRITICAL'
ORDER BY demand_supply_ratio DESC, zone, order_date, order_hour LIMIT 25""",
        "q_surge_gap": f"""
SELECT zone, {r(money_avg('avg_surge'), 2)} AS current_avg_surge,
       {r(money_avg('recommended_surge'), 2)} AS recommended_avg_surge,
       {r(f"({money_avg('recommended_surge')} - {money_avg('avg_surge')})", 2)} AS surge_gap,
       {big('SUM(total_orders)')} AS total_orders, {cancel} AS cancel_rate
FROM {ratio} GROUP BY zone HAVING {money_avg('recommended_surge')} > 1.0""",
        "q_partner_rebalancing": f"""
SELECT *, CASE WHEN avg_ds_ratio > 2.5 THEN '🔴 NEEDS +' || total_rebalance_needed || ' partners'
               WHEN avg_ds_ratio < 0.5 THEN '🟢 EXCESS: move ' || ABS(total_rebalance_needed) || ' out'
               ELSE '🟡 Balanced' END AS action
FROM (SELECT d.zone, {r(money_avg('d.demand_supply_ratio'), 2)} AS avg_ds_ratio, p.active_partners,
             {r(int_avg('d.total_orders'), 0)} AS avg_hourly_orders,
             {r(money_avg('d.cancellation_rate_pct'), 1)} AS cancel_rate,
             {big('SUM(d.partner_rebalance_count)')} AS total_rebalance_needed
      FROM {ratio} d JOIN availability p ON d.zone = p.zone GROUP BY d.zone, p.active_partners)""",
        "q_daily_trend": f"""
SELECT order_date, {big('SUM(total_orders)')} AS daily_orders, {r(money_sum('total_revenue'), 0)} AS daily_revenue,
       {cancel} AS cancel_rate, MAX(event_name) FILTER (event_name <> 'None') AS event
FROM {demand} GROUP BY order_date""",
    }


_TRUE_RATES = f"""{big('SUM(total_orders)')} AS total_orders,
       {big('SUM(total_cancellations)')} AS total_cancellations,
       {pct('SUM(total_cancellations)', 'SUM(total_orders)', 2)} AS cancel_rate_pct"""

_LATEST = "(SELECT MAX({t}.order_date + to_hours({t}.order_hour)) FROM {t})"


def _now(table: str) -> str:
    return f"order_date + to_hours(order_hour) = {_LATEST.format(t=table)}"


_STATIC = """ROUND(CASE WHEN order_hour IN (12, 13) THEN 1.3::DOUBLE WHEN order_hour IN (19, 20, 21) THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END
       + CASE WHEN rain_at_order_time = 1 THEN 0.3::DOUBLE ELSE 0::DOUBLE END
       + CASE WHEN event_active = 1 THEN 0.5::DOUBLE ELSE 0::DOUBLE END, 1)"""

_ZONED = """SELECT o.* EXCLUDE (zone), COALESCE(NULLIF(o.zone, ''), m.zone) AS zone
  FROM orders_dedup o LEFT JOIN restaurants_raw m ON o.restaurant_id = m.restaurant_id"""
_WATERMARK = "(SELECT MAX(order_timestamp) - INTERVAL 4 HOUR FROM orders_raw)"
_HOURLY_STREAM = f"""SELECT zone, window_start, window_start + INTERVAL 1 HOUR AS window_end,
         COUNT(order_id) AS total_orders, COUNT(*) FILTER (status = 'cancelled') AS total_cancellations,
         {money_sum('order_value_inr')} AS order_value
  FROM (SELECT *, date_trunc('hour', order_timestamp) AS window_start FROM ({_ZONED}))
  WHERE window_start + INTERVAL 1 HOUR <= {_WATERMARK} GROUP BY zone, window_start"""

_PARTS: dict[str, str] = {
    # sources, cleaning and quality
    "layer_counts_bronze": _counts(
        ("orders_raw", "orders_raw"),
        ("restaurants_raw", "restaurants_raw"),
        ("delivery_partners_raw", "delivery_partners_raw"),
        ("weather_hourly_raw", "weather_hourly_raw"),
        ("local_events_raw", "local_events_raw"),
    ),
    "layer_counts_silver": _counts(
        ("orders_clean", "orders_clean"),
        ("restaurants_clean", "restaurants_raw"),
        ("delivery_partners_clean", "partners_clean"),
        ("weather_clean", "weather_clean"),
        ("local_events_clean", "local_events_clean"),
    ),
    "layer_counts_gold": _counts(
        ("zone_demand_hourly", "demand_exact"),
        ("partner_availability", "availability"),
        ("demand_supply_ratio", "ratio_exact"),
        ("customer_360", "customers_360"),
        ("restaurant_performance", "performance"),
    ),
    "orders_dedup": "SELECT * FROM orders_dedup",
    "zone_backfill": "SELECT order_id, restaurant_id, zone FROM orders_repaired",
    "partner_status_flag": "SELECT order_id, partner_id, partner_status FROM orders_clean",
    "orders_calendar": """SELECT order_id, order_timestamp, order_date, order_hour, day_of_week, is_weekend,
       is_lunch_hour, is_dinner_hour, is_late_night FROM orders_clean""",
    "orders_clean": "SELECT * FROM orders_clean",
    "restaurants_clean": "SELECT * FROM restaurants_raw",
    "delivery_partners_clean": "SELECT * FROM partners_clean",
    "weather_clean": "SELECT * FROM weather_clean",
    "local_events_clean": "SELECT * FROM local_events_clean",
    "dq_audit": """
SELECT metric, CAST(n AS BIGINT) AS "count", CAST(n AS DOUBLE) / total * 100.0::DOUBLE AS percentage FROM (
  SELECT (SELECT COUNT(*) FROM orders_raw) AS total, * FROM (
    SELECT 'Total rows' AS metric, COUNT(*) AS n FROM orders_raw
    UNION ALL SELECT 'Duplicate order_ids', COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT order_id FROM orders_raw)) FROM orders_raw
    UNION ALL SELECT 'Missing zone', COUNT(*) FROM orders_raw WHERE COALESCE(zone, '') = ''
    UNION ALL SELECT 'Missing partner_id', COUNT(*) FROM orders_raw WHERE COALESCE(partner_id, '') = ''
    UNION ALL SELECT 'Missing order_value', COUNT(*) FROM orders_raw WHERE order_value_inr IS NULL))""",
    "null_zone_remaining": """
SELECT COUNT(*) AS total_orders, COUNT(*) FILTER (zone IS NULL) AS remaining_null_zones FROM orders_clean""",
    "impute_order_value_median": """
WITH known AS (SELECT o.order_id, o.zone, m.cuisine_type, o.order_value_inr
               FROM orders_clean o LEFT JOIN restaurants_raw m ON o.restaurant_id = m.restaurant_id),
groups AS (SELECT zone, cuisine_type, list_sort(list(order_value_inr)) AS v
           FROM known WHERE order_value_inr IS NOT NULL GROUP BY zone, cuisine_type),
everything AS (SELECT list_sort(list(order_value_inr)) AS v FROM known WHERE order_value_inr IS NOT NULL)
SELECT k.order_id, k.zone, k.cuisine_type,
       COALESCE(k.order_value_inr, (g.v[(len(g.v) + 1) // 2] + g.v[(len(g.v) + 2) // 2]) / 2.0::DOUBLE,
                (SELECT (v[(len(v) + 1) // 2] + v[(len(v) + 2) // 2]) / 2.0::DOUBLE FROM everything)) AS order_value_inr,
       CASE WHEN k.order_value_inr IS NULL THEN 1 ELSE 0 END AS value_imputed
FROM known k LEFT JOIN groups g ON g.zone = k.zone AND g.cuisine_type = k.cuisine_type""",
    "exclude_missing_value": "SELECT order_id, order_value_inr FROM orders_clean WHERE order_value_inr IS NOT NULL",
    "late_rows_landing": """
SELECT order_id, ROW_NUMBER() OVER arrival - 1 AS arrival_seq, order_timestamp,
       CASE WHEN order_timestamp < MAX(order_timestamp) OVER (arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS is_late
FROM orders_raw WINDOW arrival AS (ORDER BY arrival_seq, order_timestamp)""",
    "late_rows_flag": """
SELECT order_id, arrival_seq, order_timestamp, CASE WHEN order_timestamp < seen THEN 1 ELSE 0 END AS is_late
FROM (SELECT *, MAX(order_timestamp) OVER (ORDER BY arrival_seq RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
      FROM orders_raw)""",
    "surge_consistency_audit": f"""
SELECT period, rain_at_order_time, event_active, expected_surge, COUNT(*) AS orders,
       COUNT(*) FILTER (surge_multiplier = expected_surge) AS consistent,
       COUNT(*) FILTER (surge_multiplier < expected_surge) AS too_low,
       COUNT(*) FILTER (surge_multiplier > expected_surge) AS too_high,
       {r(money_avg('surge_multiplier'), 2)} AS avg_applied_surge
FROM (SELECT *, {_STATIC} AS expected_surge,
             CASE WHEN order_hour IN (12, 13) THEN 'lunch' WHEN order_hour IN (19, 20, 21) THEN 'dinner' ELSE 'other' END AS period
      FROM orders_clean)
GROUP BY ALL""",
    "fk_orphans": """
SELECT 'restaurant_id' AS foreign_key, COUNT(DISTINCT restaurant_id) AS orphan_keys, COUNT(*) AS orphan_orders
FROM orders_clean WHERE restaurant_id IS NOT NULL AND restaurant_id NOT IN (SELECT restaurant_id FROM restaurants_raw)
UNION ALL
SELECT 'partner_id', COUNT(DISTINCT partner_id), COUNT(*)
FROM orders_clean WHERE partner_id IS NOT NULL AND partner_id NOT IN (SELECT partner_id FROM partners_clean)""",
    "quarantine_bad_rows": """
SELECT arrival_seq, order_id, reason FROM (
  SELECT arrival_seq, order_id, concat_ws('; ',
    CASE WHEN COALESCE(order_id, '') = '' THEN 'missing order_id' END,
    CASE WHEN order_timestamp IS NOT NULL AND TRY_CAST(order_timestamp AS TIMESTAMP) IS NULL THEN 'bad order_timestamp' END,
    CASE WHEN order_value_inr IS NOT NULL AND TRY_CAST(order_value_inr AS DOUBLE) IS NULL THEN 'bad order_value_inr' END,
    CASE WHEN estimated_eta_mins IS NOT NULL AND TRY_CAST(estimated_eta_mins AS INTEGER) IS NULL THEN 'bad estimated_eta_mins' END,
    CASE WHEN status NOT IN ('delivered', 'cancelled', 'in_transit', 'preparing') THEN 'unknown status' END) AS reason
  FROM orders_text) WHERE reason <> ''""",
    # filters and joins
    "filter_hour_between": "SELECT order_id, zone, order_hour FROM orders_clean WHERE order_hour BETWEEN 11 AND 14",
    "filter_isin": "SELECT order_id, zone, day_of_week FROM orders_clean WHERE day_of_week IN (1, 7)",
    "filter_late_night": "SELECT order_id, zone, order_hour FROM orders_clean WHERE order_hour >= 23 OR order_hour <= 5",
    "join_orders_weather": """
SELECT o.order_id, o.zone, w.temperature_c, w.condition, w.rain_mm, w.is_rainy
FROM orders_clean o LEFT JOIN weather_clean w
  ON o.zone = w.zone AND o.order_date = w.weather_date AND o.order_hour = w.weather_hour""",
    "join_orders_weather_trunc": """
SELECT o.order_id, date_trunc('hour', o.order_timestamp) AS weather_hour_start, w.temperature_c, w.condition
FROM orders_clean o LEFT JOIN weather_clean w
  ON o.zone = w.zone AND date_trunc('hour', o.order_timestamp) = w."timestamp" """,
    "join_orders_events": """
SELECT o.order_id, o.zone, e.event_id, e.event_name, e.demand_multiplier
FROM orders_clean o LEFT JOIN local_events_clean e ON o.zone = e.zone AND o.order_date = e."date" """,
    "join_zone_contains": """
SELECT order_id, zone, order_date FROM orders_clean o
WHERE EXISTS (SELECT 1 FROM local_events_raw e
              WHERE e."date" = o.order_date
                AND list_contains(string_split(replace(e.zones_impacted, ' ', ''), ','), o.zone))""",
    "join_event_interval": """
SELECT o.order_id, event_id, event_start, event_end
FROM orders_clean o JOIN (
  SELECT zone, event_id, s AS event_start, CASE WHEN e < s THEN e + INTERVAL 1 DAY ELSE e END AS event_end
  FROM (SELECT *, "date" + CAST(start_time || ':00' AS TIME) AS s, "date" + CAST(end_time || ':00' AS TIME) AS e FROM local_events_clean)) v
 ON o.zone = v.zone AND o.order_timestamp >= event_start AND o.order_timestamp < event_end""",
    "orders_with_partner": """
SELECT o.order_id, o.partner_id, p.zone AS partner_zone, p.vehicle_type, p.status AS partner_state
FROM orders_clean o LEFT JOIN partners_clean p ON o.partner_id = p.partner_id""",
    # aggregates
    "agg_count_variants": """
SELECT status, COUNT(*) AS rows, COUNT(partner_id) AS with_partner, COUNT(order_value_inr) AS with_value
FROM orders_clean GROUP BY status""",
    "agg_multi_distinct": """
SELECT zone, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT restaurant_id) AS restaurants,
       COUNT(DISTINCT partner_id) AS partners FROM orders_clean GROUP BY zone""",
    "agg_sum_flags": "SELECT zone, "
    + ", ".join(
        f"{big(f'SUM({c})')} AS sum_{c}"
        for c in ("is_cancelled", "is_weekend", "is_lunch_hour", "is_dinner_hour", "is_late_night")
    )
    + " FROM orders_clean GROUP BY zone",
    "agg_avg_rounded": f"""
SELECT payment_mode, {r(money_avg('order_value_inr'), 2)} AS avg_order_value,
       {r(int_avg('actual_delivery_mins'), 1)} AS avg_delivery_mins,
       {r(int_avg('eta_overshoot_mins'), 1)} AS avg_eta_overshoot
FROM orders_clean GROUP BY payment_mode""",
    "agg_minmax_types": """
SELECT zone, MIN(order_value_inr) AS min_value, MAX(order_value_inr) AS max_value,
       MIN(order_date) AS min_date, MAX(order_date) AS max_date,
       MIN(status) AS min_status, MAX(status) AS max_status FROM orders_clean GROUP BY zone""",
    "agg_pct": f"SELECT zone, {pct('SUM(is_cancelled)', 'COUNT(*)')} AS cancel_rate_pct FROM orders_clean GROUP BY zone",
    "target_stats": """
SELECT COUNT(total_orders) AS rows, ROUND(AVG(total_orders), 4) AS mean_orders,
       ROUND(STDDEV_SAMP(total_orders), 4) AS std_orders FROM demand_exact WHERE zone IS NOT NULL""",
    "distinct_zones": "SELECT DISTINCT zone FROM demand_exact WHERE zone IS NOT NULL",
    # scalar functions
    "fn_date": """
SELECT order_id, order_date, order_hour, day_of_week,
       CAST(date_diff('day', order_date, CAST(delivery_timestamp AS DATE)) AS INTEGER) AS days_to_deliver,
       CASE WHEN TRY_CAST('on ' || CAST(order_timestamp AS VARCHAR) AS TIMESTAMP) IS NULL THEN 1 ELSE 0 END AS bad_text
FROM orders_clean""",
    "fn_null": """
SELECT order_id, COALESCE(order_value_inr, 0::DOUBLE) AS value_or_zero, NULLIF(discount_inr, 0) AS discount_or_null,
       order_value_inr / NULLIF(discount_inr, 0) AS value_per_discount FROM orders_clean""",
    "fn_case": """
SELECT order_id, CASE WHEN order_value_inr > 100 THEN 'high' WHEN order_value_inr > 20 THEN 'medium'
                      ELSE 'low or unknown' END AS value_band,
       NULLIF(status, 'delivered') AS open_status FROM orders_clean""",
    "fn_round": f"""
SELECT order_id, {r('(order_value_inr / 3.0::DOUBLE)', 2)} AS third_r2, {r('order_value_inr', 1)} AS value_r1,
       CAST({r('order_value_inr', 0)} AS INTEGER) AS value_int FROM orders_clean""",
    "fn_bround": f"""
SELECT order_id, {half_even('order_value_inr', 1)} AS value_b1,
       CAST({half_even('(CAST(estimated_eta_mins AS DOUBLE) / 2)', 0)} AS BIGINT) AS half_eta FROM orders_clean""",
    "fn_cap": """
SELECT order_id, LEAST(surge_multiplier * 2, 2.5::DOUBLE) AS capped_surge,
       GREATEST(COALESCE(eta_overshoot_mins, 0), 0) AS late_mins, ABS(order_value_inr - 50.0::DOUBLE) AS distance_to_50
FROM orders_clean""",
    "fn_string": """
SELECT order_id, zone || '@' || order_hour AS zone_hour, '₹' || format('{:,}', estimated_eta_mins * 1000) AS eta_label,
       payment_mode FROM orders_clean""",
    "fn_cast": """
SELECT order_id, CAST(estimated_eta_mins AS VARCHAR) AS eta_text, CAST(estimated_eta_mins AS DOUBLE) AS eta_double,
       TRY_CAST(substr(order_id, 5) AS BIGINT) AS order_number, CAST(order_date AS VARCHAR) AS date_text FROM orders_clean""",
    "fn_arith": """
SELECT order_id, CAST(estimated_eta_mins AS DOUBLE) / 7 AS eta_over_7, -estimated_eta_mins AS minus_eta,
       order_value_inr * 2 - discount_inr AS double_net, estimated_eta_mins + actual_delivery_mins AS eta_sum
FROM orders_clean""",
    # analytic tables
    "zone_demand_hourly": "SELECT * FROM demand_exact",
    "zone_demand_hourly_exact": "SELECT * FROM demand_exact",
    "zone_demand_hourly_literal": "SELECT * FROM demand_literal",
    "zone_demand_basic": f"""
SELECT order_date, order_hour, zone, COUNT(order_id) AS total_orders, {money_avg('order_value_inr')} AS avg_order_value,
       {int_avg('actual_delivery_mins')} AS avg_delivery_mins, {big('SUM(is_cancelled)')} AS total_cancellations,
       {money_avg('surge_multiplier')} AS avg_surge, MAX(rain_at_order_time) AS rain_flag, MAX(event_active) AS event_flag
FROM orders_clean GROUP BY order_date, order_hour, zone""",
    "partner_availability": "SELECT * FROM availability",
    "demand_supply_ratio": "SELECT * FROM ratio_exact",
    "demand_supply_ratio_literal": "SELECT * FROM ratio_literal",
    "customer_360": "SELECT * FROM customers_360",
    "restaurant_performance": "SELECT * FROM performance",
    # dashboards
    "q_kpi_cards": f"""
SELECT COUNT(DISTINCT order_id) AS total_orders, COUNT(DISTINCT customer_id) AS unique_customers,
       {rupees(money_sum('net_order_value'))} AS total_revenue, {r(int_avg('actual_delivery_mins'), 1)} AS avg_delivery_mins,
       {pct('SUM(is_cancelled)', 'COUNT(*)')} AS cancel_rate_pct, {r(int_avg('eta_overshoot_mins'), 1)} AS avg_eta_overshoot
FROM orders_clean""",
    **_dashboards("demand_exact", "ratio_exact"),
    **{f"{k}_literal": v for k, v in _dashboards("demand_literal", "ratio_literal").items()},
    "q_ds_heatmap_severity": f"""
SELECT zone, order_hour, {r(money_avg('demand_supply_ratio'), 2)} AS ds_ratio,
       CASE MAX(CASE zone_status WHEN 'CRITICAL' THEN 4 WHEN 'STRESSED' THEN 3 WHEN 'MODERATE' THEN 2 ELSE 1 END)
            WHEN 4 THEN 'CRITICAL' WHEN 3 THEN 'STRESSED' WHEN 2 THEN 'MODERATE' ELSE 'HEALTHY' END AS status
FROM ratio_exact GROUP BY zone, order_hour""",
    "q_cuisine_performance": f"""
SELECT cuisine_type, COUNT(*) AS restaurants, {big('SUM(total_orders)')} AS total_orders,
       {rupees(money_sum('total_revenue'))} AS total_revenue, {r(money_avg('avg_order_value'), 0)} AS avg_order_value,
       {r(money_avg('cancel_rate_pct'), 1)} AS cancel_rate, {r(money_avg('avg_delivery_mins'), 1)} AS avg_delivery_mins
FROM performance GROUP BY cuisine_type""",
    "q_customer_segments": f"""
SELECT customer_segment, COUNT(*) AS customers, {r(money_avg('total_spend'), 0)} AS avg_spend,
       {r(money_avg('avg_order_value'), 0)} AS avg_order_value, {r(int_avg('total_orders'), 1)} AS avg_orders,
       {r(money_avg('cancel_rate_pct'), 1)} AS cancel_rate,
       {r(f"({int_avg('dinner_orders')} * 100.0::DOUBLE / {int_avg('total_orders')})", 0)} AS dinner_pct
FROM customers_360 GROUP BY customer_segment""",
    "q_daily_cancellations": f"""
SELECT order_date, {big('SUM(total_orders)')} AS daily_orders, {r(money_sum('total_revenue'), 0)} AS daily_revenue,
       {big('SUM(total_cancellations)')} AS daily_cancellations FROM demand_exact GROUP BY order_date""",
    "q_zone_cancel_rate": f"""
SELECT zone, COUNT(*) AS total_orders, {big('SUM(is_cancelled)')} AS cancellations,
       {pct('SUM(is_cancelled)', 'COUNT(*)', 2)} AS cancel_rate_pct FROM orders_clean GROUP BY zone""",
    # time series
    "latest_zone_row": """
SELECT zone, order_date, order_hour, total_orders FROM demand_exact WHERE zone IS NOT NULL
QUALIFY ROW_NUMBER() OVER (PARTITION BY zone ORDER BY order_date DESC NULLS LAST, order_hour DESC) = 1""",
    "rolling_avg_demand": """
SELECT zone, hour_ts, total_orders, CASE WHEN COUNT(*) OVER k = 24 THEN CAST(SUM(total_orders) OVER k AS DOUBLE) / 24 END AS rolling_avg
FROM spine WINDOW k AS (PARTITION BY zone ORDER BY hour_ts ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)""",
    "lag_features": "SELECT * FROM lags",
    "order_velocity": """
WITH per AS (SELECT zone, CAST(floor(epoch(order_timestamp)) AS BIGINT) AS s, COUNT(*) AS n
             FROM orders_clean WHERE zone IS NOT NULL AND order_timestamp IS NOT NULL GROUP BY ALL),
recent AS (SELECT zone, to_timestamp(s) AT TIME ZONE 'UTC' AS order_ts,
                  CAST(SUM(n) OVER (PARTITION BY zone ORDER BY s RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS BIGINT) AS orders_last_60m
           FROM per),
base AS (SELECT zone, CAST(extract(hour FROM hour_ts) AS INTEGER) AS order_hour, CAST(SUM(total_orders) AS DOUBLE) / COUNT(*) AS baseline_orders
         FROM spine GROUP BY ALL)
SELECT q.zone, q.order_ts, CAST(extract(hour FROM q.order_ts) AS INTEGER) AS order_hour, q.orders_last_60m, b.baseline_orders,
       q.orders_last_60m / NULLIF(b.baseline_orders, 0) AS velocity
FROM recent q LEFT JOIN base b ON b.zone = q.zone AND b.order_hour = extract(hour FROM q.order_ts)""",
    "spike_zone_hours": "SELECT zone, order_date, order_hour, total_orders, zone_avg_orders FROM spikes WHERE is_spike = 1",
    "next_interval_target": """
WITH counts AS (SELECT zone, time_bucket(INTERVAL 30 MINUTE, order_timestamp) AS interval_ts, COUNT(*) AS orders_n
                FROM orders_clean WHERE zone IS NOT NULL AND order_timestamp IS NOT NULL GROUP BY ALL),
grid AS (SELECT z.zone, unnest(generate_series((SELECT MIN(interval_ts) FROM counts), (SELECT MAX(interval_ts) FROM counts), INTERVAL 30 MINUTE)) AS interval_ts
         FROM (SELECT DISTINCT zone FROM counts) z),
filled AS (SELECT g.zone, g.interval_ts, COALESCE(c.orders_n, 0) AS n FROM grid g LEFT JOIN counts c USING (zone, interval_ts))
SELECT zone, interval_ts, n AS orders, LEAD(n, 1) OVER w AS orders_next_30, LEAD(n, 2) OVER w AS orders_next_60
FROM filled WINDOW w AS (PARTITION BY zone ORDER BY interval_ts)""",
    "rank_zones": f"""
SELECT *, CAST(RANK() OVER (ORDER BY total_orders DESC) AS INTEGER) AS volume_rank,
       CAST(RANK() OVER (ORDER BY cancel_rate_pct DESC) AS INTEGER) AS cancel_rank
FROM (SELECT zone, {_TRUE_RATES} FROM demand_exact WHERE zone IS NOT NULL GROUP BY zone)""",
    "wma_forecast": "SELECT * FROM wma",
    # model inputs and metrics
    "ml_features": "SELECT * FROM features",
    "ml_zone_encoded": "SELECT zone, order_date, order_hour, zone_encoded FROM coded",
    "ml_interactions": """
SELECT zone, order_date, order_hour, rain_flag * is_dinner AS rain_x_dinner, event_flag * is_dinner AS event_x_evening,
       is_weekend * is_lunch AS weekend_x_lunch FROM features""",
    "ml_features_prep": """
SELECT f.zone, f.order_date, f.order_hour, f.day_of_week, f.is_weekend, f.rain_flag, f.event_flag, f.active_partners,
       p.prep AS avg_prep_time, f.total_orders
FROM features f LEFT JOIN (SELECT zone, CAST(SUM(avg_prep_time_mins) AS DOUBLE) / COUNT(*) AS prep FROM restaurants_raw GROUP BY zone) p
  ON p.zone = f.zone""",
    "ml_split_counts": f"""
SELECT CASE WHEN CAST('0x' || substr(md5(zone || '|' || order_date || '|' || order_hour), 1, 8) AS BIGINT) % 5 = 0
            THEN 'test' ELSE 'train' END AS part, COUNT(*) AS rows, {big('SUM(total_orders)')} AS total_orders
FROM features GROUP BY 1""",
    "regression_metrics": """
SELECT COUNT(*) AS rows, ROUND(SQRT(SUM((total_orders - forecast) ** 2) / COUNT(*)), 4) AS rmse,
       ROUND(SUM(ABS(total_orders - forecast)) / COUNT(*), 4) AS mae,
       ROUND(1 - SUM((total_orders - forecast) ** 2)
                 / (SUM(CAST(total_orders AS DOUBLE) ** 2) - SUM(CAST(total_orders AS DOUBLE)) ** 2 / COUNT(*)), 4) AS r2
FROM wma""",
    "wma_backtest": """
WITH edges AS (
  SELECT lo, hi - lo + 1 AS days FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM features)
), tested AS (
  SELECT (CAST(hour_ts AS DATE) - lo) * 5 // days AS fold, total_orders AS y, forecast AS f, total_orders - forecast AS e
  FROM wma, edges WHERE CAST(hour_ts AS DATE) BETWEEN lo AND lo + CAST(days - 1 AS INTEGER)
)
SELECT CAST(fold AS INTEGER) AS fold, COUNT(*) AS rows, ROUND(SQRT(SUM(e ** 2) / COUNT(*)), 4) AS rmse, ROUND(SUM(ABS(e)) / COUNT(*), 4) AS mae,
       ROUND(1 - SUM(e ** 2) / NULLIF(SUM(CAST(y AS DOUBLE) ** 2) - SUM(CAST(y AS DOUBLE)) ** 2 / COUNT(*), 0), 4) AS r2
FROM tested WHERE fold > 0 GROUP BY fold""",
    "fold_counts": f"""
WITH edges AS (
  SELECT lo, hi - lo + 1 AS days FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM features)
), cut AS (
  SELECT (order_date - lo) * 5 // days AS stretch, total_orders FROM features, edges
)
SELECT CAST(k AS INTEGER) AS fold, CASE WHEN stretch = k THEN 'test' ELSE 'train' END AS part, COUNT(*) AS rows, {big('SUM(total_orders)')} AS total_orders
FROM cut, (SELECT unnest(range(1, 5)) AS k) WHERE stretch <= k GROUP BY ALL""",
    # decision rules and operations
    "static_surge": f"SELECT order_id, order_hour, surge_multiplier, {_STATIC} AS static_surge FROM orders_clean",
    "prediction_rules": f"""
SELECT zone, hour_ts, predicted_orders, active_partners, ds_ratio,
       CASE WHEN ds_ratio > 3 THEN 'CRITICAL' WHEN ds_ratio > 2 THEN 'STRESSED' WHEN ds_ratio > 1 THEN 'MODERATE' ELSE 'HEALTHY' END AS status,
       CASE WHEN ds_ratio > 1.5 THEN {half_even('LEAST(ds_ratio * 0.3::DOUBLE + 1.0::DOUBLE, 3.0::DOUBLE)', 2)} ELSE 1.0::DOUBLE END AS recommended_surge,
       CAST(CASE WHEN ds_ratio > 2 THEN GREATEST({half_even('(forecast / 2 - active_partners * 0.3::DOUBLE)', 0)}, 0) ELSE 0 END AS BIGINT) AS partners_needed
FROM (SELECT w.zone, w.hour_ts, w.forecast, COALESCE(p.active_partners, 0) AS active_partners,
             CAST({half_even('w.forecast', 0)} AS BIGINT) AS predicted_orders,
             {half_even('(w.forecast / GREATEST(COALESCE(p.active_partners, 0), 1))', 2)} AS ds_ratio
      FROM wma w LEFT JOIN availability p ON p.zone = w.zone)""",
    "demand_alerts": """
SELECT zone, hour_ts, forecast, (SELECT COUNT(*) FROM partners_clean p WHERE p.zone = w.zone AND p.status = 'active') AS active_partners
FROM wma w WHERE forecast > 2 * (SELECT COUNT(*) FROM partners_clean p WHERE p.zone = w.zone AND p.status = 'active')""",
    "rebalance_plan": """
WITH laid AS (SELECT order_date, order_hour, zone, partner_rebalance_count > 0 AS wants, ABS(partner_rebalance_count) AS size,
                     SUM(ABS(partner_rebalance_count)) OVER (PARTITION BY order_date, order_hour, partner_rebalance_count > 0
                       ORDER BY ABS(partner_rebalance_count) DESC, zone ROWS UNBOUNDED PRECEDING) AS hi
              FROM ratio_exact WHERE zone IS NOT NULL AND partner_rebalance_count <> 0)
SELECT d.order_date, d.order_hour, s.zone AS from_zone, d.zone AS to_zone,
       CAST(LEAST(d.hi, s.hi) - GREATEST(d.hi - d.size, s.hi - s.size) AS BIGINT) AS partners_moved
FROM laid d JOIN laid s ON s.order_date = d.order_date AND s.order_hour = d.order_hour AND d.wants AND NOT s.wants
 AND d.hi - d.size < s.hi AND s.hi - s.size < d.hi""",
    "ops_console_slice": """
SELECT r.zone, r.order_date, r.order_hour, r.total_orders, w.forecast AS predicted_orders, r.active_partners,
       r.demand_supply_ratio, r.zone_status, r.recommended_surge, r.partner_rebalance_count,
       CASE WHEN w.forecast > 2 * COALESCE(r.active_partners, 0) THEN 1 ELSE 0 END AS is_alert
FROM ratio_exact r LEFT JOIN wma w ON w.zone = r.zone AND w.hour_ts = CAST(r.order_date AS TIMESTAMP) + to_hours(r.order_hour)
WHERE r.zone IN ('NATION_3', 'NATION_7') AND r.order_date BETWEEN DATE '2024-01-09' AND DATE '2024-01-25'
  AND r.order_hour BETWEEN 17 AND 22""",
    "idle_partner_share": f"""
SELECT *, {pct('idle_partners', 'NULLIF(active_partners, 0)')} AS idle_share_pct FROM (
  SELECT order_date, order_hour,
         CAST(COALESCE(SUM(CASE WHEN total_orders < 0.5 * active_partners THEN active_partners END), 0) AS BIGINT) AS idle_partners,
         CAST(COALESCE(SUM(active_partners), 0) AS BIGINT) AS active_partners,
         COUNT(*) FILTER (active_partners > 0 AND total_orders > 2 * active_partners) AS starved_zones
  FROM ratio_exact GROUP BY order_date, order_hour)""",
    "spike_kpis": f"""
SELECT is_spike, COUNT(*) AS zone_hours, {big('SUM(total_orders)')} AS total_orders,
       {pct('SUM(total_cancellations)', 'SUM(total_orders)', 2)} AS cancel_rate_pct,
       {r('(CAST(SUM(CAST(avg_eta_overshoot AS DECIMAL(18,1)) * total_orders) AS DOUBLE) / SUM(total_orders) FILTER (avg_eta_overshoot IS NOT NULL))', 2)} AS avg_eta_overshoot
FROM spikes GROUP BY is_spike""",
    "partner_utilisation": f"""
WITH busy AS (SELECT o.order_date, o.order_hour, p.zone, COUNT(DISTINCT p.partner_id) AS n
              FROM orders_clean o JOIN delivery_partners_raw p ON p.partner_id = o.partner_id
              WHERE p.status = 'active' AND p.zone IS NOT NULL GROUP BY ALL),
     hours AS (SELECT order_date, order_hour, zone FROM orders_clean WHERE zone IS NOT NULL
               UNION SELECT order_date, order_hour, zone FROM busy)
SELECT h.order_date, h.order_hour, h.zone, COALESCE(b.n, 0) AS busy_partners, COALESCE(s.n, 0) AS active_partners,
       {pct('COALESCE(b.n, 0)', 'NULLIF(s.n, 0)')} AS utilisation_pct
FROM hours h
LEFT JOIN busy b ON b.zone = h.zone AND b.order_hour = h.order_hour AND b.order_date IS NOT DISTINCT FROM h.order_date
LEFT JOIN (SELECT zone, COUNT(*) AS n FROM delivery_partners_raw WHERE status = 'active' GROUP BY zone) s ON s.zone = h.zone""",
    # named questions
    "nq_top_demand_now": f"""
SELECT zone, order_date, order_hour, total_orders FROM demand_exact
WHERE zone IS NOT NULL AND {_now('demand_exact')} ORDER BY total_orders DESC, zone LIMIT 10""",
    "nq_zone_trend": f"""
SELECT zone, order_hour, {big('SUM(total_orders)')} AS total_orders, {r(int_avg('total_orders'), 2)} AS avg_orders
FROM demand_exact WHERE zone = 'NATION_3' GROUP BY zone, order_hour""",
    "nq_weekday_weekend_by_zone": f"""
SELECT zone, {big('SUM(total_orders) FILTER (is_weekend = 0)')} AS weekday_orders,
       {big('SUM(total_orders) FILTER (is_weekend = 1)')} AS weekend_orders
FROM demand_exact WHERE zone IS NOT NULL GROUP BY zone""",
    "nq_peak_hour": f"""
SELECT order_hour, {big('SUM(total_orders)')} AS total_orders FROM demand_exact GROUP BY order_hour
ORDER BY 2 DESC, 1 LIMIT 1""",
    "nq_critical_now": f"""
SELECT zone, order_date, order_hour, total_orders, demand_supply_ratio FROM ratio_exact
WHERE zone_status = 'CRITICAL' AND {_now('ratio_exact')}""",
    "nq_need_partners": f"""
SELECT zone, {big('SUM(partner_rebalance_count)')} AS partners_wanted FROM ratio_exact
WHERE zone IS NOT NULL AND partner_rebalance_count > 0 GROUP BY zone""",
    "nq_zone_dinner_ds": f"""
SELECT zone, order_hour, {r(money_avg('demand_supply_ratio'), 2)} AS ds_ratio FROM ratio_exact
WHERE zone = 'NATION_3' AND order_hour IN (19, 20, 21, 22) GROUP BY zone, order_hour""",
    "nq_rain_cancel": f"SELECT is_rainy, {_TRUE_RATES} FROM demand_exact GROUP BY is_rainy",
    "nq_match_days": f"""
SELECT CASE WHEN day(order_date) IN (5, 12, 18, 25) THEN 1 ELSE 0 END AS is_match_day, COUNT(DISTINCT order_date) AS days,
       {_TRUE_RATES}, {r(money_avg('avg_eta_overshoot'), 2)} AS avg_eta_overshoot, {r(money_avg('avg_surge'), 2)} AS avg_surge
FROM demand_exact GROUP BY 1""",
    "nq_rain_dinner_eta": f"""
SELECT is_rainy, CASE WHEN order_hour IN (19, 20, 21, 22) THEN 1 ELSE 0 END AS is_dinner,
       {r(money_avg('avg_delivery_mins'), 2)} AS avg_delivery_mins, {r(money_avg('avg_eta_overshoot'), 2)} AS avg_eta_overshoot
FROM demand_exact GROUP BY 1, 2""",
    "nq_weather_sensitivity": f"""
SELECT w.zone, {r('(w.eta - d.eta)', 2)} AS eta_effect, {r('(w.canc - d.canc)', 2)} AS cancel_effect
FROM (SELECT zone, {money_avg('avg_eta_overshoot')} AS eta, {money_avg('cancellation_rate_pct')} AS canc FROM demand_exact WHERE is_rainy = 1 GROUP BY zone) w
JOIN (SELECT zone, {money_avg('avg_eta_overshoot')} AS eta, {money_avg('cancellation_rate_pct')} AS canc FROM demand_exact WHERE is_rainy = 0 GROUP BY zone) d
  ON w.zone = d.zone WHERE w.eta - d.eta IS NOT NULL""",
    "nq_surge_compare": f"""
SELECT zone, {r(money_avg('avg_surge'), 2)} AS current_avg_surge, {r(money_avg('recommended_surge'), 2)} AS recommended_avg_surge,
       {r(f"({money_avg('recommended_surge')} - {money_avg('avg_surge')})", 2)} AS surge_gap,
       {big('SUM(total_orders)')} AS total_orders, {r(money_avg('cancellation_rate_pct'), 1)} AS cancel_rate
FROM ratio_exact GROUP BY zone""",
    "nq_surge_too_low": f"""
SELECT zone, order_date, order_hour, avg_surge, recommended_surge, {r('(recommended_surge - avg_surge)', 2)} AS gap
FROM ratio_exact WHERE recommended_surge > avg_surge""",
    "nq_surge_over_2": """
SELECT zone, order_date, order_hour, demand_supply_ratio, recommended_surge FROM ratio_exact WHERE recommended_surge > 2""",
    "nq_power_users": "SELECT COUNT(*) AS power_users FROM customers_360 WHERE total_orders >= 15",
    "nq_segment_spend": f"""
SELECT customer_segment, COUNT(*) AS customers, {r(money_avg('total_spend'), 2)} AS avg_spend FROM customers_360 GROUP BY customer_segment""",
    "nq_segment_cancel": f"""
SELECT customer_segment, {pct('SUM(total_cancellations)', 'SUM(total_orders)', 2)} AS cancel_rate_pct
FROM customers_360 GROUP BY customer_segment ORDER BY 2 DESC, 1 LIMIT 1""",
    "nq_pred_vs_actual": """
SELECT zone, hour_ts, total_orders AS actual_orders, forecast AS predicted_orders, forecast - total_orders AS error
FROM wma WHERE hour_ts > (SELECT MAX(hour_ts) FROM wma) - INTERVAL 7 DAY""",
    # insights
    "in_match_day_lift": f"""
SELECT {r('m', 2)} AS match_orders_per_day, {r('n', 2)} AS normal_orders_per_day, {r('(m / n)', 4)} AS lift FROM (
  SELECT CAST(SUM(o) FILTER (is_match) AS DOUBLE) / COUNT(*) FILTER (is_match) AS m,
         CAST(SUM(o) FILTER (NOT is_match) AS DOUBLE) / COUNT(*) FILTER (NOT is_match) AS n
  FROM (SELECT order_date, day(order_date) IN (5, 12, 18, 25) AS is_match, SUM(total_orders) AS o
        FROM demand_exact WHERE order_hour >= 17 AND order_hour < 23 GROUP BY order_date))""",
    "in_rain_dinner_cancel": f"""
SELECT rain_at_order_time, is_dinner_hour, COUNT(*) AS total_orders, {big('SUM(is_cancelled)')} AS cancellations,
       {pct('SUM(is_cancelled)', 'COUNT(*)', 2)} AS cancel_rate_pct FROM orders_clean GROUP BY 1, 2""",
    "in_weekend_lift": f"""
SELECT is_weekend, COUNT(DISTINCT order_date) AS days, {big('SUM(total_orders)')} AS total_orders,
       {r('(CAST(SUM(total_orders) AS DOUBLE) / COUNT(DISTINCT order_date))', 2)} AS orders_per_day
FROM demand_exact WHERE order_date IS NOT NULL GROUP BY is_weekend""",
    "in_zone_imbalance": f"""
SELECT zone, COUNT(*) AS hours, COUNT(*) FILTER (active_partners > 0 AND total_orders > active_partners) AS hours_over,
       {pct('COUNT(*) FILTER (active_partners > 0 AND total_orders > active_partners)', 'COUNT(*)', 2)} AS over_pct
FROM ratio_exact WHERE zone IS NOT NULL GROUP BY zone""",
    "in_late_night_dead": f"""
SELECT zone, late_orders, active_partners, {pct('late_orders', 'NULLIF(SUM(late_orders) OVER (), 0)', 2)} AS late_share_pct,
       {pct('active_partners', 'NULLIF(SUM(active_partners) OVER (), 0)', 2)} AS partner_share_pct
FROM (SELECT a.zone, a.active_partners, CAST(COALESCE(SUM(d.total_orders), 0) AS BIGINT) AS late_orders
      FROM availability a LEFT JOIN demand_exact d ON d.zone = a.zone AND d.order_hour = 23 GROUP BY ALL)""",
    "in_zone_peak_hour": f"""
SELECT zone, order_hour AS peak_hour, n AS peak_orders FROM (
  SELECT zone, order_hour, {big('SUM(total_orders)')} AS n FROM demand_exact WHERE zone IS NOT NULL GROUP BY zone, order_hour)
QUALIFY ROW_NUMBER() OVER (PARTITION BY zone ORDER BY n DESC, order_hour) = 1""",
    # streams
    "stream_hourly_demand": f"""
SELECT zone, window_start, window_start + INTERVAL 1 HOUR AS window_end, COUNT(order_id) AS total_orders,
       COUNT(*) FILTER (status = 'cancelled') AS total_cancellations, {money_sum('order_value_inr')} AS order_value
FROM (SELECT *, date_trunc('hour', order_timestamp) AS window_start FROM orders_in_time)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT MAX(order_timestamp) - INTERVAL 24 HOUR FROM orders_feed)
GROUP BY zone, window_start""",
    "stream_dedup": "SELECT order_id, customer_id, restaurant_id, status FROM orders_in_time",
    # sketches of some hundred values are exact once rounded
    "stream_daily_uniques": """
SELECT zone, CAST(w AS DATE) AS order_date, COUNT(DISTINCT w) AS hours, COUNT(DISTINCT customer_id) AS unique_customers,
       COUNT(DISTINCT restaurant_id) AS active_restaurants
FROM (SELECT o.* EXCLUDE (zone), COALESCE(NULLIF(o.zone, ''), r.zone) AS zone, date_trunc('hour', order_timestamp) AS w
      FROM orders_watched o LEFT JOIN restaurants_raw r ON o.restaurant_id = r.restaurant_id
      WHERE watermark IS NULL OR date_trunc('hour', order_timestamp) + INTERVAL 1 HOUR > watermark)
WHERE w + INTERVAL 1 HOUR <= (SELECT MAX(order_timestamp) - INTERVAL 24 HOUR FROM orders_feed)
GROUP BY ALL""",
    "stream_late_rows": """
SELECT order_id, arrival_seq, order_timestamp, batch, watermark, CASE WHEN late THEN 1 ELSE 0 END AS is_late FROM orders_watched""",
    "stream_velocity": f"""
SELECT zone, w AS window_start, w + INTERVAL 60 MINUTE AS window_end, COUNT(order_id) AS total_orders
FROM (SELECT zone, order_id, time_bucket(INTERVAL 10 MINUTE, order_timestamp) - to_minutes(10 * k) AS w
      FROM ({_ZONED}), (SELECT unnest(range(6)) AS k))
GROUP BY zone, w HAVING w + INTERVAL 60 MINUTE <= {_WATERMARK}""",
    "stream_zone_status": f"""
SELECT zone, window_start, total_orders, active_partners, {r('q', 2)} AS demand_supply_ratio,
       CASE WHEN q > 3 THEN 'CRITICAL' WHEN q > 2 THEN 'STRESSED' WHEN q > 1 THEN 'MODERATE' ELSE 'HEALTHY' END AS zone_status,
       CASE WHEN q > 2.5 THEN {r('LEAST(q * 0.3::DOUBLE + 1.0::DOUBLE, 3.0::DOUBLE)', 2)}
            WHEN q > 1.5 THEN {r('(q * 0.2::DOUBLE + 1.0::DOUBLE)', 2)} ELSE 1.0::DOUBLE END AS recommended_surge,
       CASE WHEN total_orders > 2 * COALESCE(active_partners, 0) THEN 1 ELSE 0 END AS is_alert
FROM (SELECT h.*, a.active_partners, CAST(h.total_orders AS DOUBLE) / NULLIF(a.active_partners, 0) AS q
      FROM ({_HOURLY_STREAM}) h LEFT JOIN availability a ON a.zone = h.zone)""",
}

ORACLES: dict[str, str] = {name: with_tables(sql.strip()) for name, sql in _PARTS.items()}
