"""Common table expressions: raw inputs from the test tables, silver and gold tables."""

from __future__ import annotations


def r(x: str, digits: int) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return f"CAST(ROUND(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def money_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(28,6))) AS DOUBLE)"


def money_avg(x: str) -> str:
    return f"({money_sum(x)} / COUNT({x}))"


def int_avg(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / COUNT({x}))"


def pct(part: str, whole: str, digits: int = 1) -> str:
    return r(f"(CAST({part} AS DOUBLE) * 100.0::DOUBLE / ({whole}))", digits)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


RAW = {
    "restaurants_raw": """
  SELECT concat('RST_', CAST(p_partkey AS string)) AS restaurant_id, p_name AS restaurant_name,
         concat('NATION_', CAST(p_partkey % 25 AS string)) AS zone, p_type AS cuisine_type,
         CAST(10 + p_size % 30 AS int) AS avg_prep_time_mins,
         CAST(30 + p_partkey % 21 AS double) / CAST(10 AS double) AS rating,
         CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS is_premium,
         CAST(1290 + p_partkey % 25 AS double) / CAST(100 AS double) AS lat,
         CAST(7750 + p_partkey % 25 AS double) / CAST(100 AS double) AS lng
  FROM part""",
    "delivery_partners_raw": """
  SELECT concat('PTR_', CAST(s_suppkey AS string)) AS partner_id, s_name AS partner_name,
         concat('NATION_', CAST(s_nationkey AS string)) AS zone,
         CASE s_suppkey % 4 WHEN 0 THEN 'bike' WHEN 1 THEN 'scooter' WHEN 2 THEN 'bicycle'
              ELSE 'ev_scooter' END AS vehicle_type,
         CAST(30 + s_suppkey % 20 AS double) / CAST(10 AS double) AS avg_rating,
         CAST(100 + (s_suppkey * 37) % 900 AS int) AS total_deliveries,
         CASE WHEN s_suppkey % 5 < 2 THEN 'active' WHEN s_suppkey % 5 < 4 THEN 'on_break'
              ELSE 'inactive' END AS status,
         CAST(1 + (s_suppkey * 7) % 48 AS int) AS experience_months,
         CAST(1290 + s_nationkey % 25 AS double) / CAST(100 AS double) AS lat,
         CAST(7750 + s_nationkey % 25 AS double) / CAST(100 AS double) AS lng
  FROM supplier""",
    "weather_x": """
  SELECT t, n_name,
         CAST(n_nationkey * 7 + extract(hour FROM t) * 3 + extract(day FROM t) * 5 AS int) AS x
  FROM (SELECT DISTINCT date_trunc('hour', CAST(ts AS timestamp)) AS t FROM events)
  CROSS JOIN nation WHERE (n_nationkey + extract(hour FROM t)) % 5 < 2""",
    "weather_hourly_raw": """
  SELECT t AS "timestamp", n_name AS zone,
         CAST(200 + x % 150 AS double) / CAST(10 AS double) AS temperature_c,
         CAST(40 + x % 60 AS int) AS humidity_pct,
         CASE x % 7 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Light Rain'
              WHEN 3 THEN 'Heavy Rain' WHEN 4 THEN 'Thunderstorm' WHEN 5 THEN 'Foggy'
              ELSE 'Drizzle' END AS condition,
         CAST(50 + x % 100 AS double) / CAST(10 AS double) AS wind_speed_kmh,
         CAST(CASE WHEN x % 7 IN (2, 3, 4, 6) THEN x % 90 ELSE 0 END AS double) / CAST(10 AS double) AS rain_mm,
         CAST(2 + (x % 8) AS double) AS visibility_km
  FROM weather_x""",
    "local_events_raw": """
  SELECT concat('EVT_', lpad(CAST(p_partkey + 1 AS string), 9, '0')) AS event_id, p_name AS event_name,
         CASE p_partkey % 8 WHEN 0 THEN 'IPL Match' WHEN 1 THEN 'Festival' WHEN 2 THEN 'Concert'
              WHEN 3 THEN 'Marathon' WHEN 4 THEN 'Sale Day' WHEN 5 THEN 'College Fest'
              WHEN 6 THEN 'Public Holiday' ELSE 'Corporate Event' END AS event_type,
         CAST(DATE '2024-01-01' + CAST(30 * ((p_partkey // 50) % 1200) + (p_partkey * p_partkey) % 30 AS int) AS DATE) AS "date",
         CASE WHEN p_partkey % 11 = 4 THEN '22:30' ELSE concat(CAST(10 + p_partkey % 10 AS string), ':00') END AS start_time,
         CASE WHEN p_partkey % 11 = 4 THEN '02:00' ELSE concat(CAST(13 + p_partkey % 10 AS string), ':00') END AS end_time,
         CAST(2000 + (p_partkey * 1543) % 78000 AS int) AS expected_crowd,
         concat('NATION_', CAST((p_partkey * 3) % 25 AS string),
           CASE WHEN p_partkey % 5 >= 1 THEN concat(',NATION_', CAST((p_partkey * 3 + 7) % 25 AS string)) ELSE '' END,
           CASE WHEN p_partkey % 5 >= 2 THEN concat(', NATION_', CAST((p_partkey * 3 + 14) % 25 AS string)) ELSE '' END,
           CASE WHEN p_partkey % 5 >= 3 THEN concat(',NATION_', CAST((p_partkey * 3 + 21) % 25 AS string)) ELSE '' END,
           CASE WHEN p_partkey % 5 >= 4 THEN concat(',NATION_', CAST((p_partkey * 3 + 3) % 25 AS string)) ELSE '' END) AS zones_impacted,
         CAST(12 + p_size % 24 AS double) / CAST(10 AS double) AS demand_multiplier
  FROM part""",
    "ev": """
  SELECT event_id, user_id, event_type, value, (event_id * 37 + user_id) % 101 AS h,
         (event_id * 17 + user_id) % (SELECT count(*) FROM part) AS rid,
         event_id % (SELECT count(*) FROM supplier) AS pid,
         event_id % (SELECT count(*) FROM customer) AS cid,
         CASE WHEN event_id % 40 = 11 THEN CAST(ts AS timestamp) - interval '3' hour
              ELSE CAST(ts AS timestamp) END AS t
  FROM events""",
    "orders_once": """
  SELECT concat('ORD_', lpad(CAST(event_id AS string), 7, '0')) AS order_id,
         CASE WHEN h < 20 THEN concat('CUS_A', CAST(user_id AS string))
              WHEN h >= 96 THEN concat('CUS_C', CAST(event_id AS string))
              ELSE concat('CUS_B', CAST(cid AS string)) END AS customer_id,
         CASE WHEN event_id % 495 = 0 THEN 'RST_UNKNOWN' ELSE concat('RST_', CAST(rid AS string)) END AS restaurant_id,
         CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'PTR_UNKNOWN'
              ELSE concat('PTR_', CAST(pid AS string)) END AS partner_id,
         CASE WHEN event_id % 66 = 0 THEN '' WHEN event_id % 33 = 0 THEN NULL
              ELSE concat('NATION_', CAST(rid % 25 AS string)) END AS zone,
         t AS order_timestamp,
         CASE WHEN event_type IN ('error', 'signup') THEN NULL
              ELSE t + interval '1' minute * CAST(15 + h % 25 + event_id % 17 AS int) END AS delivery_timestamp,
         CASE WHEN event_id % 100 = 7 THEN NULL ELSE value + CAST(event_id % 9 AS double) / CAST(1000 AS double) END AS order_value_inr,
         CAST((h % 5) * 5 AS double) / CAST(2 AS double) AS discount_inr,
         CASE h % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card'
              WHEN 3 THEN 'Cash' ELSE 'Wallet' END AS payment_mode,
         CASE event_type WHEN 'error' THEN 'cancelled'
              WHEN 'signup' THEN CASE WHEN h % 2 = 0 THEN 'in_transit' ELSE 'preparing' END
              ELSE 'delivered' END AS status,
         CASE WHEN event_type = 'error' THEN CASE h % 3 WHEN 0 THEN 'no_partner' WHEN 1 THEN 'customer'
              ELSE 'restaurant' END ELSE NULL END AS cancel_reason,
         CAST(20 + h % 25 AS int) AS estimated_eta_mins,
         CASE WHEN event_type IN ('error', 'signup') THEN NULL
              ELSE CAST(15 + h % 25 + event_id % 17 AS int) END AS actual_delivery_mins,
         CAST(10 + h % 6 AS double) / CAST(10 AS double) AS surge_multiplier,
         CASE WHEN h % 5 = 0 THEN 1 ELSE 0 END AS rain_at_order_time,
         CASE WHEN h % 7 = 0 THEN 1 ELSE 0 END AS event_active,
         event_id AS arrival_seq
  FROM ev""",
    "orders_raw": """
  SELECT * FROM orders_once
  UNION ALL
  SELECT * REPLACE (CASE WHEN arrival_seq % 400 = 3 OR extract(minute FROM order_timestamp) % 10 >= 5 THEN order_timestamp
                         ELSE order_timestamp + interval '5' minute END AS order_timestamp)
  FROM orders_once WHERE arrival_seq % 200 = 3""",
    "orders_feed": """
  SELECT * EXCLUDE (step), held + step AS batch
  FROM (SELECT *, unnest(CASE WHEN arrival_seq % 50 = 7 AND held < 4 THEN [0, 1] ELSE [0] END) AS step
        FROM (SELECT o.*, LEAST((arrival_seq - lo) * 5 // (hi - lo + 1) + CASE WHEN arrival_seq % 40 = 17 THEN 1 ELSE 0 END, 4)::INTEGER AS held
              FROM orders_raw o, (SELECT MIN(arrival_seq) AS lo, MAX(arrival_seq) AS hi FROM orders_raw)))""",
    "orders_watched": """
  SELECT f.* EXCLUDE (held), watermark, order_timestamp <= watermark AS late
  FROM orders_feed f JOIN (
    SELECT batch, date_trunc('milliseconds', MAX(MAX(order_timestamp)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
           - INTERVAL 24 HOUR AS watermark FROM orders_feed GROUP BY batch) m ON m.batch = f.batch""",
    "orders_in_time": """
  SELECT o.* EXCLUDE (zone), COALESCE(NULLIF(o.zone, ''), r.zone) AS zone
  FROM (SELECT * FROM orders_watched WHERE late IS NOT TRUE AND order_id IS NOT NULL
        QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY batch, order_timestamp) = 1) o
  LEFT JOIN restaurants_raw r ON o.restaurant_id = r.restaurant_id""",
    "orders_text": """
  SELECT CASE WHEN arrival_seq % 311 <> 2 THEN order_id END AS order_id,
         CASE WHEN arrival_seq % 301 = 5 THEN 'not a time' ELSE CAST(order_timestamp AS VARCHAR) END AS order_timestamp,
         CASE WHEN arrival_seq % 307 = 9 THEN '12,50' ELSE CAST(order_value_inr AS VARCHAR) END AS order_value_inr,
         CASE WHEN arrival_seq % 313 = 1 THEN 'soon' ELSE CAST(estimated_eta_mins AS VARCHAR) END AS estimated_eta_mins,
         CASE WHEN arrival_seq % 317 = 4 THEN 'lost' ELSE status END AS status,
         arrival_seq
  FROM orders_raw""",
}

SILVER = {
    "orders_dedup": """
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY order_timestamp NULLS LAST) AS rk
    FROM orders_raw WHERE order_id IS NOT NULL)
  WHERE rk = 1""",
    "orders_repaired": """
  SELECT o.* REPLACE (COALESCE(NULLIF(o.zone, ''), m.zone) AS zone)
  FROM orders_dedup o LEFT JOIN restaurants_raw m ON o.restaurant_id = m.restaurant_id""",
    "orders_clean": """
  SELECT * EXCLUDE (arrival_seq),
         CASE WHEN COALESCE(partner_id, '') = '' THEN 'unassigned' ELSE 'assigned' END AS partner_status,
         CAST(order_timestamp AS DATE) AS order_date,
         CAST(extract(hour FROM order_timestamp) AS INTEGER) AS order_hour,
         CAST(dayofweek(order_timestamp) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN dayofweek(order_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN extract(hour FROM order_timestamp) BETWEEN 11 AND 14 THEN 1 ELSE 0 END AS is_lunch_hour,
         CASE WHEN extract(hour FROM order_timestamp) BETWEEN 19 AND 22 THEN 1 ELSE 0 END AS is_dinner_hour,
         CASE WHEN extract(hour FROM order_timestamp) >= 23 OR extract(hour FROM order_timestamp) <= 5 THEN 1 ELSE 0 END AS is_late_night,
         actual_delivery_mins - estimated_eta_mins AS eta_overshoot_mins,
         CASE status WHEN 'cancelled' THEN 1 ELSE 0 END AS is_cancelled,
         COALESCE(order_value_inr, 0) - COALESCE(discount_inr, 0) AS net_order_value
  FROM orders_repaired""",
    "partners_clean": """
  SELECT *, CASE status WHEN 'active' THEN 1 ELSE 0 END AS is_active FROM delivery_partners_raw""",
    "weather_clean": """
  SELECT *, CAST("timestamp" AS DATE) AS weather_date,
         CAST(extract(hour FROM "timestamp") AS INTEGER) AS weather_hour,
         CASE WHEN condition IN ('Light Rain', 'Heavy Rain', 'Thunderstorm', 'Drizzle') THEN 1 ELSE 0 END AS is_rainy
  FROM weather_hourly_raw""",
    "local_events_clean": """
  SELECT * EXCLUDE (piece), trim(piece) AS zone
  FROM (SELECT *, unnest(string_split(zones_impacted, ',')) AS piece FROM local_events_raw)""",
}

_MEASURES = f"""
         COUNT(o.order_id) AS total_orders,
         COUNT(DISTINCT o.customer_id) AS unique_customers,
         {r(money_avg('o.order_value_inr'), 2)} AS avg_order_value,
         {r(money_sum('o.net_order_value'), 2)} AS total_revenue,
         {r(int_avg('o.actual_delivery_mins'), 1)} AS avg_delivery_mins,
         {r(int_avg('o.estimated_eta_mins'), 1)} AS avg_estimated_eta,
         {r(int_avg('o.eta_overshoot_mins'), 1)} AS avg_eta_overshoot,
         {big('SUM(o.is_cancelled)')} AS total_cancellations,
         {pct('SUM(o.is_cancelled)', 'COUNT(o.order_id)')} AS cancellation_rate_pct,
         {r(money_avg('o.surge_multiplier'), 2)} AS avg_surge,
         MAX(o.rain_at_order_time) AS rain_flag, MAX(o.event_active) AS event_flag,
         COUNT(*) FILTER (o.partner_status = 'unassigned') AS unassigned_orders,
         COUNT(DISTINCT o.restaurant_id) AS active_restaurants,
         MAX(w.temperature_c) AS temperature_c, MAX(w.humidity_pct) AS humidity_pct,
         MAX(w.condition) AS weather_condition,
         COALESCE(MAX(w.rain_mm), 0) AS rain_mm, COALESCE(MAX(w.is_rainy), 0) AS is_rainy,
         COALESCE(MAX(e.event_name), 'None') AS event_name,
         COALESCE(MAX(e.event_type), 'None') AS event_type,
         COALESCE(MAX(e.demand_multiplier), 1.0::DOUBLE) AS demand_multiplier"""


def _demand(events: str, more: str = "") -> str:
    return f"""
  SELECT o.order_date, o.order_hour, o.zone, o.is_weekend, {_MEASURES}{more}
  FROM orders_clean o
  LEFT JOIN weather_clean w ON (w.zone, w.weather_date, w.weather_hour) = (o.zone, o.order_date, o.order_hour)
  LEFT JOIN {events} e ON (e.zone, e."date") = (o.zone, o.order_date)
  GROUP BY o.order_date, o.order_hour, o.zone, o.is_weekend"""


def _ratio(demand: str) -> str:
    return f"""
  SELECT * EXCLUDE (q),
         {r('q', 2)} AS demand_supply_ratio,
         CASE WHEN q > 3 THEN 'CRITICAL' WHEN q > 2 THEN 'STRESSED' WHEN q > 1 THEN 'MODERATE'
              ELSE 'HEALTHY' END AS zone_status,
         CASE WHEN q > 2.5 THEN {r('LEAST(q * 0.3::DOUBLE + 1.0::DOUBLE, 3.0::DOUBLE)', 2)}
              WHEN q > 1.5 THEN {r('(q * 0.2::DOUBLE + 1.0::DOUBLE)', 2)}
              ELSE 1.0::DOUBLE END AS recommended_surge,
         CAST(CASE WHEN q > 2.5 THEN ROUND(CAST(total_orders AS DECIMAL(18,2)) * 0.5 - active_partners * 0.3)
                   WHEN q < 0.5 THEN -ROUND(active_partners * 0.2) ELSE 0 END AS INTEGER) AS partner_rebalance_count
  FROM (SELECT d.order_date, d.order_hour, d.zone, d.is_weekend, d.total_orders, d.total_cancellations,
               d.cancellation_rate_pct, d.avg_surge, d.avg_eta_overshoot, d.avg_delivery_mins, d.total_revenue,
               d.rain_flag, d.event_flag, d.event_name, d.is_rainy, d.weather_condition, d.demand_multiplier,
               p.active_partners, p.total_partners,
               CAST(d.total_orders AS DOUBLE) / NULLIF(p.active_partners, 0) AS q
        FROM {demand} d LEFT JOIN availability p ON d.zone = p.zone)"""


GOLD = {
    "one_event": """
  SELECT zone, "date", event_name, event_type, demand_multiplier FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY zone, "date" ORDER BY demand_multiplier DESC, event_id DESC) AS k
    FROM local_events_clean) WHERE k = 1""",
    "demand_literal": _demand("local_events_clean"),
    "demand_exact": _demand(
        "one_event", ", CASE WHEN COUNT(w.zone) > 0 THEN 1 ELSE 0 END AS weather_known"
    ),
    "availability": f"""
  SELECT zone, COUNT(partner_id) AS total_partners, {big('SUM(is_active)')} AS active_partners,
         COUNT(*) FILTER (status = 'on_break') AS on_break_partners,
         COUNT(*) FILTER (status = 'inactive') AS inactive_partners,
         {r(money_avg('avg_rating'), 2)} AS avg_partner_rating,
         {r(int_avg('total_deliveries'), 0)} AS avg_lifetime_deliveries,
         {r(int_avg('experience_months'), 1)} AS avg_experience_months,
         COUNT(*) FILTER (vehicle_type = 'ev_scooter') AS ev_partners,
         {pct('SUM(is_active)', 'COUNT(partner_id)')} AS active_pct
  FROM partners_clean GROUP BY zone""",
    "ratio_exact": _ratio("demand_exact"),
    "ratio_literal": _ratio("demand_literal"),
    "customers_360": f"""
  SELECT *, CASE WHEN total_orders < 3 THEN 'New' WHEN total_orders < 8 THEN 'Occasional'
                 WHEN total_orders < 15 THEN 'Regular' ELSE 'Power User' END AS customer_segment
  FROM (
    SELECT customer_id, COUNT(*) AS total_orders, COUNT(DISTINCT zone) AS zones_ordered_from,
           COUNT(DISTINCT restaurant_id) AS unique_restaurants,
           {r(money_sum('net_order_value'), 2)} AS total_spend,
           {r(money_avg('net_order_value'), 2)} AS avg_order_value,
           {r(int_avg('actual_delivery_mins'), 1)} AS avg_delivery_time,
           {big('SUM(is_cancelled)')} AS total_cancellations,
           {pct('SUM(is_cancelled)', 'COUNT(*)')} AS cancel_rate_pct,
           MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
           CAST(date_diff('day', MIN(order_date), MAX(order_date)) AS INTEGER) AS customer_tenure_days,
           {big('SUM(is_weekend)')} AS weekend_orders, {big('SUM(is_lunch_hour)')} AS lunch_orders,
           {big('SUM(is_dinner_hour)')} AS dinner_orders, {big('SUM(is_late_night)')} AS late_night_orders,
           {big('SUM(rain_at_order_time)')} AS rainy_day_orders
    FROM orders_clean GROUP BY customer_id)""",
    "performance": f"""
  SELECT o.restaurant_id, m.restaurant_name, m.zone, m.cuisine_type, m.avg_prep_time_mins,
         m.rating AS restaurant_rating, m.is_premium, COUNT(o.order_id) AS total_orders,
         {r(money_sum('o.net_order_value'), 2)} AS total_revenue,
         {r(money_avg('o.net_order_value'), 2)} AS avg_order_value,
         {r(int_avg('o.actual_delivery_mins'), 1)} AS avg_delivery_mins,
         {big('SUM(o.is_cancelled)')} AS total_cancellations,
         {pct('SUM(o.is_cancelled)', 'COUNT(*)')} AS cancel_rate_pct,
         COUNT(DISTINCT o.customer_id) AS unique_customers,
         COUNT(DISTINCT o.order_date) AS active_days
  FROM orders_clean o JOIN restaurants_raw m USING (restaurant_id)
  GROUP BY ALL""",
    "series": """
  SELECT zone, CAST(order_date AS TIMESTAMP) + to_hours(order_hour) AS hour_ts, total_orders, rain_flag, event_flag
  FROM demand_exact WHERE zone IS NOT NULL AND order_date IS NOT NULL""",
    "spine": """
  SELECT z.zone, g.hour_ts, COALESCE(s.total_orders, 0) AS total_orders,
         COALESCE(s.rain_flag, 0) AS rain_flag, COALESCE(s.event_flag, 0) AS event_flag
  FROM (SELECT DISTINCT zone FROM series) z
  CROSS JOIN (SELECT unnest(generate_series((SELECT min(hour_ts) FROM series), (SELECT max(hour_ts) FROM series), INTERVAL 1 HOUR)) AS hour_ts) g
  LEFT JOIN series s ON s.zone = z.zone AND s.hour_ts = g.hour_ts""",
    "lags": """
  SELECT zone, hour_ts, total_orders, rain_flag, event_flag,
         LAG(total_orders, 168) OVER w AS lag_168, LAG(total_orders, 24) OVER w AS lag_24,
         CASE WHEN COUNT(*) OVER k = 168
              THEN CAST(SUM(total_orders) OVER k AS DOUBLE) / 168 END AS rolling_168
  FROM spine
  WINDOW w AS (PARTITION BY zone ORDER BY hour_ts),
         k AS (PARTITION BY zone ORDER BY hour_ts ROWS BETWEEN 168 PRECEDING AND 1 PRECEDING)""",
    "wma": """
  SELECT zone, hour_ts, total_orders, rain_flag, event_flag, base_forecast,
         base_forecast * CASE WHEN rain_flag = 1 THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END
                       * CASE WHEN event_flag = 1 THEN 1.8::DOUBLE ELSE 1.0::DOUBLE END AS forecast
  FROM (SELECT *, lag_168 * 0.7::DOUBLE + lag_24 * 0.2::DOUBLE + rolling_168 * 0.1::DOUBLE AS base_forecast
        FROM lags WHERE lag_168 IS NOT NULL)""",
    "spikes": f"""
  SELECT *, CASE WHEN total_orders > 2.0::DOUBLE * zone_avg_orders THEN 1 ELSE 0 END AS is_spike
  FROM (SELECT *, CAST(SUM(total_orders) OVER (PARTITION BY zone) AS DOUBLE)
                  / COUNT(*) OVER (PARTITION BY zone) AS zone_avg_orders
        FROM demand_exact WHERE zone IS NOT NULL)""",
    "features": """
  SELECT d.zone, d.order_date, d.order_hour, d.total_orders, d.avg_order_value, d.avg_surge,
         d.rain_flag, d.event_flag, d.is_rainy, d.is_weekend, d.demand_multiplier, d.rain_mm,
         COALESCE(d.temperature_c, 30.0::DOUBLE) AS temperature_c,
         CAST(dayofweek(d.order_date) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN d.order_hour BETWEEN 11 AND 14 THEN 1 ELSE 0 END AS is_lunch,
         CASE WHEN d.order_hour BETWEEN 19 AND 22 THEN 1 ELSE 0 END AS is_dinner,
         CASE WHEN d.order_hour >= 23 OR d.order_hour <= 5 THEN 1 ELSE 0 END AS is_late_night,
         p.active_partners
  FROM demand_exact d LEFT JOIN availability p ON p.zone = d.zone
  WHERE d.zone IS NOT NULL AND d.total_orders IS NOT NULL""",
    "coded": """
  SELECT f.*, CAST(z.code AS INTEGER) AS zone_encoded
  FROM features f JOIN (SELECT zone, ROW_NUMBER() OVER (ORDER BY zone) - 1 AS code
                        FROM (SELECT DISTINCT zone FROM features)) z USING (zone)""",
}

TABLES = {**RAW, **SILVER, **GOLD}
