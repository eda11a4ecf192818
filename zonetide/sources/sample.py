"""Adapter from the TPC-H-like test tables to the five raw inputs.

``FIXTURES.md`` gives the mapping and why each irregularity is there.  Every test row
is used; the calendar grows with ``part`` at 50 entries per 30 days.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import ARRIVAL, DELIVERY_PARTNERS, LOCAL_EVENTS, ORDERS, RESTAURANTS, WEATHER_HOURLY

# Every zone has weather in two hours of five, so that joins meet hours without weather.
WEATHER_HOURS = "(n.n_nationkey + hour(timestamp)) % 5 < 2"


def _tenth(number: str) -> str:
    return f"CAST({number} AS double) / CAST(10 AS double)"


def _zone(number: str) -> str:
    return f"concat('NATION_', CAST({number} AS string))"


def _row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


class SampleData:
    """Raw inputs as lazy DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    @cached_property
    def restaurants(self) -> DataFrame:
        return self.read("part").selectExpr(
            "concat('RST_', CAST(p_partkey AS string)) AS restaurant_id",
            "p_name AS restaurant_name",
            f"{_zone('p_partkey % 25')} AS zone",
            "p_type AS cuisine_type",
            "CAST(10 + p_size % 30 AS int) AS avg_prep_time_mins",
            f"{_tenth('30 + p_partkey % 21')} AS rating",
            "CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS is_premium",
            "CAST(1290 + p_partkey % 25 AS double) / CAST(100 AS double) AS lat",
            "CAST(7750 + p_partkey % 25 AS double) / CAST(100 AS double) AS lng",
        ).select(*RESTAURANTS.names)

    @cached_property
    def delivery_partners(self) -> DataFrame:
        return self.read("supplier").selectExpr(
            "concat('PTR_', CAST(s_suppkey AS string)) AS partner_id",
            "s_name AS partner_name",
            f"{_zone('s_nationkey')} AS zone",
            "CASE s_suppkey % 4 WHEN 0 THEN 'bike' WHEN 1 THEN 'scooter' "
            "WHEN 2 THEN 'bicycle' ELSE 'ev_scooter' END AS vehicle_type",
            f"{_tenth('30 + s_suppkey % 20')} AS avg_rating",
            "CAST(100 + (s_suppkey * 37) % 900 AS int) AS total_deliveries",
            "CASE WHEN s_suppkey % 5 < 2 THEN 'active' WHEN s_suppkey % 5 < 4 THEN 'on_break' "
            "ELSE 'inactive' END AS status",
            "CAST(1 + (s_suppkey * 7) % 48 AS int) AS experience_months",
            "CAST(1290 + s_nationkey % 25 AS double) / CAST(100 AS double) AS lat",
            "CAST(7750 + s_nationkey % 25 AS double) / CAST(100 AS double) AS lng",
        ).select(*DELIVERY_PARTNERS.names)

    @cached_property
    def weather_hourly(self) -> DataFrame:
        """Every hour that has events, in the covered zones."""
        hours = self.read("events").select(
            F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("timestamp")
        ).distinct()
        covered = (
            self.read("nation")
            .agg(F.collect_list(F.struct("n_nationkey", "n_name")))
            .scalar()
        )
        x = hours.select("timestamp", F.explode(covered).alias("n")).filter(WEATHER_HOURS).selectExpr(
            "timestamp",
            "n.n_name AS zone",
            "CAST(n.n_nationkey * 7 + hour(timestamp) * 3 + day(timestamp) * 5 AS int) AS x",
        )
        return x.selectExpr(
            "timestamp",
            "zone",
            f"{_tenth('200 + x % 150')} AS temperature_c",
            "CAST(40 + x % 60 AS int) AS humidity_pct",
            "CASE x % 7 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Light Rain' "
            "WHEN 3 THEN 'Heavy Rain' WHEN 4 THEN 'Thunderstorm' WHEN 5 THEN 'Foggy' "
            "ELSE 'Drizzle' END AS condition",
            f"{_tenth('50 + x % 100')} AS wind_speed_kmh",
            f"{_tenth('CASE WHEN x % 7 IN (2, 3, 4, 6) THEN x % 90 ELSE 0 END')} AS rain_mm",
            "CAST(2 + x % 8 AS double) AS visibility_km",
        ).select(*WEATHER_HOURLY.names)

    @cached_property
    def local_events(self) -> DataFrame:
        more = "".join(
            f", CASE WHEN p_partkey % 5 >= {n} THEN concat('{sep}', "
            f"{_zone(f'(p_partkey * 3 + {step}) % 25')}) ELSE '' END"
            for n, sep, step in ((1, ",", 7), (2, ", ", 14), (3, ",", 21), (4, ",", 3))
        )
        return self.read("part").selectExpr(
            "concat('EVT_', lpad(CAST(p_partkey + 1 AS string), 9, '0')) AS event_id",
            "p_name AS event_name",
            "CASE p_partkey % 8 WHEN 0 THEN 'IPL Match' WHEN 1 THEN 'Festival' "
            "WHEN 2 THEN 'Concert' WHEN 3 THEN 'Marathon' WHEN 4 THEN 'Sale Day' "
            "WHEN 5 THEN 'College Fest' WHEN 6 THEN 'Public Holiday' "
            "ELSE 'Corporate Event' END AS event_type",
            "date_add(DATE '2024-01-01', CAST(30 * ((p_partkey div 50) % 1200) "
            "+ (p_partkey * p_partkey) % 30 AS int)) AS `date`",
            "CASE WHEN p_partkey % 11 = 4 THEN '22:30' ELSE concat(CAST(10 + p_partkey % 10 AS string), ':00') END AS start_time",
            "CASE WHEN p_partkey % 11 = 4 THEN '02:00' ELSE concat(CAST(13 + p_partkey % 10 AS string), ':00') END AS end_time",
            "CAST(2000 + (p_partkey * 1543) % 78000 AS int) AS expected_crowd",
            f"concat({_zone('(p_partkey * 3) % 25')}{more}) AS zones_impacted",
            f"{_tenth('12 + p_size % 24')} AS demand_multiplier",
        ).select(*LOCAL_EVENTS.names)

    @cached_property
    def orders(self) -> DataFrame:
        ev = self.read("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            F.expr("(event_id * 37 + user_id) % 101").alias("h"),
            (F.expr("event_id * 17 + user_id") % _row_count(self.read("part"))).alias("rid"),
            (F.col("event_id") % _row_count(self.read("supplier"))).alias("pid"),
            (F.col("event_id") % _row_count(self.read("customer"))).alias("cid"),
            F.expr(
                "CASE WHEN event_id % 40 = 11 THEN CAST(ts AS timestamp) - interval '3' hour "
                "ELSE CAST(ts AS timestamp) END"
            ).alias("t"),
        )
        once = ev.selectExpr(
            "concat('ORD_', lpad(CAST(event_id AS string), 7, '0')) AS order_id",
            "CASE WHEN h < 20 THEN concat('CUS_A', CAST(user_id AS string)) "
            "WHEN h >= 96 THEN concat('CUS_C', CAST(event_id AS string)) "
            "ELSE concat('CUS_B', CAST(cid AS string)) END AS customer_id",
            "CASE WHEN event_id % 495 = 0 THEN 'RST_UNKNOWN' "
            "ELSE concat('RST_', CAST(rid AS string)) END AS restaurant_id",
            "CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 97 = 0 THEN 'PTR_UNKNOWN' "
            "ELSE concat('PTR_', CAST(pid AS string)) END AS partner_id",
            "CASE WHEN event_id % 66 = 0 THEN '' WHEN event_id % 33 = 0 THEN NULL "
            f"ELSE {_zone('rid % 25')} END AS zone",
            "t AS order_timestamp",
            "CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE t + interval '1' minute "
            "* CAST(15 + h % 25 + event_id % 17 AS int) END AS delivery_timestamp",
            "CASE WHEN event_id % 100 = 7 THEN NULL ELSE value + CAST(event_id % 9 AS double) "
            "/ CAST(1000 AS double) END AS order_value_inr",
            "CAST((h % 5) * 5 AS double) / CAST(2 AS double) AS discount_inr",
            "CASE h % 5 WHEN 0 THEN 'UPI' WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Debit Card' "
            "WHEN 3 THEN 'Cash' ELSE 'Wallet' END AS payment_mode",
            "CASE event_type WHEN 'error' THEN 'cancelled' WHEN 'signup' THEN "
            "CASE WHEN h % 2 = 0 THEN 'in_transit' ELSE 'preparing' END "
            "ELSE 'delivered' END AS status",
            "CASE WHEN event_type = 'error' THEN CASE h % 3 WHEN 0 THEN 'no_partner' "
            "WHEN 1 THEN 'customer' ELSE 'restaurant' END END AS cancel_reason",
            "CAST(20 + h % 25 AS int) AS estimated_eta_mins",
            "CASE WHEN event_type IN ('error', 'signup') THEN NULL "
            "ELSE CAST(15 + h % 25 + event_id % 17 AS int) END AS actual_delivery_mins",
            f"{_tenth('10 + h % 6')} AS surge_multiplier",
            "CASE WHEN h % 5 = 0 THEN 1 ELSE 0 END AS rain_at_order_time",
            "CASE WHEN h % 7 = 0 THEN 1 ELSE 0 END AS event_active",
            f"event_id AS {ARRIVAL}",
            # One row in 200 arrives twice, in one scan of the source.
            "explode(CASE WHEN event_id % 200 = 3 THEN array(0, 1) ELSE array(0) END) AS copy",
        )
        shifted = F.expr(
            # a later copy stays in the ten minutes of the first, so that windows agree on it
            f"CASE WHEN copy = 1 AND {ARRIVAL} % 400 <> 3 AND minute(order_timestamp) % 10 < 5 "
            "THEN order_timestamp + interval '5' minute ELSE order_timestamp END"
        )
        return once.withColumn("order_timestamp", shifted).select(*ORDERS.names, ARRIVAL)

    def orders_feed(self, batches: int) -> DataFrame:
        """Orders as ``batches`` deliveries, numbered in ``delivery``: in order of arrival, but
        one in 40 is held back by a delivery and one in 50 is delivered once more."""
        seq = F.col(ARRIVAL)
        lo, hi = (self.orders.agg(f(seq)).scalar() for f in (F.min, F.max))
        own = F.least((seq - lo) * batches / (hi - lo + 1), F.lit(batches - 1)).cast("int")
        last = F.lit(batches - 1)
        held = F.least(own + F.when(seq % 40 == 17, 1).otherwise(0), last)
        again = F.when((seq % 50 == 7) & (held < last), F.array(held, held + 1)).otherwise(F.array(held))
        return self.orders.select("*", F.explode(again).alias("delivery"))

    def text(self, table: str) -> DataFrame:
        """An input with every column as text; orders have some broken cells."""
        if table == "orders":
            return self.orders_text
        df = getattr(self, table)
        return df.select(*[F.col(c).cast("string") for c in df.columns])

    @cached_property
    def orders_text(self) -> DataFrame:
        """Orders as unparsed text with some cells broken, as a bad export has them."""
        text = self.orders.select(
            *[F.col(n).cast("string").alias(n) for n in ORDERS.names], ARRIVAL
        )
        seq = F.col(ARRIVAL)
        return text.withColumns(
            {
                "order_id": F.when(seq % 311 != 2, F.col("order_id")),
                "order_timestamp": F.when(seq % 301 == 5, F.lit("not a time")).otherwise(
                    F.col("order_timestamp")
                ),
                "order_value_inr": F.when(seq % 307 == 9, F.lit("12,50")).otherwise(
                    F.col("order_value_inr")
                ),
                "estimated_eta_mins": F.when(seq % 313 == 1, F.lit("soon")).otherwise(
                    F.col("estimated_eta_mins")
                ),
                "status": F.when(seq % 317 == 4, F.lit("lost")).otherwise(F.col("status")),
            }
        )
