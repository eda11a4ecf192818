"""Raw inputs → bronze → silver → gold.

``Layers`` builds each table at most once and hands it on as a written parquet table,
so a dashboard query reads the small analytic table instead of repeating the scan,
dedup and aggregation of all orders.  A written table also survives lost executors.
"""

from __future__ import annotations

import hashlib
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning, gold, quality
from ..session import delete_folder, prepare, shared_dir
from ..sources import catalog, files
from ..sources.sample import SampleData
from ..sources.schemas import ARRIVAL

BRONZE = {
    "orders_raw": "orders",
    "restaurants_raw": "restaurants",
    "delivery_partners_raw": "delivery_partners",
    "weather_hourly_raw": "weather_hourly",
    "local_events_raw": "local_events",
}
SILVER = (
    "orders_clean",
    "restaurants_clean",
    "delivery_partners_clean",
    "weather_clean",
    "local_events_clean",
)
GOLD = (
    "zone_demand_hourly",
    "partner_availability",
    "demand_supply_ratio",
    "customer_360",
    "restaurant_performance",
)
# Kept facts are laid out by date, so that date filters, and the latest hour, prune files.
PARTITIONED = {
    "orders_clean": "order_date",
    "zone_demand_hourly": "order_date",
    "demand_supply_ratio": "order_date",
}


class Layers:
    def __init__(self, spark: SparkSession, raw, *, fan_out: bool = False):
        """``raw`` has one DataFrame attribute per raw input.

        ``fan_out`` makes the demand table, and all tables above it, count an order once
        per event of its zone and day (see ``gold.zone_demand_hourly``).
        """
        self.spark = prepare(spark)
        self.raw = raw
        self.fan_out = fan_out
        self._written: dict[str, DataFrame] = {}
        self._paths: dict[str, str] = {}
        self._kept: dict[str, object] = {}
        self._inputs: dict[str, DataFrame] = {}
        self._lock = threading.RLock()
        self._making: dict[str, threading.RLock] = {}
        app = self.spark.sparkContext.applicationId
        self._root = f"{shared_dir(self.spark)}/zonetide/{app}-{uuid.uuid4().hex[:12]}"

    # -- how a table is made from the layer below ---------------------------------

    def plan(self, name: str) -> DataFrame:
        """Lazy plan of a table over the written tables of the layer below.

        Silver tables start from the written bronze table where there is one, and from
        the raw input otherwise: a copy of all orders is not made only to be read once.
        """
        if name in self._inputs:
            return self._inputs[name]
        if name in BRONZE:
            return getattr(self.raw, BRONZE[name])
        return getattr(self, f"_{name}")()

    def _bronze(self, name: str) -> DataFrame:
        return self._written[name] if name in self._written else self.plan(name)

    def substitute(self, name: str, df: DataFrame) -> None:
        """Use ``df`` as the input of a bronze table."""
        self._inputs[name] = df

    def replace(self, name: str, df: DataFrame) -> None:
        """Use ``df`` for a table from now on."""
        with self._lock:
            self._written[name] = df

    def arrivals(self) -> DataFrame:
        """Raw orders with the number of their arrival; landing files are numbered by their
        order and the rows' order in them."""
        orders = self.plan("orders_raw")
        if ARRIVAL in orders.columns:
            return orders
        return files.number_arrivals(orders, self.store)

    def _orders_clean(self):
        return cleaning.clean_orders(self._bronze("orders_raw"), self._bronze("restaurants_raw"))

    def _restaurants_clean(self):
        return cleaning.clean_restaurants(self._bronze("restaurants_raw"))

    def _delivery_partners_clean(self):
        return cleaning.clean_partners(self._bronze("delivery_partners_raw"))

    def _weather_clean(self):
        return cleaning.clean_weather(self._bronze("weather_hourly_raw"))

    def _local_events_clean(self):
        return cleaning.clean_local_events(self._bronze("local_events_raw"))

    def _demand(self, fan_out: bool):
        # the one aggregation of all orders serves both forms
        orders = self.table("orders_clean")
        return gold.zone_demand_hourly(
            orders,
            self.table("weather_clean"),
            self.table("local_events_clean"),
            fan_out=fan_out,
            hourly=self.remember("hourly_orders", lambda: gold.hourly_orders(orders)),
        )

    def _zone_demand_hourly(self):
        return self._demand(self.fan_out)

    def _zone_demand_hourly_literal(self):
        return self._demand(fan_out=True)

    def _partner_availability(self):
        return gold.partner_availability(self.table("delivery_partners_clean"))

    def _demand_supply_ratio(self):
        return gold.demand_supply_ratio(
            self.table("zone_demand_hourly"), self.table("partner_availability")
        )

    def _demand_supply_ratio_literal(self):
        return gold.demand_supply_ratio(
            self.table("zone_demand_hourly_literal"), self.table("partner_availability")
        )

    def _customer_360(self):
        return gold.customer_360(self.table("orders_clean"))

    def _restaurant_performance(self):
        return gold.restaurant_performance(
            self.table("orders_clean"), self.table("restaurants_clean")
        )

    # -- written tables -----------------------------------------------------------

    def folder(self, name: str) -> str:
        """A new folder in the shared folder; never one that was used before."""
        return f"{self._root}/{name}-{uuid.uuid4().hex[:12]}"

    def close(self) -> None:
        """Remove all intermediate tables; nothing that reads them may run any more."""
        with self._lock:
            self._written.clear()
            self._paths.clear()
            self._kept.clear()
            delete_folder(self.spark, self._root)

    def _own_lock(self, name: str) -> threading.RLock:
        """One lock per table, so that different tables are built side by side."""
        with self._lock:
            return self._making.setdefault(name, threading.RLock())

    def table(self, name: str) -> DataFrame:
        return self.remember(name, lambda: self.plan(name))

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write as it is partitioned: adaptive execution has already evened the last
        shuffle out, and another one for a date layout would pay only for tables that
        are kept (see ``build_catalog``)."""
        path = self.folder(name)
        df.write.parquet(path)
        self._paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def path(self, name: str) -> str:
        """Folder of a written table, for stream readers."""
        self.table(name)
        return self._paths[name]

    def keep(self, name: str, make):
        """Result of ``make()``, made once; for fitted models."""
        with self._own_lock(name):
            if name not in self._kept:
                self._kept[name] = make()
            return self._kept[name]

    def remember(self, name: str, make) -> DataFrame:
        """Write the result of ``make()`` once under a name of its own."""
        with self._own_lock(name):
            if name not in self._written:
                self._written[name] = self.write(name, make())
            return self._written[name]

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """``remember`` for an operator's intermediate result."""
        return self.remember(name, lambda: df)


_layers: dict[str, Layers] = {}
_layers_lock = threading.Lock()


def sample_layers(spark: SparkSession, sf_dir: str) -> Layers:
    """Layers over one folder of test tables, shared by all queries of the session."""
    app = spark.sparkContext.applicationId
    key = hashlib.sha1(f"{app}|{id(spark)}|{sf_dir}".encode()).hexdigest()
    with _layers_lock:
        if key not in _layers:
            _layers[key] = Layers(spark, SampleData(spark, sf_dir))
        else:
            prepare(spark)
        return _layers[key]


def build_catalog(layers: Layers, prefix: str = "", fmt: str = "parquet") -> dict[str, int]:
    """Write all layers as tables in schemas bronze, silver and gold.

    Each table is replaced in one step when its rows are complete.  Every table is read back by the tables above it, so nothing is computed twice.
    Rows of any raw input that break its schema go to ``bronze.<input>_quarantine`` with
    their reasons, so that bronze and quarantine together are the input.  Returns the row
    counts.
    """
    spark = layers.spark
    counts: dict[str, int] = {}
    catalog.create_schema(spark, f"{prefix}bronze")
    for name, table in BRONZE.items():
        good, aside = quality.split_by_schema(layers.raw.text(table), table)
        target = f"{prefix}bronze.{table}_quarantine"
        counts[target] = catalog.create_or_replace(aside, target, fmt=fmt)
        layers.substitute(name, good)
    for schema, names in (("bronze", tuple(BRONZE)), ("silver", SILVER), ("gold", GOLD)):
        catalog.create_schema(spark, f"{prefix}{schema}")
        for name in names:
            target, df = f"{prefix}{schema}.{name}", layers.plan(name)
            counts[target] = catalog.create_or_replace(
                df, target, fmt=fmt, partition_by=PARTITIONED.get(name)
            )
            layers.replace(name, spark.table(target).select(*df.columns))
    catalog.comment_gold(spark, f"{prefix}gold")
    return counts


def refresh_orders(layers: Layers, new: DataFrame, prefix: str = "", fmt: str = "parquet") -> DataFrame:
    """Take new bronze orders into tables that ``build_catalog`` wrote; returns the dates
    whose partitions of silver orders, hourly demand and ratio were written anew.

    Only those dates are read and written in full: the dates of the new rows, and those
    where an order stood that a new copy moves.  Orders seen before are cleaned again from
    all their bronze rows, so that the result is that of a full build.  Customers and
    restaurants, which have no dates, are aggregated anew and replaced in one step.
    Bronze grows last: a run that fails before can be repeated, and one repeated after
    adds only copies that cleaning leaves out.  Masters, weather and events are those of
    the tables; when they change, build all.
    """
    spark = layers.spark
    named = lambda layer, name: spark.table(f"{prefix}{layer}.{name}")
    bronze, silver = named("bronze", "orders_raw"), named("silver", "orders_clean")
    new = layers.write("refresh-new", new.select(*bronze.columns))
    ids = layers.write("refresh-ids", new.select("order_id").distinct())
    known = layers.write("refresh-known", silver.join(ids, "order_id").select("order_id", "order_date"))
    again = bronze.join(known.select("order_id"), "order_id", "left_semi")
    cleaned = cleaning.clean_orders(new.unionByName(again), named("bronze", "restaurants_raw"))
    cleaned = layers.write("refresh-cleaned", cleaned)
    dates = cleaned.select("order_date").unionByName(known.select("order_date")).distinct()
    dates = layers.write("refresh-dates", dates)
    day = dates.select(F.col("order_date").alias("_day"))
    kept = silver.join(day, F.col("order_date").eqNullSafe(F.col("_day")), "left_semi")
    kept = kept.join(ids, "order_id", "left_anti").select(*cleaned.columns)
    orders = layers.write("refresh-orders", kept.unionByName(cleaned))
    demand = gold.zone_demand_hourly(
        orders, named("silver", "weather_clean"), named("silver", "local_events_clean"), fan_out=layers.fan_out
    )
    demand = layers.write("refresh-demand", demand)
    ratio = layers.write("refresh-ratio", gold.demand_supply_ratio(demand, named("gold", "partner_availability")))
    for layer, name, df in (("silver", "orders_clean", orders), ("gold", "zone_demand_hourly", demand), ("gold", "demand_supply_ratio", ratio)):
        catalog.overwrite_partitions(df, f"{prefix}{layer}.{name}", PARTITIONED[name], dates, fmt=fmt)
    silver = named("silver", "orders_clean").select(*cleaned.columns)
    catalog.create_or_replace(gold.customer_360(silver), f"{prefix}gold.customer_360", fmt=fmt)
    performance = gold.restaurant_performance(silver, named("silver", "restaurants_clean"))
    catalog.create_or_replace(performance, f"{prefix}gold.restaurant_performance", fmt=fmt)
    new.write.mode("append").format(fmt).save(catalog.location(spark, f"{prefix}bronze.orders_raw"))
    spark.catalog.refreshTable(f"{prefix}bronze.orders_raw")
    return dates


def publish_predictions(predictions: DataFrame, prefix: str = "", fmt: str = "parquet") -> int:
    """Write the forecast next to the other gold tables and return its row count."""
    spark = predictions.sparkSession
    rows = catalog.create_or_replace(predictions, f"{prefix}gold.demand_predictions", fmt=fmt)
    catalog.comment_gold(spark, f"{prefix}gold")
    return rows
