from datetime import datetime, timedelta
from functools import reduce

import builders as b
import pytest
from pyspark.sql import functions as F

from zonetide.operators import gold
from zonetide.sources import catalog
from zonetide.sources.schemas import ORDERS
from zonetide.streaming import orders as streams

START = datetime(2024, 1, 1, 10)


@pytest.fixture()
def feed(spark, tmp_path):
    """Write files one after the other; the stream reads one per batch, oldest first."""
    folder = tmp_path / "orders"

    def land(n, *rows):
        b.orders(spark, *rows).coalesce(1).write.mode("append").parquet(str(folder / f"part={n}"))

    def source(delay="1 hour"):
        df = streams.read_orders(spark, f"{folder}/*", ORDERS, delay, files_per_batch=1)
        return df.select(*ORDERS.names)

    return land, source


def at(minutes, i, **more):
    return {"order_id": str(i), "order_timestamp": START + timedelta(minutes=minutes), **more}


def test_late_rows_are_dropped_and_counted(spark, feed, tmp_path):
    land, source = feed
    land(0, at(0, 1), at(30, 2))
    land(1, at(600, 3))
    land(2, at(601, 6))  # a watermark rejects rows from the batch after next on
    land(3, at(5, 4), at(590, 5))  # order 4 is ten hours late
    master = b.restaurants(spark, {})
    out = str(tmp_path / "out")
    with streams.state_partitions(spark, 2):
        query = streams.run_to_files(streams.hourly_demand(source(), master), out, str(tmp_path / "cp"))
    got = {r.window_start: r.total_orders for r in spark.read.parquet(out).collect()}
    assert got == {START: 2}
    assert streams.late_rows_dropped(query) == 1


def test_restart_continues_from_the_checkpoint(spark, feed, tmp_path):
    land, source = feed
    master = b.restaurants(spark, {})
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    land(0, at(0, 1), at(70, 2))
    with streams.state_partitions(spark, 2):
        streams.run_to_files(streams.hourly_demand(source("30 minutes"), master), out, cp)
        land(1, at(80, 3), at(400, 4))
        streams.run_to_files(streams.hourly_demand(source("30 minutes"), master), out, cp)
    got = {r.window_start: r.total_orders for r in spark.read.parquet(out).collect()}
    assert got == {START: 1, START + timedelta(hours=1): 2}


def test_dedup_across_batches(spark, feed, tmp_path):
    land, source = feed
    land(0, at(0, 1), at(1, 2))
    land(1, at(0, 1), at(2, 3), {"order_id": None})
    out = str(tmp_path / "out")
    with streams.state_partitions(spark, 2):
        streams.run_to_files(streams.dedup(source()), out, str(tmp_path / "cp"))
    assert sorted(r.order_id for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_dedup_feeds_windows_and_equals_batch(spark, feed, tmp_path):
    land, source = feed
    rows = [at(i * 7, i, status="cancelled" if i % 4 == 0 else "delivered") for i in range(60)]
    land(0, *rows[:30])
    land(1, *rows[28:])  # two orders arrive twice
    master = b.restaurants(spark, {})
    out = str(tmp_path / "out")
    with streams.state_partitions(spark, 2):
        result = streams.hourly_demand(streams.dedup(source()), master)
        streams.run_to_files(result, out, str(tmp_path / "cp"))
    got = {r.window_start: (r.total_orders, r.total_cancellations) for r in spark.read.parquet(out).collect()}
    want = {}
    for i, r in enumerate(rows):
        hour = r["order_timestamp"].replace(minute=0)
        n, c = want.get(hour, (0, 0))
        want[hour] = (n + 1, c + (i % 4 == 0))
    limit = rows[-1]["order_timestamp"] - timedelta(hours=1)
    assert got == {h: v for h, v in want.items() if h + timedelta(hours=1) <= limit}


def test_sliding_velocity(spark, feed, tmp_path):
    land, source = feed
    land(0, at(5, 1), at(25, 2), at(900, 3))
    out = str(tmp_path / "out")
    with streams.state_partitions(spark, 2):
        streams.run_to_files(streams.velocity(source(), b.restaurants(spark, {})), out, str(tmp_path / "cp"))
    got = {(r.window_start - START).total_seconds() / 60: r.total_orders for r in spark.read.parquet(out).collect()}
    assert got == {-50: 1, -40: 1, -30: 2, -20: 2, -10: 2, 0: 2, 10: 1, 20: 1}


def test_zone_status_batches(spark, feed, tmp_path):
    land, source = feed
    land(0, *[at(i, i) for i in range(7)], at(30, 90, zone="", restaurant_id="R2"))
    land(1, at(900, 99))
    master = b.restaurants(spark, {}, {"restaurant_id": "R2", "zone": "Z2"})
    staff = b.partners(spark, {}, {"partner_id": "P2"}).withColumn("is_active", F.lit(1))
    supply = gold.partner_availability(staff)
    out = str(tmp_path / "out")
    with streams.state_partitions(spark, 2):
        streams.run_batches(
            streams.hourly_demand(source(), master),
            lambda batch: streams.zone_status(batch, supply),
            out,
            str(tmp_path / "cp"),
        )
    got = {r.zone: (r.total_orders, r.demand_supply_ratio, r.zone_status, r.is_alert) for r in spark.read.parquet(out).collect()}
    assert got == {"Z1": (7, 3.5, "CRITICAL", 1), "Z2": (1, None, "HEALTHY", 1)}


@pytest.fixture()
def deliveries(spark):
    """Four deliveries: on time; newer; late ones and copies; later than everything."""
    rows = [(0, at(0, 1)), (0, at(50, 2)), (1, at(300, 3)), (1, at(270, 4))]
    rows += [(2, at(10, 5)), (2, at(280, 4)), (2, at(290, 6)), (2, at(239, 7)), (3, at(241, 8)), (3, at(900, 9))]
    feed = [b.orders(spark, r).withColumn("n", F.lit(n)) for n, r in rows]
    return reduce(lambda x, y: x.unionByName(y), feed)


def test_late_rows_go_aside_and_nothing_is_lost(spark, deliveries, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    seen = []

    def run(path):
        source = streams.read_orders(spark, path, ORDERS, "1 hour")
        query = streams.run_with_late_rows(source, out, cp, "1 hour")
        seen.append(streams.late_rows(spark, out, ORDERS).count())
        return query

    streams.run_deliveries(deliveries, "n", str(tmp_path / "in"), run)
    assert seen == [2, 4, 8, 10]  # every delivery is a batch
    rows = streams.late_rows(spark, out, ORDERS)
    assert {(r.order_id, r.batch) for r in rows.filter("is_late = 1").collect()} == {("5", 2), ("7", 2)}
    marks = {r.batch: r.watermark for r in rows.select("batch", "watermark").distinct().collect()}
    assert marks == {0: None, 1: START - timedelta(minutes=10), 2: START + timedelta(minutes=240), 3: START + timedelta(minutes=240)}
    assert sorted(rows.select(*ORDERS.names).collect(), key=repr) == sorted(deliveries.select(*ORDERS.names).collect(), key=repr)


def test_state_drops_what_the_side_output_calls_late(spark, deliveries, tmp_path):
    def run(path):
        source = streams.read_orders(spark, path, ORDERS, "1 hour")
        return streams.run_to_files(streams.dedup(source), str(tmp_path / "out"), str(tmp_path / "cp"))

    with streams.state_partitions(spark, 2):
        runs = streams.run_deliveries(deliveries, "n", str(tmp_path / "in"), run)
    kept = [r.order_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    # order 4 came again a delivery later: its state was carried over
    assert sorted(kept) == ["1", "2", "3", "4", "6", "8", "9"]
    assert sum(map(streams.late_rows_dropped, runs)) == 2


def test_repeated_batch_replaces_its_rows(spark, deliveries, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    streams.land(deliveries.filter("n = 0").drop("n"), folder, 0)
    for cp in ("cp1", "cp2"):  # a lost checkpoint makes the batch run again
        streams.run_with_late_rows(streams.read_orders(spark, f"{folder}/*", ORDERS), out, str(tmp_path / cp))
    assert streams.late_rows(spark, out, ORDERS).count() == 2


def test_registered_feed_has_late_and_repeated_rows(layers):
    from zonetide.plans.registry import DELIVERIES, bind

    rows = bind("stream_late_rows")(layers.spark, layers.raw.folder)
    got = rows.groupBy("batch").agg(F.sum("is_late").alias("late")).sort("batch").collect()
    assert [r.batch for r in got] == list(range(DELIVERIES))
    assert sum(r.late for r in got) > 5
    twice = rows.filter("is_late = 0").groupBy("order_id").agg(F.countDistinct("batch").alias("n")).filter("n > 1")
    assert twice.count() > 0


def test_sketches_merge_within_their_error(spark):
    rows = spark.range(200_000).selectExpr(
        "concat('C', id % 50000) AS customer_id", "concat('R', id % 3000) AS restaurant_id", "'Z1' AS zone",
        "timestamp'2024-01-01' + make_dt_interval(0, CAST(id % 24 AS int)) AS order_timestamp",
    )
    hours = streams.hourly_uniques(rows, b.restaurants(spark, {}))
    (day,) = streams.uniques(hours, "zone", F.to_date("window_start").alias("day")).collect()
    assert day.hours == 24
    for got, want in ((day.unique_customers, 50_000), (day.active_restaurants, 3000)):
        assert abs(got - want) <= 3 * streams.SKETCH_ERROR * want
    few = streams.uniques(hours.filter("hour(window_start) = 3"), "window_start").first()
    exact = rows.filter("hour(order_timestamp) = 3").select("customer_id").distinct().count()
    assert abs(few.unique_customers - exact) <= 3 * streams.SKETCH_ERROR * exact


def test_dimensions_are_those_of_the_batch_also_when_it_runs_again(spark, tmp_path):
    catalog.create_schema(spark, "dims")
    zone = [("Z1", datetime(2024, 1, 1, 10), 1, "Rain")]

    def publish(partners):
        supply = spark.createDataFrame([("Z1", partners)], "zone string, active_partners long")
        catalog.create_or_replace(supply, "dims.supply")

    catalog.create_or_replace(spark.createDataFrame(zone, "zone string, timestamp timestamp, is_rainy int, condition string"), "dims.weather")
    events = "zone string, date date, demand_multiplier double, event_name string"
    catalog.create_or_replace(spark.createDataFrame([("Z1", START.date(), 1.5, "Match"), ("Z1", START.date(), 2.0, "Fest")], events), "dims.events")
    tables = {"partner_availability": "dims.supply", "weather_clean": "dims.weather", "local_events_clean": "dims.events"}
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    hourly = "zone string, order_timestamp timestamp, total_orders long, window_start timestamp"

    def deliver(n, cp):
        rows = spark.createDataFrame([("Z1", START + timedelta(hours=n), 8, START + timedelta(hours=n))], hourly)
        streams.land(rows, folder, n)
        source = streams.read_orders(spark, f"{folder}/*", rows.schema)
        streams.run_with_dimensions(source, streams.enriched_status, tables, out, str(tmp_path / cp))

    def found():
        rows = spark.read.option("mergeSchema", True).parquet(f"{out}/rows").collect()
        return {r.batch: (r.active_partners, r.demand_supply_ratio, r.is_rainy, r.event_name) for r in rows}, {r.batch: r.dimensions for r in rows}

    publish(2)
    deliver(0, "cp")
    publish(4)
    deliver(1, "cp")
    got, versions = found()
    assert got == {0: (2, 4.0, 1, "Fest"), 1: (4, 2.0, 0, "Fest")}
    assert versions[0]["partner_availability"] != versions[1]["partner_availability"]
    publish(8)
    # the checkpoint is lost: both deliveries are one batch now, with the version of batch 0
    deliver(1, "again")
    again, after = found()
    assert again[0][0] == 2 and after[0] == versions[0]
    deliver(2, "cp")
    assert found()[0][2][0] == 8
