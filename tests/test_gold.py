import builders as b
import pytest
from builders import ts
from pyspark.sql import functions as F

from zonetide.operators import cleaning, dashboards, gold, joins, ml, ops


@pytest.fixture()
def two_events(spark):
    orders = cleaning.clean_orders(
        b.orders(
            spark,
            {"order_id": "1"},
            {"order_id": "2", "status": "cancelled"},
            {"order_id": "3", "partner_id": None},
            {"order_id": "4", "zone": None, "restaurant_id": "?"},
        ),
        b.restaurants(spark, {}),
    )
    weather = cleaning.clean_weather(b.weather(spark, {"condition": "Drizzle", "rain_mm": 2.0}))
    events = cleaning.clean_local_events(
        b.events(
            spark,
            {"event_name": "Small", "event_type": "Sale Day", "demand_multiplier": 1.2},
            {"event_id": "E2", "event_name": "Big", "event_type": "Concert", "demand_multiplier": 3.0},
        )
    )
    return orders, weather, events


def by_zone(df):
    return {r.zone: r for r in df.collect()}


def test_fan_out_multiplies_sums_only(two_events):
    exact = by_zone(gold.zone_demand_hourly(*two_events))["Z1"]
    literal = by_zone(gold.zone_demand_hourly(*two_events, fan_out=True))["Z1"]
    assert (exact.total_orders, literal.total_orders) == (3, 6)
    assert (exact.total_revenue, literal.total_revenue) == (300.0, 600.0)
    assert (exact.total_cancellations, literal.total_cancellations) == (1, 2)
    assert (exact.unassigned_orders, literal.unassigned_orders) == (1, 2)
    for same in ("unique_customers", "avg_order_value", "cancellation_rate_pct", "avg_surge"):
        assert exact[same] == literal[same]
    assert (exact.event_name, exact.event_type, exact.demand_multiplier) == ("Big", "Concert", 3.0)
    assert (literal.event_name, literal.event_type) == ("Small", "Sale Day")
    assert (exact.is_rainy, exact.rain_mm, exact.weather_known) == (1, 2.0, 1)


def test_unknown_zone_keeps_its_group(two_events):
    r = by_zone(gold.zone_demand_hourly(*two_events))[None]
    assert (r.total_orders, r.event_name, r.is_rainy, r.weather_known) == (1, "None", 0, 0)


def test_fan_out_equals_the_joined_rows(two_events):
    orders, weather, events = two_events
    joined = joins.orders_events(joins.orders_weather(orders, weather), events).count()
    total = sum(r.total_orders for r in gold.zone_demand_hourly(*two_events, fan_out=True).collect())
    assert joined == total == 7


def test_literal_minus_exact_is_the_fan_out(layers):
    exact = layers.table("zone_demand_hourly").agg({"total_orders": "sum"}).first()[0]
    literal = layers.table("zone_demand_hourly_literal").agg({"total_orders": "sum"}).first()[0]
    assert (literal, exact) == (1054, 1000)


def test_heatmap_status(spark):
    df = spark.createDataFrame(
        [("Z", 1, 4.0, "CRITICAL"), ("Z", 1, 0.5, "HEALTHY")],
        "zone string, order_hour int, demand_supply_ratio double, zone_status string",
    )
    assert dashboards.ds_heatmap(df).first().status == "HEALTHY"
    assert dashboards.ds_heatmap(df, by_severity=True).first().status == "CRITICAL"


def plan_of(spark, *counts):
    rows = [(ts("2024-01-01").date(), 20, z, n) for z, n in counts]
    df = spark.createDataFrame(
        rows, "order_date date, order_hour int, zone string, partner_rebalance_count int"
    )
    return {(r.from_zone, r.to_zone): r.partners_moved for r in ops.rebalance_plan(df).collect()}


def test_rebalance_plan(spark):
    got = plan_of(spark, ("d5", 5), ("d3", 3), ("s4", -4), ("s2", -2), ("even", 0))
    assert got == {("s4", "d5"): 4, ("s2", "d5"): 1, ("s2", "d3"): 1}


@pytest.mark.parametrize(
    "counts",
    [
        [("a", 5), ("b", -5)],
        [("a", 5)],
        [("a", -5)],
        [("a", 2), ("b", 2), ("c", -4)],
        [("a", 7), ("b", 1), ("c", -1), ("d", -1), ("e", -9)],
    ],
)
def test_rebalance_plan_moves_the_smaller_total(spark, counts):
    got = plan_of(spark, *counts)
    want = sum(n for _, n in counts if n > 0)
    have = -sum(n for _, n in counts if n < 0)
    assert sum(got.values()) == min(want, have)
    for zone, n in counts:
        out = sum(m for (f, _), m in got.items() if f == zone)
        into = sum(m for (_, t), m in got.items() if t == zone)
        assert into <= max(n, 0) and out <= max(-n, 0)


def test_event_interval_is_half_open(spark):
    orders = cleaning.with_calendar(
        b.orders(
            spark,
            *[
                {"order_id": m, "order_timestamp": ts(f"2024-01-03 {m}:00")}
                for m in ("11:59", "12:00", "12:59", "13:00")
            ],
        )
    )
    events = cleaning.clean_local_events(b.events(spark, {}))
    got = {r.order_id for r in joins.orders_during_events(orders, events).collect()}
    assert got == {"12:00", "12:59"}


def test_event_that_ends_after_midnight(spark):
    moments = ("2024-01-03 22:29", "2024-01-03 22:30", "2024-01-04 00:00", "2024-01-04 01:59", "2024-01-04 02:00", "2024-01-03 01:00")
    orders = cleaning.with_calendar(b.orders(spark, *[{"order_id": m, "order_timestamp": ts(f"{m}:00")} for m in moments]))
    late = {"start_time": "22:30", "end_time": "02:00"}
    none = [{"event_id": "E2", "start_time": "10:00", "end_time": "10:00"}, {"event_id": "E3", "end_time": "soon"}]
    events = cleaning.clean_local_events(b.events(spark, late, *none))
    got = joins.orders_during_events(orders, events)
    assert sorted(r.order_id for r in got.collect()) == list(moments[1:4])
    assert set(orders.columns) <= set(got.columns)


def test_events_listed_by_hour_are_never_broadcast(spark, tmp_path):
    cleaning.clean_local_events(b.events(spark, {}, {"event_id": "E2"})).write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    got = joins.orders_during_events(cleaning.with_calendar(b.orders(spark, {})), events)
    assert sorted(r.event_id for r in got.collect()) == ["E1", "E2"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_folds_learn_from_the_past_only(spark):
    rows = spark.sql("SELECT date_add(date'2024-01-01', CAST(id AS int)) AS order_date, id AS total_orders FROM range(20)")
    rows = rows.unionByName(rows.selectExpr("CAST(NULL AS date) AS order_date", "total_orders").limit(1))
    for r in ml.walk_forward(rows).groupBy("fold").pivot("part", ["train", "test"]).agg(
        F.min("total_orders").alias("lo"), F.max("total_orders").alias("hi"), F.count(F.lit(1)).alias("n")
    ).collect():
        assert (r.train_lo, r.train_hi, r.test_lo, r.test_hi) == (0, 4 * r.fold - 1, 4 * r.fold, 4 * r.fold + 3)
        assert (r.train_n, r.test_n) == (4 * r.fold, 4)


def test_zone_containment_keeps_each_order_once(two_events):
    orders, _, events = two_events
    got = joins.orders_in_event_zones(orders, events)
    assert sorted(r.order_id for r in got.collect()) == ["1", "2", "3"]


def test_status_counts_sum_to_rows(layers):
    df = layers.table("demand_supply_ratio")
    counts = {r.zone_status: r["count"] for r in df.groupBy("zone_status").count().collect()}
    assert counts == {"MODERATE": 4, "HEALTHY": 974}
