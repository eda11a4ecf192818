from datetime import datetime, timedelta
from types import SimpleNamespace

import builders as b
import pytest
from pyspark.sql import functions as F

from zonetide.functions.measures import exact_avg, exact_sum
from zonetide.operators import cleaning, forecast, gold, ml, ops
from zonetide.plans import registry


def demand(spark, rows):
    return spark.createDataFrame(
        [(t.date(), t.hour, z, n, rain, event) for t, z, n, rain, event in rows],
        "order_date date, order_hour int, zone string, total_orders bigint, rain_flag int, event_flag int",
    )


START = datetime(2024, 1, 1)


def test_absent_hours_are_zero(spark):
    df = demand(spark, [(START, "A", 3, 0, 0), (START + timedelta(hours=3), "B", 2, 0, 0)])
    got = {(r.zone, r.hour_ts.hour): r.total_orders for r in forecast.hourly_spine(df).collect()}
    want = {(z, h): 0 for z in "AB" for h in range(4)} | {("A", 0): 3, ("B", 3): 2}
    assert got == want


def test_weighted_forecast(spark):
    # 30 orders an hour on average, 10 a week before and 20 a day before the last hour.
    rows = []
    for h in range(168):
        n = 10 if h == 0 else 20 if h == 144 else None
        rows.append((START + timedelta(hours=h), "A", n, 0, 0))
    rest = 168 * 30 - 30
    rows = [(t, z, n if n is not None else 0, r, e) for t, z, n, r, e in rows]
    rows[1] = (rows[1][0], "A", rest, 0, 0)
    rows.append((START + timedelta(hours=168), "A", 5, 1, 1))
    out = forecast.weighted_average_forecast(demand(spark, rows)).collect()
    assert len(out) == 1
    assert out[0].base_forecast == pytest.approx(14.0)
    assert out[0].forecast == pytest.approx(35.28)


def test_velocity_against_brute_force(spark):
    times = [(i * 977) % 20_000 for i in range(300)]
    rows = [
        {"order_id": str(i), "zone": "A" if i % 3 else "B", "order_timestamp": START + timedelta(seconds=s)}
        for i, s in enumerate(times)
    ]
    orders = b.orders(spark, *rows)
    hours = demand(spark, [(START + timedelta(hours=h), z, 2, 0, 0) for h in range(6) for z in "AB"])
    got = {(r.zone, r.order_ts): r.orders_last_60m for r in forecast.order_velocity(orders, hours).collect()}
    for row in rows:
        t = row["order_timestamp"]
        want = sum(
            1
            for o in rows
            if o["zone"] == row["zone"] and t - timedelta(seconds=3600) <= o["order_timestamp"] <= t
        )
        assert got[(row["zone"], t)] == want


def test_next_interval(spark):
    orders = b.orders(
        spark,
        *[{"order_id": str(m), "order_timestamp": START + timedelta(minutes=m)} for m in (1, 2, 31, 95)],
    )
    got = forecast.next_interval_target(forecast.interval_orders(orders)).orderBy("interval_ts").collect()
    assert [(r.orders, r.orders_next_30, r.orders_next_60) for r in got] == [
        (2, 1, 0),
        (1, 0, 1),
        (0, 1, None),
        (1, None, None),
    ]


def test_metrics(spark):
    df = spark.createDataFrame([(1, 2.0), (3, 3.0), (5, 4.0)], "total_orders int, prediction double")
    r = ml.regression_metrics(df).first()
    assert (r["rows"], r.rmse, r.mae, r.r2) == (3, 0.8165, 0.6667, 0.75)


def test_split_is_a_partition(layers):
    rows = ml.features(layers.table("zone_demand_hourly"), layers.table("partner_availability"))
    train, test = ml.split(rows)
    n, n_train, n_test = rows.count(), train.count(), test.count()
    assert n == n_train + n_test and 0.1 < n_test / n < 0.3
    early, late = ml.split_by_time(rows)
    assert early.count() + late.count() == n
    assert early.agg(F.max("order_date")).first()[0] < late.agg(F.min("order_date")).first()[0]


def test_model_round_trip(spark, layers, tmp_path):
    rows = ml.training_rows(layers.table("zone_demand_hourly"), layers.table("partner_availability"))
    train, test = ml.split(rows)
    model = ml.fit(ml.gbt(maxIter=2, maxDepth=3), train, ml.FEATURES)
    scored = ml.score(model, test)
    metrics = ml.regression_metrics(scored)
    ml.save_model(model, str(tmp_path / "model"))
    again = ml.score(ml.load_model(str(tmp_path / "model")), test)
    assert again.exceptAll(scored).count() == 0
    spark.sql("CREATE SCHEMA IF NOT EXISTS runs")
    ml.record_run(spark, "runs.model_runs", "gbt", model, metrics)
    ml.record_run(spark, "runs.model_runs", "gbt again", model, metrics)
    stored = spark.table("runs.model_runs")
    assert stored.count() == 2 and '"maxIter": 2' in stored.first().params
    importance = ml.feature_importance(spark, model)
    assert importance.count() == len(ml.FEATURES)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_scenario_recomputes_hour_features(layers):
    rows = ml.training_rows(layers.table("zone_demand_hourly"), layers.table("partner_availability"))
    got = ml.scenario_rows(rows)
    assert got.count() == rows.select("zone").distinct().count()
    fixed = got.select(
        "order_hour", "is_dinner", "is_lunch", "is_late_night", "rain_x_dinner", "event_x_evening", "weekend_x_lunch"
    ).distinct()
    assert [tuple(r) for r in fixed.collect()] == [(20, 1, 0, 0, 1, 1, 0)]


def test_one_wrong_date_does_not_stretch_the_calendar(spark, layers):
    known = layers.table("zone_demand_hourly")
    odd = known.limit(1).withColumn("order_date", F.lit("1970-01-01").cast("date"))
    more = forecast.lag_features(known.unionByName(odd))
    assert more.count() - forecast.lag_features(known).count() <= 25 * 24 * 10
    same = more.filter("hour_ts > '2000-01-01'").select("zone", "hour_ts", "lag_168", "rolling_168")
    want = forecast.lag_features(known).select("zone", "hour_ts", "lag_168", "rolling_168")
    assert want.exceptAll(same).filter("lag_168 is not null").count() == 0


def test_queries_keep_every_hour_of_a_long_silence(spark):
    last = 40 * 24 + 5
    orders = {("A", 0): 3, ("A", last - 24): 4, ("B", 7): 2, ("A", last): 5}
    rows = demand(spark, [(START + timedelta(hours=h), z, n, 0, 0) for (z, h), n in orders.items()])
    past = {(z, i): orders.get((z, i), 0) for z in "AB" for i in range(last + 1)}
    want = {
        (z, START + timedelta(hours=i)): (
            n,
            past.get((z, i - 168)),
            past.get((z, i - 24)),
            sum(past[z, k] for k in range(i - 168, i)) / 168 if i >= 168 else None,
        )
        for (z, i), n in past.items()
    }
    layers = SimpleNamespace(table=lambda name: rows)
    lags = registry.ALL["lag_features"](layers).collect()
    assert len(lags) == len(want) == 2 * (last + 1)
    assert {(r.zone, r.hour_ts): (r.total_orders, r.lag_168, r.lag_24, r.rolling_168) for r in lags} == want
    assert registry.ALL["rolling_avg_demand"](layers).count() == len(want)
    assert registry.ALL["wma_forecast"](layers).count() == ml.next_hour_rows(rows).count() == len(want) - 2 * 168
    baseline = forecast.order_velocity(b.orders(spark, {"zone": "A", "order_timestamp": START}), rows).first().baseline_orders
    assert baseline == 3 / 41


def test_next_intervals_of_a_long_silence(spark):
    at = [START, START + timedelta(days=40)]
    orders = b.orders(spark, *[{"order_id": str(t), "order_timestamp": t} for t in at])
    got = forecast.next_interval_target(forecast.interval_orders(orders)).orderBy("interval_ts").collect()
    n = 40 * 48 + 1
    assert [r.interval_ts for r in got] == [START + timedelta(minutes=30 * i) for i in range(n)]
    ahead = [(r.orders, r.orders_next_30, r.orders_next_60) for r in got]
    assert ahead == [(1, 0, 0), *[(0, 0, 0)] * (n - 4), (0, 0, 1), (0, 1, None), (1, None, None)]


def test_means_of_past_hours_do_not_sum_every_frame_anew(spark):
    hours = [("A", START + timedelta(hours=i), i * i % 7) for i in range(400) if not 30 <= i < 40]
    rows = spark.createDataFrame(hours, "zone string, at timestamp, total_orders bigint")
    demand = rows.selectExpr("zone", "date(at) order_date", "hour(at) order_hour", "total_orders", "0 rain_flag", "0 event_flag")
    lags = forecast.lag_features(demand)
    plan = lags._jdf.queryExecution().optimizedPlan().toString()
    assert "RowFrame, -168, -1)" not in plan and "unboundedpreceding" in plan
    orders = [0 if 30 <= i < 40 else i * i % 7 for i in range(400)]
    got = [r.rolling_168 for r in lags.orderBy("hour_ts").collect()]
    assert got == [sum(orders[i - 168 : i]) / 168 if i >= 168 else None for i in range(400)]
    daily = [r.rolling_avg for r in forecast.rolling_average(demand).orderBy("hour_ts").collect()]
    assert daily == [sum(orders[i - 24 : i]) / 24 if i >= 24 else None for i in range(400)]


def test_alerts_and_utilisation_of_a_zone_without_partners(spark):
    expected = spark.createDataFrame([("A", START, 1000.0), ("B", START, 1.0)], "zone string, hour_ts timestamp, forecast double")
    staff = b.partners(spark, {"zone": "B"}).withColumn("is_active", F.lit(1))
    supply = gold.partner_availability(staff)
    alerts = ops.demand_alerts(expected, supply).collect()
    assert [(r.zone, r.active_partners) for r in alerts] == [("A", 0)]
    orders = cleaning.clean_orders(
        b.orders(spark, {"zone": "A", "partner_id": ""}, {"order_id": "2", "zone": "B"}, {"order_id": "3", "zone": "B", "partner_id": None, "order_timestamp": START}),
        b.restaurants(spark, {}),
    )
    got = {(r.zone, r.order_hour): (r.busy_partners, r.active_partners, r.utilisation_pct) for r in ops.partner_utilisation(orders, staff, supply).collect()}
    assert got == {("A", 12): (0, 0, None), ("B", 12): (1, 1, 100.0), ("B", 0): (0, 1, 0.0)}


def test_sums_are_not_cut_and_odd_values_surface(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (0.004,), (None,)], "x double")
    r = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert (r.s, r.a) == (0.012, 0.004)
    r = df.unionByName(spark.createDataFrame([(float("nan"),)], "x double")).agg(exact_avg("x").alias("a")).first()
    assert r.a != r.a
