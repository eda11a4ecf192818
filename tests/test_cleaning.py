import builders as b
import pytest
from builders import ts
from pyspark.sql import functions as F

from zonetide.operators import cleaning, quality


def test_identical_copies_become_one_row(spark):
    df = b.orders(spark, {}, {})
    assert cleaning.dedup_orders(df).count() == 1


def test_row_with_time_beats_row_without(spark):
    df = b.orders(spark, {"order_timestamp": None}, {"order_timestamp": ts("2024-01-01 10:00:00")})
    assert cleaning.dedup_orders(df).first().order_timestamp == ts("2024-01-01 10:00:00")


def test_earliest_row_wins_and_tie_break_is_stable(spark):
    rows = [
        {"order_timestamp": ts("2024-01-01 11:00:00"), "status": "late"},
        {"order_timestamp": ts("2024-01-01 10:00:00"), "status": "x"},
        {"order_timestamp": ts("2024-01-01 10:00:00"), "status": "y"},
    ]
    picked = {
        cleaning.dedup_orders(b.orders(spark, *order)).first().status
        for order in (rows, rows[::-1], rows[1:] + rows[:1])
    }
    assert len(picked) == 1 and picked <= {"x", "y"}


def test_rows_without_id_are_left_to_the_quarantine(spark):
    df = b.orders(spark, {"order_id": None}, {"order_id": None}, {})
    assert cleaning.dedup_orders(df).count() == 1


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    plan = cleaning.dedup_orders(b.orders(spark, {}))._jdf.queryExecution().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_zone_repair(spark, threshold):
    df = b.orders(
        spark,
        {"order_id": "1", "zone": None},
        {"order_id": "2", "zone": ""},
        {"order_id": "3", "zone": "Z1"},
        {"order_id": "4", "zone": None, "restaurant_id": "?"},
        {"order_id": "5", "zone": "Z5", "restaurant_id": None},
    )
    master = b.restaurants(spark, {"zone": "Z9"}, {"zone": "Z9"})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = cleaning.backfill_zone(df, master)
        zones = {r.order_id: r.zone for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert zones == {"1": "Z9", "2": "Z9", "3": "Z1", "4": None, "5": "Z5"}
    assert out.columns == df.columns


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_orders_are_ranked_once(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        raw = b.orders(spark, {}, {"order_id": "2", "zone": ""}, {"order_id": "2", "zone": ""})
        out = cleaning.clean_orders(raw, b.restaurants(spark, {}))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Window [") == 1



def test_net_value(spark):
    df = b.orders(
        spark,
        {"order_id": "1", "order_value_inr": None, "discount_inr": 50.0},
        {"order_id": "2", "order_value_inr": 100.0, "discount_inr": None},
        {"order_id": "3", "order_value_inr": None, "discount_inr": None},
    )
    out = {r.order_id: r.net_order_value for r in cleaning.with_order_measures(df).collect()}
    assert out == {"1": -50.0, "2": 100.0, "3": 0.0}


@pytest.mark.parametrize(
    "moment, weekend, lunch, dinner, late",
    [
        ("2024-01-07 23:00:00", 1, 0, 0, 1),  # Sunday
        ("2024-01-06 05:59:00", 1, 0, 0, 1),  # Saturday
        ("2024-01-08 06:00:00", 0, 0, 0, 0),  # Monday
        ("2024-01-08 14:59:00", 0, 1, 0, 0),
        ("2024-01-08 15:00:00", 0, 0, 0, 0),
        ("2024-01-08 22:59:00", 0, 0, 1, 0),
    ],
)
def test_calendar_edges(spark, moment, weekend, lunch, dinner, late):
    r = cleaning.with_calendar(b.orders(spark, {"order_timestamp": ts(moment)})).first()
    assert (r.is_weekend, r.is_lunch_hour, r.is_dinner_hour, r.is_late_night) == (
        weekend,
        lunch,
        dinner,
        late,
    )


def test_null_time_has_null_calendar_and_zero_flags(spark):
    r = cleaning.with_calendar(b.orders(spark, {"order_timestamp": None})).first()
    assert (r.order_date, r.order_hour, r.is_weekend, r.is_late_night) == (None, None, 0, 0)


def test_overshoot(spark):
    df = b.orders(
        spark,
        {"order_id": "1", "actual_delivery_mins": 40},
        {"order_id": "2", "actual_delivery_mins": 20},
        {"order_id": "3", "actual_delivery_mins": None},
    )
    out = {r.order_id: r.eta_overshoot_mins for r in cleaning.with_order_measures(df).collect()}
    assert out == {"1": 10, "2": -10, "3": None}


def test_event_zones_are_split_and_trimmed(spark):
    df = b.events(spark, {"zones_impacted": "A, B,C"})
    assert [r.zone for r in cleaning.clean_local_events(df).collect()] == ["A", "B", "C"]


def test_rainy_conditions(spark):
    names = ["Clear", "Cloudy", "Light Rain", "Heavy Rain", "Thunderstorm", "Foggy", "Drizzle"]
    df = cleaning.clean_weather(b.weather(spark, *[{"condition": n} for n in names]))
    assert [r.is_rainy for r in df.collect()] == [0, 0, 1, 1, 1, 0, 1]


def test_bad_text_becomes_null(spark):
    text = spark.createDataFrame(
        [("R1", "n", "Z", "A", "ten", "4.5", "1", "x", "1")], b.RESTAURANTS.names
    )
    r = cleaning.clean_restaurants(text).first()
    assert (r.avg_prep_time_mins, r.rating, r.is_premium, r.lat, r.lng) == (None, 4.5, 1, None, 1.0)


def test_audit_counts_null_ids_as_one(spark):
    df = b.orders(
        spark,
        {"order_id": None, "zone": ""},
        {"order_id": None, "partner_id": None},
        {"order_id": "1", "order_value_inr": None},
        {"order_id": "1"},
    )
    out = {r.metric: (r["count"], r.percentage) for r in quality.audit(df).collect()}
    assert out == {
        "Total rows": (4, 100.0),
        "Duplicate order_ids": (2, 50.0),
        "Missing zone": (1, 25.0),
        "Missing partner_id": (1, 25.0),
        "Missing order_value": (1, 25.0),
    }
    total = df.count()
    assert total - df.dropDuplicates(["order_id"]).count() == out["Duplicate order_ids"][0]


def test_audit_of_no_rows(spark):
    out = {r.metric: r["count"] for r in quality.audit(b.orders(spark).limit(0)).collect()}
    assert out["Total rows"] == 0


def test_exact_medians_against_sorting(spark):
    rows = [(k, float((i * 7919) % 1009) / 4) for k, n in (("a", 101), ("b", 100), ("c", 1), ("d", 2)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.median for r in quality.exact_medians(quality.value_counts(df, ["k"], "v"), ["k"], "v").collect()}
    for k in "abcd":
        v = sorted(x for kk, x in rows if kk == k)
        assert got[k] == (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2


def test_impute_falls_back_to_the_overall_median(spark):
    df = b.orders(
        spark,
        {"order_id": "1", "order_value_inr": 10.0},
        {"order_id": "2", "order_value_inr": 30.0},
        {"order_id": "3", "order_value_inr": None},
        {"order_id": "4", "order_value_inr": None, "zone": None},
        {"order_id": "5", "order_value_inr": 100.0, "zone": "Z2"},
    )
    out = quality.impute_order_value(df, b.restaurants(spark, {}))
    assert {r.order_id: (r.order_value_inr, r.value_imputed) for r in out.collect()} == {
        "1": (10.0, 0),
        "2": (30.0, 0),
        "3": (20.0, 1),
        "4": (30.0, 1),
        "5": (100.0, 0),
    }


@pytest.mark.parametrize("block", [2, 3, 1 << 20])
def test_late_rows_do_not_depend_on_the_block_size(spark, block):
    times = [5, 1, 7, 6, 7, 8, 2, 9, 9, 3]
    rows = [(f"o{i}", i, ts(f"2024-01-01 00:0{t}:00")) for i, t in enumerate(times)]
    rows.append(("copy", 2, ts("2024-01-01 00:00:00")))
    rows.append(("no number", None, ts("2024-01-01 00:00:00")))
    df = spark.createDataFrame(rows, "order_id string, arrival_seq bigint, order_timestamp timestamp")
    got = {r.order_id: r.is_late for r in quality.flag_late_rows(df, block=block).collect()}
    want = {
        name: int(seq is not None and any(t < seen for _, s, seen in rows if s is not None and s < seq))
        for name, seq, t in rows
    }
    assert got == want


def test_duplicate_master_keys(spark):
    df = b.restaurants(spark, {}, {}, {"restaurant_id": "R2"})
    assert [tuple(r) for r in quality.duplicate_keys(df, "restaurant_id").collect()] == [("R1", 2)]


def test_orphans(spark):
    df = b.orders(
        spark,
        {"restaurant_id": "R1"},
        {"restaurant_id": "?"},
        {"restaurant_id": "?"},
        {"restaurant_id": None, "partner_id": "!"},
    )
    out = quality.fk_orphans(df, b.restaurants(spark, {}), b.partners(spark, {}))
    assert {tuple(r) for r in out.collect()} == {("restaurant_id", 1, 2), ("partner_id", 1, 1)}


def test_quarantine_splits_and_explains(spark):
    good = {n: None for n in b.ORDERS.names} | {
        "order_id": "1",
        "order_timestamp": "2024-01-01 10:00:00",
        "status": "delivered",
        "estimated_eta_mins": "30",
    }
    bad = [
        good | {"order_id": None},
        good | {"order_timestamp": "soon", "estimated_eta_mins": "3x"},
        good | {"status": "lost"},
    ]
    schema = ", ".join(f"{n} string" for n in b.ORDERS.names)
    df = spark.createDataFrame([tuple(r[n] for n in b.ORDERS.names) for r in [good, *bad]], schema)
    kept, aside = quality.split_by_schema(df)
    assert [r.estimated_eta_mins for r in kept.collect()] == [30]
    assert kept.schema == b.ORDERS
    assert [r.reason for r in aside.collect()] == [
        "missing order_id",
        "bad order_timestamp; bad estimated_eta_mins",
        "unknown status",
    ]


def test_hot_key_survives_dedup_and_repair(spark):
    """A third of the rows carries one id and one restaurant; nothing is lost."""
    hot = F.col("id") % 3 == 0
    raw = spark.range(30_000).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("o"), "id")).alias("order_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("order_timestamp"),
        F.when(hot, "R1").otherwise(F.concat(F.lit("R"), "id")).alias("restaurant_id"),
        F.lit(None).cast("string").alias("zone"),
    )
    full = raw.select(
        *[
            F.col(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in b.ORDERS.fields
        ]
    )
    out = cleaning.clean_orders(full, b.restaurants(spark, {"zone": "Z9"}))
    assert out.count() == 20_001
    hot_row = out.filter("order_id = 'hot'").first()
    assert hot_row.zone == "Z9" and hot_row.order_timestamp == ts("2023-11-14 22:13:20")
