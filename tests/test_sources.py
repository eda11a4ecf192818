import os
import re

import builders as b
import pytest
from pyspark.sql import functions as F

from zonetide import session
from zonetide.operators import quality
from zonetide.plans import layers as build
from zonetide.sources import catalog, files
from zonetide.sources.schemas import ORDERS, RAW

CSV = """order_id,customer_id,restaurant_id,partner_id,zone,order_timestamp,delivery_timestamp,order_value_inr,discount_inr,payment_mode,status,cancel_reason,estimated_eta_mins,actual_delivery_mins,surge_multiplier,rain_at_order_time,event_active
O1,C1,R1,,"",2024-01-01 10:00:00,,12.5,0,UPI,delivered,,30,28,1.2,0,1
O2,C1,R1,P1,Z1,not a time,,abc,0,UPI,delivered,,x,28,1.2,0,1
"""


def test_orders_csv_with_fixed_schema(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text(CSV)
    df = files.read_raw(spark, str(path), "orders")
    assert df.schema == ORDERS
    first, second = df.collect()
    assert (first.partner_id, first.zone, first.order_value_inr) == (None, None, 12.5)
    assert (second.order_timestamp, second.order_value_inr, second.estimated_eta_mins) == (None, None, None)
    assert files.read_raw_text(spark, str(path), "orders").collect()[1].order_value_inr == "abc"


def test_inferred_schema_is_an_option(spark, tmp_path):
    path = tmp_path / "restaurants.csv"
    path.write_text("restaurant_id,rating\nR1,4.5\n")
    assert dict(files.read_raw(spark, str(path), "restaurants", infer=True).dtypes)["rating"] == "double"


def test_event_times_stay_text(spark, tmp_path):
    path = tmp_path / "events.csv"
    names = ",".join(f.name for f in b.LOCAL_EVENTS.fields)
    path.write_text(f'{names}\nE1,M,IPL Match,2024-05-01,20:00,23:00,10,"A, B",1.5\n')
    r = files.read_raw(spark, str(path), "local_events").first()
    assert (r.start_time, str(r.date), r.zones_impacted) == ("20:00", "2024-05-01", "A, B")


def test_manifest(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x" * 1024 * 1024)
    (tmp_path / "b.txt").write_text("y")
    got = files.file_manifest(spark, str(tmp_path), "*.csv").collect()
    assert [(r.file_name, r.size_bytes, r.size_mb) for r in got] == [("a.csv", 1048576, 1.0)]


def test_overwrite_returns_the_row_count(spark):
    catalog.create_schema(spark, "bronze_t")
    catalog.create_schema(spark, "bronze_t")
    df = spark.range(7).withColumn("day", F.col("id") % 2)
    assert catalog.overwrite_table(df, "bronze_t.numbers", partition_by="day") == 7
    assert catalog.overwrite_table(df.limit(3), "bronze_t.numbers", partition_by="day") == 3
    assert catalog.scalar(catalog.read_table(spark, "bronze_t.numbers").agg(F.count("*"))) == 3


def test_create_or_replace_without_catalog_support(spark):
    catalog.create_schema(spark, "bronze_t")
    for n in (4, 2):
        assert catalog.create_or_replace(spark.range(n), "bronze_t.replaced") == n
        assert spark.table("bronze_t.replaced").count() == n


def test_replaced_table_changes_at_once_and_old_rows_stay_readable(spark):
    catalog.create_schema(spark, "bronze_t")
    name, rows = "bronze_t.swapped", spark.range(6).selectExpr("id", "id % 2 AS day")
    catalog.create_or_replace(rows, name, partition_by="day")
    reader, first = spark.table(name), catalog.location(spark, name)
    broken = rows.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        catalog.create_or_replace(broken, name, partition_by="day")
    assert catalog.location(spark, name) == first and spark.table(name).count() == 6
    assert catalog.create_or_replace(rows.filter("id < 3"), name, partition_by="day") == 3
    assert catalog.location(spark, name) != first
    assert sorted(r.id for r in spark.table(name).filter("day = 0").collect()) == [0, 2]
    assert reader.count() == 6  # who started before still reads the old version
    catalog.drop_old_versions(spark, name, keep_hours=0)
    versions = os.listdir(re.sub("^file:", "", first.rpartition("/")[0]))
    assert catalog.location(spark, name).rpartition("/")[2] in versions and first.rpartition("/")[2] not in versions
    # other columns: created anew
    assert catalog.create_or_replace(rows.withColumn("more", F.lit("x")), name, partition_by="day") == 6
    assert set(spark.table(name).columns) == {"id", "day", "more"}


def _files(spark, name):
    return {f: os.path.getmtime(re.sub("^file:/*", "/", f)) for f in spark.table(name).inputFiles()}


def test_refresh_equals_full_build_and_leaves_other_dates_alone(spark, layers):
    class Part:
        def __init__(self, orders):
            self.orders = orders

        def text(self, table):
            return self.orders if table == "orders" else layers.raw.text(table)

    whole = layers.raw.orders_text
    late = F.col("arrival_seq") >= 700
    copies = (F.col("arrival_seq") % 200 == 3) & (F.col("order_timestamp") != F.lit("2024-01-01"))
    # some orders of the first part come again with other times, earlier and later
    moved = whole.filter("arrival_seq in (11, 12)").withColumn("order_timestamp", F.lit("2024-01-02 10:00:00"))
    moved = moved.unionByName(whole.filter("arrival_seq = 40").withColumn("order_timestamp", F.lit("2023-12-30 10:00:00")))
    second = whole.filter(late | copies).unionByName(moved)
    build.build_catalog(build.Layers(spark, Part(whole.unionByName(second))), prefix="full_")
    own = build.Layers(spark, Part(whole.filter(~late)))
    build.build_catalog(own, prefix="part_")
    before = _files(spark, "part_silver.orders_clean") | _files(spark, "part_gold.zone_demand_hourly")
    good, _ = quality.split_by_schema(second)
    dates = set()
    for _ in range(2):  # a repeated run changes nothing
        dates |= {r[0] for r in build.refresh_orders(own, good, prefix="part_").collect()}
    for table in ("silver.orders_clean", "gold.zone_demand_hourly", "gold.demand_supply_ratio", "gold.customer_360", "gold.restaurant_performance"):
        want, got = spark.table(f"full_{table}"), spark.table(f"part_{table}")
        got = got.select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, table
    after = _files(spark, "part_silver.orders_clean") | _files(spark, "part_gold.zone_demand_hourly")
    untouched = {f: t for f, t in before.items() if not any(f"order_date={d}/" in f for d in dates)}
    assert 0 < len(untouched) < len(before)
    assert untouched.items() <= after.items()


@pytest.mark.parametrize("split", ["60", "1000000"])
def test_arrival_numbers_of_csv_in_splits_equal_a_count(spark, tmp_path, split):
    names = ["b", "a", "c", "empty"]
    for name, n in zip(names, (40, 25, 1, 0)):
        (tmp_path / f"{name}.csv").write_text("x,y\n" + "".join(f"{name}{i},{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = spark.read.option("header", True).schema("x string, y int").csv(str(tmp_path))
        numbered = files.number_arrivals(rows, lambda name, df: _written(df, tmp_path / "kept"), "n")
        got = [r.x for r in numbered.sort("n").collect()]
        splits = spark.read.parquet(str(tmp_path / "kept")).select("_path", "_start").distinct().count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert splits > 3 or split != "60"
    assert got == [f"{n}{i}" for n, k in (("a", 25), ("b", 40), ("c", 1)) for i in range(k)]
    assert sorted(r.n for r in numbered.collect()) == list(range(66))


def _written(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_late_rows_of_landing_files_equal_those_by_number(spark, layers, tmp_path):
    ordered = layers.raw.orders.repartition(1).sortWithinPartitions("arrival_seq", "order_timestamp")
    path = str(tmp_path / "orders.csv")
    columns = [F.col(f.name).cast("string") for f in ORDERS.fields]
    ordered.select(*columns).write.option("header", True).option("maxRecordsPerFile", 300).csv(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        own = build.Layers(spark, files.LandingFiles(spark, str(tmp_path)))
        got = quality.flag_late_rows(own.arrivals()).select("order_id", "order_timestamp", "is_late").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    seen, want = None, []
    for r in ordered.collect():
        want.append((r.order_id, r.order_timestamp, int(seen is not None and r.order_timestamp < seen)))
        seen = max(seen or r.order_timestamp, r.order_timestamp)
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(w[2] for w in want) > 10


def test_partition_without_rows_goes(spark):
    catalog.create_schema(spark, "bronze_t")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, day string")
    catalog.create_or_replace(rows, "bronze_t.days", partition_by="day")
    touched = spark.createDataFrame([("a",), (None,)], "day string")
    catalog.overwrite_partitions(rows.filter("id = 1").withColumn("id", F.lit(9)), "bronze_t.days", "day", touched)
    assert sorted((r.id, r.day) for r in spark.table("bronze_t.days").collect()) == [(2, "b"), (9, "a")]


def test_fan_out_layers(spark, layers):
    own = build.Layers(spark, layers.raw, fan_out=True)
    got, want = own.table("demand_supply_ratio"), layers.table("demand_supply_ratio_literal")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_current_schema(spark):
    before = spark.catalog.currentDatabase()
    catalog.create_schema(spark, "elsewhere")
    catalog.use(spark, "elsewhere", catalog="spark_catalog")
    try:
        assert spark.catalog.currentDatabase() == "elsewhere"
    finally:
        catalog.use(spark, before)


def test_literal_rows(spark):
    df = spark.createDataFrame([("Total rows", 3, 100.0)], "metric string, count bigint, percentage double")
    assert df.columns == ["metric", "count", "percentage"]


def test_catalog_build_writes_all_layers_with_comments(spark, layers):
    own = build.Layers(spark, layers.raw)
    counts = build.build_catalog(own, prefix="t_")
    assert counts["t_bronze.orders_raw"] + counts["t_bronze.orders_quarantine"] == 1005
    ids = spark.table("t_bronze.orders_raw").select("order_id").distinct().count()
    assert counts["t_silver.orders_clean"] == spark.table("t_silver.orders_clean").count() == ids
    total = spark.table("t_gold.zone_demand_hourly").agg(F.sum("total_orders")).first()[0]
    assert total == ids
    detail = spark.sql("DESCRIBE TABLE EXTENDED t_gold.demand_supply_ratio").collect()
    comments = {r.col_name: r.comment for r in detail if r.comment}
    assert comments["recommended_surge"].startswith("Factor on the fee")
    assert any(r.col_name == "Comment" and "zone" in r.data_type for r in detail)


def test_layers_from_landing_files_equal_those_from_tables(spark, layers, tmp_path):
    for table in ("orders", "restaurants", "delivery_partners", "weather_hourly", "local_events"):
        df = getattr(layers.raw, table)
        df.select(*[f.name for f in RAW[table].fields]).write.option("header", True).csv(
            str(tmp_path / f"{table}.csv")
        )
    own = build.Layers(spark, files.LandingFiles(spark, str(tmp_path)))
    for name in ("zone_demand_hourly", "demand_supply_ratio", "customer_360", "restaurant_performance"):
        got, want = own.table(name), layers.table(name)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_catalog_build_with_quarantine(spark, layers):
    own = build.Layers(spark, layers.raw)
    counts = build.build_catalog(own, prefix="q_")
    for table in RAW:
        left = counts[f"q_bronze.{table}_raw"] + counts[f"q_bronze.{table}_quarantine"]
        assert left == layers.raw.text(table).count()
    good = spark.table("q_bronze.orders_raw")
    assert counts["q_silver.orders_clean"] == good.select("order_id").distinct().count()
    bad = spark.table("q_bronze.orders_quarantine")
    assert counts["q_bronze.orders_quarantine"] == bad.count() > 0
    assert counts["q_bronze.orders_raw"] == 1005 - bad.count()
    kept = spark.table("q_silver.orders_clean")
    whole = bad.groupBy("order_id").count().filter("order_id is not null")
    copies = layers.raw.orders.groupBy("order_id").count().withColumnRenamed("count", "n")
    gone = whole.join(copies, "order_id").filter("count = n")
    assert kept.join(gone, "order_id", "left_semi").count() == 0


def test_published_predictions(spark):
    catalog.create_schema(spark, "p_gold")
    df = spark.createDataFrame([("Z", 3)], "zone string, predicted_orders bigint")
    assert build.publish_predictions(df, prefix="p_") == 1
    detail = spark.sql("DESCRIBE TABLE EXTENDED p_gold.demand_predictions").collect()
    assert any(r.col_name == "Comment" and "trained model" in r.data_type for r in detail)


def test_close_removes_the_intermediate_tables(spark, layers):
    own = build.Layers(spark, layers.raw)
    assert own.table("restaurants_clean").count() == 200
    folder = own.path("restaurants_clean").removeprefix("file:")
    assert os.path.isdir(folder)
    own.close()
    assert not os.path.exists(folder)


def test_a_cluster_needs_a_shared_folder():
    class Elsewhere:
        conf: dict = {}

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere)


@pytest.mark.parametrize("name", ["restaurants", "delivery_partners", "weather_hourly", "local_events", "orders"])
def test_sample_schemas(layers, name):
    got = {f.name: f.dataType for f in getattr(layers.raw, name).schema.fields}
    assert {f.name: f.dataType for f in RAW[name].fields}.items() <= got.items()
