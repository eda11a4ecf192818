import math

import builders as b
import pytest
from pyspark.sql import functions as F

from zonetide.functions import rules
from zonetide.functions.measures import exact_avg, rupees


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"])
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "r, status",
    [
        (1.0, "HEALTHY"),
        (1.01, "MODERATE"),
        (2.0, "MODERATE"),
        (2.01, "STRESSED"),
        (3.0, "STRESSED"),
        (3.01, "CRITICAL"),
    ],
)
def test_status_cuts(spark, r, status):
    assert one(spark, rules.zone_status("r"), r=r) == status


def test_no_supply(spark):
    r = F.lit(None).cast("double")
    assert one(spark, rules.zone_status(r)) == "HEALTHY"
    assert one(spark, rules.zone_status(r, "CRITICAL")) == "CRITICAL"
    assert one(spark, rules.recommended_surge(r)) == 1.0
    assert one(spark, rules.ratio(F.lit(3), F.lit(0))) is None


@pytest.mark.parametrize("r, surge", [(1.5, 1.0), (2.0, 1.4), (2.5, 1.5), (2.6, 1.78), (7.0, 3.0)])
def test_surge(spark, r, surge):
    assert one(spark, rules.recommended_surge("r"), r=r) == surge


@pytest.mark.parametrize("orders, active, moved", [(26, 10, 10), (4, 10, -2), (10, 10, 0), (5, 0, 0)])
def test_rebalance(spark, orders, active, moved):
    o, a = F.lit(orders).cast("bigint"), F.lit(active).cast("bigint")
    assert one(spark, rules.rebalance_count(rules.ratio(o, a), o, a)) == moved


@pytest.mark.parametrize(
    "predicted, active, ratio, surge, needed, status",
    [
        (25.0, 10, 2.5, 1.75, 10, "STRESSED"),
        (5.0, 0, 5.0, 2.5, 2, "CRITICAL"),
        (15.0, 10, 1.5, 1.0, 0, "MODERATE"),
        (5.0, None, 5.0, 2.5, 2, "CRITICAL"),
    ],
)
def test_prediction_rules(spark, predicted, active, ratio, surge, needed, status):
    df = spark.createDataFrame([(predicted, active)], "p double, a bigint")
    r = rules.with_prediction_rules(df, "p", "a").first()
    assert (r.ds_ratio, r.recommended_surge, r.partners_needed, r.status) == (
        ratio,
        surge,
        needed,
        status,
    )


@pytest.mark.parametrize(
    "hour, rain, event, surge",
    [(12, 0, 0, 1.3), (13, 1, 0, 1.6), (14, 0, 0, 1.0), (19, 0, 1, 2.0), (21, 1, 1, 2.3), (22, 0, 0, 1.0)],
)
def test_static_surge(spark, hour, rain, event, surge):
    assert one(spark, rules.static_surge("h", "r", "e"), h=hour, r=rain, e=event) == surge


@pytest.mark.parametrize(
    "n, label",
    [(2, "New"), (3, "Occasional"), (7, "Occasional"), (8, "Regular"), (14, "Regular"), (15, "Power User")],
)
def test_segments(spark, n, label):
    assert one(spark, rules.segment("n"), n=n) == label


def test_rounding_and_labels(spark):
    assert one(spark, F.round(F.lit(0.125), 2)) == 0.13
    assert one(spark, F.round(F.lit(1.005), 2)) == 1.01
    assert one(spark, rupees(F.lit(1234567.5))) == "₹1,234,568"
    assert one(spark, rupees(F.lit(2.5))) == "₹2"


def test_exact_avg_skips_nulls(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert df.agg(exact_avg("v").alias("a")).first().a == pytest.approx(0.15, abs=1e-15)
    assert df.filter("v is null").agg(exact_avg("v").alias("a")).first().a is None


def test_exact_avg_shows_what_is_no_number(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (2.0,)], "v double")
    assert math.isnan(df.agg(exact_avg("v").alias("a")).first().a)
    assert df.filter("v < 3").agg(exact_avg("v").alias("a")).first().a == 1.5


def test_builders_have_defaults(spark):
    assert b.orders(spark, {}).count() == 1
