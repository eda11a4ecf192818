"""Demand models on ``pyspark.ml``: features, training, metrics, scoring.

The whole path is distributed: features are DataFrames, trees are grown by Spark, and
scoring is one ``transform``.  Only metrics and model parameters reach the driver.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.calendar import is_dinner, is_late_night, is_lunch
from ..functions.measures import flag
from ..functions.rules import with_prediction_rules
from .forecast import lag_features, latest_zone_row

LABEL = "total_orders"

# Model features, in order.
FEATURES = [
    "order_hour",
    "day_of_week",
    "is_weekend",
    "is_lunch",
    "is_dinner",
    "is_late_night",
    "rain_flag",
    "event_flag",
    "demand_multiplier",
    "active_partners",
    "rain_mm",
    "temperature_c",
    "zone_encoded",
    "rain_x_dinner",
    "event_x_evening",
    "weekend_x_lunch",
]
CALENDAR_FEATURES = FEATURES[:6]
SIGNAL_FEATURES = FEATURES[:12]
STARTER_FEATURES = [
    "order_hour",
    "day_of_week",
    "is_weekend",
    "rain_flag",
    "event_flag",
    "active_partners",
    "avg_prep_time",
]
LAG_FEATURES = ["total_orders", "hour_of_day", "day_of_week", "lag_24", "lag_168", "rolling_168"]

# Model parameters of full training runs.  A node needs 10 rows to split,
# which pyspark.ml expresses as at least 5 rows in each child.
GBT_PARAMS = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.1, "minInstancesPerNode": 5}
GBT_STARTER_PARAMS = {"maxIter": 200, "maxDepth": 5}
RF_PARAMS = {
    "numTrees": 200,
    "maxDepth": 8,
    "minInstancesPerNode": 5,
    "featureSubsetStrategy": "all",
}
SEED = 42
DEFAULT_TEMPERATURE = 30.0
SCENARIO_HOUR = 20


def features(demand: DataFrame, availability: DataFrame) -> DataFrame:
    supply = availability.select("zone", "active_partners")
    known = demand.filter(F.col("zone").isNotNull() & F.col(LABEL).isNotNull())
    hour = "order_hour"
    return known.join(supply, "zone", "left").select(
        "zone",
        "order_date",
        hour,
        LABEL,
        "avg_order_value",
        "avg_surge",
        "rain_flag",
        "event_flag",
        "is_rainy",
        "is_weekend",
        F.coalesce("demand_multiplier", F.lit(1.0)).alias("demand_multiplier"),
        F.coalesce("rain_mm", F.lit(0.0)).alias("rain_mm"),
        F.coalesce("temperature_c", F.lit(DEFAULT_TEMPERATURE)).alias("temperature_c"),
        F.dayofweek("order_date").alias("day_of_week"),
        flag(is_lunch(hour)).alias("is_lunch"),
        flag(is_dinner(hour)).alias("is_dinner"),
        flag(is_late_night(hour)).alias("is_late_night"),
        "active_partners",
    )


def with_zone_code(rows: DataFrame) -> DataFrame:
    """Alphabetical zone number from 0.  Only the distinct zones are numbered."""
    numbered = rows.select("zone").distinct().withColumn(
        "zone_encoded", F.row_number().over(Window.orderBy("zone")) - 1
    )
    return rows.join(numbered, "zone")


def with_interactions(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "rain_x_dinner": F.col("rain_flag") * F.col("is_dinner"),
            "event_x_evening": F.col("event_flag") * F.col("is_dinner"),
            "weekend_x_lunch": F.col("is_weekend") * F.col("is_lunch"),
        }
    )


def with_prep_time(rows: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Average preparation time of the zone's restaurants."""
    prep = restaurants.groupBy("zone").agg(F.avg("avg_prep_time_mins").alias("avg_prep_time"))
    return rows.join(prep, "zone", "left")


def training_rows(demand: DataFrame, availability: DataFrame) -> DataFrame:
    return with_interactions(with_zone_code(features(demand, availability)))


def is_test_row(share: int = 5) -> Column:
    """Stable random split: one row in ``share`` by a digest of its keys."""
    key = F.concat_ws(
        "|", "zone", F.col("order_date").cast("string"), F.col("order_hour").cast("string")
    )
    number = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return number % share == 0


def split(rows: DataFrame, share: int = 5) -> tuple[DataFrame, DataFrame]:
    return rows.filter(~is_test_row(share)), rows.filter(is_test_row(share))


def split_by_time(rows: DataFrame, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """First part of the calendar for training, the rest for testing."""
    days = rows.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    lo, hi = days.select("lo").scalar(), days.select("hi").scalar()
    cut = F.date_add(lo, F.round(F.datediff(hi, lo) * share).cast("int"))
    return rows.filter(F.col("order_date") <= cut), rows.filter(F.col("order_date") > cut)


def walk_forward(
    rows: DataFrame, folds: int = 4, day: Column | str = "order_date", calendar: DataFrame | None = None
) -> DataFrame:
    """Rows with the ``fold`` and ``part`` (train or test) they belong to, once for each fold.

    The calendar of ``calendar`` (default: the rows') is cut into ``folds`` + 1 equal
    stretches; fold k learns from the first k of them and is tested on the next, so that
    no model has seen what comes after.  Rows outside the calendar belong to no fold.
    """
    day = F.col(day) if isinstance(day, str) else day
    edges = (rows if calendar is None else calendar).agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    stretch = F.floor(F.datediff(day, lo) * (folds + 1) / (F.datediff(hi, lo) + 1)).cast("int")
    tagged = rows.withColumn("_stretch", F.when((day >= lo) & (day <= hi), stretch))
    own = F.greatest(F.col("_stretch"), F.lit(1))
    fold = F.explode(F.when(F.col("_stretch").isNotNull(), F.sequence(own, F.lit(folds))))
    part = F.when(F.col("fold") == F.col("_stretch"), "test").otherwise("train")
    return tagged.withColumn("fold", fold).withColumn("part", part).drop("_stretch")


def backtest(
    tagged: DataFrame, models: Callable[[int, DataFrame], PipelineModel], folds: int = 4
) -> DataFrame:
    """Metrics of each fold of ``walk_forward``, whose model comes from ``models(fold, train)``;
    all folds are scored and measured in one job."""
    parts = []
    for k in range(1, folds + 1):
        own = tagged.filter(F.col("fold") == k)
        model = models(k, own.filter(F.col("part") == "train"))
        parts.append(score(model, own.filter(F.col("part") == "test")).select("fold", LABEL, "prediction"))
    return regression_metrics(reduce(DataFrame.unionByName, parts), by=("fold",))


def fold_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("fold", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(LABEL).alias("total_orders")
    )


def split_counts(rows: DataFrame) -> DataFrame:
    part = F.when(is_test_row(), "test").otherwise("train")
    return rows.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(LABEL).alias("total_orders")
    )


def _without_nulls(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.fillna(0, subset=[n for n in names if n in rows.columns])


def fit(estimator, rows: DataFrame, names: list[str], label: str = LABEL) -> PipelineModel:
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    estimator = estimator.setFeaturesCol("features").setLabelCol(label).setSeed(SEED)
    return Pipeline(stages=[assembler, estimator]).fit(_without_nulls(rows, names))


def gbt(**params) -> GBTRegressor:
    return GBTRegressor(**{**GBT_PARAMS, **params})


def random_forest(**params) -> RandomForestRegressor:
    return RandomForestRegressor(**{**RF_PARAMS, **params})


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    names = model.stages[0].getInputCols()
    return model.transform(_without_nulls(rows, names)).drop("features")


def regression_metrics(
    rows: DataFrame, label: str = LABEL, prediction: str = "prediction", by: tuple[str, ...] = ()
) -> DataFrame:
    """RMSE, MAE and R² in one pass, of each group of ``by``."""
    y, e = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    n, sse = F.count(F.lit(1)), F.sum(e * e)
    spread = F.var_pop(y) * n
    return rows.groupBy(*by).agg(
        n.alias("rows"),
        F.round(F.sqrt(sse / n), 4).alias("rmse"),
        F.round(F.sum(F.abs(e)) / n, 4).alias("mae"),
        F.round(1 - sse / F.nullif(spread, F.lit(0.0)), 4).alias("r2"),
    )


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Importance of every feature, least important first."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        "importance", "feature"
    )


def predicted_vs_actual(model: PipelineModel, test: DataFrame) -> DataFrame:
    return score(model, test).select(
        "zone",
        "order_date",
        "order_hour",
        F.col(LABEL).alias("actual_orders"),
        F.col("prediction").alias("predicted_orders"),
    )


def scenario_rows(rows: DataFrame, hour: int = SCENARIO_HOUR) -> DataFrame:
    """Every zone's latest row, moved to a rainy event evening at ``hour``.

    All features that follow from the hour are computed again.
    """
    on = F.lit(1)
    h = F.lit(hour)
    moved = latest_zone_row(rows).withColumns(
        {
            "order_hour": h,
            "is_lunch": flag(is_lunch(h)),
            "is_dinner": flag(is_dinner(h)),
            "is_late_night": flag(is_late_night(h)),
            "rain_flag": on,
            "event_flag": on,
            "active_partners": F.coalesce("active_partners", F.lit(0).cast("bigint")),
        }
    )
    return with_interactions(moved)


def scenario_scores(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return score(model, scenario_rows(rows)).select(
        "zone", "order_hour", "active_partners", F.col("prediction").alias("predicted")
    )


def demand_predictions(scores: DataFrame) -> DataFrame:
    """Scenario scores with the prediction rules applied."""
    return with_prediction_rules(scores, "predicted", "active_partners").select(
        "zone",
        "predicted_orders",
        "active_partners",
        "ds_ratio",
        "status",
        "recommended_surge",
        "partners_needed",
    )


def next_hour_rows(demand: DataFrame) -> DataFrame:
    """Lag features of every zone-hour with the orders of the next hour as label."""
    following = Window.partitionBy("zone").orderBy("hour_ts")
    return (
        lag_features(demand, quiet_days=None)
        .withColumns(
            {
                "hour_of_day": F.hour("hour_ts"),
                "day_of_week": F.dayofweek("hour_ts"),
                "next_orders": F.lead("total_orders").over(following),
            }
        )
        .filter(F.col("lag_168").isNotNull())
    )


def next_hour_model(rows: DataFrame, **params) -> PipelineModel:
    known = rows.filter(F.col("next_orders").isNotNull())
    return fit(gbt(**params), known, LAG_FEATURES, "next_orders")


def next_hour_predictions(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Orders expected in the hour after the last known one, per zone."""
    last = rows.filter(F.col("next_orders").isNull())
    return score(model, last).select(
        "zone",
        (F.col("hour_ts") + F.make_dt_interval(hours=F.lit(1))).alias("hour_ts"),
        F.col("total_orders").alias("current_orders"),
        F.col("prediction").alias("predicted_orders"),
    )


def compare_models(models: dict[tuple[str, str], PipelineModel], test: DataFrame) -> DataFrame:
    """Hold-out metrics of models named by kind and feature set."""
    parts = []
    for (kind, name), model in models.items():
        named = (
            F.lit(kind).alias("model"),
            F.lit(name).alias("feature_set"),
            F.lit(len(model.stages[0].getInputCols())).alias("features"),
        )
        parts.append(regression_metrics(score(model, test)).select(*named, "*"))
    return reduce(DataFrame.unionByName, parts).orderBy("rmse", "model", "feature_set")


def record_run(
    spark: SparkSession, table: str, run: str, model: PipelineModel, metrics: DataFrame
) -> None:
    """Append a run with its parameters and hold-out metrics to a table of runs."""
    params = {p.name: v for p, v in model.stages[-1].extractParamMap().items()}
    row = metrics.select(
        F.lit(run).alias("run_name"),
        F.lit(time.time()).cast("timestamp").alias("recorded_at"),
        F.lit(json.dumps(params, default=str, sort_keys=True)).alias("params"),
        "rmse",
        "mae",
        "r2",
    )
    row.write.mode("append").saveAsTable(table)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
