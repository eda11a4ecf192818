"""Build all tables from a folder of raw CSV files, then train and publish the forecast.

    python -m zonetide.plans.build LANDING_FOLDER [SCHEMA_PREFIX] [FORMAT]
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from ..operators import ml
from ..sources.files import LandingFiles
from . import registry
from .layers import Layers, build_catalog, publish_predictions


def main(folder: str, prefix: str = "", fmt: str = "parquet") -> None:
    spark = SparkSession.builder.appName("zonetide build").getOrCreate()
    layers = Layers(spark, LandingFiles(spark, folder))
    counts = build_catalog(layers, prefix, fmt)
    model = registry.gbt_model(layers)
    metrics = registry.metrics(layers, model)
    ml.record_run(spark, f"{prefix}gold.model_runs", "boosted trees", model, metrics)
    target = f"{prefix}gold.demand_predictions"
    counts[target] = publish_predictions(registry.demand_predictions(layers), prefix, fmt)
    for table, rows in counts.items():
        print(f"{table}: {rows:,} rows")
    layers.close()


if __name__ == "__main__":
    main(*sys.argv[1:])
