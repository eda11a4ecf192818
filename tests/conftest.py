import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="zonetide-warehouse-"))
        .config("spark.ui.enabled", "false")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def layers(spark):
    from zonetide.plans.layers import sample_layers

    return sample_layers(spark, SMALL)
