"""Every registered query against its DuckDB SQL, and the driver contract."""

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as contract
from zonetide.plans.registry import ALL

NO_SQL = {
    "raw_file_manifest",
    "demand_predictions",
    "q_predictions",
    "nq_pred_rebalance",
    "ml_backtest",
    "ml_gbt_metrics",
    "ml_rf_metrics",
    "ml_feature_importance",
    "ml_scenario_predictions",
    "ml_pred_vs_actual",
    "ml_model_comparison",
    "ml_next_hour",
}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SMALL)


def test_only_models_and_files_lack_sql():
    assert set(ALL) - set(contract.oracle_sql()) == NO_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() == 978


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, con, name):
    assert compare.check(spark, con, name, SMALL) == []
