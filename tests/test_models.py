"""Trained models: predictions against a walk over the stored trees, metrics against SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from zonetide.operators import ml
from zonetide.plans import registry


@pytest.fixture(scope="module")
def rows(layers):
    return registry._training_rows(layers).cache()


def walked(spark, model, path):
    """Predict by the nodes that the saved model holds."""
    stage = model.stages[-1]
    stage.write().overwrite().save(path)
    trees = {}
    for r in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        trees.setdefault(r.treeID, {})[r.id] = r
    weights = list(stage.treeWeights)

    def tree(nodes, x):
        node = nodes[0]
        while node.leftChild >= 0:
            left = x[node.split.featureIndex] <= node.split.leftCategoriesOrThreshold[0]
            node = nodes[node.leftChild if left else node.rightChild]
        return node.prediction

    def predict(x):
        each = [w * tree(trees[i], x) for i, w in enumerate(weights)]
        return sum(each) / (sum(weights) if "RandomForest" in type(stage).__name__ else 1)

    return predict


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_predictions_follow_the_stored_trees(spark, layers, rows, tmp_path, kind):
    learner = ml.gbt(maxIter=8, maxDepth=4) if kind == "boosted" else ml.random_forest(numTrees=8, maxDepth=5)
    train, test = ml.split(rows)
    model = ml.fit(learner, train, ml.FEATURES)
    predict = walked(spark, model, str(tmp_path / "model"))
    scored = ml.score(model, test).collect()
    assert len(scored) > 100
    for r in scored:
        x = [float(r[f] if r[f] is not None else 0) for f in ml.FEATURES]
        assert r["prediction"] == pytest.approx(predict(x), rel=1e-9)


def test_metrics_of_stored_predictions_equal_sql(spark, layers, rows, tmp_path):
    train, _ = ml.split(rows)
    model = ml.fit(ml.random_forest(numTrees=5, maxDepth=4), train, ml.FEATURES)
    tagged = ml.walk_forward(rows, 3)
    out = ml.score(model, tagged.filter("part = 'test'")).select("fold", "total_orders", "prediction")
    out.write.parquet(str(tmp_path / "scored"))
    stored = spark.read.parquet(str(tmp_path / "scored"))
    got = {r.fold: tuple(r)[1:] for r in ml.regression_metrics(stored, by=("fold",)).collect()}
    sql = f"""
SELECT fold, count(*), round(sqrt(avg((total_orders - prediction) ** 2)), 4), round(avg(abs(total_orders - prediction)), 4),
       round(1 - sum((total_orders - prediction) ** 2) / (var_pop(total_orders) * count(*)), 4)
FROM '{tmp_path}/scored/*.parquet' GROUP BY fold"""
    want = {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    assert set(got) == {1, 2, 3}
    for fold, values in want.items():
        assert got[fold] == pytest.approx(values, abs=1.1e-4)


def test_backtest_equals_fitting_each_fold_by_hand(layers, rows):
    tagged = ml.walk_forward(rows, 2)
    fits = []

    def model(fold, train):
        fits.append((fold, train.agg(F.max("order_date")).first()[0]))
        return ml.fit(ml.random_forest(numTrees=3, maxDepth=3), train, ml.FEATURES)

    got = {r.fold: r.rmse for r in ml.backtest(tagged, model, 2).collect()}
    for fold, newest in fits:
        test = tagged.filter((F.col("fold") == fold) & (F.col("part") == "test"))
        assert test.agg(F.min("order_date")).first()[0] > newest
        own = tagged.filter((F.col("fold") == fold) & (F.col("part") == "train"))
        again = ml.fit(ml.random_forest(numTrees=3, maxDepth=3), own, ml.FEATURES)
        assert ml.regression_metrics(ml.score(again, test)).first()["rmse"] == pytest.approx(got[fold], abs=1e-3)
