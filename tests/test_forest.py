"""Forests grown by nodes: the same trees as Spark's learner where nothing is drawn, whichever way the nodes were split."""

import math

import numpy as np
import pytest
from pyspark.ml import regression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from gaugemill.plans import forest, importance


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, (600, 3)).astype(float)
    y = np.where(x[:, 0] > 9, 40.0, -7.0) + 3 * x[:, 1] + (x[:, 2] % 3) + rng.normal(size=600)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)], "a double, b double, c double, y double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def settings(**more):
    return {"featuresCol": "features", "labelCol": "y", "predictionCol": "p", "numTrees": 3, "maxDepth": 12, "minInstancesPerNode": 2, "seed": 3, **more}


def predicted(model, rows):
    return [r["p"] for r in model.transform(rows).orderBy("a", "b", "c", "y").collect()]


@pytest.mark.parametrize("local_rows", [10**6, 40])
@pytest.mark.parametrize("depth", [2, 12])
def test_whole_rows_give_the_trees_of_sparks_learner(rows, monkeypatch, local_rows, depth):
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    plain = settings(bootstrap=False, featureSubsetStrategy="all", maxDepth=depth)
    known = regression.RandomForestRegressor(**plain).fit(rows)
    found = forest.RandomForestRegressor(**plain).fit(rows)
    assert predicted(found, rows) == pytest.approx(predicted(known, rows), rel=1e-9)
    assert [t.numNodes for t in found.trees] == [t.numNodes for t in known.trees] and found.getMaxDepth() == depth
    assert found.featureImportances.toArray() == pytest.approx(known.featureImportances.toArray(), abs=1e-3)  # small nodes have ties


@pytest.mark.parametrize("local_rows", [10**6, 60])
def test_resampled_trees_differ_repeat_and_are_saved(rows, monkeypatch, tmp_path, local_rows):
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    fit = lambda: forest.RandomForestRegressor(**settings(featureSubsetStrategy="onethird")).fit(rows)
    one, two = fit(), fit()
    assert predicted(one, rows) == predicted(two, rows)
    assert len({t.toDebugString.split("\n", 1)[1] for t in one.trees}) == 3
    one.write().overwrite().save(f"{tmp_path}/forest")
    assert predicted(RandomForestRegressionModel.load(f"{tmp_path}/forest"), rows) == predicted(one, rows)
    y = np.array([r["y"] for r in rows.orderBy("a", "b", "c", "y").collect()])
    assert np.var(y - predicted(one, rows)) < 0.1 * np.var(y)


def test_upper_nodes_change_nothing_when_no_column_is_drawn(rows, monkeypatch):
    found = []
    for local_rows in (10**6, 60):
        monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
        found.append(predicted(forest.RandomForestRegressor(**settings(featureSubsetStrategy="all")).fit(rows), rows))
    assert found[0] == pytest.approx(found[1], rel=1e-9)


def test_no_task_takes_more_rows_than_told(rows, monkeypatch):
    seen, known = [], forest.grow_rest
    monkeypatch.setattr(forest, "LOCAL_ROWS", 50)
    monkeypatch.setattr(forest, "grow_rest", lambda *a: seen.append(known(*a)) or seen[0])
    forest.RandomForestRegressor(**settings(featureSubsetStrategy="all")).fit(rows)
    assert 0 < seen[0].where("local = 0").agg(F.max("n")).first()[0] <= 50


def test_times_drawn():
    rows = np.arange(200_000)
    drawn = forest.times_drawn(rows, 4, 42, 1.0, True)
    for k in range(5):
        assert np.mean(drawn == k) == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.005)
    assert abs(np.corrcoef(drawn, forest.times_drawn(rows, 5, 42, 1.0, True))[0, 1]) < 0.02
    assert np.mean(forest.times_drawn(rows, 4, 42, 0.3, False)) == pytest.approx(0.3, abs=0.01)
    assert set(forest.times_drawn(rows, 4, 42, 1.0, False)) == {1.0}


def test_thresholds_lie_between_values_or_quantiles(spark):
    rows = spark.range(5000).select(F.array((F.col("id") % 3).cast("double"), F.col("id").cast("double"), F.lit(4.0), F.when(F.col("id") == 7, 1.0).otherwise(0.0)).alias("x"))
    few, many, one, rare = forest.thresholds(rows, 4, 32)
    assert few.tolist() == [0.5, 1.5] and one.tolist() == [] and rare.tolist() == [0.5]
    assert len(many) == 31 and all(c % 1 == 0.5 for c in many) and np.abs(many - np.arange(1, 32) * 5000 / 32).max() < 15


def test_columns_tried():
    names = ["all", "onethird", "auto", "sqrt", "log2", "4", "0.5"]
    assert [forest.columns_tried(s, 10, 5) for s in names] == [10, 4, 4, 4, 4, 4, 5]
    assert forest.columns_tried("auto", 10, 1) == 10


def test_importance_is_scored_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(importance, "PART_ROWS", 50)
    rows = spark.range(100).select("id", F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"), F.col("id").cast("double").alias("y"))
    seen = []

    def predict(scored):
        seen.append(scored.rdd.getNumPartitions())
        return scored.withColumn("prediction", F.col("a"))

    found = {r["feature"]: r["importance_mean"] for r in importance.permutation_importance(rows, predict, ["a", "b"], "y", ["id"], repeats=3).collect()}
    assert seen[0] >= 12 and found["b"] == 0 and found["a"] > 10


@pytest.mark.parametrize("local_rows", [10**6, 60])
def test_nodes_in_files_predict_like_sparks_model(spark, rows, monkeypatch, tmp_path, local_rows):
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(forest, "node_data", lambda *_: pytest.fail("no nodes go to the driver"))
    found = forest.NodeForestRegressor(**settings(featureSubsetStrategy="onethird")).fit(rows)
    monkeypatch.undo()
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    known = forest.RandomForestRegressor(**settings(featureSubsetStrategy="onethird")).fit(rows)
    assert predicted(found, rows) == predicted(known, rows)
    assert spark.read.parquet(found.nodes).agg(F.sum("n")).first()[0] == known.totalNumNodes and found.getNumTrees == 3
    found.write().overwrite().save(f"{tmp_path}/a forest")
    again = forest.NodeForestModel.load(f"{tmp_path}/a forest")
    assert predicted(again, rows) == predicted(found, rows) and len(spark.read.parquet(again.nodes).inputFiles()) == 3


def test_models_keep_their_nodes_in_files():
    from gaugemill.plans.models import estimator

    assert all(isinstance(estimator(name, 1), forest.NodeForestRegressor) for name in ("random_forest", "extra_trees"))


def test_importance_reads_the_model_a_few_times_and_rises_by_exactly_nothing(spark, monkeypatch):
    monkeypatch.setattr(importance, "PART_ROWS", 1)
    monkeypatch.setattr(importance, "TASKS_PER_CORE", 2)
    rows = spark.range(300).select("id", (F.col("id") / 7).alias("a"), F.rand(3).alias("b"), (F.col("id") / 3).alias("y"))
    seen = []

    def predict(scored):
        seen.append(scored.rdd.getNumPartitions())
        return scored.withColumn("prediction", F.col("a") * 1.1)

    found = {r["feature"]: r["importance_mean"] for r in importance.permutation_importance(rows, predict, ["a", "b"], "y", ["id"], repeats=3).collect()}
    assert seen[0] <= 2 * spark.sparkContext.defaultParallelism and found["b"] == 0 and found["a"] != 0
