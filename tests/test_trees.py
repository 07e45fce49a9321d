"""Boosting with patience and forests over random cut points, on data whose best answer is known."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from gaugemill.contracts import Candidate
from gaugemill.plans import models, trees


def test_stop_round():
    assert trees.stop_round([5, 4, 3, 3.5, 3.2, 3.1], 3) == (3, True)
    assert trees.stop_round([5, 4, 3, 3.5, 2.9, 3.1], 3) == (5, False)  # the wait begins anew
    assert trees.stop_round([1, 1, 1], 2) == (1, True)  # an equal loss is no gain
    assert trees.stop_round([1], 5) == (1, False)


@pytest.fixture(scope="module")
def boosting(spark):
    """Two values of x: one split explains everything but a noise that the held-out rows have the other way round."""
    rows = [(float(i % 2), 10.0 * (i % 2) + (0.5 if i % 4 < 2 else -0.5), i % 5 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double, held boolean")
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(df).cache()


def learner(**settings):
    return GBTRegressor(featuresCol="features", labelCol="y", predictionCol="p", maxDepth=1, seed=1, **settings)


def test_boosting_is_cut_at_its_best_round(boosting, monkeypatch):
    monkeypatch.setattr(trees, "FIRST_ROUNDS", 4)
    train, held = boosting.where("NOT held"), boosting.where("held")
    whole = learner(maxIter=40, stepSize=1.0).fit(train)
    losses = whole.evaluateEachIteration(held, "squared")
    best, _ = trees.stop_round(losses, 3)
    found = trees.fit_boosting(learner(maxIter=40, stepSize=1.0), train, held, patience=3)
    assert found.getNumTrees == best < 40
    assert found.evaluateEachIteration(held, "squared")[-1] == min(losses)
    same = [a["p"] == b["p"] for a, b in zip(found.transform(held).select("p").collect(), learner(maxIter=best, stepSize=1.0).fit(train).transform(held).select("p").collect(), strict=True)]
    assert all(same)


def test_boosting_goes_on_while_it_gains(spark):
    df = spark.createDataFrame([(float(i % 20), float(i % 20), i % 60 < 20) for i in range(240)], "x double, y double, held boolean")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    train, held = df.where("NOT held"), df.where("held")
    found = trees.fit_boosting(learner(maxIter=12, stepSize=0.1), train, held, patience=5)
    assert found.getNumTrees == 12  # both parts have the same rows, so every round gains
    assert trees.fit_boosting(learner(maxIter=3, stepSize=0.1), train, None).getNumTrees == 3


def test_cuts_lie_in_the_range_and_differ():
    rng = np.random.default_rng(1)
    first, second = (trees.random_cuts([(0.0, 10.0), (5.0, 5.0)], 6, rng) for _ in range(2))
    for cuts in (first, second):
        assert cuts[0][0] == -math.inf and cuts[0][-1] == math.inf and len(cuts[0]) == 8
        assert all(0 <= x <= 10 for x in cuts[0][1:-1]) and cuts[0] == sorted(cuts[0])
        assert cuts[1] == [-math.inf, 5.0, math.inf]
    assert first[0] != second[0]


@pytest.fixture(scope="module")
def lined(spark):
    return spark.createDataFrame([(float(i), float(i % 3), 3.0 * (i >= 50)) for i in range(100)], "x double, w double, y double")


def test_thresholds_are_those_drawn(lined):
    forest = RandomForestRegressor(labelCol="y", predictionCol="__raw", numTrees=7, maxDepth=4, bootstrap=False, featureSubsetStrategy="all")
    fitted = trees.fit_random_cuts(lined, ["x"], ["w"], forest, seed=3, groups=3, cuts=5)
    cutters, forests = fitted[0:-1:3], fitted[2:-1:3]
    assert [m.getNumTrees for m in forests] == [3, 2, 2]
    drawn = [c.getSplitsArray()[0] for c in cutters]
    assert len({tuple(d) for d in drawn}) == 3 and all(len(d) == 7 and 0 <= d[1] and d[-2] <= 99 for d in drawn)
    out = lined
    for stage in fitted:
        out = stage.transform(out)
    told: dict = {}
    for r in out.collect():
        for g, d in enumerate(drawn):
            # a group's prediction changes with x at its own cut points only
            low, high = max(c for c in d if c <= r["x"]), min(c for c in d if c > r["x"])
            told.setdefault((g, low, r["w"]), set()).add(r[f"__raw{g}"])
            if high <= 50 or low >= 50:
                assert r[f"__raw{g}"] == r["y"]
        assert r["__raw"] == pytest.approx((3 * r["__raw0"] + 2 * r["__raw1"] + 2 * r["__raw2"]) / 7)
    assert all(len(v) == 1 for v in told.values())


@pytest.mark.parametrize("name, settings", [("random_forest", {"numTrees": 3}), ("extra_trees", {"numTrees": 3, "maxDepth": 3}), ("hist_gradient_boosting", {"maxIter": 3, "maxDepth": 2})])
def test_saved_trees_predict_the_same(spark, lined, tmp_path, name, settings):
    rows = lined.withColumn("id", F.monotonically_increasing_id()).withColumn("c", F.when(F.col("w") > 0, "a").otherwise("b"))
    model = models.fit_model(rows, Candidate(name, "log1p", settings), ["x"], ["c"], "y", "id")
    model.save(f"{tmp_path}/model")
    again = models.load_model(spark, f"{tmp_path}/model")
    one, two = (sorted((r["id"], r["prediction"]) for r in m.transform(rows).collect()) for m in (model, again))
    assert one == two and all(-0.5 < p < 3.5 for _, p in one)


def test_rows_of_a_fit_are_bounded(spark, lined, monkeypatch):
    seen = []
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, df: _stop(seen, df))
    rows = lined.withColumn("id", F.monotonically_increasing_id())
    with pytest.raises(StopIteration):
        models.fit_model(rows, Candidate("random_forest", "plain", {"numTrees": 1}), ["x"], [], "y", "id", max_rows=40)
    assert 20 <= seen[0] <= 60


def test_all_rows_are_fitted_unless_told(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(models.RandomForestRegressor, "fit", lambda self, df: _stop(seen, df))
    rows = spark.range(130_000).select("id", (F.col("id") % 7).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    with pytest.raises(StopIteration):
        models.fit_model(rows, Candidate("random_forest", "plain", {"numTrees": 1}), ["x"], [], "y", "id")
    assert seen == [130_000]


def _stop(seen, df):
    seen.append(df.count())
    raise StopIteration
