import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugemill.contracts import FULL_ROW_RULES, HOUSE, MINIMAL_COLUMNS, Candidate, FeatureContract, Rule, TrainingParams
from gaugemill.operators.enrich import enrich
from gaugemill.operators.knn import build_index, knn_predict, nearest_neighbours
from gaugemill.plans import registry
from gaugemill.plans.features import build_features
from gaugemill.plans.importance import feature_ablation, permutation_importance
from gaugemill.plans.models import estimator, fit_model, fit_preprocessing, load_model
from gaugemill.plans.monitoring import monitor
from gaugemill.plans.scoring import predict_full, predict_minimal, score
from gaugemill.plans.training import train
from gaugemill.sources.readers import read_if_usable, read_table
from gaugemill.sources.reports import read_reports, write_report
from gaugemill.sources.writers import read_contract, write_rows
from gaugemill.streaming.scoring import predict_stream


def brute_neighbours(train_v, queries, codes, k):
    """All pairs: numeric part plus one-hot distance, ties by training row number."""
    n = train_v.shape[1] - codes
    d = ((queries[:, None, :n] - train_v[None, :, :n]) ** 2).sum(axis=2)
    for c in range(n, n + codes):
        a, b = queries[:, None, c], train_v[None, :, c]
        d += np.where((a == b) & (a >= 0), 0, (a >= 0).astype(float) + (b >= 0))
    d = np.sqrt(d)
    return [sorted(range(len(train_v)), key=lambda t: (round(row[t], 9), t))[:k] for row in d], d


@pytest.mark.parametrize(("pivots", "chunk"), [(1, 10_000), (12, 10_000), (40, 40), (12, 150)])
def test_neighbour_join_is_exact(spark, pivots, chunk):
    rng = np.random.default_rng(3)
    train_v = np.round(np.column_stack([rng.normal(size=(600, 3)), rng.integers(0, 4, 600)]), 2)
    train_v[::3] = [0.5, 0.5, 0.5, 1]  # a third of the rows in one spot
    queries = np.round(np.column_stack([rng.normal(size=(90, 3)), rng.integers(-1, 4, 90)]), 2)
    queries[::4] = [0.5, 0.5, 0.5, 1]
    fit_rows = spark.createDataFrame([(i, float(i), v.tolist()) for i, v in enumerate(train_v)], "id long, y double, v array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "q long, v array<double>")
    index = build_index(fit_rows, "id", "y", F.col("v"), 1, 5, pivots, chunk)
    got = nearest_neighbours(index, asked, "q", F.col("v")).toPandas()
    want, d = brute_neighbours(train_v, queries, 1, 5)
    for q in range(len(queries)):
        mine = got[got.q_id == q].sort_values(["distance", "t_id"])
        assert mine.t_id.tolist() == want[q]
        assert np.allclose(mine.distance, d[q][want[q]], atol=1e-9)
    predicted = knn_predict(index, asked, F.col("v")).toPandas().set_index("q").prediction
    for q in range(len(queries)):
        near = d[q][want[q]]
        at_zero = [t for t in want[q] if d[q][t] < 1e-12]
        mean = np.mean(at_zero) if at_zero else np.sum(np.array(want[q]) / near) / np.sum(1 / near)
        assert predicted[q] == pytest.approx(mean)


def test_equal_training_vectors_are_kept_k_times(spark):
    spots = [[0.0, 0.0], [3.0, 4.0], [9.0, 9.0]]
    rows = [(900 - i, float(i), spots[0 if i < 700 else 1 + i % 2]) for i in range(900)]
    fit_rows = spark.createDataFrame(rows, "id long, y double, v array<double>").repartition(6)
    index = build_index(fit_rows, "id", "y", F.col("v"), 0, 5)
    kept = {tuple(r["t_vec"]): sorted(r["ids"]) for r in index.rows.groupBy("t_vec").agg(F.collect_list("t_id").alias("ids")).collect()}
    assert kept == {tuple(s): sorted(i for i, _, v in rows if v == s)[:5] for s in spots}
    asked = spark.createDataFrame([(0, [0.0, 0.0]), (1, [3.0, 3.0])], "q long, v array<double>")
    got = nearest_neighbours(index, asked, "q", F.col("v")).toPandas()
    for q, spot in ((0, spots[0]), (1, spots[1])):
        assert sorted(got[got.q_id == q].t_id) == kept[tuple(spot)]


def test_query_rows_visit_few_groups(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    v = np.column_stack([rng.normal(size=(2400, 2)), rng.integers(0, 12, 2400)])
    rows = spark.createDataFrame([(i, float(i), x.tolist()) for i, x in enumerate(v)], "id long, y double, v array<double>")
    monkeypatch.setattr("gaugemill.operators.knn.work_dir", lambda _, name: f"{tmp_path}/{name}")
    index = build_index(rows, "id", "y", F.col("v"), 1, 5, 48, 100)
    assert index.groups().max() >= 20
    got = nearest_neighbours(index, rows.filter("id < 300"), "id", F.col("v")).toPandas()
    # beside its own group, where a category is apart from the others
    assert spark.read.parquet(f"{tmp_path}/visits").count() < 600
    want, _ = brute_neighbours(v, v[:300], 1, 5)
    assert all(got[got.q_id == q].sort_values(["distance", "t_id"]).t_id.tolist() == want[q] for q in range(0, 300, 7))


def test_too_few_training_rows(spark):
    rows = spark.createDataFrame([(1, 1.0, [0.0])], "id long, y double, v array<double>")
    with pytest.raises(ValueError, match="fewer than k"):
        build_index(rows, "id", "y", F.col("v"))


@pytest.fixture(scope="module")
def sold(spark):
    """Made-up house rows with a price that follows size, grade and place."""
    rng = np.random.default_rng(5)
    n = 400
    living = rng.integers(600, 4000, n).astype(float)
    zipcode = rng.choice(["98001", "98002", "98003"], n)
    grade = rng.integers(4, 12, n)
    place = pd.Series(zipcode).map({"98001": 0.0, "98002": 150_000.0, "98003": 300_000.0}).values
    rows = pd.DataFrame({
        "id": np.arange(n), "date": "20141013T000000", "price": 150 * living + 20_000 * grade + place + rng.normal(0, 5000, n) + 50_000,
        "bedrooms": rng.integers(1, 6, n).astype(float), "bathrooms": rng.integers(1, 4, n).astype(float), "sqft_living": living,
        "sqft_lot": rng.integers(2000, 9000, n).astype(float), "floors": 1.0, "waterfront": 0, "view": rng.integers(0, 3, n),
        "condition": rng.integers(1, 6, n), "grade": grade, "sqft_above": living, "sqft_basement": 0.0,
        "yr_built": rng.integers(1950, 2010, n), "yr_renovated": 0, "zipcode": zipcode, "lat": 47.5, "long": -122.0,
        "sqft_living15": living, "sqft_lot15": 5000.0,
    })
    return spark.createDataFrame(rows).persist()


@pytest.fixture(scope="module")
def places(spark):
    rows = [(z, *(float(i + j) for i in range(26))) for j, z in enumerate(("98001", "98002", "98003"))]
    return spark.createDataFrame(rows, "zipcode string, " + ", ".join(f"{c} double" for c in HOUSE.attributes))


PARAMS = TrainingParams(
    candidates=(
        Candidate("baseline_knn", "plain"),
        Candidate("hist_gradient_boosting", "log1p", {"maxIter": 8, "maxDepth": 4, "maxBins": 32}),
        Candidate("random_forest", "log1p", {"numTrees": 6, "maxDepth": 6}),
        Candidate("extra_trees", "log1p", {"numTrees": 6, "maxDepth": 6}),
    )
)


@pytest.fixture(scope="module")
def trained(spark, sold, places, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("training"))
    return base, train(sold, places, HOUSE, f"{base}/out", PARAMS, registry_base=f"{base}/registry")


def test_training_compares_and_saves(spark, trained, sold):
    base, found = trained
    rows = {r["key"]: r for r in found.rows.collect()}
    assert list(rows) == ["baseline_knn_plain", "hist_gradient_boosting_log1p", "random_forest_log1p", "extra_trees_log1p"]
    assert found.best["rmse"] == min(r["rmse"] for r in rows.values())
    spread = sold.agg(F.stddev("price")).first()[0]
    assert all(r["rmse"] < spread for r in rows.values())  # also shows that log targets come back in price units
    table = spark.read.parquet(f"{base}/out/comparison")
    assert table.filter("best").first()["key"] == found.best["key"]
    assert read_contract(spark, f"{base}/out/contract") == HOUSE
    runs = registry.runs(spark, f"{base}/registry")
    assert runs.count() == 5 and runs.filter("key = 'training_comparison'").first()["params"]["n_features"] == "53"


def test_saved_models_predict_the_same(spark, trained, sold, places):
    base, found = trained
    features = build_features(enrich(sold, places, "zipcode"), HOUSE, ["id", "price"]).orderBy("id").limit(30)
    for key in ("baseline_knn_plain", "random_forest_log1p"):
        first, second = (load_model(spark, f"{base}/out/candidates/{key}").transform(features) for _ in range(2))
        a, b = (d.orderBy("id").toPandas().prediction for d in (first, second))
        assert np.allclose(a, b) and a.notna().all()


def test_registry_prefers_registered_then_local(spark, trained, tmp_path):
    base, found = trained
    name = PARAMS.registered_model_name
    _, info = registry.resolve_model(spark, f"{base}/registry", name)
    assert info == {"model_name": name, "model_version": "1", "model_source": "registry"}
    assert registry.register_model(spark, f"{base}/registry", name, "nowhere") == 2
    _, info = registry.resolve_model(spark, f"{base}/registry", name, found.model_path)
    assert info["model_source"] == "local_artifact" and info["model_version"] == "local"
    _, info = registry.resolve_model(spark, None, name, found.model_path)
    assert info["model_source"] == "local_artifact"
    with pytest.raises(RuntimeError, match="no registered version"):
        registry.resolve_model(spark, str(tmp_path), name, f"{tmp_path}/none")
    registry.tag_version(spark, base, name, 1, {"best_model": "true"})
    assert registry.version_tags(spark, base).first()["value"] == "true"


def test_training_refuses_bad_input(spark, sold, places, tmp_path):
    bad = sold.withColumn("price", F.when(F.col("id") > 0, F.col("price")))
    with pytest.raises(ValueError, match="price"):
        train(bad, places, HOUSE, str(tmp_path), PARAMS)
    with pytest.raises(ValueError, match="no candidate"):
        train(sold, places, HOUSE, str(tmp_path), PARAMS, only=["other"])
    with pytest.raises(ValueError, match="unknown estimator"):
        estimator("other", 1)


def test_row_cap_and_cross_validation(sold, places, tmp_path):
    params = TrainingParams(cv_folds=2, candidates=(PARAMS.candidates[2],))
    found = train(sold, places, HOUSE, str(tmp_path), params, max_rows=120)
    assert found.best["cv_rmse_mean"] > 0 and found.version is None


def test_params_from_json():
    params = TrainingParams.from_json('{"training": {"test_size": 0.3, "cv_folds": 4, "models": [{"name": "random_forest", "target_mode": "log1p"}]}}')
    assert (params.test_size, params.cv_folds, params.random_state) == (0.3, 4, 42)
    assert [c.key for c in params.candidates] == ["random_forest_log1p"]
    assert TrainingParams.from_json("{}") == TrainingParams()


def test_unseen_and_missing_categories_are_all_zero(spark):
    fit_rows = spark.createDataFrame([(1, 1.0, "a", 1.0), (2, 2.0, "b", 2.0), (3, None, "a", 3.0)] * 4, "id long, x double, c string, y double")
    prep = fit_preprocessing(fit_rows, ["x"], ["c"])
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "c string").select(*prep.one_hot("c"), prep.code("c").alias("code"))
    assert [tuple(r) for r in rows.collect()] == [(1, 0, 0.0), (0, 0, -1.0), (0, 0, -1.0)]
    model = fit_model(fit_rows, Candidate("random_forest", "plain", {"numTrees": 3, "maxDepth": 2}), ["x"], ["c"], "y", "id", prep=prep)
    odd = spark.createDataFrame([(9, None, "z"), (10, 1.0, None)], "id long, x double, c string")
    assert model.transform(odd).filter("prediction IS NOT NULL").count() == 2


INFO = {"model_name": "m", "model_version": "1", "model_source": "registry"}


def test_predictions_full_minimal_and_batch(spark, trained, sold, places, tmp_path):
    _, found = trained
    rows = sold.drop("date", "price")
    rows = rows.withColumn("grade", F.when(F.col("id") == 0, 99).otherwise(F.col("grade")))
    done, refused = predict_full(rows, places, found.model, HOUSE, INFO, FULL_ROW_RULES, keep=["id"])
    row = done.first()
    assert done.count() == 399 and [tuple(r["broken"]) for r in refused.collect()] == [("grade",)]
    assert row["n_features"] == 53 and len(row["feature_metadata"]["final_feature_columns"]) == 53 and row["model_version"] == "1"
    short, _ = predict_minimal(sold.select("id", *MINIMAL_COLUMNS), places, found.model, HOUSE, INFO, keep=["id"])
    assert short.filter("predicted_price > 0").count() == 400
    strict = [Rule("sqft_above", gt=float(sold.selectExpr("percentile(sqft_living, 0.5)").first()[0])) if r.column == "sqft_above" else r for r in FULL_ROW_RULES]
    few, broken = predict_minimal(sold.select("id", *MINIMAL_COLUMNS), places, found.model, HOUSE, INFO, full_rules=strict, keep=["id"])
    assert few.count() + broken.count() == 400 and broken.count() > 0
    twice = places.union(places.limit(1).withColumn("zipcode", F.concat(F.lit(" "), "zipcode")))
    with pytest.raises(ValueError, match="not unique"):
        predict_full(rows, twice, found.model, HOUSE, INFO, FULL_ROW_RULES, keep=["id"])
    # scoring gives what training features give
    batch = score(sold.drop("id", "date", "price"), places, found.model, HOUSE, f"{tmp_path}/scores.csv")
    assert batch.columns == ["zipcode", "predicted_price"] and batch.count() == 400
    features = build_features(enrich(sold, places, "zipcode"), HOUSE, ["id"])
    direct = found.model.transform(features).agg(F.sum("prediction")).first()[0]
    assert batch.agg(F.sum(F.col("predicted_price").cast("double"))).first()[0] == pytest.approx(direct)


@pytest.mark.parametrize("key", ["random_forest_log1p", "baseline_knn_plain"])
def test_stream_gives_the_batch_result(spark, trained, sold, places, tmp_path, key):
    base, _ = trained
    model = load_model(spark, f"{base}/out/candidates/{key}")
    rows = sold.drop("date", "price").withColumn("view", F.when(F.col("id") % 50 == 0, -1).otherwise(F.col("view")))
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for q in predict_stream(stream, places, model, HOUSE, INFO, f"{tmp_path}/out", f"{tmp_path}/cp", keep=["id"]):
        q.awaitTermination()
    done, refused = predict_full(rows, places, model, HOUSE, INFO, keep=["id"])
    got = spark.read.parquet(f"{tmp_path}/out/predictions").select("id", "predicted_price").orderBy("id").toPandas()
    want = done.select("id", "predicted_price").orderBy("id").toPandas()
    assert got.id.tolist() == want.id.tolist() and np.allclose(got.predicted_price, want.predicted_price)
    assert spark.read.parquet(f"{tmp_path}/out/rejected").count() == refused.count() == 8


def test_importance_and_ablation(spark, trained, sold, places):
    base, _ = trained
    features = build_features(enrich(sold, places, "zipcode"), HOUSE, ["id", "price"])
    model = load_model(spark, f"{base}/out/candidates/random_forest_log1p")
    rise = permutation_importance(features, model.transform, list(HOUSE.final), "price", ["id"], repeats=2).toPandas().set_index("feature")
    assert len(rise) == 53 and rise.importance_mean["floors"] == 0 and rise.importance_mean.idxmax() in (
        "sqft_living", "sqft_above", "total_sqft", "sqft_living15")
    numeric = ("sqft_living", "grade")
    got = feature_ablation(
        features, features, {"base": (numeric, ()), "place": (numeric, ("zipcode",))}, PARAMS.candidates[2], "price", "id"
    ).toPandas().set_index("scenario")
    assert got.mae_improvement["base"] == 0 and got.mae_improvement["place"] > 0


def test_monitoring_report(spark, sold, places, tmp_path):
    unseen = sold.drop("id", "date", "price").limit(100)
    scored = sold.select("zipcode", (F.col("price") * 2).alias("predicted_price"))
    labeled = sold.select(F.col("price").alias("actual_price"), F.col("price").alias("prediction"))
    report = monitor(sold, unseen, places, HOUSE, scored, labeled)
    write_report(report, f"{tmp_path}/reports", "run1")
    row = read_reports(spark, f"{tmp_path}/reports", "run1").first()
    assert row["report_version"] == "1.0" and row["quality"]["ok"] and row["quality"]["n_fact_rows"] == 400
    assert row["data_drift"]["summary"]["n_features_evaluated"] == len(row["data_drift"]["features"]) == 43
    assert row["prediction_drift"]["drift"] and row["model_performance"]["mae"] == 0.0
    bad = monitor(sold.withColumn("bedrooms", F.lit(None).cast("double")), unseen, places, HOUSE).first()
    assert not bad["quality"]["ok"] and bad["data_drift"]["reason"] == "upstream_quality_failed"
    assert bad["prediction_drift"]["reason"] == "predictions_file_missing"
    assert bad["model_performance"]["reason"] == "no_labels_file_configured"
    odd = monitor(sold, unseen, places, HOUSE, scored.drop("predicted_price"), labeled, ["lat"]).first()
    assert odd["prediction_drift"]["reason"] == "missing_predicted_price_column"


def test_sources(spark, tmp_path):
    text = 'id,zipcode,price,note\n1,"98178",100.5,x\n2,NA,n/a,\n3,98001,12d,nan\n'
    (tmp_path / "rows.csv").write_text(text)
    df = read_table(spark, f"{tmp_path}/rows.csv", {"id": "bigint", "price": "double", "zipcode": "string"})
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "98178", 100.5, "x"), (2, None, None, None), (3, "98001", None, None)]
    write_rows(df, f"{tmp_path}/copy")
    assert read_table(spark, f"{tmp_path}/copy").count() == 3
    assert read_if_usable(spark, f"{tmp_path}/none", ["a"]) == (None, "predictions_file_missing")
    assert read_if_usable(spark, f"{tmp_path}/rows.csv", ["a"])[1] == "missing_predicted_price_column"
    assert read_if_usable(spark, f"{tmp_path}/rows.csv", ["id"])[1] is None
    assert isinstance(HOUSE, FeatureContract)


def test_writers_at_the_same_time_get_versions_of_their_own(spark, tmp_path, monkeypatch):
    base = f"{tmp_path}/registry"
    monkeypatch.setattr(registry, "last_version", lambda *_: 0)  # each reads the table before the others write
    got = [registry.register_model(spark, base, "a/b", f"path{i}") for i in range(3)] + [registry.register_model(spark, base, "c", "p")]
    assert got == [1, 2, 3, 1]
    rows = registry.versions(spark, base).where("name = 'a/b'").collect()
    assert sorted((r["version"], r["path"]) for r in rows) == [(1, "path0"), (2, "path1"), (3, "path2")]
    monkeypatch.undo()
    assert registry.register_model(spark, base, "a/b", "path3") == 4
