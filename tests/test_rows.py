import pytest
from pyspark.sql import functions as F

from gaugemill.contracts import FULL_ROW_RULES, HOUSE, MINIMAL_COLUMNS, MINIMAL_DEFAULTS, MINIMAL_ROW_RULES, FeatureContract
from gaugemill.operators import constraints, quality, sampling
from gaugemill.operators.drift import common_numeric_columns
from gaugemill.operators.enrich import enrich, fill_attributes
from gaugemill.plans.features import build_features, expand_minimal, features_and_target, to_contract


def test_join_keeps_rows_and_bridges_key_types(spark, zips):
    fact = spark.createDataFrame([("98178", 1), ('"98001"', 2), (None, 3), ("99999", 4)], "zipcode string, n int")
    dim = spark.createDataFrame([(98178, 5.0), (98001, 6.0)], "zipcode long, size double")
    got = {r["n"]: r for r in enrich(fact, dim, "zipcode").collect()}
    assert len(got) == 4
    assert [got[i]["size"] for i in (1, 2, 3, 4)] == [5.0, 6.0, None, None]
    assert got[2]["zipcode"] == "98001"
    filled = {r["n"]: r["size"] for r in fill_attributes(enrich(fact, dim, "zipcode"), ["size"]).collect()}
    assert filled[3] == filled[4] == 0.0


def test_null_keys_match_each_other(spark):
    fact = spark.createDataFrame([(None, 1), ("1", 2)], "k string, n int")
    dim = spark.createDataFrame([(None, 7.0)], "k string, size double")
    assert {r["n"]: r["size"] for r in enrich(fact, dim, "k").collect()} == {1: 7.0, 2: None}


@pytest.mark.parametrize("how", ["left", "inner", "right", "full"])
def test_join_modes_agree_with_pandas(spark, how):
    fact = spark.createDataFrame([(str(10_000 + (i % 7 if i % 3 else 0)), i) for i in range(300)], "k string, n int")
    dim = spark.createDataFrame([(str(10_003 + i), float(i)) for i in range(8)], "k string, size double")
    got = enrich(fact, dim, "k", how).toPandas()
    want = fact.toPandas().merge(dim.toPandas(), on="k", how={"full": "outer"}.get(how, how))
    order = ["k", "n", "size"]
    assert got[order].fillna(-1).sort_values(order).values.tolist() == want[order].fillna(-1).sort_values(order).values.tolist()


def test_shuffled_join_of_a_hot_key(spark):
    """A key with a third of all rows, without a broadcast."""
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("77777")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    dim = spark.range(0, 3000, 2).select(F.col("id").cast("string").alias("k"), F.lit(1.0).alias("size"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich(fact, dim, "k", "full")
        got = joined.agg(F.count("id").alias("facts"), F.count("size").alias("sizes"), F.count(F.lit(1)).alias("n")).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    alone = sum(1 for i in range(0, 3000, 2) if i % 3 == 0)
    assert (got["facts"], got["n"], got["sizes"]) == (3000, 3000 + alone, 1500)


def test_duplicate_dimension_key_raises_after_normalization(spark):
    fact = spark.createDataFrame([("98178",)], "zipcode string")
    dim = spark.createDataFrame([("98178", 1.0), (' 98178.0', 2.0)], "zipcode string, size double")
    with pytest.raises(ValueError, match="not unique"):
        enrich(fact, dim, "zipcode", check_unique=True)


def test_engineered_values(houses, zips):
    merged = enrich(houses({}), zips("98178"), "zipcode")
    row = build_features(merged, HOUSE, reference_year=2020).first()
    assert (row["house_age"], row["renovated_flag"], row["renovation_age"], row["total_sqft"]) == (20.0, 1, 10.0, 1500.0)
    assert row["living_to_lot_ratio"] == pytest.approx(0.3)
    assert row["bath_bed_ratio"] == pytest.approx(2 / 3)
    assert row["basement_ratio"] == pytest.approx(0.2)
    assert (row["geo_zip_bucket"], row["geo_cluster_placeholder"]) == (178, 0)
    assert row.asDict().keys() == dict.fromkeys(HOUSE.final).keys()
    assert len(HOUSE.final) == 53 and len(HOUSE.model_numeric) == 48


def test_zero_denominators_and_missing_values(houses, zips):
    changes = dict(bedrooms=0.0, sqft_lot=0.0, sqft_above=0.0, sqft_basement=0.0, yr_renovated=0)
    merged = enrich(houses(changes, dict(yr_built=None, sqft_living=None, bathrooms=None)), zips("98001"), "zipcode")
    first, second = build_features(merged, HOUSE).collect()
    assert [first[c] for c in ("living_to_lot_ratio", "basement_ratio", "renovated_flag", "renovation_age")] == [0.0, 0.0, 0, 0.0]
    assert first["bath_bed_ratio"] == 2.0
    assert first["ppltn_qty"] == 0.0  # join miss
    assert second["house_age"] is None and second["bath_bed_ratio"] == 0.0 and second["living_to_lot_ratio"] == 0.0
    null = build_features(merged, HOUSE, policy="null").collect()
    assert null[0]["living_to_lot_ratio"] is None and null[0]["bath_bed_ratio"] is None and null[0]["renovation_age"] is None


def test_metadata_does_not_leak_and_order_is_restored(houses, zips):
    merged = enrich(houses({}), zips("98178"), "zipcode")
    features = build_features(merged, HOUSE)
    assert not {"id", "date", "price"} & set(features.columns)
    shuffled = features.select(*reversed(features.columns)).drop("view").withColumn("zipcode", F.lit(None).cast("string"))
    back = to_contract(shuffled, HOUSE)
    assert back.columns == list(HOUSE.final)
    assert back.first()["view"] is None and back.first()["zipcode"] == ""
    with pytest.raises(ValueError, match="floors"):
        build_features(merged.drop("floors"), HOUSE)
    with pytest.raises(ValueError, match="no target"):
        features_and_target(merged.drop("price"), HOUSE)
    assert features_and_target(merged, HOUSE).columns[-1] == "price"


def test_minimal_rows_are_completed(houses):
    full = expand_minimal(houses({}).select(*MINIMAL_COLUMNS), HOUSE, dict(MINIMAL_DEFAULTS))
    row = full.first()
    assert set(full.columns) == set(HOUSE.inference_columns)
    assert (row["sqft_above"], row["sqft_lot15"], row["waterfront"], row["yr_renovated"], row["sqft_basement"]) == (1500.0, 5000.0, 0, 0, 0.0)


def test_contract_survives_json():
    assert FeatureContract.from_json(HOUSE.to_json()) == HOUSE


def test_row_rules(houses):
    rows = houses({}, dict(bedrooms=-1.0, grade=14), dict(zipcode="98"), dict(sqft_living=0.0), dict(yr_built=None)).drop("id", "date", "price")
    valid, rejected = constraints.split_by_rules(rows, FULL_ROW_RULES)
    assert valid.count() == 1
    assert sorted(tuple(r["broken"]) for r in rejected.collect()) == [("bedrooms", "grade"), ("sqft_living",), ("yr_built",), ("zipcode",)]
    with pytest.raises(ValueError, match="unknown columns"):
        constraints.split_by_rules(rows.withColumn("color", F.lit("red")), FULL_ROW_RULES)
    with pytest.raises(ValueError, match="4 rows break"):
        constraints.require_valid(rows, FULL_ROW_RULES)
    with pytest.raises(ValueError, match="at most 3"):
        constraints.require_valid(rows, FULL_ROW_RULES, max_rows=3)
    with pytest.raises(ValueError, match="no rows"):
        constraints.require_valid(rows.limit(0), FULL_ROW_RULES)
    assert len(MINIMAL_ROW_RULES) == 11
    assert constraints.require_valid(rows.limit(1).select(*MINIMAL_COLUMNS), MINIMAL_ROW_RULES).count() == 1


def test_sales_checks(houses, zips):
    good = quality.check_sales(houses({}), HOUSE)
    assert good.count() == 0
    bad = houses({}, dict(price=None), dict(id=2, zipcode=None)).withColumn("extra", F.lit(1)).drop("lat")
    found = {(r["check"], r["column"], r["severity"]): r["n_rows"] for r in quality.check_sales(bad, HOUSE).collect()}
    assert found == {
        ("schema", "lat", "error"): 0, ("schema", "extra", "warning"): 0, ("nulls", "price", "error"): 1,
        ("nulls", "zipcode", "error"): 1, ("null_key", "zipcode", "error"): 1, ("duplicate_ids", "id", "warning"): 2,
    }
    with pytest.raises(ValueError, match="sales.price: 1 values missing"):
        quality.gate(quality.check_sales(bad, HOUSE), "training")


def test_dimension_and_inference_checks(houses, zips):
    dim = quality.check_dimension(zips("98178", "98178", "98001"), HOUSE, "demographics").collect()
    assert [(r["check"], r["n_rows"], r["message"]) for r in dim] == [
        ("duplicate_keys", 2, "demographics.zipcode: 2 rows share their key")
    ]
    rows = houses({}, {}, {}, dict(lat=1.0)).drop("id", "date", "price")
    found = quality.check_inference(rows, HOUSE)
    assert [r["message"] for r in found.collect()] == ["inference: 2 rows repeat another"]
    assert quality.gate(found, "inference") == ["inference: 2 rows repeat another"]
    gone = quality.null_findings(rows, ["color"], "inference").first()
    assert gone["message"] == "inference.color: not there to be checked for missing values"
    assert quality.check_merged(rows, HOUSE, "merged").first()["severity"] == "error"


def test_summary_keeps_check_order(houses, zips):
    facts, dim = houses({}, {}, dict(price=None, sqft_living=None)), zips("98178")
    row = quality.summarize(quality.check_training(facts, dim, HOUSE), facts, dim).first()
    assert not row["ok"] and (row["n_fact_rows"], row["n_dim_rows"]) == (3, 1)
    assert row["errors"] == ["sales.price: 1 values missing", "sales.sqft_living: 1 values missing"]
    assert row["warnings"] == ["sales.id: 3 rows share their id"]


def test_common_numeric_columns(spark):
    ref = spark.createDataFrame([(1, 2.0, 1000, "a", True)], "id long, price double, size int, name string, new boolean")
    cur = spark.createDataFrame([(True, 1, "1100", "b")], "new boolean, id long, size string, name string")
    assert common_numeric_columns(ref, cur) == ["size", "new"]


def test_splits_repeat_and_cover(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    fit, test = sampling.split_by_hash(df, ["k"])
    again = sampling.split_by_hash(df.repartition(7), ["k"])[1]
    assert sorted(r[0] for r in test.collect()) == sorted(r[0] for r in again.collect())
    assert fit.count() + test.count() == 5000 and abs(test.count() - 1000) < 120
    other = sampling.split_by_hash(df, ["k"], seed=7)[1]
    assert {r[0] for r in other.collect()} != {r[0] for r in test.collect()}
    fit, test = sampling.split_exact(df.limit(999), ["k"], 0.2)
    assert test.count() == 200 and fit.count() == 799


def test_ranks_folds_and_permutation(spark):
    df = spark.range(1003).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    ranked = sampling.with_hash_rank(df, ["k"], 42).toPandas()
    assert sorted(ranked["rank"]) == list(range(1003)) and set(ranked["rank_of"]) == {1003}
    sizes = [r["count"] for r in sampling.with_fold(df, ["k"], 5, contiguous=True).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [201, 201, 201, 200, 200]
    assert sampling.with_fold(df, ["k"], 5).groupBy("fold").count().count() == 5
    dealt = sampling.permuted_values(df, ["k"], ["v"], 3).toPandas()
    assert len(dealt) == 1003 and sorted(dealt["v__permuted"]) == sorted(dealt["v"])
    assert (dealt["v__permuted"] != dealt["v"]).mean() > 0.9
    assert sampling.sample_rows(df, ["k"], 10).count() == 10


def test_nan_breaks_a_rule(spark):
    from gaugemill.contracts import Rule
    from gaugemill.operators.constraints import split_by_rules

    rows = spark.createDataFrame([(1, 2.0, "abc"), (2, float("nan"), "abc"), (3, None, "abc"), (4, 1.0, "NaN")], "id long, x double, t string")
    valid, rejected = split_by_rules(rows, [Rule("x", ge=0), Rule("t", min_length=3)], ["id"])
    assert sorted(r["id"] for r in valid.collect()) == [1, 4]
    assert {r["id"]: r["broken"] for r in rejected.collect()} == {2: ["x"], 3: ["x"]}


def test_samples_and_first_rows_of_any_size(spark):
    from gaugemill.operators.sampling import first_rows, sample_rows

    df = spark.range(1000).selectExpr("id % 500 AS id", "id AS n").repartition(7)
    assert sorted(r["id"] for r in first_rows(df, ["id"], 401).collect()) == sorted([i // 2 for i in range(401)])
    assert first_rows(df, ["id"], 5000).count() == 1000 and first_rows(df, ["id"], 0).count() == 0
    assert sample_rows(df, ["n"], 300).select("n").distinct().count() == 300


def test_malformed_training_parameters_raise():
    from gaugemill.contracts import TrainingParams

    for text in ('{"models": [{"target_mode": "plain"}]}', '{"models": ["random_forest"]}', '{"models": [{"name": "x", "size": 1}]}', '{"cv_folds": "many"}'):
        with pytest.raises(ValueError):
            TrainingParams.from_json(text)


def test_categories_are_exact_or_raise(spark):
    from gaugemill.plans.models import fit_preprocessing

    df = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", 3.0)], "c string, x double")
    prep = fit_preprocessing(df, ["x"], ["c"])
    assert prep.categories["c"] == ("a", "b", "c") and prep.hashed == ()
    assert [round(r[0], 2) for r in df.selectExpr(prep.scaled("x")).collect()] == [-1.22, 0.0, 1.22]
    with pytest.raises(ValueError, match="hashed"):
        fit_preprocessing(df, [], ["c"], max_categories=2)
    assert fit_preprocessing(df, [], ["c"], max_categories=2, hashed=["c"]).hashed == ("c",)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 101, 997])
def test_permuted_ranks_are_a_permutation(spark, n):
    a, b = sampling.grid_of(n)
    assert 0 <= a * b - n < a <= b
    out = spark.range(n).select("id", *(sampling.permuted_rank(F.col("id"), n, F.lit(s)).alias(f"s{s}") for s in (1, 2))).orderBy("id").collect()
    assert sorted(r["s1"] for r in out) == sorted(r["s2"] for r in out) == list(range(n))
    if n >= 100:
        same = sum(r["s1"] == r["s2"] for r in out) + sum(r["s1"] == r["id"] for r in out)
        steps = {out[i + 1]["s1"] - out[i]["s1"] for i in range(n - 1)}
        assert same < n // 5 and len(steps) > n // 3  # neither the identity nor a shift


def test_dealt_values_give_every_row_away_once(spark):
    ranked = spark.range(60).select(F.col("id").alias("rank"), (F.col("id") * 10).alias("v"))
    out = sampling.dealt_values(ranked, 60, ["v"], [5, 6, 7])
    for repeat in range(3):
        given = [r["v__permuted"] for r in out.where(F.col("repeat") == repeat).collect()]
        assert sorted(given) == [10 * i for i in range(60)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1  # one join, whatever the number of seeds
