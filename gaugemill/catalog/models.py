"""Queries on models: neighbour regression, scoring, training, runs and versions, streams."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from gaugemill.catalog.tables import (
    ACCOUNT_DEFAULTS,
    ACCOUNTS,
    ACCOUNTS_SQL,
    accounts,
    features_sql,
    in_share_sql,
    nations,
    table,
)
from gaugemill.contracts import Candidate, Rule, TrainingParams
from gaugemill.operators.enrich import enrich
from gaugemill.operators.knn import build_index, nearest_neighbours, weighted_mean
from gaugemill.operators.sampling import split_by_hash
from gaugemill.operators.stats import regression_metrics
from gaugemill.plans import registry
from gaugemill.plans.features import build_features
from gaugemill.plans.importance import feature_ablation as ablate
from gaugemill.plans.importance import permutation_importance as importance_of
from gaugemill.plans.models import (
    cross_validated,
    cross_validated_rmse,
    fit_contract_model,
    fit_model,
    fit_preprocessing,
    load_model,
    preprocessing_stages,
)
from gaugemill.plans.scoring import predict_full as run_full
from gaugemill.plans.scoring import predict_minimal as run_minimal
from gaugemill.plans.scoring import predict_requests as run_requests
from gaugemill.plans.scoring import score, scored_rows
from gaugemill.plans.training import read_comparison, train, train_baseline
from gaugemill.session import work_dir
from gaugemill.sources.readers import read_table
from gaugemill.sources.writers import read_contract, read_params, write_rows
from gaugemill.streaming.scoring import predict_stream

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


KNN = Candidate("baseline_knn", "plain")
KEEP = ["c_custkey", "balance"]
# The estimators as they are declared. The target is plain: balances go below -1, where log1p has no value.
TREES = {name: Candidate(name, "plain") for name in ("random_forest", "hist_gradient_boosting", "extra_trees")}


def _facts(spark, sf_dir):
    return accounts(spark, sf_dir).fillna(0.0, list(ACCOUNTS.numeric[:2]))


def _split_features(spark, sf_dir):
    """Training and validation features; written once, since fitting reads them several times."""
    merged = enrich(_facts(spark, sf_dir), nations(spark, sf_dir), ACCOUNTS.key)
    path = write_rows(build_features(merged, ACCOUNTS, KEEP), work_dir(spark, "features"))
    return split_by_hash(spark.read.parquet(path), ["c_custkey"])


def _knn(spark, sf_dir):
    fit_rows, _ = _split_features(spark, sf_dir)
    return fit_contract_model(fit_rows, KNN, ACCOUNTS)


def _unlabeled(spark, sf_dir):
    """All customers, as rows to be scored."""
    return _facts(spark, sf_dir).drop("balance")


# --- SQL of the neighbour regressor: all pairs, which is what the Spark form avoids ------------------------------

NUM = ACCOUNTS.model_numeric


def _knn_sql(rows: str = "test_rows") -> str:
    """Scaled features, five nearest by distance and id, weighted mean; predictions for the rows of ``rows``."""
    med = ", ".join(f"coalesce(median({c}), 0e0) AS {c}" for c in NUM)
    moments = ", ".join(
        f"avg(coalesce(f.{c}, m.{c})) AS {c}_m, CASE WHEN stddev_pop(coalesce(f.{c}, m.{c})) = 0 THEN 1e0 ELSE stddev_pop(coalesce(f.{c}, m.{c})) END AS {c}_s"
        for c in NUM
    )
    scaled = ", ".join(f"(coalesce(f.{c}, m.{c}) - s.{c}_m) / s.{c}_s AS {c}" for c in NUM)
    squares = " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in NUM)
    codes = " + ".join(
        f"CASE WHEN q.{c} = t.{c} THEN 0e0 ELSE 1e0 + CASE WHEN q.{c} IN (SELECT {c} FROM train) THEN 1e0 ELSE 0e0 END END"
        for c in ACCOUNTS.categorical
    )
    return f"""med AS (SELECT {med} FROM train),
moments AS (SELECT {moments} FROM train f, med m),
scaled_train AS (SELECT f.c_custkey, f.balance, f.c_mktsegment, f.nation, {scaled} FROM train f, med m, moments s),
scaled_rows AS (SELECT f.c_custkey, f.c_mktsegment, f.nation, {scaled} FROM {rows} f, med m, moments s),
pairs AS (SELECT q.c_custkey AS q_id, t.c_custkey AS t_id, t.balance AS y, sqrt({squares} + {codes}) AS d FROM scaled_rows q, scaled_train t),
nearest AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY d, t_id) <= 5),
predicted AS (SELECT q_id AS c_custkey, CASE WHEN count(*) FILTER (WHERE d = 0) > 0 THEN avg(y) FILTER (WHERE d = 0)
    ELSE sum(y / d) FILTER (WHERE d > 0) / sum(1 / d) FILTER (WHERE d > 0) END AS predicted_price FROM nearest GROUP BY q_id)"""


FACTS_SQL = f"""WITH {ACCOUNTS_SQL},
facts AS (SELECT * REPLACE (coalesce(n_orders, 0) AS n_orders, coalesce(total_price, 0) AS total_price) FROM accounts),
features AS (SELECT c_custkey, balance, {features_sql(ACCOUNTS)} FROM facts LEFT JOIN nations USING (nation)),
train AS (SELECT * FROM features WHERE NOT {in_share_sql('c_custkey', 0.2, 42)}),
test_rows AS (SELECT * FROM features WHERE {in_share_sql('c_custkey', 0.2, 42)})"""


@query(f"{FACTS_SQL}, {_knn_sql('features')} SELECT c_custkey, nation, round(predicted_price, 4) AS predicted_price FROM predicted JOIN features USING (c_custkey)")
def batch_score(spark, sf_dir):
    """Customers enriched, scored and written by the neighbour model."""
    model = _knn(spark, sf_dir)
    rows = _unlabeled(spark, sf_dir)
    # the id rides along outside the contract, so the checks see the contract's columns only
    merged = enrich(rows, nations(spark, sf_dir), ACCOUNTS.key)
    path = write_rows(scored_rows(merged, model, ACCOUNTS, ["c_custkey"]), work_dir(spark, "scores"))
    return read_table(spark, path).withColumn("predicted_price", F.round("predicted_price", 4))


@query(f"""{FACTS_SQL}, {_knn_sql('features')} SELECT nation, count(*) AS n_rows, round(sum(predicted_price), 2) AS predicted_sum
FROM predicted JOIN features USING (c_custkey) GROUP BY nation""")
def batch_score_job(spark, sf_dir):
    """W4 with its gates, from unlabeled rows without any id to a CSV file of key and prediction."""
    rows = _unlabeled(spark, sf_dir).drop("c_custkey")
    scored = score(rows, nations(spark, sf_dir), _knn(spark, sf_dir), ACCOUNTS, work_dir(spark, "scores") + ".csv")
    return scored.groupBy("nation").agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(F.col("predicted_price").cast("double")), 2).alias("predicted_sum")
    )


ACCOUNT_RULES = (
    Rule("n_orders", ge=0, integral=True),
    Rule("total_price", ge=0),
    Rule("avg_price", gt=50_000),
    Rule("max_price", gt=0, le=495_000),
    Rule("open_price", ge=0),
    Rule("done_price", ge=0),
    Rule("first_year", ge=1990, le=2100, integral=True),
    Rule("last_year", ge=1990, le=2100, integral=True),
    Rule("urgent_orders", ge=0, integral=True),
    Rule("c_mktsegment", min_length=3),
    Rule("nation"),
)
RULES_SQL = "coalesce(avg_price > 50000 AND max_price > 0 AND max_price <= 495000 AND first_year >= 1990 AND last_year >= 1990, false)"
INFO = {"model_name": "balance", "model_version": "1", "model_source": "registry"}


@query(f"""{FACTS_SQL}, valid AS (SELECT * FROM features WHERE {RULES_SQL}), {_knn_sql('valid')}
SELECT c_custkey, nation, round(predicted_price, 4) AS predicted_price, 'balance' AS model_name, '1' AS model_version, {len(ACCOUNTS.final)} AS n_features, '' AS broken
FROM predicted JOIN valid USING (c_custkey)
UNION ALL SELECT c_custkey, nation, -1, 'balance', '1', {len(ACCOUNTS.final)},
  array_to_string(list_filter([CASE WHEN NOT coalesce(avg_price > 50000, false) THEN 'avg_price' END,
    CASE WHEN NOT coalesce(max_price > 0 AND max_price <= 495000, false) THEN 'max_price' END,
    CASE WHEN open_price IS NULL THEN 'open_price' END, CASE WHEN done_price IS NULL THEN 'done_price' END,
    CASE WHEN first_year IS NULL THEN 'first_year' END, CASE WHEN last_year IS NULL THEN 'last_year' END,
    CASE WHEN urgent_orders IS NULL THEN 'urgent_orders' END], lambda x: x IS NOT NULL), ',')
FROM features WHERE NOT {RULES_SQL}""")
def predict_full(spark, sf_dir):
    """Checked rows predicted, refused rows with their reasons."""
    model = _knn(spark, sf_dir)
    done, refused = run_full(
        _unlabeled(spark, sf_dir), nations(spark, sf_dir), model, ACCOUNTS, INFO, ACCOUNT_RULES, keep=["c_custkey"]
    )
    return _answers(done, refused)


def _answers(done, refused):
    done = done.select(
        "c_custkey", "nation", F.round("predicted_price", 4).alias("predicted_price"), "model_name", "model_version", "n_features", F.lit("").alias("broken")
    )
    refused = refused.select(
        "c_custkey", F.lpad(F.col("nation").cast("string"), 5, "0").alias("nation"), F.lit(-1.0).alias("predicted_price"),
        F.lit(INFO["model_name"]).alias("model_name"), F.lit(INFO["model_version"]).alias("model_version"),
        F.lit(len(ACCOUNTS.final)).alias("n_features"), F.concat_ws(",", "broken").alias("broken"),
    )
    return done.unionByName(refused)


ORACLE["stream_predict"] = ORACLE["predict_full"]


@query(ORACLE["predict_full"])
def stream_predict(spark, sf_dir):
    """W6 on a stream of customers: their order figures are the static side, each batch is checked and scored."""
    model = _knn(spark, sf_dir)
    schema = table(spark, sf_dir, "customer").schema
    arriving = spark.readStream.schema(schema).parquet(f"{sf_dir}/customer*.parquet")
    figures = _facts(spark, sf_dir).drop("balance", "c_mktsegment", "nation")
    rows = arriving.join(figures, "c_custkey").select(
        "c_custkey", *ACCOUNTS.numeric, "c_mktsegment", F.col("c_nationkey").alias("nation")
    )
    out = work_dir(spark, "stream")
    for running in predict_stream(
        rows, nations(spark, sf_dir), model, ACCOUNTS, INFO, out, f"{out}/checkpoint", keep=["c_custkey"], rules=ACCOUNT_RULES
    ):
        running.awaitTermination()
    return _answers(spark.read.parquet(f"{out}/predictions"), spark.read.parquet(f"{out}/rejected"))


MINIMAL_RULES = tuple(r for r in ACCOUNT_RULES if r.column not in ACCOUNT_DEFAULTS)


@query(f"""WITH {ACCOUNTS_SQL},
facts AS (SELECT * REPLACE (coalesce(n_orders, 0) AS n_orders, coalesce(total_price, 0) AS total_price) FROM accounts),
features AS (SELECT c_custkey, balance, {features_sql(ACCOUNTS)} FROM facts LEFT JOIN nations USING (nation)),
train AS (SELECT * FROM features WHERE NOT {in_share_sql('c_custkey', 0.2, 42)}),
marked AS (SELECT *, array_to_string(list_filter([CASE WHEN NOT coalesce(max_price > 0 AND max_price <= 495000, false) THEN 'max_price' END,
  CASE WHEN NOT coalesce(first_year >= 1990, false) THEN 'first_year' END], lambda x: x IS NOT NULL), ',') AS early FROM facts),
checked AS (SELECT *, CASE WHEN early = '' AND max_price <= 50000 THEN 'avg_price' ELSE early END AS broken FROM marked),
minimal AS (SELECT * REPLACE (max_price AS avg_price, total_price AS open_price, 0e0 AS done_price, first_year AS last_year, 0e0 AS urgent_orders)
  FROM checked WHERE broken = ''),
filled AS (SELECT c_custkey, balance, {features_sql(ACCOUNTS)} FROM minimal LEFT JOIN nations USING (nation)), {_knn_sql('filled')}
SELECT c_custkey, round(predicted_price, 4) AS predicted_price, '' AS broken FROM predicted
UNION ALL SELECT c_custkey, NULL, broken FROM checked WHERE broken <> ''""")
def predict_minimal(spark, sf_dir):
    """Minimal rows checked, completed, checked again and predicted; refused rows with their reasons."""
    rows = _unlabeled(spark, sf_dir).drop(*ACCOUNT_DEFAULTS)
    done, refused = run_minimal(
        rows, nations(spark, sf_dir), _knn(spark, sf_dir), ACCOUNTS, INFO, MINIMAL_RULES, ACCOUNT_RULES, ACCOUNT_DEFAULTS, ["c_custkey"]
    )
    done = done.select("c_custkey", F.round("predicted_price", 4).alias("predicted_price"), F.lit("").alias("broken"))
    return done.unionByName(refused.select("c_custkey", F.lit(None).cast("double").alias("predicted_price"), F.concat_ws(",", "broken").alias("broken")))


# requests of five customers each, one per nation, and one of all customers taken often enough to pass the limit
REQUESTS_SQL = """asked AS (
  SELECT 'five-' || CAST(c_custkey // 5 AS VARCHAR) AS request, * FROM features
  UNION ALL SELECT 'nation-' || nation, * FROM features
  UNION ALL SELECT CASE WHEN row_number() OVER (ORDER BY c_custkey) <= 501 THEN 'many' ELSE 'rest' END, * FROM features)"""


@query(f"""{FACTS_SQL}, {REQUESTS_SQL},
sizes AS (SELECT request, count(*) AS n_rows, count(*) FILTER (NOT {RULES_SQL}) AS n_bad,
  coalesce(bool_or(NOT coalesce(avg_price > 50000, false)), false) AS bad_avg, coalesce(bool_or(NOT coalesce(max_price > 0 AND max_price <= 495000, false)), false) AS bad_max,
  bool_or(open_price IS NULL) AS bad_open FROM asked GROUP BY request UNION ALL SELECT 'silent', 0, 0, false, false, false),
valid AS (SELECT * FROM features WHERE {RULES_SQL}), {_knn_sql('valid')},
answers AS (SELECT request, sum(predicted_price) AS total, count(*) AS n_answers FROM asked JOIN predicted USING (c_custkey) GROUP BY request)
SELECT request, n_rows, n_bad, CASE WHEN n_rows = 0 THEN 'no rows' WHEN n_rows > 500 THEN CAST(n_rows AS VARCHAR) || ' rows, at most 500 allowed'
    WHEN n_bad > 0 THEN CAST(n_bad AS VARCHAR) || ' rows break a rule' ELSE '' END AS reason,
  CAST(bad_avg AS INTEGER) + 2 * CAST(bad_max AS INTEGER) + 4 * CAST(bad_open AS INTEGER) AS broken_sum,
  CASE WHEN n_rows BETWEEN 1 AND 500 AND n_bad = 0 THEN n_answers ELSE 0 END AS n_answers,
  round(CASE WHEN n_rows BETWEEN 1 AND 500 AND n_bad = 0 THEN total ELSE 0 END, 3) AS predicted_sum
FROM sizes LEFT JOIN answers USING (request)""")
def predict_requests(spark, sf_dir):
    """Requests answered or refused as a whole: too many rows, one bad row among good ones, no rows."""
    customers = _unlabeled(spark, sf_dir)
    many = customers.select("c_custkey").orderBy("c_custkey").limit(501).withColumn("first", F.lit(True))
    nation = F.lpad(F.col("nation").cast("string"), 5, "0")
    asked = customers.withColumn("request", F.concat(F.lit("five-"), F.floor(F.col("c_custkey") / 5).cast("string")))
    asked = asked.unionByName(customers.withColumn("request", F.concat(F.lit("nation-"), nation)))
    asked = asked.unionByName(
        customers.join(many, "c_custkey", "left").withColumn("request", F.when(F.col("first"), "many").otherwise("rest")).drop("first")
    )
    known = asked.select("request").unionByName(spark.createDataFrame([("silent",)], "request string"))
    answered, verdicts = run_requests(
        asked, "request", nations(spark, sf_dir), _knn(spark, sf_dir), ACCOUNTS, INFO, ACCOUNT_RULES, ["c_custkey"], expected=known
    )
    totals = answered.groupBy("request").agg(F.count(F.lit(1)).alias("n_answers"), F.sum("predicted_price").alias("total"))
    broken = sum((F.array_contains("broken", c).cast("int") * n for c, n in (("avg_price", 1), ("max_price", 2), ("open_price", 4))), F.lit(0))
    return verdicts.join(totals, "request", "left").select(
        "request", "n_rows", "n_bad", F.coalesce("reason", F.lit("")).alias("reason"), broken.alias("broken_sum"),
        F.coalesce("n_answers", F.lit(0)).alias("n_answers"), F.round(F.coalesce("total", F.lit(0.0)), 3).alias("predicted_sum"),
    )


@query(f"""WITH e AS (SELECT vec_id, CAST(label AS DOUBLE) AS y, embedding AS v FROM embeddings),
train AS (SELECT * FROM e WHERE NOT {in_share_sql('vec_id', 0.2, 42)}), 
pairs AS (SELECT q.vec_id AS q_id, t.vec_id AS t_id, t.y, list_distance(CAST(q.v AS DOUBLE[]), CAST(t.v AS DOUBLE[])) AS d FROM e q, train t),
nearest AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY d, t_id) AS r FROM pairs QUALIFY r <= 5)
SELECT q_id AS vec_id, count(*) AS neighbours, CAST(sum(t_id) AS BIGINT) AS neighbour_sum,
  round(CASE WHEN min(d) = 0 THEN avg(y) FILTER (WHERE d = 0) ELSE sum(y / d) FILTER (WHERE d > 0) / sum(1 / d) FILTER (WHERE d > 0) END, 6) AS prediction
FROM nearest GROUP BY q_id""")
def knn_regression(spark, sf_dir):
    """For every vector the five nearest of the training vectors and their label mean weighted by 1 / distance."""
    vectors = table(spark, sf_dir, "embeddings")
    fit_rows, _ = split_by_hash(vectors, ["vec_id"])
    vector = F.col("embedding").cast("array<double>")
    found = nearest_neighbours(build_index(fit_rows, "vec_id", "label", vector), vectors, "vec_id", vector)
    facts = found.groupBy("q_id").agg(F.count(F.lit(1)).alias("neighbours"), F.sum("t_id").alias("neighbour_sum"))
    return facts.join(weighted_mean(found), "q_id").select(
        F.col("q_id").alias("vec_id"), "neighbours", "neighbour_sum", F.round("prediction", 6).alias("prediction")
    )


@query(f"""{FACTS_SQL}, {_knn_sql()} SELECT 'baseline_knn_plain' AS key, count(*) AS n, round(avg(abs(balance - predicted_price)), 4) AS mae,
  round(sqrt(avg(pow(balance - predicted_price, 2))), 4) AS rmse, round(1 - avg(pow(balance - predicted_price, 2)) / var_pop(balance), 6) AS r2
FROM predicted JOIN test_rows USING (c_custkey)""")
def train_baseline_knn(spark, sf_dir):
    """The whole training job with the neighbour baseline alone, saved, loaded and scored."""
    out = work_dir(spark, "training")
    train_baseline(_facts(spark, sf_dir), nations(spark, sf_dir), ACCOUNTS, out, params=TrainingParams(reference_year=ACCOUNTS.reference_year))
    model = load_model(spark, f"{out}/best_model")
    scored = model.transform(_split_features(spark, sf_dir)[1])
    found = regression_metrics(scored, "balance", "prediction")
    return found.select(
        F.lit("baseline_knn_plain").alias("key"), "n", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2")
    )


# --- tree models: no SQL equivalent ------------------------------------------------------------------------------

@query()
def train_compare(spark, sf_dir):
    """All four candidates on the same rows, one metric row each."""
    params = TrainingParams(
        reference_year=ACCOUNTS.reference_year,
        candidates=(KNN, *TREES.values()),
    )
    found = train(_facts(spark, sf_dir), nations(spark, sf_dir), ACCOUNTS, work_dir(spark, "training"), params)
    return found.rows.drop("run_id", "model_path")


@query()
def cv_rmse(spark, sf_dir):
    """M8: cross-validated RMSE per fold."""
    fit_rows, _ = _split_features(spark, sf_dir)
    return cross_validated_rmse(fit_rows, TREES["random_forest"], ACCOUNTS, 3)


def _tree_scores(spark, sf_dir, name):
    fit_rows, test_rows = _split_features(spark, sf_dir)
    model = fit_contract_model(fit_rows, TREES[name], ACCOUNTS)
    return regression_metrics(model.transform(test_rows), "balance", "prediction")


@query()
def train_score_rf(spark, sf_dir):
    """M6."""
    return _tree_scores(spark, sf_dir, "random_forest")


@query()
def train_score_gbt(spark, sf_dir):
    """M5."""
    return _tree_scores(spark, sf_dir, "hist_gradient_boosting")


@query()
def train_score_extra(spark, sf_dir):
    """M7, an approximation."""
    return _tree_scores(spark, sf_dir, "extra_trees")


@query()
def model_importance(spark, sf_dir):
    """M11 on a fitted forest."""
    fit_rows, test_rows = _split_features(spark, sf_dir)
    model = fit_contract_model(fit_rows, TREES["random_forest"], ACCOUNTS)
    return importance_of(test_rows, model.transform, list(ACCOUNTS.final), "balance", ["c_custkey"])


@query()
def feature_ablation(spark, sf_dir):
    """One forest without and with the nation's columns."""
    fit_rows, test_rows = _split_features(spark, sf_dir)
    base = (*ACCOUNTS.numeric, *ACCOUNTS.engineered)
    scenarios = {
        "without": (base, ("c_mktsegment",)),
        "with": ((*base, *ACCOUNTS.attributes), ACCOUNTS.categorical),
    }
    return ablate(fit_rows, test_rows, scenarios, TREES["random_forest"], "balance", "c_custkey")


# --- the same estimators where their answer is known: flags that a tree can tell apart completely ------------------

FLAG_SQL = "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1e0 ELSE 0e0 END"
RICH_SQL = "CASE WHEN total_price > 2000000 THEN 1e0 ELSE 0e0 END"


def _flagged(spark, sf_dir):
    flags = {"flag": F.expr(FLAG_SQL.replace("e0", "D")), "rich": F.expr(RICH_SQL.replace("e0", "D"))}
    return tuple(side.withColumns(flags) for side in _split_features(spark, sf_dir))


def _group_means(spark, sf_dir, name):
    fit_rows, test_rows = _flagged(spark, sf_dir)
    model = fit_model(fit_rows, Candidate(name, "log1p", {"bootstrap": False} if name == "random_forest" else {}), ["flag"], [], "total_price", "c_custkey")
    return model.transform(test_rows).select("c_custkey", F.round("prediction", 2).alias("prediction"))


def _group_means_sql(condition: str = "true") -> str:
    return f"""{FACTS_SQL}, means AS (SELECT {FLAG_SQL} AS flag, exp(avg(ln(1 + total_price))) - 1 AS m FROM train WHERE {condition} GROUP BY 1)
SELECT c_custkey, round(m, 2) AS prediction FROM test_rows JOIN means ON flag = {FLAG_SQL}"""


@query(_group_means_sql())
def forest_group_means(spark, sf_dir):
    """M6, M3: a forest of the declared size and depth on one flag, without resampling, of a log1p target: group means."""
    return _group_means(spark, sf_dir, "random_forest")


@query(_group_means_sql())
def extra_trees_group_means(spark, sf_dir):
    """M7, M3: random cut points between the two values of the flag; the declared settings."""
    return _group_means(spark, sf_dir, "extra_trees")


@query(_group_means_sql(f"NOT {in_share_sql('c_custkey', 0.1, 43)}"))
def boosting_group_means(spark, sf_dir):
    """M5, M3: 500 rounds allowed, none gains after the first, so the ensemble is cut there; a tenth of the rows only decides that."""
    return _group_means(spark, sf_dir, "hist_gradient_boosting")


FULL_TREES = Candidate("random_forest", "plain", {"bootstrap": False, "numTrees": 5})


@query(f"""{FACTS_SQL}, folded AS (SELECT *, {FLAG_SQL} AS flag, CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 3 AS INTEGER) AS fold FROM train),
means AS (SELECT f.fold, t.flag, avg(t.balance) AS m FROM (SELECT DISTINCT fold FROM folded) f JOIN folded t ON t.fold <> f.fold GROUP BY 1, 2)
SELECT fold, count(*) AS n, round(sqrt(avg(pow(balance - m, 2))), 6) AS rmse FROM folded JOIN means USING (fold, flag) GROUP BY fold""")
def cv_group_means(spark, sf_dir):
    """M8: the folds and their errors, each predicted by the group means of the others."""
    fit_rows, _ = _flagged(spark, sf_dir)
    found = cross_validated(fit_rows, lambda rows: fit_model(rows, FULL_TREES, ["flag"], [], "balance", "c_custkey"), "c_custkey", "balance", 3)
    return found.withColumn("rmse", F.round("rmse", 6))


def _ablation_sql() -> str:
    def scored(name: str, keys: str) -> str:
        on = " AND ".join(f"{x} = m.k{i}" for i, x in enumerate(keys.split(" | ")))
        cells = ", ".join(f"{x} AS k{i}" for i, x in enumerate(keys.split(" | ")))
        groups = ", ".join(str(i + 1) for i in range(len(keys.split(" | "))))
        return f"""SELECT '{name}' AS scenario, t.balance AS y, m.p FROM test_rows t JOIN (SELECT {cells}, avg(balance) AS p FROM train GROUP BY {groups}) m ON {on}"""

    return f"""{FACTS_SQL}, scored AS ({scored('flag', FLAG_SQL)} UNION ALL {scored('both', FLAG_SQL + ' | ' + RICH_SQL)}),
rows_ AS (SELECT scenario, avg(abs(y - p)) AS mae, sqrt(avg(pow(y - p, 2))) AS rmse, 1 - avg(pow(y - p, 2)) / var_pop(y) AS r2 FROM scored GROUP BY scenario)
SELECT r.scenario, round(r.mae, 6) AS mae, round(r.rmse, 6) AS rmse, round(r.r2, 6) AS r2, round(b.mae - r.mae, 6) AS mae_improvement,
  round(b.rmse - r.rmse, 6) AS rmse_improvement, round(r.r2 - b.r2, 6) AS r2_gain FROM rows_ r, (SELECT * FROM rows_ WHERE scenario = 'flag') b"""


@query(_ablation_sql())
def ablation_group_means(spark, sf_dir):
    """One flag against two, where a full tree predicts the means of the groups."""
    fit_rows, test_rows = _flagged(spark, sf_dir)
    found = ablate(fit_rows, test_rows, {"flag": (["flag"], []), "both": (["flag", "rich"], [])}, FULL_TREES, "balance", "c_custkey")
    figures = ("mae", "rmse", "r2", "mae_improvement", "rmse_improvement", "r2_gain")
    return found.select("scenario", *(F.round(c, 6).alias(c) for c in figures))


OTHER_SPLIT = FACTS_SQL.replace(in_share_sql("c_custkey", 0.2, 42), in_share_sql("c_custkey", 0.3, 7))


@query(f"""{OTHER_SPLIT}, {_knn_sql()} SELECT 'baseline_knn_plain' AS key, true AS best, round(avg(abs(balance - predicted_price)), 4) AS mae,
  round(sqrt(avg(pow(balance - predicted_price, 2))), 4) AS rmse, 0.3 AS test_size, 7 AS random_state, 'accounts' AS contract, 'balance' AS target,
  {len(ACCOUNTS.final)} AS n_features, '{",".join(ACCOUNTS.final)}' AS features FROM predicted JOIN test_rows USING (c_custkey)""")
def training_artifacts(spark, sf_dir):
    """A training job whose parameters come from a JSON text; its comparison, parameters and contract read back."""
    base = work_dir(spark, "training")
    settings = {"training": {"test_size": 0.3, "random_state": 7, "reference_year": ACCOUNTS.reference_year, "models": [{"name": "baseline_knn"}]}}
    spark.createDataFrame([(json.dumps(settings),)], "value string").write.text(f"{base}/given")
    train(_facts(spark, sf_dir), nations(spark, sf_dir), ACCOUNTS, f"{base}/out", read_params(spark, f"{base}/given"))
    params, contract = read_params(spark, f"{base}/out/params"), read_contract(spark, f"{base}/out/contract")
    return read_comparison(spark, f"{base}/out").select(
        "key", "best", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"), F.lit(params.test_size).alias("test_size"),
        F.lit(params.random_state).alias("random_state"), F.lit(contract.name).alias("contract"), F.lit(contract.target).alias("target"),
        F.lit(len(contract.final)).alias("n_features"), F.lit(",".join(contract.final)).alias("features"),
    )


@query(f"""{FACTS_SQL} SELECT c_custkey, round(2e0 * (CASE WHEN c_mktsegment IN (SELECT c_mktsegment FROM train) THEN 1 ELSE 0 END)
  + (CASE WHEN nation IN (SELECT nation FROM train) THEN 1 ELSE 0 END), 1) AS hot FROM test_rows""")
def one_hot_stages(spark, sf_dir):
    """M2, M3 as ML stages: how many indicator columns are set, weighted 2 and 1; none for unseen values."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    fit_rows, test_rows = _split_features(spark, sf_dir)
    prep = fit_preprocessing(fit_rows, [], ACCOUNTS.categorical)
    coded = Pipeline(stages=preprocessing_stages(prep)).fit(fit_rows).transform(test_rows)

    def ones(c):
        return F.aggregate(vector_to_array(c), F.lit(0.0), lambda a, x: a + x)

    return coded.select("c_custkey", F.round(2.0 * ones("c_mktsegment__hot") + ones("nation__hot"), 1).alias("hot"))


RUNS_SQL = f"""{FACTS_SQL}, runs AS (SELECT c_mktsegment AS key, count(*) AS n, avg(abs(balance - total_price / 100)) AS mae FROM features GROUP BY 1)"""


@query(f"""{RUNS_SQL} SELECT key, n, round(mae, 4) AS mae, CAST(row_number() OVER (ORDER BY key) AS INTEGER) AS version FROM runs""")
def run_log(spark, sf_dir):
    """A run and a registered version per market segment, read back from the tables."""
    base = work_dir(spark, "registry")
    scored = _facts(spark, sf_dir).withColumn("predicted_price", F.col("total_price") / 100)
    rows = regression_metrics(scored, "balance", "predicted_price", ["c_mktsegment"]).orderBy("c_mktsegment").collect()
    for r in rows:  # one row per market segment
        run_id = registry.log_run(spark, base, "balance", r["c_mktsegment"], {"n": r["n"]}, {"mae": r["mae"]})
        registry.register_model(spark, base, "balance", "none", run_id, {"mae": r["mae"]})
    runs, versions = registry.runs(spark, base), registry.versions(spark, base)
    return runs.join(versions.select("run_id", "version"), "run_id").select(
        "key", F.col("params")["n"].cast("long").alias("n"), F.round(F.col("metrics")["mae"], 4).alias("mae"), "version"
    )
