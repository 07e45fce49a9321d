"""Queries on distributions and metrics: quantiles, PSI, KS, drift reports, regression metrics, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugemill.catalog.tables import LISTING, LISTING_SQL, accounts, listing, nations, parts, table
from gaugemill.catalog.tables import ACCOUNTS, ACCOUNTS_SQL
from gaugemill.functions.numeric import log_target, unlog_prediction
from gaugemill.operators import drift, selection, stats
from gaugemill.operators.enrich import enrich
from gaugemill.plans.importance import permutation_importance as importance_of
from gaugemill.plans.models import fit_preprocessing
from gaugemill.plans.monitoring import monitor
from gaugemill.plans.monitoring import monitoring_job as run_monitoring
from gaugemill.plans import registry
from gaugemill.session import work_dir
from gaugemill.sources.readers import RawTables
from gaugemill.sources.reports import read_reports, report_summary
from gaugemill.sources.writers import write_rows

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


# --- two sides of the order lines: shipped before and from 2000 on ----------------------------------------------

DRIFT_COLUMNS = ["quantity", "price", "discount", "tax", "grown_price"]


def sides(spark, sf_dir):
    """Both sides out of one scan; ``grown_price`` drifts with the year, ``tax`` has gaps."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        (F.col("l_shipdate") < F.expr("timestamp_ntz'2000-01-01'")).alias("is_ref"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
        F.when(F.col("l_linenumber") != 3, F.col("l_tax")).alias("tax"),
        (F.col("l_extendedprice") * (F.year("l_shipdate") - 1990)).alias("grown_price"),
    )


def long_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, is_ref, {c} AS v FROM {source} WHERE {c} IS NOT NULL" for c in columns)


SIDES_SQL = f"""
sides AS (SELECT l_shipdate < TIMESTAMP '2000-01-01' AS is_ref, l_quantity AS quantity, l_extendedprice AS price,
    l_discount AS discount, CASE WHEN l_linenumber <> 3 THEN l_tax END AS tax,
    l_extendedprice * (year(l_shipdate) - 1990) AS grown_price FROM lineitem),
long AS ({long_sql(DRIFT_COLUMNS, 'sides')})"""

SIZES_SQL = """
sizes AS (SELECT feature, count(*) FILTER (WHERE is_ref) AS n_reference, count(*) FILTER (WHERE NOT is_ref) AS n_current
  FROM long GROUP BY feature)"""

KS_SQL = """
value_counts AS (SELECT feature, v, count(*) FILTER (WHERE is_ref) AS r, count(*) FILTER (WHERE NOT is_ref) AS c FROM long GROUP BY feature, v),
running AS (SELECT feature, sum(r) OVER w AS r, sum(c) OVER w AS c FROM value_counts WINDOW w AS (PARTITION BY feature ORDER BY v)),
ks AS (SELECT feature, max(abs(r / n_reference - c / n_current)) AS d, any_value(n_reference) AS n1, any_value(n_current) AS n2
  FROM running JOIN sizes USING (feature) GROUP BY feature)"""


def _theta_sql(power: int, half: float) -> str:
    start = 0 if half else 1
    x = f"pow(pi() * (k + {half}e0), 2)"
    return f"list_sum(list_transform(range({start}, {start + 10}), lambda k: 2e0 * pow({x}, {power}) * exp(-{x} / (2e0 * z * z))))"


# Pelz-Good series; from n d² = 2.2 on twice the one-sided sum less the share of both sides
PVALUE_SQL = f"""
sized AS (SELECT *, round_even(CAST(n1 AS DOUBLE) * n2 / (n1 + n2), 0) AS n FROM ks),
scaled AS (SELECT *, greatest(sqrt(n) * d, 0.1e0) AS z, sqrt(pi() / 2) AS c FROM sized),
sums AS (SELECT *, {', '.join(f'{_theta_sql(p, 0.5)} AS s{p}' for p in range(4))},
  {', '.join(f'{_theta_sql(p, 0.0)} AS t{p}' for p in (1, 2))} FROM scaled),
pvalues AS (SELECT feature, n1, n2, d, least(1e0, greatest(0e0,
  CASE WHEN n * d * d < 2.2 THEN 1 - (
      c / z * s0 + c / (6 * pow(z, 4)) * (s1 - z * z * s0) / sqrt(n)
      + (c / (72 * pow(z, 7)) * ((6 * pow(z, 6) + 2 * pow(z, 4)) * s0 + (2 * pow(z, 4) - 5 * z * z) * s1 + (1 - 2 * z * z) * s2)
         - c / (36 * pow(z, 3)) * t1) / n
      + (c / (6480 * pow(z, 10)) * ((5 - 30 * z * z) * s3 + (212 * pow(z, 4) - 60 * z * z) * s2
         + (135 * pow(z, 4) - 96 * pow(z, 6)) * s1 - (30 * pow(z, 6) + 90 * pow(z, 8)) * s0)
         + c / (108 * pow(z, 6)) * (3 * z * z * t1 - t2)) / (n * sqrt(n)))
    ELSE 2 * d * list_sum(list_transform(range(0, CAST(floor(n * (1 - d)) AS BIGINT) + 1), lambda j: CASE WHEN 1 - d - j / n <= 0 THEN 0e0
      ELSE exp(lgamma(n + 1) - lgamma(j + 1e0) - lgamma(n - j + 1) + (j - 1) * ln(d + j / n) + (n - j) * ln(1 - d - j / n)) END)) - 2 * exp(-8 * n * d * d) END)) AS p FROM sums)"""

EDGES_SQL = """
sorted AS (SELECT feature, list_sort(list(v)) AS a, count(*) AS n FROM long WHERE is_ref GROUP BY feature),
ranks AS (SELECT feature, n, a, i, (n - 1) * (CASE WHEN i = 10 THEN 1e0 ELSE i * 0.1e0 END) AS h FROM sorted, (SELECT unnest(range(0, 11)) AS i)),
ends AS (SELECT feature, n, i, h - floor(h) AS g, a[CAST(floor(h) AS BIGINT) + 1] AS lo, a[CAST(ceil(h) AS BIGINT) + 1] AS hi FROM ranks),
edges AS (SELECT feature, any_value(n) AS n, list_sort(list_distinct(list(
    CASE WHEN g >= 0.5 THEN hi - (hi - lo) * (1 - g) ELSE lo + (hi - lo) * g END))) AS e FROM ends GROUP BY feature)"""

HISTOGRAM_SQL = """
grid AS (SELECT feature, unnest(range(0, len(e) - 1)) AS bin, e FROM edges),
placed AS (SELECT feature, least(len(list_filter(e, lambda x: x <= v)), len(e) - 1) - 1 AS bin, is_ref
  FROM long JOIN edges USING (feature) WHERE v BETWEEN e[1] AND e[len(e)]),
histogram AS (SELECT feature, grid.bin, e[grid.bin + 1] AS lower, e[grid.bin + 2] AS upper,
    count(*) FILTER (WHERE is_ref) AS n_ref, count(*) FILTER (WHERE NOT is_ref) AS n_cur
  FROM grid LEFT JOIN placed USING (feature, bin) GROUP BY feature, grid.bin, e)"""

PSI_SQL = """
shares AS (SELECT feature, n_ref / greatest(sum(n_ref) OVER w, 1) AS x, n_cur / greatest(sum(n_cur) OVER w, 1) AS y
  FROM histogram WINDOW w AS (PARTITION BY feature)),
psi AS (SELECT feature, coalesce(sum((y - x) * ln((y + 1e-6) / (x + 1e-6))), 0) AS psi FROM edges LEFT JOIN shares USING (feature) GROUP BY feature)"""

DRIFT_SQL = f"""WITH {SIDES_SQL}, {SIZES_SQL}, {KS_SQL}, {PVALUE_SQL}, {EDGES_SQL}, {HISTOGRAM_SQL}, {PSI_SQL},
report AS (SELECT feature, d, p, psi, p < 0.01 OR psi > 0.25 AS drift,
  CASE WHEN p < 0.01 AND psi > 0.25 THEN 'ks_pvalue<0.01 and psi>0.25' WHEN p < 0.01 THEN 'ks_pvalue<0.01'
    WHEN psi > 0.25 THEN 'psi>0.25' ELSE 'none' END AS drift_reason, n1 AS n_reference, n2 AS n_current
  FROM pvalues JOIN psi USING (feature))"""


@query(f"""WITH {SIDES_SQL}, {EDGES_SQL}
SELECT feature, n, CAST(place AS INTEGER) AS position, round(e[place + 1], 6) AS edge FROM (SELECT feature, n, e, unnest(range(0, len(e))) AS place FROM edges)""")
def quantile_grid(spark, sf_dir):
    """Distinct deciles of the reference side."""
    ref = sides(spark, sf_dir).filter("is_ref")
    found = drift.quantile_grid(ref, DRIFT_COLUMNS)
    return found.select("feature", "n", F.posexplode("edges").alias("position", "edge")).withColumn("edge", F.round("edge", 6))


@query(f"""WITH {SIDES_SQL}, {EDGES_SQL}, {HISTOGRAM_SQL}
SELECT feature, CAST(bin AS INTEGER) AS bin, round(lower, 6) AS lower, round(upper, 6) AS upper, n_ref, n_cur FROM histogram""")
def histogram_bins(spark, sf_dir):
    """Both sides counted over the reference deciles, values outside dropped."""
    both = drift.tagged_sides(None, None, DRIFT_COLUMNS, sides=sides(spark, sf_dir))
    profile = drift.rank_profile(None, None, DRIFT_COLUMNS, drift.bin_probabilities(), False, sides=both)
    counts = drift.full_histogram(both, drift.collect_edges(profile))
    return counts.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query(f"""WITH {SIDES_SQL}, {SIZES_SQL}, {EDGES_SQL}, {HISTOGRAM_SQL}, {PSI_SQL}
SELECT feature, n_reference, n_current, round(psi, 6) AS psi FROM psi JOIN sizes USING (feature)""")
def psi(spark, sf_dir):
    """A8."""
    return drift.psi(None, None, DRIFT_COLUMNS, sides=sides(spark, sf_dir)).withColumn("psi", F.round("psi", 6))


@query(f"WITH {SIDES_SQL}, {SIZES_SQL}, {KS_SQL} SELECT feature, n1 AS n_reference, n2 AS n_current, round(d, 9) AS ks_statistic FROM ks")
def ks_statistic(spark, sf_dir):
    """A9."""
    found = drift.rank_profile(None, None, DRIFT_COLUMNS, (), True, sides=sides(spark, sf_dir))
    return found.select("feature", "n_reference", "n_current", F.round("ks_statistic", 9).alias("ks_statistic"))


@query(f"""WITH {SIDES_SQL}, {SIZES_SQL}, {KS_SQL}, {PVALUE_SQL}
SELECT feature, round(d, 9) AS ks_statistic, round(p, 6) AS ks_pvalue FROM pvalues""")
def ks_pvalue(spark, sf_dir):
    """A10."""
    found = drift.ks(None, None, DRIFT_COLUMNS, sides=sides(spark, sf_dir))
    return found.select("feature", F.round("ks_statistic", 9).alias("ks_statistic"), F.round("ks_pvalue", 6).alias("ks_pvalue"))


@query(f"""{DRIFT_SQL}
SELECT feature, false AS skipped, 'none' AS reason, round(d, 9) AS ks_statistic, round(p, 6) AS ks_pvalue, round(psi, 6) AS psi,
  drift, drift_reason, n_reference, n_current FROM report
UNION ALL SELECT 'weight', true, 'missing_in_one_frame', -1, -1, -1, false, 'none', -1, -1""")
def data_drift(spark, sf_dir):
    """All features of the order lines in one report; a feature that is not there is skipped."""
    report = drift.data_drift(None, None, [*DRIFT_COLUMNS, "weight"], sides=sides(spark, sf_dir))
    report = report.withColumns({"ks_statistic": F.round("ks_statistic", 9)} | {c: F.round(c, 6) for c in ("ks_pvalue", "psi")})
    filled = report.fillna("none", ["reason", "drift_reason"]).fillna(False, ["drift"]).fillna(-1)
    return filled.drop("seq")


@query(f"""{DRIFT_SQL}
SELECT count(*) AS n_features_evaluated, count(*) FILTER (WHERE drift) AS n_features_drift_flagged, bool_or(drift) AS drift,
  0.01e0 AS ks_pvalue_threshold, 0.25e0 AS psi_alert_threshold FROM report""")
def data_drift_summary(spark, sf_dir):
    """A12."""
    return drift.drift_summary(drift.data_drift(None, None, DRIFT_COLUMNS, sides=sides(spark, sf_dir)))


def _scored_lines(spark, sf_dir):
    """Order lines with a price estimated as quantity times retail price; no estimate without a part."""
    merged = enrich(listing(spark, sf_dir), parts(spark, sf_dir), "part_key")
    return merged.withColumn("predicted_price", F.col("quantity") * F.col("p_retailprice"))


SCORED_SQL = f"""WITH {LISTING_SQL},
scored AS (SELECT l.*, p_size, p_retailprice, quantity * p_retailprice AS predicted_price FROM listing l LEFT JOIN parts p USING (part_key))"""
PREDICTION_KS = f"""
long AS (SELECT 'v' AS feature, true AS is_ref, price AS v FROM scored UNION ALL
  SELECT 'v', false, predicted_price FROM scored WHERE predicted_price IS NOT NULL), {SIZES_SQL}, {KS_SQL}, {PVALUE_SQL},
moments AS (SELECT avg(price) AS bm, stddev_pop(price) AS bs, avg(predicted_price) AS cm, stddev_pop(predicted_price) AS cs FROM scored),
shift AS (SELECT *, abs(cm - bm) / (abs(bm) + 1e-9) AS rel FROM moments)"""
PREDICTION_REASON = """CASE WHEN p < 0.01 AND rel > 0.25 THEN 'ks_pvalue<0.01; mean_shift>0.25' WHEN p < 0.01 THEN 'ks_pvalue<0.01'
    WHEN rel > 0.25 THEN 'mean_shift>0.25' ELSE 'none' END"""


@query(f"""{SCORED_SQL}, {PREDICTION_KS}
SELECT false AS skipped, round(bm, 4) AS baseline_mean, round(bs, 4) AS baseline_std, round(cm, 4) AS current_mean, round(cs, 4) AS current_std,
  round(rel, 6) AS relative_mean_shift, round(d, 9) AS ks_statistic, round(p, 6) AS ks_pvalue, p < 0.01 OR rel > 0.25 AS drift,
  {PREDICTION_REASON} AS drift_reason, n1 AS n_baseline, n2 AS n_current FROM pvalues, shift""")
def prediction_drift(spark, sf_dir):
    """Estimated prices against actual ones."""
    # both values of a line out of one scan and join
    pair = F.array(F.struct(F.lit(True).alias("is_ref"), F.col("price").alias("v")), F.struct(F.lit(False).alias("is_ref"), F.col("predicted_price").alias("v")))
    found = drift.prediction_drift(None, None, sides=_scored_lines(spark, sf_dir).select(F.inline(pair)))
    rounded = {c: F.round(c, 4) for c in ("baseline_mean", "baseline_std", "current_mean", "current_std")}
    rounded |= {"relative_mean_shift": F.round("relative_mean_shift", 6), "ks_statistic": F.round("ks_statistic", 9), "ks_pvalue": F.round("ks_pvalue", 6)}
    return found.withColumns(rounded).drop("reason")


# --- metrics ----------------------------------------------------------------------------------------------------

METRICS_SQL = """count(*) AS n, avg(abs(price - predicted_price)) AS mae, avg(pow(price - predicted_price, 2)) AS mse,
  sqrt(avg(pow(price - predicted_price, 2))) AS rmse, 1 - avg(pow(price - predicted_price, 2)) / var_pop(price) AS r2"""
ROUNDED_METRICS = "n, round(mae, 4) AS mae, round(mse, 2) AS mse, round(rmse, 4) AS rmse, round(r2, 6) AS r2"


def _rounded(df):
    return df.withColumns({"mae": F.round("mae", 4), "rmse": F.round("rmse", 4), "r2": F.round("r2", 6)} | (
        {"mse": F.round("mse", 2)} if "mse" in df.columns else {}))


@query(f"""{SCORED_SQL} SELECT l_returnflag, {ROUNDED_METRICS} FROM (SELECT l_returnflag, {METRICS_SQL} FROM scored
WHERE predicted_price IS NOT NULL GROUP BY l_returnflag)""")
def regression_metrics(spark, sf_dir):
    """Per return flag, pairs without an estimate left out."""
    return _rounded(stats.regression_metrics(_scored_lines(spark, sf_dir), "price", "predicted_price", ["l_returnflag"]))


@query(f"""{SCORED_SQL}, p AS (SELECT * FROM scored WHERE predicted_price IS NOT NULL),
m AS (SELECT sum(quantity * price) / sum(quantity) AS mean FROM p)
SELECT count(*) AS n, round(sum(quantity * abs(price - predicted_price)) / sum(quantity), 4) AS mae,
  round(sum(quantity * pow(price - predicted_price, 2)) / sum(quantity), 2) AS mse,
  round(sqrt(sum(quantity * pow(price - predicted_price, 2)) / sum(quantity)), 4) AS rmse,
  round(1 - sum(quantity * pow(price - predicted_price, 2)) / sum(quantity * pow(price - mean, 2)), 6) AS r2 FROM p, m""")
def regression_metrics_weighted(spark, sf_dir):
    """A1 with sample weights."""
    return _rounded(stats.regression_metrics(_scored_lines(spark, sf_dir), "price", "predicted_price", weight="quantity"))


@query(f"""{SCORED_SQL} SELECT round(avg(abs(y - q)), 8) AS mae, round(sqrt(avg(pow(y - q, 2))), 8) AS rmse, round(avg(back), 4) AS mean_back
FROM (SELECT ln(1 + price) AS y, ln(1 + predicted_price) AS q, exp(ln(1 + predicted_price)) - 1 AS back FROM scored WHERE predicted_price IS NOT NULL)""")
def log_target_metrics(spark, sf_dir):
    """metrics on the log1p scale, and the mean estimate after the way back."""
    scored = _scored_lines(spark, sf_dir).select(
        log_target(F.col("price"), "log1p").alias("y_true"), log_target(F.col("predicted_price"), "log1p").alias("y_pred")
    )
    found = scored.filter("y_pred is not null").agg(
        *(c.alias(k) for k, c in stats.metric_columns(F.col("y_true"), F.col("y_pred")).items()),
        F.round(F.avg(unlog_prediction(F.col("y_pred"), "log1p")), 4).alias("mean_back"),
    )
    return found.select(F.round("mae", 8).alias("mae"), F.round("rmse", 8).alias("rmse"), "mean_back")


@query(f"""{SCORED_SQL} SELECT 'ok' AS status, n AS n_samples, round(mae, 4) AS mae, round(rmse, 4) AS rmse FROM
(SELECT {METRICS_SQL} FROM scored WHERE predicted_price IS NOT NULL)""")
def performance_report(spark, sf_dir):
    """Columns found by name."""
    found = stats.performance_report(_scored_lines(spark, sf_dir))
    return found.select("status", "n_samples", F.round("mae", 4).alias("mae"), F.round("rmse", 4).alias("rmse"))


@query(f"""{SCORED_SQL} SELECT count(predicted_price) AS n, round(avg(predicted_price), 4) AS mean, round(stddev_samp(predicted_price), 4) AS std,
  round(min(predicted_price), 4) AS min, round(max(predicted_price), 4) AS max FROM scored""")
def prediction_summary(spark, sf_dir):
    """A3."""
    found = stats.prediction_summary(_scored_lines(spark, sf_dir), "predicted_price")
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "std", "min", "max")})


@query(f"""WITH {LISTING_SQL}, s AS (SELECT 'price' AS "column", avg(price) AS mean, stddev_samp(price) AS std FROM listing
  UNION ALL SELECT 'quantity', avg(quantity), stddev_samp(quantity) FROM listing UNION ALL SELECT 'tax', avg(tax), stddev_samp(tax) FROM listing)
SELECT "column", round(mean, 5) AS mean, round(std, 5) AS std FROM s""")
def baseline_stats(spark, sf_dir):
    """An absent column is left out."""
    found = stats.baseline_stats(listing(spark, sf_dir), ["price", "quantity", "tax", "weight"])
    return found.withColumns({c: F.round(c, 5) for c in ("mean", "std")})


SCALED = ["quantity", "discount", "tax", "price"]
FILLED_SQL = f"""WITH {LISTING_SQL}, med AS (SELECT {', '.join(f'median({c}) AS {c}' for c in SCALED)} FROM listing),
filled AS (SELECT l_orderkey, l_linenumber, {', '.join(f'coalesce(l.{c}, med.{c}) AS {c}' for c in SCALED)} FROM listing l, med)"""


@query(FILLED_SQL + "".join(
    f"{' SELECT' if i == 0 else ' UNION ALL SELECT'} '{c}' AS feature, round((SELECT {c} FROM med), 6) AS median, round(avg({c}), 5) AS mean, round(stddev_pop({c}), 5) AS std FROM filled"
    for i, c in enumerate(SCALED)))
def scaling_stats(spark, sf_dir):
    """A5: medians, and moments after filling with them."""
    found = stats.scaling_stats(listing(spark, sf_dir), SCALED)
    return found.withColumns({c: F.round(c, 6 if c == "median" else 5) for c in ("median", "mean", "std")})


@query(f"""{FILLED_SQL}, m AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in SCALED)} FROM filled)
SELECT l_orderkey, l_linenumber, {', '.join(f'round(({c} - {c}_m) / {c}_s, 7) AS {c}' for c in SCALED)} FROM filled, m""")
def impute_scale(spark, sf_dir):
    """M1: filled and standardized order lines; NaN is missing like NULL."""
    lines = listing(spark, sf_dir).withColumn("tax", F.coalesce("tax", F.lit(float("nan"))))
    prep = fit_preprocessing(lines, SCALED, [])
    return lines.select("l_orderkey", "l_linenumber", *(F.round(F.expr(prep.scaled(c)), 7).alias(c) for c in SCALED))


FLAGS = [("l_returnflag", v) for v in "ANR"] + [("l_linestatus", v) for v in "FO"]


@query(f"""WITH {LISTING_SQL} SELECT l_orderkey, l_linenumber,
{', '.join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}" for c, v in FLAGS)} FROM listing""")
def one_hot(spark, sf_dir):
    """M2: a 0/1 column per fitted category."""
    lines = listing(spark, sf_dir)
    prep = fit_preprocessing(lines, [], ["l_returnflag", "l_linestatus"])
    return lines.select("l_orderkey", "l_linenumber", *(col for c in prep.categorical for col in prep.one_hot(c)))


# --- choosing ---------------------------------------------------------------------------------------------------

ESTIMATES = {"by_retail": "quantity * p_retailprice", "by_size": "quantity * (1000e0 + p_size)", "flat": "25e0 * 1000e0"}


def _candidates(spark, sf_dir):
    """Metric rows of three closed-form price estimates, from one scan."""
    merged = enrich(listing(spark, sf_dir), parts(spark, sf_dir), "part_key", "inner")
    rows = F.array(*(
        F.struct(F.lit(i).alias("position"), F.lit(k).alias("scenario"), F.expr(e).cast("double").alias("predicted_price"))
        for i, (k, e) in enumerate(ESTIMATES.items())
    ))
    long = merged.select("price", F.inline(rows))
    return stats.regression_metrics(long, "price", "predicted_price", ["position", "scenario"])


CANDIDATES_SQL = f"""WITH {LISTING_SQL}, j AS (SELECT * FROM listing JOIN parts USING (part_key)),
long AS ({' UNION ALL '.join(f"SELECT {i} AS position, '{k}' AS scenario, price, {e} AS predicted_price FROM j" for i, (k, e) in enumerate(ESTIMATES.items()))}),
candidates AS (SELECT position, scenario, {METRICS_SQL} FROM long GROUP BY position, scenario)"""


@query(f"{CANDIDATES_SQL} SELECT position, scenario, {ROUNDED_METRICS} FROM candidates ORDER BY rmse, mae, r2 DESC, position LIMIT 1")
def best_candidate(spark, sf_dir):
    """T1."""
    return _rounded(selection.best_candidate(_candidates(spark, sf_dir)))


@query(f"""{CANDIDATES_SQL}, base AS (SELECT * FROM candidates WHERE scenario = 'flat')
SELECT c.scenario, round(base.mae - c.mae, 4) AS mae_improvement, round(base.rmse - c.rmse, 4) AS rmse_improvement,
  round(c.r2 - base.r2, 6) AS r2_gain FROM candidates c, base""")
def ablation_deltas(spark, sf_dir):
    """A14."""
    found = selection.ablation_deltas(_candidates(spark, sf_dir), "flat")
    return found.select(
        "scenario", F.round("mae_improvement", 4).alias("mae_improvement"), F.round("rmse_improvement", 4).alias("rmse_improvement"),
        F.round("r2_gain", 6).alias("r2_gain"),
    )


IMPORTANCE_FEATURES = ["n_orders", "avg_price", "supplier_balance"]
ESTIMATE = "n_orders * 100e0 + avg_price / 50e0 + supplier_balance / 10e0"


def _estimate(df):
    return df.withColumn("prediction", F.expr(ESTIMATE.replace("e0", "D")))


def _importance(spark, sf_dir):
    facts = accounts(spark, sf_dir).fillna(0.0, ["n_orders", "avg_price"])
    merged = enrich(facts, nations(spark, sf_dir), "nation").fillna(0.0, ["supplier_balance"])
    return importance_of(merged, _estimate, IMPORTANCE_FEATURES, "balance", ["c_custkey"], repeats=5)


def _variant(changed: str) -> str:
    return ESTIMATE.replace(changed, f"b.{changed}") if changed else ESTIMATE


def _importance_sql() -> str:
    filled = ", ".join(f"coalesce({c}, 0e0) AS {c}" for c in IMPORTANCE_FEATURES)
    def draw(value: str, i: int) -> str:
        return f"CAST('0x' || substr(md5(CAST({value} AS VARCHAR) || ':{i}:' || CAST(seed AS VARCHAR)), 1, 8) AS BIGINT)"

    columns = ", ".join(f"a.{c}, b.{c} AS {c}__b" for c in IMPORTANCE_FEATURES)
    repeats = f"SELECT a.repeat, a.balance, {columns} FROM given a JOIN ranked b ON a.want = b.rk"
    permutation = f"""ranked AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(c_custkey AS VARCHAR) || ':0'), c_custkey) - 1 AS rk FROM f),
sizes AS (SELECT n, CAST(greatest(1, floor(sqrt(n))) AS BIGINT) AS top FROM (SELECT count(*) AS n FROM f)),
grid AS (SELECT n, a, (n + a - 1) // a AS b FROM sizes, range(1, 100001) r(a) WHERE a <= top AND a > greatest(0, top // 2 - 1, top - 1001) ORDER BY (n + a - 1) // a * a, a DESC LIMIT 1),
r0 AS (SELECT seed, x, x % a AS l, x // a AS r, a, b, n FROM grid, range(43, 48) s(seed), LATERAL (SELECT unnest(range(a * b)) AS x)),
r1 AS (SELECT * REPLACE ((l + {draw('r', 0)}) % a AS l) FROM r0), r2 AS (SELECT * REPLACE ((r + {draw('l', 1)}) % b AS r) FROM r1),
r3 AS (SELECT * REPLACE ((l + {draw('r', 2)}) % a AS l) FROM r2), r4 AS (SELECT * REPLACE ((r + {draw('l', 3)}) % b AS r) FROM r3),
pi AS (SELECT seed, x, l + a * r AS y, n FROM r4),
walk AS (SELECT seed, x AS start, y, n FROM pi WHERE x < n UNION ALL SELECT w.seed, w.start, p.y, w.n FROM walk w JOIN pi p ON w.seed = p.seed AND w.y = p.x WHERE w.y >= w.n),
given AS (SELECT w.seed - 43 AS repeat, w.y AS want, k.* FROM walk w JOIN ranked k ON k.rk = w.start WHERE w.y < w.n)"""
    maes = " UNION ALL ".join(
        f"SELECT repeat, '{c}' AS feature, avg(abs(balance - ({ESTIMATE.replace(c, c + '__b')}))) - avg(abs(balance - ({ESTIMATE}))) AS rise FROM dealt GROUP BY repeat"
        for c in IMPORTANCE_FEATURES
    )
    return f"""WITH RECURSIVE {ACCOUNTS_SQL}, f AS (SELECT c_custkey, balance, {filled} FROM accounts LEFT JOIN nations USING (nation)),
{permutation},
dealt AS ({repeats}), rises AS ({maes}),
importance AS (SELECT feature, avg(rise) AS importance_mean, stddev_pop(rise) AS importance_std FROM rises GROUP BY feature)"""


@query(f"{_importance_sql()} SELECT feature, round(importance_mean, 4) AS importance_mean, round(importance_std, 4) AS importance_std FROM importance")
def permutation_importance(spark, sf_dir):
    """Rise of the MAE of a closed-form estimate when a column is dealt out anew, five repeats."""
    return _importance(spark, sf_dir).withColumns({c: F.round(c, 4) for c in ("importance_mean", "importance_std")})


@query(f"{_importance_sql()} SELECT feature, round(importance_mean, 4) AS importance_mean FROM importance ORDER BY importance_mean DESC, feature LIMIT 2")
def importance_topk(spark, sf_dir):
    """T2."""
    top = selection.importance_topk(_importance(spark, sf_dir), 2, digits=4)
    return top.select("feature", "importance_mean")


# --- tables of runs and versions --------------------------------------------------------------------------------

YEARLY_SQL = f"""{SCORED_SQL},
yearly AS (SELECT l_returnflag AS name, CAST(made_year AS INTEGER) AS version, avg(abs(price - predicted_price)) AS mae, count(*) AS n
  FROM scored WHERE predicted_price IS NOT NULL GROUP BY 1, 2)"""


@query(f"{YEARLY_SQL} SELECT name, version, round(mae, 4) AS mae, n FROM yearly QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) = 1")
def latest_model(spark, sf_dir):
    """The newest version per name, versions being the yearly scores per return flag."""
    scored = _scored_lines(spark, sf_dir).withColumn("version", F.col("made_year").cast("int"))
    table_ = stats.regression_metrics(scored, "price", "predicted_price", ["l_returnflag", "version"])
    found = registry.latest_versions(table_.withColumnRenamed("l_returnflag", "name").select("name", "version", "mae", "n"))
    return found.withColumn("mae", F.round("mae", 4))


# --- the whole monitoring report --------------------------------------------------------------------------------

MONITORED = ["n_orders", "total_price", "max_price", "n_suppliers"]
MONITOR_SQL = f"""WITH {ACCOUNTS_SQL},
rich AS (SELECT a.* REPLACE (coalesce(n_orders, 0) AS n_orders, coalesce(total_price, 0) AS total_price), n_suppliers FROM accounts a LEFT JOIN nations USING (nation)),
sides AS (SELECT true AS is_ref, * FROM rich UNION ALL SELECT false, * FROM rich WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
long AS ({long_sql(MONITORED, 'sides')}), {SIZES_SQL}, {KS_SQL}, {EDGES_SQL}, {HISTOGRAM_SQL}, {PSI_SQL}
"""


@query(f"""{MONITOR_SQL}
SELECT '1.0' AS report_version, true AS ok, 0 AS n_errors, (SELECT count(*) FROM accounts) AS n_fact_rows, (SELECT count(*) FROM nations) AS n_dim_rows,
  (SELECT count(*) FROM psi) AS n_features_evaluated,
  (SELECT array_to_string(list(feature || ':' || CAST(round(d * 1e6) AS BIGINT) ORDER BY feature), ',') FROM ks) AS ks_millionths,
  (SELECT array_to_string(list(feature || ':' || CAST(round(psi * 1e6) AS BIGINT) ORDER BY feature), ',') FROM psi) AS psi_millionths,
  (SELECT round(avg(total_price / 100), 4) FROM rich) AS current_mean, (SELECT round(avg(balance), 4) FROM rich) AS baseline_mean,
  'ok' AS status, (SELECT count(*) FROM rich) AS n_samples, (SELECT round(avg(abs(balance - total_price / 100)), 4) FROM rich) AS mae""")
def monitoring_report(spark, sf_dir):
    """W5 on frames: all accounts against two market segments, estimates against balances, flattened."""
    facts, dim = accounts(spark, sf_dir).fillna(0.0, ["n_orders", "total_price"]), nations(spark, sf_dir)
    unseen = facts.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).drop("c_custkey", "balance")
    scored = facts.select((F.col("total_price") / 100).alias("predicted_price"), F.col("balance").alias("actual_price"))
    report = monitor(facts, unseen, dim, ACCOUNTS, scored, scored, MONITORED)
    features = F.array_sort("data_drift.features")

    def told(name):
        return F.array_join(F.transform(features, lambda f: F.concat_ws(":", f["feature"], F.round(f[name] * 1e6).cast("long"))), ",")

    return report.select(
        "report_version", "quality.ok", F.size("quality.errors").alias("n_errors"), "quality.n_fact_rows", "quality.n_dim_rows",
        "data_drift.summary.n_features_evaluated", told("ks_statistic").alias("ks_millionths"), told("psi").alias("psi_millionths"),
        F.round("prediction_drift.summary_stats.current_mean", 4).alias("current_mean"),
        F.round("prediction_drift.summary_stats.baseline_mean", 4).alias("baseline_mean"),
        "model_performance.status", "model_performance.n_samples", F.round("model_performance.mae", 4).alias("mae"),
    )


def _told_sql(name: str, value: str) -> str:
    return f"(SELECT array_to_string(list(feature || ':' || CAST(round({value} * 1e6) AS BIGINT) ORDER BY feature), ',') FROM {name})"


@query(f"""{MONITOR_SQL}, figures AS (
SELECT (SELECT count(*) FROM accounts) AS n_fact_rows, (SELECT count(*) FROM psi) AS n_features_evaluated,
  {_told_sql('ks', 'd')} AS ks_millionths, {_told_sql('psi', 'psi')} AS psi_millionths)
SELECT 'absent' AS run_id, figures.*, true AS prediction_drift_skipped, 'predictions_file_missing' AS prediction_drift_reason, CAST(NULL AS DOUBLE) AS current_mean,
  'skipped' AS performance_status, 'no_labels_file_configured' AS performance_reason, CAST(NULL AS BIGINT) AS n_samples, CAST(NULL AS DOUBLE) AS mae FROM figures
UNION ALL SELECT 'incomplete', figures.*, true, 'missing_predicted_price_column', NULL, 'skipped', 'y_true_or_y_pred_not_provided', NULL, NULL FROM figures
UNION ALL SELECT 'present', figures.*, false, NULL, (SELECT round(avg(total_price / 100), 4) FROM rich), 'ok', NULL,
  (SELECT count(*) FROM rich), (SELECT round(avg(abs(balance - total_price / 100)), 4) FROM rich) FROM figures""")
def monitoring_job(spark, sf_dir):
    """Reports of three runs from the paths of CSV tables. The predictions and labels are not there, without
    their columns, and there; the last run is a repeated one, first made without them."""
    base = work_dir(spark, "monitoring")
    facts = drift.held(accounts(spark, sf_dir).fillna(0.0, ["n_orders", "total_price"]), "accounts")  # four tables are made of them
    unseen = facts.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).drop("c_custkey", "balance")
    for name, rows in (("accounts", facts), ("nations", nations(spark, sf_dir)), ("unseen", unseen)):
        write_rows(rows, f"{base}/raw/{name}.csv")
    scored = facts.select((F.col("total_price") / 100).alias("predicted_price"), F.col("balance").alias("actual_price"))
    write_rows(scored, f"{base}/scored.csv")
    write_rows(scored.select(F.col("predicted_price").alias("other")), f"{base}/other.csv")
    numbers = dict.fromkeys((*ACCOUNTS.numeric, ACCOUNTS.target, *ACCOUNTS.attributes), "double") | {"c_custkey": "bigint"}
    tables = RawTables("accounts.csv", "nations.csv", "unseen.csv", numbers, numbers)

    def run(run_id, scores):
        return run_monitoring(spark, f"{base}/raw", f"{base}/reports", run_id, ACCOUNTS, tables, scores, scores, MONITORED)

    for run_id, scores in (("absent", None), ("incomplete", f"{base}/other.csv"), ("present", f"{base}/none.csv"), ("present", f"{base}/scored.csv")):
        run(run_id, scores)
    reports = read_reports(spark, f"{base}/reports")
    features = F.array_sort("data_drift.features")

    def told(name):
        return F.array_join(F.transform(features, lambda f: F.concat_ws(":", f["feature"], F.round(f[name] * 1e6).cast("long"))), ",")

    flat = report_summary(reports).join(reports.select("run_id", told("ks_statistic").alias("ks_millionths"), told("psi").alias("psi_millionths")), "run_id")
    return flat.select(
        "run_id", "n_fact_rows", "n_features_evaluated", "ks_millionths", "psi_millionths", "prediction_drift_skipped", "prediction_drift_reason",
        F.round("current_mean", 4).alias("current_mean"), "performance_status", "performance_reason", "n_samples", F.round("mae", 4).alias("mae"),
    )
