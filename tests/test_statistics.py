import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gaugemill.operators import drift, selection, stats
from gaugemill.operators.ranks import rank_profile

DECILES = drift.bin_probabilities()


def numpy_ks(x, y):
    x, y = np.sort(x[~np.isnan(x)]), np.sort(y[~np.isnan(y)])
    both = np.concatenate([x, y])
    return np.abs(np.searchsorted(x, both, "right") / len(x) - np.searchsorted(y, both, "right") / len(y)).max()


def numpy_psi(expected, actual):
    expected, actual = expected[~np.isnan(expected)], actual[~np.isnan(actual)]
    edges = np.unique(np.quantile(expected, np.linspace(0, 1, 11)))
    if len(edges) < 2:
        return 0.0
    e, a = np.histogram(expected, edges)[0], np.histogram(actual, edges)[0]
    e, a = e / max(e.sum(), 1), a / max(a.sum(), 1)
    return float(np.sum((a - e) * np.log((a + 1e-6) / (e + 1e-6))))


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(0)
    n, m = 4000, 2500
    ref = pd.DataFrame({
        "normal": rng.normal(size=n),
        "few": rng.integers(0, 5, n).astype(float),
        "hot": np.where(rng.random(n) < 0.4, 0.0, rng.normal(size=n)),  # one value holds over a third of the rows
        "same": np.full(n, 3.0),
    })
    cur = pd.DataFrame({
        "normal": rng.normal(size=m) + 0.3,
        "few": rng.integers(0, 6, m).astype(float),
        "hot": np.where(rng.random(m) < 0.35, -0.0, rng.normal(size=m)),
        "same": np.full(m, 3.0),
    })
    ref.loc[::7, "normal"] = np.nan
    return ref, cur


@pytest.mark.parametrize("rows_per_range", [1_000_000, 900, 60])
def test_ranks_are_exact_for_any_number_of_ranges(spark, samples, rows_per_range):
    ref, cur = samples
    columns = list(ref.columns)
    found = rank_profile(spark.createDataFrame(ref), spark.createDataFrame(cur), columns, DECILES, True, rows_per_range)
    rows = {r["feature"]: r for r in found.collect()}
    for c in columns:
        assert rows[c]["ks_statistic"] == pytest.approx(numpy_ks(ref[c].values, cur[c].values), abs=1e-12)
        assert rows[c]["quantiles"] == np.quantile(ref[c].dropna(), np.linspace(0, 1, 11)).tolist()
        assert (rows[c]["n_reference"], rows[c]["n_current"]) == (ref[c].notna().sum(), len(cur))


@pytest.mark.parametrize("rows_per_range", [1_000_000, 700])
def test_psi_agrees_with_numpy(spark, samples, rows_per_range):
    ref, cur = samples
    found = drift.psi(spark.createDataFrame(ref), spark.createDataFrame(cur), list(ref.columns), rows_per_range=rows_per_range)
    got = {r["feature"]: r["psi"] for r in found.collect()}
    for c in ref.columns:
        assert got[c] == pytest.approx(numpy_psi(ref[c].values, cur[c].values), abs=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.floats(-50, 50).map(lambda v: round(v, 1)), min_size=2, max_size=60),
    st.lists(st.floats(-50, 50).map(lambda v: round(v, 1)), min_size=2, max_size=60),
)
def test_statistics_agree_with_numpy_on_any_sample(spark, x, y):
    ref, cur = (spark.createDataFrame(pd.DataFrame({"v": s})) for s in (x, y))
    x, y = np.array(x), np.array(y)
    row = drift.data_drift(ref, cur, ["v"], min_samples=2, rows_per_range=16).first()
    assert row["ks_statistic"] == pytest.approx(numpy_ks(x, y), abs=1e-12)
    assert row["psi"] == pytest.approx(numpy_psi(x, y), abs=1e-9)
    none = drift.data_drift(ref, ref, ["v"], min_samples=2).first()
    assert (none["ks_statistic"], none["psi"], none["drift"], none["ks_pvalue"]) == (0.0, 0.0, False, 1.0)


def test_values_outside_the_edges_are_dropped(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(100)], "v double")
    cur = spark.createDataFrame([(float(i + 1000),) for i in range(100)], "v double")
    row = drift.data_drift(ref, cur, ["v"]).first()
    assert row["psi"] == pytest.approx(numpy_psi(np.arange(100.0), np.arange(100.0) + 1000))
    assert row["psi"] > 0.25 and row["ks_statistic"] == 1.0 and row["drift_reason"] == "ks_pvalue<0.01 and psi>0.25"


def test_drift_report_flags_and_skips(spark):
    rng = np.random.default_rng(1)
    ref = pd.DataFrame({"same": rng.normal(size=400), "moved": rng.normal(size=400), "few": [1.0] * 5 + [np.nan] * 395, "gone": 1.0})
    cur = pd.DataFrame({"same": rng.normal(size=400), "moved": rng.normal(6, 1, size=400), "few": 1.0, "text": "a"})
    frames = spark.createDataFrame(ref), spark.createDataFrame(cur)
    report = drift.data_drift(*frames, ["same", "moved", "few", "gone"], min_samples=20)
    rows = {r["feature"]: r for r in report.orderBy("seq").collect()}
    assert list(rows) == ["same", "moved", "few", "gone"]
    assert not rows["same"]["drift"] and rows["same"]["drift_reason"] == "none"
    assert rows["moved"]["drift"]
    assert (rows["few"]["reason"], rows["few"]["n_reference"], rows["few"]["n_current"]) == ("insufficient_samples", 5, 400)
    assert rows["gone"]["reason"] == "missing_in_one_frame" and rows["gone"]["ks_statistic"] is None
    summary = drift.drift_summary(report).first()
    assert (summary["n_features_evaluated"], summary["n_features_drift_flagged"], summary["drift"]) == (2, 1, True)
    plain = drift.data_drift(*frames, ["moved"], include_psi=False).first()
    assert plain["psi"] is None and plain["drift_reason"] == "ks_pvalue<0.01"
    assert [r["feature"] for r in drift.data_drift(*frames).orderBy("seq").collect()] == ["same", "moved", "few"]


def test_histogram_lists_empty_bins(spark):
    ref = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 1, 2, 9)], "v double")
    cur = spark.createDataFrame([(float(v),) for v in (0, 9, 9, 12)], "v double")
    sides = drift.tagged_sides(ref, cur, ["v"])
    rows = drift.full_histogram(sides, {"v": [0.0, 1.0, 2.0, 5.0, 9.0]}).orderBy("bin").collect()
    assert [(r["n_ref"], r["n_cur"]) for r in rows] == [(1, 1), (3, 0), (1, 0), (1, 2)]


def test_prediction_drift(spark):
    rng = np.random.default_rng(99)
    base, cur = rng.normal(0, 1, 2000), rng.normal(12, 1, 500)
    frames = [spark.createDataFrame(pd.DataFrame({c: v})) for c, v in (("predicted_price", cur), ("price", base))]
    row = drift.prediction_drift(*frames, mean_relative_shift_threshold=0.05).first()
    assert row["drift"] and not row["skipped"] and row["drift_reason"] == "ks_pvalue<0.01; mean_shift>0.05"
    assert row["baseline_std"] == pytest.approx(np.std(base)) and row["current_mean"] == pytest.approx(np.mean(cur))
    short = drift.prediction_drift(frames[0].limit(1), frames[1]).first()
    assert (short["skipped"], short["reason"], short["n_current"], short["n_baseline"]) == (True, "insufficient_samples", 1, 2000)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(100.0, 110.0, 1.0), (200.0, 190.0, 2.0), (300.0, 310.0, 1.0), (None, 1.0, 9.0), (5.0, float("nan"), 9.0)], "t double, p double, w double")
    row = stats.regression_metrics(df, "t", "p").first()
    assert (row["n"], row["mae"], row["rmse"]) == (3, 10.0, pytest.approx(10.0))
    assert row["r2"] == pytest.approx(1 - 300 / 20000)
    weighted = stats.regression_metrics(df, "t", "p", weight="w").first()
    assert weighted["r2"] == pytest.approx(1 - 400 / 20000) and weighted["mae"] == pytest.approx(10.0)
    flat = spark.createDataFrame([(1e9, 1e9), (1e9, 1e9)], "t double, p double")
    assert stats.regression_metrics(flat, "t", "p").first()["r2"] == 1.0
    assert stats.regression_metrics(flat.limit(1), "t", "p").first()["r2"] is None


def test_performance_report(spark):
    ok = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 4.0)], "id int, actual_price double, predicted_price double")
    row = stats.performance_report(ok).first()
    assert (row["status"], row["n_samples"], row["mae"]) == ("ok", 2, 1.5)
    none = spark.createDataFrame([(1.0, None), (None, 2.0)], "y_true double, prediction double")
    assert stats.performance_report(none).first()["reason"] == "no_aligned_non_null_pairs"
    assert stats.performance_report(ok.drop("predicted_price")).first()["reason"] == "y_true_or_y_pred_not_provided"
    assert stats.first_existing(ok, ("price", "actual_price")) == "actual_price"


def test_summaries(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,), (float("nan"),)], "v double")
    row = stats.prediction_summary(df, "v").first()
    assert (row["n"], row["mean"], row["std"], row["min"], row["max"]) == (2, 2.0, pytest.approx(math.sqrt(2)), 1.0, 3.0)
    assert stats.prediction_summary(df.filter("v = 1"), "v").first()["std"] == 0.0
    empty = stats.prediction_summary(df.limit(0), "v").first()
    assert empty["n"] == 0 and empty["mean"] is None and empty["min"] is None
    base = stats.baseline_stats(df, ["v", "w"]).collect()
    assert [(r["column"], r["mean"]) for r in base] == [("v", 2.0)]


@pytest.mark.parametrize("rows_per_range", [1_000_000, 100])
def test_scaling_stats(spark, samples, rows_per_range):
    ref = samples[0].copy()
    ref["none"] = np.nan
    for r in stats.scaling_stats(spark.createDataFrame(ref), list(ref.columns), rows_per_range).collect():
        v = ref[r["feature"]]
        median = 0.0 if v.isna().all() else v.median()
        filled = v.fillna(median)
        assert r["median"] == pytest.approx(median) and r["mean"] == pytest.approx(filled.mean())
        assert r["std"] == pytest.approx(filled.std(ddof=0), abs=1e-12)


def test_selection(spark):
    rows = spark.createDataFrame(
        [(0, "a", 10.0, 5.0, 0.5), (1, "b", 10.0, 4.0, 0.4), (2, "c", 10.0, 4.0, 0.6), (3, "d", 10.0, 4.0, 0.6)],
        "position int, scenario string, rmse double, mae double, r2 double",
    )
    assert selection.best_candidate(rows).first()["scenario"] == "c"
    gains = {r["scenario"]: r for r in selection.ablation_deltas(rows, "a").collect()}
    assert gains["c"]["mae_improvement"] == 1.0 and gains["c"]["r2_gain"] == pytest.approx(0.1) and gains["a"]["rmse_improvement"] == 0.0


def test_importances_that_differ_by_noise_are_ties(frame):
    from gaugemill.operators.selection import importance_topk

    rows = frame([("c", 3.4e-10), ("b", 2.9e-12), ("a", -2.4e-10), ("d", 0.5)], "feature string, importance_mean double")
    assert [r["feature"] for r in importance_topk(rows, 3, digits=4).collect()] == ["d", "a", "b"]
    assert [r["feature"] for r in importance_topk(rows, 3).collect()] == ["d", "c", "b"]
