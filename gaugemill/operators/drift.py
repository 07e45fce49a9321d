"""Distribution drift of features and of predictions."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugemill.functions.kolmogorov import with_ks_pvalue
from gaugemill.functions.numeric import relative_shift
from gaugemill.operators.ranks import ROWS_PER_RANGE, rank_profile, tagged_sides
from gaugemill.session import work_dir

KS_PVALUE_THRESHOLD = 0.01
PSI_THRESHOLD = 0.25
MEAN_SHIFT_THRESHOLD = 0.25
MIN_SAMPLES = 20
BINS = 10
PSI_EPS = 1e-6
PROFILE = ("feature", "n_reference", "n_current", "ks_statistic")


def common_numeric_columns(
    reference: DataFrame, current: DataFrame, exclude: Sequence[str] = ("id", "date", "price")
) -> list[str]:
    """Columns of both frames, numeric (or boolean) in the first, in its order. Reads schemas only."""
    there = set(current.columns) - set(exclude)
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in reference.schema if f.name in there and isinstance(f.dataType, kinds)]


def bin_probabilities(bins: int = BINS) -> list[float]:
    """Evenly spaced probabilities from 0 to 1."""
    return [i * (1 / bins) for i in range(bins)] + [1.0]


def quantile_grid(df: DataFrame, columns: Sequence[str], bins: int = BINS, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(feature, n, edges)``: distinct evenly spaced quantiles per column."""
    found = rank_profile(df, None, columns, bin_probabilities(bins), ks=False, rows_per_range=rows_per_range)
    return found.select("feature", F.col("n_reference").alias("n"), F.array_distinct("quantiles").alias("edges"))


def collect_edges(profile: DataFrame) -> dict[str, list[float]]:
    """Distinct quantiles per feature on the driver: one short list per feature."""
    return {r["feature"]: sorted(set(r["quantiles"] or [])) for r in profile.collect()}


def _number(x: float) -> str:
    return f"({x!r}D)" if math.isfinite(x) else f"double('{x}')"


def histogram(sides: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """``(feature, bin, n_ref, n_cur)`` over the given edges; bins without rows are left out.

    Bins are half-open, the last one is closed, and values outside the edges are dropped. Each value is compared
    with the literal inner edges of its column; rows are counted before the shuffle, which carries one record per
    bin and task.
    """
    cells = []
    for name, e in edges.items():
        if len(e) < 2:
            continue
        above = " + ".join(f"CAST(`{name}` >= {_number(x)} AS INT)" for x in e[1:-1]) or "0"
        inside = f"`{name}` BETWEEN {_number(e[0])} AND {_number(e[-1])}"
        cells.append(f"struct({name!r} AS feature, CASE WHEN {inside} THEN {above} END AS bin)")
    if not cells:
        return sides.sparkSession.createDataFrame([], "feature string, bin int, n_ref long, n_cur long")
    placed = sides.select("is_ref", F.expr(f"inline(array({', '.join(cells)}))")).filter("bin IS NOT NULL")
    return placed.groupBy("feature", "bin").agg(F.count_if("is_ref").alias("n_ref"), F.count_if(~F.col("is_ref")).alias("n_cur"))


def full_histogram(sides: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """Histogram rows for every bin, with 0 for the empty ones, and the bin's lower and upper edge."""
    bins = [(name, i, e[i], e[i + 1]) for name, e in edges.items() for i in range(len(e) - 1)]
    grid = sides.sparkSession.createDataFrame(bins, "feature string, bin int, lower double, upper double")
    return grid.join(histogram(sides, edges), ["feature", "bin"], "left").fillna(0, ["n_ref", "n_cur"])


def psi_from_histogram(counts: DataFrame) -> DataFrame:
    """``(feature, psi_sum)`` from bin counts; a bin empty on both sides adds nothing."""
    whole = Window.partitionBy("feature")  # at most one row per bin
    ref = F.col("n_ref") / F.greatest(F.sum("n_ref").over(whole), F.lit(1))
    cur = F.col("n_cur") / F.greatest(F.sum("n_cur").over(whole), F.lit(1))
    term = (F.col("cur") - F.col("ref")) * F.ln((F.col("cur") + PSI_EPS) / (F.col("ref") + PSI_EPS))
    return counts.select("feature", ref.alias("ref"), cur.alias("cur")).groupBy("feature").agg(F.sum(term).alias("psi_sum"))


def _with_psi(profile: DataFrame, sides: DataFrame) -> DataFrame:
    """Profile rows with ``psi``: NULL below two values on a side, 0.0 without two distinct edges.

    The profile is one short row per feature; it is brought to the driver so that the bin edges become literals
    of the second scan and the ranks are not worked out again.
    """
    rows = profile.collect()
    edges = {r["feature"]: sorted(set(r["quantiles"] or [])) for r in rows}
    found = sides.sparkSession.createDataFrame(
        [(*(r[c] for c in PROFILE), len(edges[r["feature"]]) < 2) for r in rows],
        "feature string, n_reference long, n_current long, ks_statistic double, one_edge boolean",
    )
    value = F.expr("CASE WHEN n_reference >= 2 AND n_current >= 2 THEN CASE WHEN one_edge THEN 0D ELSE coalesce(psi_sum, 0D) END END")
    sums = psi_from_histogram(histogram(sides, edges))
    return found.join(sums, "feature", "left").withColumn("psi", value).drop("psi_sum", "one_edge")


def psi(
    reference: DataFrame | None,
    current: DataFrame | None,
    columns: Sequence[str],
    bins: int = BINS,
    rows_per_range: int = ROWS_PER_RANGE,
    sides: DataFrame | None = None,
) -> DataFrame:
    """``(feature, n_reference, n_current, psi)`` with quantile bins of the reference side."""
    sides = tagged_sides(reference, current, columns, sides)
    profile = rank_profile(None, None, columns, bin_probabilities(bins), False, rows_per_range, sides)
    return _with_psi(profile, sides).select("feature", "n_reference", "n_current", "psi")


def ks(
    reference: DataFrame | None,
    current: DataFrame | None,
    columns: Sequence[str],
    rows_per_range: int = ROWS_PER_RANGE,
    sides: DataFrame | None = None,
) -> DataFrame:
    """``(feature, n_reference, n_current, ks_statistic, ks_pvalue)``."""
    sides = tagged_sides(reference, current, columns, sides)
    found = rank_profile(None, None, columns, (), True, rows_per_range, sides).drop("quantiles")
    return with_ks_pvalue(found)


def _reason(flags: Sequence[tuple[Column, str]], joint: str) -> Column:
    told = F.concat_ws(joint, *(F.when(flag, F.lit(text)) for flag, text in flags))
    return F.when(told == "", "none").otherwise(told)


def held(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once: scans, joins and estimates below them don't run again per statistic.

    Rows without columns, which no file can hold, stay as they are."""
    if not rows.columns:
        return rows
    spark = rows.sparkSession
    path = work_dir(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def data_drift(
    reference: DataFrame | None,
    current: DataFrame | None,
    columns: Sequence[str] | None = None,
    ks_pvalue_threshold: float = KS_PVALUE_THRESHOLD,
    psi_alert_threshold: float = PSI_THRESHOLD,
    min_samples: int = MIN_SAMPLES,
    include_psi: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
    sides: DataFrame | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Drift per feature, in the order given; all features are handled together.

    Pass ``sides`` (values with a boolean ``is_ref``) instead of two frames when both sides come out of one
    scan. ``n_rows`` tells the rows of both sides where they are known; it only saves the count that decides into
    how many ranges the values are cut.
    """
    if columns is None:
        columns = common_numeric_columns(reference, current)
    if sides is None:
        usable = [c for c in columns if c in reference.columns and c in current.columns]
        spark = reference.sparkSession
        sides = tagged_sides(reference, current, usable) if usable else None
    else:
        usable, spark = [c for c in columns if c in sides.columns], sides.sparkSession
        sides = tagged_sides(None, None, usable, sides) if usable else None
    asked = spark.createDataFrame(
        [(i, c, c in usable) for i, c in enumerate(columns)], "seq int, feature string, present boolean"
    )
    if usable:
        sides = held(sides, "drift-sides")
        n_rows = sides.count() if n_rows is None else n_rows
        probabilities = bin_probabilities() if include_psi else ()
        found = rank_profile(None, None, usable, probabilities, True, rows_per_range, sides, n_rows)
        if include_psi:
            found = _with_psi(found, sides)
        else:
            found = found.withColumn("psi", F.lit(None).cast("double"))
    else:
        found = spark.createDataFrame(
            [], "feature string, n_reference long, n_current long, ks_statistic double, quantiles array<double>, psi double"
        )
    rows = asked.join(found.drop("quantiles"), "feature", "left")
    n_ref, n_cur = (F.coalesce(c, F.lit(0)) for c in ("n_reference", "n_current"))
    reason = F.when(~F.col("present"), "missing_in_one_frame").when(
        (n_ref < min_samples) | (n_cur < min_samples), "insufficient_samples"
    )
    rows = rows.select(
        "seq", "feature", reason.isNotNull().alias("skipped"), reason.alias("reason"),
        F.when(reason.isNull(), F.col("ks_statistic")).alias("ks_statistic"),
        F.when(reason.isNull(), F.col("psi")).alias("psi"),
        F.when(F.col("present"), n_ref).alias("n_reference"),
        F.when(F.col("present"), n_cur).alias("n_current"),
    )
    rows = with_ks_pvalue(rows)
    by_ks = F.coalesce(F.col("ks_pvalue") < ks_pvalue_threshold, F.lit(False))
    by_psi = F.coalesce(F.col("psi") > psi_alert_threshold, F.lit(False))
    told = _reason(((by_ks, f"ks_pvalue<{ks_pvalue_threshold}"), (by_psi, f"psi>{psi_alert_threshold}")), " and ")
    return rows.select(
        "seq", "feature", "skipped", "reason", "ks_statistic", "ks_pvalue", "psi",
        F.when(~F.col("skipped"), by_ks | by_psi).alias("drift"),
        F.when(~F.col("skipped"), told).alias("drift_reason"),
        "n_reference", "n_current",
    )


def drift_summary(
    report: DataFrame,
    ks_pvalue_threshold: float = KS_PVALUE_THRESHOLD,
    psi_alert_threshold: float = PSI_THRESHOLD,
) -> DataFrame:
    """One row: features evaluated, flagged, any flagged, thresholds."""
    flagged = F.count_if("drift")
    return report.agg(
        F.count_if(~F.col("skipped")).alias("n_features_evaluated"),
        flagged.alias("n_features_drift_flagged"),
        (flagged > 0).alias("drift"),
        F.lit(ks_pvalue_threshold).alias("ks_pvalue_threshold"),
        F.lit(psi_alert_threshold).alias("psi_alert_threshold"),
    )


def prediction_drift(
    current: DataFrame | None,
    baseline: DataFrame | None,
    current_column: str = "predicted_price",
    baseline_column: str = "price",
    ks_pvalue_threshold: float = KS_PVALUE_THRESHOLD,
    mean_relative_shift_threshold: float = MEAN_SHIFT_THRESHOLD,
    rows_per_range: int = ROWS_PER_RANGE,
    sides: DataFrame | None = None,
) -> DataFrame:
    """One row comparing predictions with a baseline; skipped with fewer than two values on a side.

    Instead of two frames, ``sides`` may bring values ``v`` with a boolean ``is_ref``.
    """
    if sides is None:
        baseline, current = baseline.select(F.col(baseline_column).alias("v")), current.select(F.col(current_column).alias("v"))
    sides = tagged_sides(baseline, current, ["v"], sides)
    sides = held(sides, "prediction-sides")
    base, cur = F.when(F.col("is_ref"), F.col("v")), F.when(~F.col("is_ref"), F.col("v"))
    moments = sides.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(base).alias("n_baseline"), F.count(cur).alias("n_current"),
        F.avg(base).alias("baseline_mean"), F.stddev_pop(base).alias("baseline_std"),
        F.avg(cur).alias("current_mean"), F.stddev_pop(cur).alias("current_std"),
    )
    seen = moments.first()  # one row, also tells the size of the second scan
    profile = rank_profile(None, None, ["v"], (), True, rows_per_range, sides, seen["n_rows"]).select("feature", "ks_statistic")
    known = sides.sparkSession.createDataFrame([seen], moments.schema).withColumn("feature", F.lit("v"))
    skipped = (F.col("n_baseline") < 2) | (F.col("n_current") < 2)
    value_columns = ("baseline_mean", "baseline_std", "current_mean", "current_std", "ks_statistic")
    rows = known.join(profile, "feature", "left").select(
        skipped.alias("skipped"),
        F.when(skipped, "insufficient_samples").alias("reason"),
        *(F.when(~skipped, F.col(c)).alias(c) for c in value_columns),
        "n_baseline", "n_current",
    )
    rows = rows.withColumn("relative_mean_shift", relative_shift(F.col("current_mean"), F.col("baseline_mean")))
    rows = with_ks_pvalue(rows, n1="n_baseline")
    by_ks = F.coalesce(F.col("ks_pvalue") < ks_pvalue_threshold, F.lit(False))
    by_mean = F.coalesce(F.col("relative_mean_shift") > mean_relative_shift_threshold, F.lit(False))
    told = _reason(((by_ks, f"ks_pvalue<{ks_pvalue_threshold}"), (by_mean, f"mean_shift>{mean_relative_shift_threshold}")), "; ")
    return rows.select(
        "skipped", "reason", "baseline_mean", "baseline_std", "current_mean", "current_std", "relative_mean_shift",
        "ks_statistic", "ks_pvalue",
        F.when(~F.col("skipped"), by_ks | by_mean).alias("drift"),
        F.when(~F.col("skipped"), told).alias("drift_reason"),
        "n_baseline", "n_current",
    )
