"""Metrics and whole-column statistics, each one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugemill.contracts import PREDICTION_CANDIDATES, TRUTH_CANDIDATES
from gaugemill.functions.numeric import numeric_column
from gaugemill.operators.ranks import ROWS_PER_RANGE, rank_profile


def metric_columns(truth: Column, prediction: Column) -> dict[str, Column]:
    """Aggregates ``n, mae, mse, rmse, r2`` of double columns without missing values.

    The spread of the truth comes from ``var_pop``, which merges partial means and does not cancel like
    sum(y²) - sum(y)²/n. Without spread r2 is 1 for perfect predictions and else 0; below two rows it is NULL.
    """
    error = truth - prediction
    mse = F.avg(error * error)
    spread = F.var_pop(truth)
    r2 = F.when(F.count(truth) < 2, None).when(
        spread == 0, F.when(mse == 0, 1.0).otherwise(0.0)
    ).otherwise(1 - F.try_divide(mse, spread))
    return {
        "n": F.count(truth),
        "mae": F.avg(F.abs(error)),
        "mse": mse,
        "rmse": F.sqrt(mse),
        "r2": r2,
    }


def aligned_pairs(df: DataFrame, truth: str, prediction: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(y_true, y_pred)`` as doubles, only rows with both."""
    pairs = df.select(numeric_column(df, truth).alias("y_true"), numeric_column(df, prediction).alias("y_pred"), *keep)
    return pairs.filter("y_true is not null and y_pred is not null")


def regression_metrics(df: DataFrame, truth: str, prediction: str, by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """MAE, MSE, RMSE and R² of predictions in target units, per ``by`` group or over all rows."""
    if weight is None:
        metrics = metric_columns(F.col("y_true"), F.col("y_pred"))
        return aligned_pairs(df, truth, prediction, by).groupBy(*by).agg(*(c.alias(k) for k, c in metrics.items()))
    pairs = aligned_pairs(df, truth, prediction, [*by, F.col(weight).cast("double").alias("w")])
    error = F.col("y_true") - F.col("y_pred")
    total = F.sum("w")
    # spread around the weighted mean, with one shared offset so that large targets do not cancel
    offset = pairs.agg(F.avg("y_true")).scalar()
    y = F.col("y_true") - F.col("offset")
    wy = F.sum(F.col("w") * y)
    spread = F.sum(F.col("w") * y * y) - F.try_divide(wy * wy, total)
    sse = F.sum(F.col("w") * error * error)
    return pairs.withColumn("offset", offset).groupBy(*by).agg(
        F.count("y_true").alias("n"),
        F.try_divide(F.sum(F.col("w") * F.abs(error)), total).alias("mae"),
        F.try_divide(sse, total).alias("mse"),
        F.sqrt(F.try_divide(sse, total)).alias("rmse"),
        F.when(F.count("y_true") < 2, None)
        .when(spread == 0, F.when(sse == 0, 1.0).otherwise(0.0))
        .otherwise(1 - F.try_divide(sse, spread))
        .alias("r2"),
    )


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First of ``candidates`` that is a column."""
    return next((c for c in candidates if c in df.columns), None)


PERFORMANCE_SCHEMA = "status string, reason string, n_samples long, mae double, rmse double"


def performance_report(
    df: DataFrame,
    truth_candidates: Sequence[str] = TRUTH_CANDIDATES,
    prediction_candidates: Sequence[str] = PREDICTION_CANDIDATES,
) -> DataFrame:
    """One row ``(status, reason, n_samples, mae, rmse)``; skipped without columns or without pairs."""
    truth, prediction = first_existing(df, truth_candidates), first_existing(df, prediction_candidates)
    if truth is None or prediction is None:
        row = ("skipped", "y_true_or_y_pred_not_provided", None, None, None)
        return df.sparkSession.createDataFrame([row], PERFORMANCE_SCHEMA)
    found = regression_metrics(df, truth, prediction)
    some = F.col("n") > 0
    return found.select(
        F.when(some, "ok").otherwise("skipped").alias("status"),
        F.when(~some, "no_aligned_non_null_pairs").alias("reason"),
        F.when(some, F.col("n")).alias("n_samples"),
        "mae", "rmse",
    )


def prediction_summary(df: DataFrame, column: str) -> DataFrame:
    """One row ``(n, mean, std, min, max)``, sample deviation (0.0 for one value); NULLs without values."""
    v = numeric_column(df, column)
    return df.agg(
        F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.when(F.count(v) == 1, 0.0).otherwise(F.stddev_samp(v)).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )


def baseline_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, mean, std)`` with sample deviation, for those columns that are there."""
    here = [c for c in columns if c in df.columns]
    wide = df.agg(
        *(F.struct(F.lit(c).alias("column"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std")).alias(f"s{i}")
          for i, c in enumerate(here) for v in [numeric_column(df, c)])
    )
    return wide.select(F.inline(F.array(*wide.columns)))


def scaling_stats(df: DataFrame, columns: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """``(feature, median, mean, std)``: median of the values present, then mean and population deviation of
    the column after filling it with the median.

    The filled moments follow from the moments of the values present, so the column is not scanned again.
    A column without values gets median 0.
    """
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.struct(F.lit(c).alias("feature"), F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("s2")).alias(f"s{i}")
          for i, c in enumerate(columns) for v in [numeric_column(df, c)]),
    )
    seen = wide.first()  # one row, also tells the size of the second scan
    moments = df.sparkSession.createDataFrame([seen], wide.schema)
    moments = moments.select("rows", F.inline(F.array(*(f"s{i}" for i in range(len(columns))))))
    median = rank_profile(df, None, columns, [0.5], ks=False, rows_per_range=rows_per_range, n_rows=seen["rows"])
    rows = moments.join(median.select("feature", F.col("quantiles")[0].alias("median")), "feature", "left")
    med, rows_n = F.coalesce("median", F.lit(0.0)), F.col("rows")
    n, filled = F.col("n"), F.col("rows") - F.col("n")
    m, s2 = F.coalesce("m", F.lit(0.0)), F.coalesce("s2", F.lit(0.0))
    mean = F.try_divide(n * m + filled * med, rows_n)
    variance = F.try_divide(n * s2 + (med - m) * (med - m) * n * filled / F.greatest(rows_n, F.lit(1)), rows_n)
    return rows.select("feature", med.alias("median"), mean.alias("mean"), F.sqrt(variance).alias("std"))


def scale_expressions(stats: Sequence, source: DataFrame) -> list[Column]:
    """Filled and standardized columns from collected :func:`scaling_stats`; a constant column is only centred."""
    return [
        (
            (F.coalesce(numeric_column(source, s["feature"]), F.lit(s["median"])) - F.lit(s["mean"]))
            / F.lit(s["std"] or 1.0)
        ).alias(s["feature"])
        for s in stats
    ]
