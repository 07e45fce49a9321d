"""Monitoring reports as nested JSON documents, one per run, with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Documents with skipped sections leave fields out; they read as NULL.
REPORT_SCHEMA = """
run_id STRING, report_version STRING, timestamp_utc TIMESTAMP,
quality STRUCT<ok: BOOLEAN, errors: ARRAY<STRING>, warnings: ARRAY<STRING>, n_fact_rows: BIGINT, n_dim_rows: BIGINT>,
data_drift STRUCT<kind: STRING, skipped: BOOLEAN, reason: STRING,
  features: ARRAY<STRUCT<feature: STRING, skipped: BOOLEAN, reason: STRING, ks_statistic: DOUBLE, ks_pvalue: DOUBLE, psi: DOUBLE,
    drift: BOOLEAN, drift_reason: STRING, n_reference: BIGINT, n_current: BIGINT>>,
  summary: STRUCT<n_features_evaluated: BIGINT, n_features_drift_flagged: BIGINT, drift: BOOLEAN, ks_pvalue_threshold: DOUBLE,
    psi_alert_threshold: DOUBLE>>,
prediction_drift STRUCT<kind: STRING, skipped: BOOLEAN, reason: STRING,
  summary_stats: STRUCT<baseline_mean: DOUBLE, baseline_std: DOUBLE, current_mean: DOUBLE, current_std: DOUBLE, relative_mean_shift: DOUBLE>,
  ks_statistic: DOUBLE, ks_pvalue: DOUBLE, drift: BOOLEAN, drift_reason: STRING, n_baseline: BIGINT, n_current: BIGINT>,
model_performance STRUCT<kind: STRING, status: STRING, reason: STRING, n_samples: BIGINT, mae: DOUBLE, rmse: DOUBLE>
"""


def write_report(report: DataFrame, base: str, run_id: str) -> str:
    """Write one report as the partition ``run_id`` of ``base``.

    The document is written aside and moved into place when the job commits. A run that is repeated replaces its own
    document and no other; a run that fails leaves the earlier document as it was.
    """
    named = report.withColumn("run_id", F.lit(run_id))
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").json(base)
    return base


def read_reports(spark: SparkSession, base: str, run_id: str | None = None) -> DataFrame:
    """Reports of all runs, or of one; a text that is no report raises."""
    found = spark.read.schema(REPORT_SCHEMA).option("mode", "FAILFAST").json(base)
    return found if run_id is None else found.where(F.col("run_id") == run_id)


def report_summary(reports: DataFrame) -> DataFrame:
    """One flat row per report: the figures that a reader looks at first."""
    return reports.select(
        "run_id", "report_version", "timestamp_utc", F.col("quality.ok").alias("quality_ok"), F.col("quality.n_fact_rows").alias("n_fact_rows"),
        "data_drift.summary.n_features_evaluated", "data_drift.summary.n_features_drift_flagged", F.col("data_drift.summary.drift").alias("data_drift"),
        F.col("prediction_drift.skipped").alias("prediction_drift_skipped"), F.col("prediction_drift.reason").alias("prediction_drift_reason"),
        F.col("prediction_drift.drift").alias("prediction_drift"), "prediction_drift.ks_pvalue",
        F.col("prediction_drift.summary_stats.current_mean").alias("current_mean"),
        F.col("model_performance.status").alias("performance_status"), F.col("model_performance.reason").alias("performance_reason"),
        "model_performance.n_samples", "model_performance.mae", "model_performance.rmse",
    )
