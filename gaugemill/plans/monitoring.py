"""Monitoring: quality, feature drift, prediction drift and labeled performance in one report row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.contracts import PREDICTION_CANDIDATES, TRUTH_CANDIDATES, FeatureContract
from gaugemill.operators.drift import (
    KS_PVALUE_THRESHOLD,
    PSI_THRESHOLD,
    common_numeric_columns,
    data_drift,
    held,
    prediction_drift,
)
from gaugemill.operators.enrich import enrich
from gaugemill.operators.quality import check_inference, check_training, gate, summarize
from gaugemill.operators.stats import baseline_stats, performance_report
from gaugemill.sources.readers import HOUSE_TABLES, RawTables, read_all, read_if_usable
from gaugemill.sources.reports import read_reports, write_report
from gaugemill.sources.writers import write_rows

REPORT_VERSION = "1.0"


def quality_section(sales: DataFrame, dim: DataFrame, contract: FeatureContract) -> DataFrame:
    return summarize(check_training(sales, dim, contract), sales, dim)


def data_drift_section(
    reference: DataFrame, current: DataFrame, columns: Sequence[str] | None = None,
    exclude: Sequence[str] = ("id", "date", "price"), n_rows: int | None = None,
) -> DataFrame:
    """One struct ``data_drift``: the feature rows in order and their summary."""
    columns = common_numeric_columns(reference, current, exclude) if columns is None else columns
    report = data_drift(reference, current, columns, n_rows=n_rows)
    fields = [c for c in report.columns if c != "seq"]
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct(*report.columns))),
        lambda r: F.struct(*(r[c].alias(c) for c in fields)),
    )
    flagged, evaluated = F.count_if("drift"), F.count_if(~F.col("skipped"))
    return report.agg(
        F.struct(
            F.lit("data_drift").alias("kind"), F.lit(False).alias("skipped"), F.lit(None).cast("string").alias("reason"),
            ordered.alias("features"),
            F.struct(
                evaluated.alias("n_features_evaluated"), flagged.alias("n_features_drift_flagged"),
                (flagged > 0).alias("drift"), F.lit(KS_PVALUE_THRESHOLD).alias("ks_pvalue_threshold"),
                F.lit(PSI_THRESHOLD).alias("psi_alert_threshold"),
            ).alias("summary"),
        ).alias("data_drift")
    )


def _told(spark: SparkSession, name: str, values: Mapping[str, Column]) -> DataFrame:
    """One row with a struct of known values: a one-row range, which the planner knows to be small."""
    return spark.range(1).select(F.struct(*(v.alias(k) for k, v in values.items())).alias(name))


def _skipped(df: DataFrame, name: str, reason: str) -> DataFrame:
    return _told(df.sparkSession, name, {"kind": F.lit(name), "skipped": F.lit(True), "reason": F.lit(reason)})


def prediction_drift_section(sales: DataFrame, predictions: DataFrame | None, target: str, column: str = "predicted_price", reason: str = "predictions_file_missing") -> DataFrame:
    if predictions is None:
        return _skipped(sales, "prediction_drift", reason)
    if column not in predictions.columns:
        return _skipped(sales, "prediction_drift", f"missing_{column}_column")
    found = prediction_drift(predictions, sales, column, target)
    stats = ("baseline_mean", "baseline_std", "current_mean", "current_std", "relative_mean_shift")
    return found.select(
        F.struct(
            F.lit("prediction_drift").alias("kind"), "skipped", "reason", F.struct(*stats).alias("summary_stats"),
            "ks_statistic", "ks_pvalue", "drift", "drift_reason", "n_baseline", "n_current",
        ).alias("prediction_drift")
    )


def performance_section(sales: DataFrame, labeled: DataFrame | None) -> DataFrame:
    if labeled is None:
        told = {"kind": "model_performance", "status": "skipped", "reason": "no_labels_file_configured"}
        return _told(sales.sparkSession, "model_performance", {k: F.lit(v) for k, v in told.items()})
    df = performance_report(labeled).select(F.lit("model_performance").alias("kind"), "*")
    return df.select(F.struct(*df.columns).alias("model_performance"))


def monitor(
    sales: DataFrame, unseen: DataFrame, dim: DataFrame, contract: FeatureContract,
    predictions: DataFrame | None = None, labeled: DataFrame | None = None,
    drift_columns: Sequence[str] | None = None, prediction_column: str = "predicted_price",
    predictions_reason: str = "predictions_file_missing",
) -> DataFrame:
    """One nested report row. Feature drift is skipped when quality failed, which is looked up first; the other
    sections do not depend on it. Rows to be scored that fail their checks raise, as do dimension keys that are equal
    once normalized."""
    quality = quality_section(sales, dim, contract)
    found = quality.first()
    quality = _told(sales.sparkSession, "quality", {
        f.name: F.array(*map(F.lit, found[f.name])).cast(f.dataType) if isinstance(found[f.name], list) else F.lit(found[f.name]).cast(f.dataType)
        for f in quality.schema
    })
    if found["ok"]:
        gate(check_inference(unseen, contract), "inference")
        # the joins add no rows, so they need not run for the count
        n_rows = found["n_fact_rows"] + unseen.count()
        drift = data_drift_section(
            enrich(sales, dim, contract.key, check_unique=True), enrich(unseen, dim, contract.key), drift_columns, contract.metadata, n_rows
        )
    else:
        drift = _skipped(sales, "data_drift", "upstream_quality_failed")
    sections = [
        quality, drift,
        prediction_drift_section(sales, predictions, contract.target, prediction_column, predictions_reason),
        performance_section(sales, labeled),
    ]
    # every section is one row: put them side by side under a constant key
    keyed = [s.withColumn("__one", F.lit(1)) for s in sections]
    joined = reduce(lambda a, b: a.join(b, "__one"), keyed).drop("__one")
    return joined.select(F.lit(REPORT_VERSION).alias("report_version"), F.current_timestamp().alias("timestamp_utc"), "*")


def monitoring_job(
    spark: SparkSession, raw: str, reports: str, run_id: str, contract: FeatureContract, tables: RawTables = HOUSE_TABLES,
    predictions: str | None = None, labels: str | None = None, drift_columns: Sequence[str] | None = None,
    prediction_column: str = "predicted_price", stats: str | None = None, stats_columns: Sequence[str] = (),
) -> DataFrame:
    """From the paths of the raw tables, the last predictions and the labels to the report of a run, which is returned as read back.

    A source that is not named or not there skips its section with a reason, as does one without the columns asked for.
    Where ``stats`` is given the mean and deviation of ``stats_columns`` of the labeled rows go there. A run can be
    repeated: its report is replaced.
    """
    raw_tables = read_all(spark, raw, tables)
    # text tables are parsed once; checks, sizes and drift each read the typed rows
    sales, unseen = held(raw_tables["sales"], "monitored-sales"), held(raw_tables["unseen"], "monitored-unseen")
    scored, why = read_if_usable(spark, predictions, [prediction_column], {prediction_column: "double"})
    numbers = dict.fromkeys((*TRUTH_CANDIDATES, *PREDICTION_CANDIDATES), "double")
    labeled, _ = read_if_usable(spark, labels, (), numbers)
    report = monitor(
        sales, unseen, raw_tables["demographics"], contract, scored, labeled, drift_columns,
        prediction_column, why or "predictions_file_missing",
    )
    if stats is not None:
        write_rows(baseline_stats(sales, stats_columns or (contract.target,)), stats)
    write_report(report, reports, run_id)
    return read_reports(spark, reports, run_id)
