"""Training: checked inputs, enriched rows, features, candidates compared on held-out rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.contracts import FeatureContract, TrainingParams
from gaugemill.operators.enrich import enrich
from gaugemill.operators.quality import check_inference, check_training, gate
from gaugemill.operators.sampling import first_rows, in_share
from gaugemill.operators.selection import best_candidate
from gaugemill.operators.stats import regression_metrics
from gaugemill.plans import registry
from gaugemill.plans.features import build_features, require_columns
from gaugemill.plans.models import (
    cross_validated_rmse,
    fit_contract_model,
    fit_preprocessing,
)
from gaugemill.session import work_dir
from gaugemill.sources.writers import write_contract, write_params, write_rows

COMPARISON_SCHEMA = (
    "position int, key string, model string, target_mode string, mae double, rmse double, r2 double, "
    "cv_rmse_mean double, run_id string, model_path string"
)


def training_frame(sales: DataFrame, dim: DataFrame, contract: FeatureContract, validate: bool = True) -> DataFrame:
    """Labeled rows with their attributes; with ``validate`` any error in the inputs raises."""
    if validate:
        gate(check_training(sales, dim, contract), "training")
    merged = enrich(sales, dim, contract.key, check_unique=validate)
    if validate:
        require_columns(merged, contract.merged_columns, "merged training")
    return merged


def inference_frame(rows: DataFrame, dim: DataFrame, contract: FeatureContract, validate: bool = True) -> DataFrame:
    """Rows to be scored with their attributes."""
    if validate:
        gate(check_inference(rows, contract), "inference")
    merged = enrich(rows, dim, contract.key, check_unique=validate)
    if validate:
        require_columns(merged, contract.merged_columns, "merged inference")
    return merged


@dataclass
class TrainingResult:
    rows: DataFrame
    best: dict[str, Any]
    model: Any
    model_path: str
    version: int | None
    params: TrainingParams
    warnings: list[str] = field(default_factory=list)


def train(
    sales: DataFrame,
    dim: DataFrame,
    contract: FeatureContract,
    out: str,
    params: TrainingParams | None = None,
    only: Sequence[str] | None = None,
    max_rows: int | None = None,
    registry_base: str | None = None,
    validate: bool = True,
) -> TrainingResult:
    """Fit every candidate on the same training rows and keep the best on the validation rows.

    The feature rows are written to the shared work folder once, so a lost executor costs a re-read and not the
    join and checks again. The driver holds one metric row per candidate.
    """
    params = params or TrainingParams()
    candidates = [c for c in params.candidates if not only or c.name in only]
    if not candidates:
        raise ValueError("no candidate to train (empty list or filter)")
    spark = sales.sparkSession
    warnings = gate(check_training(sales, dim, contract), "training") if validate else []
    if max_rows is not None:
        # the dimension adds no rows, so the cut may go below the join
        sales = first_rows(sales, [contract.row_id], max_rows)
    merged = enrich(sales, dim, contract.key, check_unique=validate)
    if validate:
        require_columns(merged, contract.merged_columns, "merged training")
    path = work_dir(spark, "features")
    features = build_features(merged, contract, keep=[contract.row_id, contract.target], reference_year=params.reference_year)
    # one folder per side: the jobs that fit never open the validation files
    held_out = in_share([contract.row_id], params.test_size, params.random_state)
    features.withColumn("__held_out", held_out.cast("int")).write.partitionBy("__held_out").parquet(path)
    features = spark.read.parquet(path)
    fit_rows, test_rows = (features.filter(F.col("__held_out") == side).drop("__held_out") for side in (0, 1))
    prep = fit_preprocessing(fit_rows, contract.model_numeric, contract.categorical)

    parent = registry.new_run_id()
    if registry_base:
        described = {
            "reference_year": params.reference_year, "test_size": params.test_size,
            "random_state": params.random_state, "n_rows": features.count(),
            "n_features": len(contract.final), "feature_names": ",".join(contract.final),
        }
        registry.log_run(spark, registry_base, params.experiment_name, "training_comparison", described, {}, run_id=parent)

    metrics, models = [], []
    for position, candidate in enumerate(candidates):
        cv = None
        if params.cv_folds > 1:
            cv = cross_validated_rmse(fit_rows, candidate, contract, params.cv_folds, params.random_state).agg(F.avg("rmse")).first()[0]
        model = fit_contract_model(fit_rows, candidate, contract, params.random_state, prep)
        found = regression_metrics(model.transform(test_rows), contract.target, "prediction").first()
        run_id, model_path = registry.new_run_id(), f"{out}/candidates/{candidate.key}"
        model.save(model_path)
        metrics.append(
            (position, candidate.key, candidate.name, candidate.target_mode, found["mae"], found["rmse"], found["r2"], cv, run_id, model_path)
        )
        models.append(model)
        if registry_base:
            described = {
                "estimator": candidate.name, "target_mode": candidate.target_mode,
                "target_transform": "log1p(target)" if candidate.target_mode == "log1p" else "target",
            }
            scores = {"mae": found["mae"], "rmse": found["rmse"], "r2": found["r2"], "cv_rmse_mean": cv}
            registry.log_run(spark, registry_base, params.experiment_name, candidate.key, described, scores, parent, run_id, model_path)

    table = spark.createDataFrame(metrics, COMPARISON_SCHEMA)
    best = best_candidate(table).first().asDict()
    write_rows(table.withColumn("best", F.col("position") == best["position"]), f"{out}/comparison")
    write_contract(spark, contract, f"{out}/contract")
    write_params(spark, params, f"{out}/params")
    model = models[best["position"]]
    model.save(f"{out}/best_model")
    version = None
    if registry_base:
        scores = {k: best[k] for k in ("mae", "rmse", "r2")}
        version = registry.register_model(
            spark, registry_base, params.registered_model_name, f"{out}/best_model", best["run_id"], scores, {"best_model": "true"}
        )
    return TrainingResult(table, best, model, f"{out}/best_model", version, params, warnings)


def read_comparison(spark: SparkSession, out: str) -> DataFrame:
    """The metric rows that a training job left below ``out``, the best one marked."""
    return spark.read.schema(f"{COMPARISON_SCHEMA}, best boolean").parquet(f"{out}/comparison")


def train_baseline(sales: DataFrame, dim: DataFrame, contract: FeatureContract, out: str, **kwargs) -> TrainingResult:
    """Training with the nearest-neighbour baseline alone."""
    return train(sales, dim, contract, out, only=["baseline_knn"], **kwargs)
