"""Candidate models: shared preprocessing plus an estimator, with the target in its own units at both ends."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugemill.contracts import Candidate, FeatureContract
from gaugemill.functions.numeric import log_target, unlog_prediction
from gaugemill.operators.knn import Cells, NeighbourIndex, build_index, knn_predict, load_index
from gaugemill.operators.ranks import ROWS_PER_RANGE
from gaugemill.operators.sampling import in_share, with_fold
from gaugemill.operators.stats import regression_metrics, scaling_stats
from gaugemill.plans.forest import NodeForestRegressor, RandomForestRegressor
from gaugemill.plans.trees import fit_boosting, fit_random_cuts
from gaugemill.session import work_dir

LABEL = "__label"
HOLD_OUT = "__hold_out"
MAX_CATEGORIES = 100_000  # what the driver may hold of a column
HASHED_CATEGORIES = 4_096
PART_ROWS, MAX_PARTS = 5_000, 200  # labeled rows in a partition of a tree ensemble's fit, and partitions
OWN_PARAMS = ("validation_fraction", "patience")  # settings of the fit, not of Spark's learners

# Estimator settings of the candidates.
DEFAULT_PARAMS: Mapping[str, Mapping] = {
    "baseline_knn": {"k": 5},
    "hist_gradient_boosting": {
        "maxDepth": 8, "stepSize": 0.08, "maxIter": 500, "minInstancesPerNode": 20, "maxBins": 256,
        "validation_fraction": 0.1, "patience": 20,
    },
    "random_forest": {"numTrees": 200, "maxDepth": 24, "minInstancesPerNode": 2, "featureSubsetStrategy": "all"},
    "extra_trees": {
        "numTrees": 200, "maxDepth": 24, "minInstancesPerNode": 2, "bootstrap": False,
        "featureSubsetStrategy": "onethird",
    },
}


@dataclass(frozen=True)
class Preprocessing:
    """Fitted medians, means and deviations of the numeric columns and categories of the others.

    Every value is a category of its own. Columns named in ``hashed`` (a contract's choice, never made by size) are
    coded by hash bucket instead, and that is saved with the model.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    stats: Mapping[str, tuple[float, float, float]]
    categories: Mapping[str, tuple[str, ...]]
    hashed: tuple[str, ...]
    standardize: bool = True

    def scaled(self, name: str) -> str:
        median, mean, std = self.stats[name]
        filled = f"coalesce(nanvl(try_cast(`{name}` AS DOUBLE), CAST(NULL AS DOUBLE)), ({median!r}D))"
        return f"({filled} - ({mean!r}D)) / ({(std or 1.0)!r}D)" if self.standardize else filled

    def category(self, name: str) -> str:
        text = f"CAST(`{name}` AS STRING)"
        return f"CAST(pmod(xxhash64({text}), {HASHED_CATEGORIES}) AS STRING)" if name in self.hashed else text

    def code(self, name: str) -> Column:
        """Position of the value among the fitted categories, -1 for any other and for missing ones."""
        at = F.array_position(F.array(*(F.lit(v) for v in self.categories[name])), F.expr(self.category(name)))
        return F.coalesce(at - 1, F.lit(-1)).cast("double")

    def vector(self) -> Column:
        """Scaled numbers followed by category codes, for the neighbour join."""
        return F.array(*(F.expr(self.scaled(c)) for c in self.numeric), *(self.code(c) for c in self.categorical))

    def one_hot(self, name: str) -> list[Column]:
        """0/1 column per fitted category; all zero for an unseen or missing value."""
        value = F.expr(self.category(name))
        return [
            F.when(value == v, 1).otherwise(0).alias(f"{name}_{v}") for v in self.categories[name]
        ]

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> Preprocessing:
        raw = json.loads(text)
        return cls(
            tuple(raw["numeric"]), tuple(raw["categorical"]), {k: tuple(v) for k, v in raw["stats"].items()},
            {k: tuple(v) for k, v in raw["categories"].items()}, tuple(raw["hashed"]), raw["standardize"],
        )


def fit_preprocessing(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], standardize: bool = True,
    rows_per_range: int = ROWS_PER_RANGE, hashed: Sequence[str] = (), max_categories: int = MAX_CATEGORIES,
) -> Preprocessing:
    """Fit on training rows only. One row per column and its categories reach the driver; more than
    ``max_categories`` of them raise."""
    stats = {}
    if numeric:
        fitted = scaling_stats(train, list(numeric), rows_per_range).collect()
        stats = {r["feature"]: (r["median"], r["mean"], r["std"]) for r in fitted}
    hashed = tuple(c for c in categorical if c in hashed)
    categories: dict[str, tuple[str, ...]] = {}
    exact = [c for c in categorical if c not in hashed]
    if exact:
        sizes = train.agg(*(F.count_distinct(F.col(c).cast("string")).alias(c) for c in exact)).first()
        large = {c: sizes[c] for c in exact if sizes[c] > max_categories}
        if large:
            raise ValueError(f"more than {max_categories} categories in {large}: name the columns in the contract's 'hashed' or raise max_categories")
    if categorical:
        draft = Preprocessing((), tuple(categorical), {}, {}, hashed)
        found = train.agg(
            *(F.array_sort(F.collect_set(F.expr(draft.category(c)))).alias(c) for c in categorical)
        ).first()
        categories = {c: tuple(found[c]) for c in categorical}
    return Preprocessing(tuple(numeric), tuple(categorical), stats, categories, hashed, standardize)


def preprocessing_stages(prep: Preprocessing) -> list:
    """ML stages from contract columns to a ``features`` vector, all fitted state included."""
    columns = [f"{prep.scaled(c)} AS `{c}__z`" for c in prep.numeric]
    columns += [f"{prep.category(c)} AS `{c}__text`" for c in prep.categorical]
    stages: list = [SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")]
    inputs = [f"{c}__z" for c in prep.numeric]
    if prep.categorical:
        # unseen and missing values share one more index, which the encoder drops: all zeros
        stages.append(
            StringIndexer(
                inputCols=[f"{c}__text" for c in prep.categorical],
                outputCols=[f"{c}__index" for c in prep.categorical],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            )
        )
        stages.append(
            OneHotEncoder(
                inputCols=[f"{c}__index" for c in prep.categorical],
                outputCols=[f"{c}__hot" for c in prep.categorical],
                dropLast=True, handleInvalid="keep",
            )
        )
        inputs += [f"{c}__hot" for c in prep.categorical]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")]


def estimator(name: str, seed: int, **overrides) -> GBTRegressor | RandomForestRegressor:
    """Unfitted regressor. Node ids are kept with the rows between levels, so deep trees need not be walked again."""
    if name not in DEFAULT_PARAMS or name == "baseline_knn":
        raise ValueError(f"unknown estimator {name!r}")
    params = {k: v for k, v in {**DEFAULT_PARAMS[name], **overrides}.items() if k not in OWN_PARAMS}
    common = {"featuresCol": "features", "labelCol": LABEL, "predictionCol": "__raw", "seed": seed, "cacheNodeIds": True}
    return (GBTRegressor if name == "hist_gradient_boosting" else NodeForestRegressor)(**common, **params)


def fit_trees(labeled: DataFrame, candidate: Candidate, prep: Preprocessing, row_id: str, seed: int, max_rows: int | None = None) -> PipelineModel:
    """Preprocessing, the candidate's trees and the way back to target units as one pipeline.

    All labeled rows are fitted, unless ``max_rows`` asks for about that many (a share by the row id's digest): the nodes of
    a deep forest grow with them and are held by the driver. The features are made once and written, in as many parts as
    ``PART_ROWS`` asks for, and at most ``MAX_PARTS``: each level of a tree adds up one table of statistics per part.
    """
    params = {**DEFAULT_PARAMS[candidate.name], **candidate.params}
    n = labeled.count()
    if max_rows is not None and n > max_rows:
        n, labeled = max_rows, labeled.filter(in_share([row_id], max_rows / n, seed + 2))
    fraction = params.get("validation_fraction", 0)
    held = in_share([row_id], fraction, seed + 1) if fraction else F.lit(False)
    stages = Pipeline(stages=preprocessing_stages(prep)).fit(labeled).stages
    inputs = stages[-1].getInputCols()
    made = PipelineModel(stages).transform(labeled).select(LABEL, "features", *(f"`{c}`" for c in inputs), held.alias(HOLD_OUT))
    path = work_dir(labeled.sparkSession, "training-features")
    made.repartition(min(MAX_PARTS, max(1, math.ceil(n / PART_ROWS)))).write.parquet(path)
    ready = labeled.sparkSession.read.parquet(path)
    regressor = estimator(candidate.name, seed, **candidate.params)
    if candidate.name == "extra_trees":
        scaled = [f"{c}__z" for c in prep.numeric]
        fitted = fit_random_cuts(ready, scaled, [c for c in inputs if c not in scaled], regressor, seed)
    elif candidate.name == "hist_gradient_boosting":
        train, held_out = ready.filter(~F.col(HOLD_OUT)), ready.filter(HOLD_OUT)
        fitted = [fit_boosting(regressor, train, held_out if fraction and not held_out.isEmpty() else None, params["patience"])]
    else:
        fitted = [regressor.fit(ready)]
    back = {"plain": "__raw", "log1p": "expm1(__raw)"}[candidate.target_mode]
    finish = SQLTransformer(statement=f"SELECT *, {back} AS prediction FROM __THIS__")
    return PipelineModel([*stages, *fitted, finish])


@dataclass
class TreeModel:
    """Fitted pipeline whose last stage turns the raw output into target units."""

    pipeline: PipelineModel
    kind: str = "tree"

    def transform(self, features: DataFrame) -> DataFrame:
        """``features`` with a ``prediction``; stateless, so it also runs on a stream."""
        return self.pipeline.transform(features).select(*features.columns, "prediction")

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        _write_text(f"{path}/kind", {"kind": self.kind})


@dataclass
class NeighbourModel:
    """Nearest-neighbour regressor over the preprocessed training rows."""

    prep: Preprocessing
    index: NeighbourIndex
    target_mode: str
    kind: str = "neighbours"

    def transform(self, features: DataFrame) -> DataFrame:
        scored = knn_predict(self.index, features, self.prep.vector())
        return scored.withColumn("prediction", unlog_prediction(F.col("prediction"), self.target_mode))

    def save(self, path: str) -> None:
        self.index.rows.write.mode("overwrite").parquet(f"{path}/rows")
        _write_text(
            f"{path}/kind",
            {
                "kind": self.kind, "prep": self.prep.to_json(), "target_mode": self.target_mode,
                "cells": self.index.cells.document(), "width": self.index.low.shape[1], "k": self.index.k, "n_codes": self.index.n_codes,
            },
        )


def _write_text(path: str, document: Mapping) -> None:
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(document),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_model(spark: SparkSession, path: str) -> TreeModel | NeighbourModel:
    """Model saved by either class."""
    raw = json.loads("".join(r["value"] for r in spark.read.option("wholetext", True).text(f"{path}/kind").collect()))
    if raw["kind"] == "tree":
        return TreeModel(PipelineModel.load(f"{path}/pipeline"))
    index = load_index(spark, f"{path}/rows", Cells.read(raw["cells"]), raw["width"], raw["k"], raw["n_codes"])
    return NeighbourModel(Preprocessing.from_json(raw["prep"]), index, raw["target_mode"])


def fit_model(
    train: DataFrame,
    candidate: Candidate,
    numeric: Sequence[str],
    categorical: Sequence[str],
    target: str,
    row_id: str,
    seed: int = 42,
    prep: Preprocessing | None = None,
    hashed: Sequence[str] = (),
    max_rows: int | None = None,
) -> TreeModel | NeighbourModel:
    """Fit one candidate on feature rows. Pass ``prep`` to share the preprocessing of several candidates.

    ``max_rows``, where it is given, bounds the labeled rows of a tree ensemble; the neighbour model keeps them all.
    """
    prep = prep or fit_preprocessing(train, numeric, categorical, hashed=hashed)
    labeled = train.withColumn(LABEL, log_target(F.col(target).cast("double"), candidate.target_mode))
    if candidate.name == "baseline_knn":
        k = int(candidate.params.get("k", DEFAULT_PARAMS["baseline_knn"]["k"]))
        index = build_index(labeled, row_id, LABEL, prep.vector(), len(prep.categorical), k)
        return NeighbourModel(prep, index, candidate.target_mode)
    return TreeModel(fit_trees(labeled, candidate, prep, row_id, seed, max_rows))


def fit_contract_model(train: DataFrame, candidate: Candidate, contract: FeatureContract, seed: int = 42, prep: Preprocessing | None = None):
    """Fit one candidate on the columns of a contract."""
    return fit_model(train, candidate, contract.model_numeric, contract.categorical, contract.target, contract.row_id, seed, prep, contract.hashed)


def cross_validated_rmse(
    train: DataFrame, candidate: Candidate, contract: FeatureContract, folds: int, seed: int = 42,
    contiguous: bool = False,
) -> DataFrame:
    """``(fold, n, rmse)`` on held-out folds in target units; preprocessing is fitted inside each fold."""
    def fit(rows: DataFrame):
        return fit_contract_model(rows, candidate, contract, seed)

    return cross_validated(train, fit, contract.row_id, contract.target, folds, seed, contiguous)


def cross_validated(
    train: DataFrame, fit: Callable[[DataFrame], TreeModel | NeighbourModel], row_id: str, target: str, folds: int, seed: int = 42, contiguous: bool = False,
) -> DataFrame:
    """``(fold, n, rmse)``: each fold predicted by what ``fit`` makes of the others."""
    marked = with_fold(train, [row_id], folds, seed, contiguous)
    parts = []
    for fold in range(folds):
        model = fit(marked.filter(F.col("fold") != fold).drop("fold"))
        scored = model.transform(marked.filter(F.col("fold") == fold))
        parts.append(regression_metrics(scored, target, "prediction").select(F.lit(fold).alias("fold"), "n", "rmse"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
