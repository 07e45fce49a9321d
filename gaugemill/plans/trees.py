"""Tree ensembles on Spark's learners: boosting with patience, and forests over random cut points."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATIENCE = 20  # rounds without gain after which boosting stops
LEAST_GAIN = 1e-7
FIRST_ROUNDS = 40
CUT_GROUPS, CUTS = 10, 15  # groups of trees with cut points of their own, cut points of a column


# --- boosting -----------------------------------------------------------------------------------------------------------


def stop_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of rounds with the least loss before ``patience`` rounds passed without a lower one, and whether they did.

    A loss is lower by more than ``LEAST_GAIN``, so that rounding alone keeps nothing going.
    """
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best] - LEAST_GAIN:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosting(regressor: GBTRegressor, train: DataFrame, held_out: DataFrame | None, patience: int = PATIENCE) -> GBTRegressionModel:
    """Boosting that stops where the loss of the held-out rows has not fallen for ``patience`` rounds, cut at its best round.

    Spark stops at the first round that gains less than a tolerance and cannot go on from a fitted model. So a number of
    rounds is fitted that doubles until the wait ends within it, the loss of every round is looked up, and the ensemble is
    fitted once more with the best number of rounds. Boosting repeats itself exactly, so that is the same ensemble cut
    short. All fits together take at most some four times the rounds of the last one.
    """
    most = regressor.getMaxIter()
    if held_out is None or patience <= 0:
        return regressor.fit(train)
    rounds = min(FIRST_ROUNDS, most)
    while True:
        model = regressor.copy({regressor.maxIter: rounds}).fit(train)
        best, ended = stop_round(model.evaluateEachIteration(held_out, "squared"), patience)
        if ended or rounds == most:
            break
        rounds = min(2 * rounds, most)
    return model if best == rounds else regressor.copy({regressor.maxIter: best}).fit(train)


# --- forests over random cut points -----------------------------------------------------------------------------------------


def random_cuts(ranges: Sequence[tuple[float, float]], cuts: int, rng: np.random.Generator) -> list[list[float]]:
    """Sorted distinct cut points per column, drawn evenly between its smallest and largest value."""
    out = []
    for low, high in ranges:
        drawn = np.unique(rng.uniform(low, high, cuts)) if high > low else np.array([low])
        out.append([-math.inf, *drawn.tolist(), math.inf])
    return out


def random_cut_stages(
    numeric: Sequence[str], others: Sequence[str], ranges: Sequence[tuple[float, float]], forest: RandomForestRegressor, seed: int,
    groups: int = CUT_GROUPS, cuts: int = CUTS,
) -> list[list]:
    """Stages of each group: its own cut points for the columns ``numeric``, its share of the trees over the cut columns and
    ``others``, and a prediction column of its own."""
    trees = forest.getNumTrees()
    groups = min(groups, trees)
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        share = trees // groups + (g < trees % groups)
        names = [f"{c}__cut{g}" for c in numeric]
        stages: list = []
        if numeric:
            stages.append(Bucketizer(inputCols=list(numeric), outputCols=names, splitsArray=random_cuts(ranges, cuts, rng), handleInvalid="keep"))
        stages.append(VectorAssembler(inputCols=[*names, *others], outputCol=f"features__{g}", handleInvalid="keep"))
        own = forest.copy({
            forest.numTrees: share, forest.featuresCol: f"features__{g}", forest.predictionCol: f"__raw{g}", forest.seed: seed + g,
            forest.maxBins: max(forest.getMaxBins(), cuts + 2),
        })
        out.append([*stages, own])
    return out


def fit_random_cuts(
    ready: DataFrame, numeric: Sequence[str], others: Sequence[str], forest: RandomForestRegressor, seed: int,
    groups: int = CUT_GROUPS, cuts: int = CUTS,
) -> list[Transformer]:
    """Fitted stages that end in ``__raw``, the mean of all trees."""
    ranges: list[tuple[float, float]] = []
    if numeric:
        row = ready.agg(*(f(F.col(f"`{c}`")) for c in numeric for f in (F.min, F.max))).first()
        ranges = [(row[2 * i] or 0.0, row[2 * i + 1] or 0.0) for i in range(len(numeric))]
    fitted: list[Transformer] = []
    weights = []
    for stages in random_cut_stages(numeric, others, ranges, forest, seed, groups, cuts):
        model: PipelineModel = Pipeline(stages=stages).fit(ready)
        fitted += model.stages
        weights.append(stages[-1].getNumTrees())
    total = " + ".join(f"{w} * __raw{g}" for g, w in enumerate(weights))
    return [*fitted, SQLTransformer(statement=f"SELECT *, ({total}) / {sum(weights)} AS __raw FROM __THIS__")]
