"""Permutation importance and feature-set ablation."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.contracts import Candidate
from gaugemill.operators.sampling import dealt_values, with_hash_rank
from gaugemill.operators.selection import ablation_deltas
from gaugemill.operators.stats import regression_metrics
from gaugemill.plans.models import fit_model, fit_preprocessing
from gaugemill.session import work_dir

BASE_LABEL = "__unchanged"
PART_ROWS = 10_000  # rows that a task scores, about
TASKS_PER_CORE = 8


def permutation_importance(
    df: DataFrame, predict: Callable[[DataFrame], DataFrame], features: Sequence[str], target: str,
    keys: Sequence[str], repeats: int = 5, seed: int = 42,
) -> DataFrame:
    """``(feature, importance_mean, importance_std)``: rise of the MAE when a column's values are dealt out anew,
    mean and population deviation over the repeats.

    ``predict`` adds ``prediction`` in the units of ``target``. The rows are ranked by the digest of their key once and
    written; all repeats are permutations of these ranks and meet their values in one join. The variants of a row (one
    column exchanged each) are scored together with the unchanged row, and summed side by side in one aggregate, so that a
    column that no prediction depends on rises by exactly 0, however the sums are rounded. The rows are dealt into as many
    tasks as their variants ask for: by their bytes alone they would end in a few. There are ``TASKS_PER_CORE`` at most: a
    task reads the whole model.
    """
    path = work_dir(df.sparkSession, "importance")
    with_hash_rank(df.select(*dict.fromkeys([*keys, target, *features])), keys, 0).drop("rank_of").write.parquet(path)
    ranked = df.sparkSession.read.parquet(path)
    types = {f.name: f.dataType for f in ranked.schema}
    n = ranked.count()
    dealt = dealt_values(ranked, n, features, [seed + 1 + r for r in range(repeats)])
    most = TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    dealt = dealt.repartition(max(1, min(most, math.ceil(n * repeats * len(features) / PART_ROWS))))
    variants = F.array(
        *(
            F.struct(F.lit(name).alias("feature"), *(F.col(f"{c}__permuted" if c == name else c).cast(types[c]).alias(c) for c in features))
            for name in (BASE_LABEL, *features)
        )
    )
    scored = predict(dealt.select("repeat", target, F.inline(variants)))
    gap = F.abs(F.col(target) - F.col("prediction"))
    maes = scored.groupBy("repeat").agg(*(F.avg(F.when(F.col("feature") == name, gap)).alias(f"mae{i}") for i, name in enumerate((BASE_LABEL, *features))))
    rises = F.array(*(F.struct(F.lit(name).alias("feature"), (F.col(f"mae{i}") - F.col("mae0")).alias("rise")) for i, name in enumerate(features, 1)))
    return maes.select(F.inline(rises)).groupBy("feature").agg(
        F.avg("rise").alias("importance_mean"), F.stddev_pop("rise").alias("importance_std")
    )


def fill_most_frequent(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Missing categories become the most frequent training value (the smallest of several)."""
    for c in columns:
        top = train.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(1).collect()
        if top:
            train, test = (d.withColumn(c, F.coalesce(F.col(c), F.lit(top[0][c]))) for d in (train, test))
    return train, test


def feature_ablation(
    train: DataFrame, test: DataFrame, scenarios: Mapping[str, tuple[Sequence[str], Sequence[str]]],
    candidate: Candidate, target: str, row_id: str, seed: int = 42,
) -> DataFrame:
    """Metric rows of one estimator fitted on several feature sets ``{scenario: (numeric, categorical)}``, with the
    gains over the first scenario. Numbers are filled with the median but not scaled."""
    rows = None
    for position, (name, (numeric, categorical)) in enumerate(scenarios.items()):
        fit_rows, test_rows = fill_most_frequent(train, test, categorical)
        prep = fit_preprocessing(fit_rows, numeric, categorical, standardize=False)
        model = fit_model(fit_rows, candidate, numeric, categorical, target, row_id, seed, prep)
        found = regression_metrics(model.transform(test_rows), target, "prediction").select(
            F.lit(position).alias("position"), F.lit(name).alias("scenario"), "mae", "rmse", "r2"
        )
        rows = found if rows is None else rows.unionByName(found)
    return ablation_deltas(rows, next(iter(scenarios)))
