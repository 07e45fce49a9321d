"""Choosing among result rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_candidate(rows: DataFrame, position: str = "position") -> DataFrame:
    """The row with the lowest rmse, then lowest mae, then highest r2; the first listed wins a full tie."""
    return rows.orderBy("rmse", "mae", F.desc("r2"), position).limit(1)


def importance_topk(rows: DataFrame, n: int = 15, by: str = "importance_mean", tie: str = "feature", digits: int | None = None) -> DataFrame:
    """The ``n`` rows with the largest importance; equal ones by ``tie``.

    With ``digits`` importances are told and compared to so many decimals: differences below are left by the order in
    which a sum was added up, and change with the layout of the rows.
    """
    if digits is not None:
        rows = rows.withColumn(by, F.round(by, digits))
    return rows.orderBy(F.desc(by), tie).limit(n)


def ablation_deltas(rows: DataFrame, base: str, scenario: str = "scenario", by: Sequence[str] = ()) -> DataFrame:
    """Metric rows with their gain over the ``base`` scenario: lower MAE and RMSE and higher R² count as gain."""
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))  # one row per scenario

    def of_base(metric: str):
        return F.max(F.when(F.col(scenario) == base, F.col(metric))).over(group)

    return rows.select(
        "*",
        (of_base("mae") - F.col("mae")).alias("mae_improvement"),
        (of_base("rmse") - F.col("rmse")).alias("rmse_improvement"),
        (F.col("r2") - of_base("r2")).alias("r2_gain"),
    )
