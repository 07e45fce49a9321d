"""Enrichment of fact rows with the attributes of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.functions.keys import with_normalized_key
from gaugemill.functions.numeric import numeric_column


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts (NULL keys count as equal)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, key: str) -> None:
    """Raise if a normalized dimension key occurs twice. Runs a job."""
    twice = duplicate_keys(with_normalized_key(df, key), [key]).limit(3).collect()
    if twice:
        raise ValueError(f"dimension keys are not unique: {key} = {[r[key] for r in twice]}")


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    check_unique: bool = False,
    normalize: bool = True,
) -> DataFrame:
    """Join ``dim`` onto ``fact`` on the normalized key; NULL keys match each other.

    No side is marked for broadcast: the planner broadcasts the dimension while its measured size stays
    below the session's threshold and otherwise shuffles, where adaptive execution splits a hot key of the
    fact side. A shuffled outer join that has to keep unmatched dimension rows cannot be split on the
    fact side, so ``right`` and ``full`` are put together from an inner or left join and the dimension rows whose key
    is not among the distinct fact keys.
    """
    if how not in ("left", "inner", "right", "full", "outer"):
        raise ValueError(f"unknown join mode {how!r}")
    if normalize:
        fact, dim = with_normalized_key(fact, key), with_normalized_key(dim, key)
    if check_unique:
        require_unique(dim, key)
    clash = (set(fact.columns) & set(dim.columns)) - {key}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    right = dim.withColumnRenamed(key, "__dim_key")
    kept = "left" if how in ("left", "full", "outer") else "inner"
    matched = fact.join(right, F.col(key).eqNullSafe(F.col("__dim_key")), kept).drop("__dim_key")
    if how in ("left", "inner"):
        return matched
    fact_keys = fact.select(F.col(key).alias("__fact_key")).distinct()
    rest = dim.join(fact_keys, F.col(key).eqNullSafe(F.col("__fact_key")), "left_anti")
    return matched.unionByName(rest, allowMissingColumns=True)


def fill_attributes(df: DataFrame, attributes: list[str]) -> DataFrame:
    """Attributes as doubles with 0.0 where the join found nothing."""
    present = set(attributes) & set(df.columns)
    return df.select(
        *(
            F.coalesce(numeric_column(df, c), F.lit(0.0)).alias(c) if c in present else F.col(c)
            for c in df.columns
        )
    )
