"""Feature building: one projection over the joined rows, the same for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugemill.contracts import FeatureContract
from gaugemill.functions.engineered import engineered_columns
from gaugemill.functions.keys import clean_key_text, key_bucket, prediction_key
from gaugemill.functions.numeric import numeric_column


def drop_metadata(df: DataFrame, contract: FeatureContract) -> DataFrame:
    """Rows without id, date and target; columns that are not there are no matter."""
    return df.drop(*contract.metadata)


def features_and_target(df: DataFrame, contract: FeatureContract) -> DataFrame:
    """Features with the target as last column; raises if there is no target."""
    if contract.target not in df.columns:
        raise ValueError(f"no target column {contract.target!r}")
    inputs = drop_metadata(df, contract).columns
    return df.select(*(c for c in inputs if c != contract.target), contract.target)


def build_features(
    df: DataFrame,
    contract: FeatureContract,
    keep: Sequence[str] = (),
    reference_year: int | None = None,
    policy: str = "zero",
    fill_attributes: bool = True,
) -> DataFrame:
    """Model-ready columns in contract order, after the ``keep`` columns (row id, target).

    Everything is one ``select`` of built-in expressions, so it folds into the scan or join below it.
    """
    needed = {*contract.numeric, *contract.categorical, *contract.roles.values()}
    if fill_attributes:
        needed |= set(contract.attributes)
    absent = [c for c in (*contract.final, *contract.roles.values()) if c in needed and c not in df.columns]
    if absent:
        raise ValueError(f"missing columns for the feature contract: {sorted(set(absent))}")

    part = {role: numeric_column(df, c) for role, c in contract.roles.items()}
    year = contract.reference_year if reference_year is None else reference_year
    out = engineered_columns(part, year, policy)
    out |= {c: numeric_column(df, c) for c in contract.numeric}
    out |= {c: F.col(c) for c in contract.categorical if c not in contract.numeric}
    for c in contract.attributes:
        value = numeric_column(df, c)
        out[c] = F.coalesce(value, F.lit(0.0)) if fill_attributes else value
    if contract.key in df.columns:
        out[contract.key] = clean_key_text(F.col(contract.key))
        out |= dict(zip(contract.geo, (key_bucket(out[contract.key]), F.lit(0)), strict=False))
    return df.select(*keep, *(out[c].alias(c) for c in contract.final))


def to_contract(df: DataFrame, contract: FeatureContract, keep: Sequence[str] = ()) -> DataFrame:
    """Contract order with absent columns as NULL and the key as text for the fitted encoder."""
    have = set(df.columns)
    ordered = df.select(
        *keep, *(F.col(c) if c in have else F.lit(None).cast("double").alias(c) for c in contract.final)
    )
    if contract.key not in contract.final:
        return ordered
    return ordered.withColumn(contract.key, prediction_key(F.col(contract.key)))


def expand_minimal(df: DataFrame, contract: FeatureContract, defaults: dict) -> DataFrame:
    """Complete minimal rows to all fact columns; text defaults copy another column."""
    filled = {
        c: F.col(v).cast("double") if isinstance(v, str) else F.lit(v)
        for c, v in defaults.items()
    }
    columns = contract.inference_columns
    absent = [c for c in columns if c not in filled and c not in df.columns]
    if absent:
        raise ValueError(f"minimal rows lack {absent}")
    extra = [c for c in df.columns if c not in columns]
    return df.select(*extra, *(filled[c].alias(c) if c in filled else F.col(c) for c in columns))


def require_columns(df: DataFrame, columns: Sequence[str], context: str) -> None:
    """Raise if columns are missing; reads the schema only."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"{context}: missing columns: {absent}")
