"""Numeric coercion: unreadable text, NaN and missing all become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_double(c: Column, dtype: T.DataType) -> Column:
    """Double value of a column, or NULL. ``12d`` and ``1f`` are not numbers, ``inf`` is one."""
    if isinstance(dtype, T.StringType):
        readable = F.when(~c.rlike(r"[0-9.][dDfF]\s*$"), c)
        # a CASE on isnan would read the text twice
        return F.nullif(readable.try_cast("double"), F.lit(float("nan")))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def numeric_column(df: DataFrame, name: str) -> Column:
    """Coerced value of column ``name`` of ``df``."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.expr(f"CASE WHEN NOT isnan(`{name}`) THEN CAST(`{name}` AS DOUBLE) END")
    return to_double(F.col(name), dtype)


def missing(df: DataFrame, name: str) -> Column:
    """True where a value is NULL or NaN."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def log_target(c: Column, mode: str) -> Column:
    """Target as the model is fitted on it."""
    return {"plain": c, "log1p": F.log1p(c)}[mode]


def unlog_prediction(c: Column, mode: str) -> Column:
    """Prediction back in target units."""
    return {"plain": c, "log1p": F.expm1(c)}[mode]


def relative_shift(current: Column, base: Column) -> Column:
    """Distance of two means relative to the first sample's."""
    return F.abs(current - base) / (F.abs(base) + F.lit(1e-9))
