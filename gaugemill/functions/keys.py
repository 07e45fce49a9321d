"""Join-key normalization as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\r\f\x0b"
KEY_WIDTH = 5


def _padded(digits: Column) -> Column:
    # lpad also cuts, so the width is never below the length at hand
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(KEY_WIDTH)), F.lit("0"))


def _text_key(c: Column) -> Column:
    """Strip blanks, then double, then single quotes; pad plain numbers with zeros."""
    bare = F.btrim(F.btrim(F.btrim(c, F.lit(BLANKS)), F.lit('"')), F.lit("'"))
    whole = F.ltrim(F.split_part(bare, F.lit("."), F.lit(1)), F.lit("0"))
    return F.when(bare.rlike(r"^([0-9]+\.?[0-9]*|\.[0-9]+)$"), _padded(whole)).otherwise(bare)


def normalize_key(c: Column, dtype: T.DataType) -> Column:
    """Five-digit text form of a key held as text or as any number; missing stays missing."""
    if isinstance(dtype, T.StringType):
        return _text_key(c)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = F.when(~F.isnan(c), c)
    whole = c.try_cast("long")
    text = whole.cast("string")
    return F.when(whole < 0, text).otherwise(_padded(text))


def with_normalized_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``key`` normalized; unchanged if the column is absent."""
    if key not in df.columns:
        return df
    return df.withColumn(key, normalize_key(F.col(key), df.schema[key].dataType))


def clean_key_text(c: Column) -> Column:
    """Drop all double quotes and outer blanks, without padding."""
    return F.btrim(F.replace(c.cast("string"), F.lit('"'), F.lit("")), F.lit(BLANKS))


def prediction_key(c: Column) -> Column:
    """Key as the fitted encoder expects it: missing becomes the empty text."""
    return clean_key_text(F.coalesce(c.cast("string"), F.lit("")))


def key_bucket(c: Column, buckets: int = 1000) -> Column:
    """Whole part of the key modulo ``buckets``; anything that is not a number counts as 0."""
    from gaugemill.functions.numeric import to_double

    number = to_double(F.replace(c.cast("string"), F.lit('"'), F.lit("")), T.StringType())
    return F.pmod(F.coalesce(number.try_cast("long"), F.lit(0)), F.lit(buckets)).cast("int")
