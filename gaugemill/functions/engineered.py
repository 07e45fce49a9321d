"""Engineered ages, areas and ratios.

Two policies: ``zero`` (the one models are trained on) reads missing parts as 0 and gives 0 where a ratio
has no denominator; ``null`` leaves such values missing and does not clip ages.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-9


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _share(top: Column, bottom: Column) -> Column:
    return F.when(bottom > TINY, top / bottom).otherwise(F.lit(0.0))


def engineered_columns(part: Mapping[str, Column], reference_year: int, policy: str = "zero") -> dict[str, Column]:
    """Engineered columns by name, from already coerced double columns keyed by role."""
    year = F.lit(float(reference_year))
    built, renovated = part["built"], part["renovated"]
    if policy == "null":
        was_renovated = F.coalesce(renovated > 0, F.lit(False))
        total = part["above"] + part["basement"]
        return {
            "house_age": year - built,
            "renovated_flag": was_renovated.cast("int"),
            "renovation_age": F.when(was_renovated, year - renovated),
            "total_sqft": total,
            "living_to_lot_ratio": F.try_divide(part["living"], part["lot"]),
            "bath_bed_ratio": F.try_divide(part["bathrooms"], part["bedrooms"]),
            "basement_ratio": F.try_divide(part["basement"], total),
        }
    if policy != "zero":
        raise ValueError(f"unknown policy {policy!r}")
    renovated = _zero(renovated)
    was_renovated = (renovated > 0) & (renovated > _zero(built))
    basement = _zero(part["basement"])
    total = _zero(part["above"]) + basement
    return {
        # greatest() skips NULL, the age of an unknown year must stay NULL
        "house_age": F.when(built.isNotNull(), F.greatest(year - built, F.lit(0.0))),
        "renovated_flag": was_renovated.cast("int"),
        "renovation_age": F.when(was_renovated, F.greatest(year - renovated, F.lit(0.0))).otherwise(F.lit(0.0)),
        "total_sqft": total,
        "living_to_lot_ratio": _share(_zero(part["living"]), _zero(part["lot"])),
        "bath_bed_ratio": _zero(part["bathrooms"]) / F.greatest(_zero(part["bedrooms"]), F.lit(1.0)),
        "basement_ratio": _share(basement, total),
    }
