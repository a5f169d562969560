"""Display-unit conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vocab import LBS_PER_KG


def convert_unit(df: DataFrame, col: str = "added_weight", unit: str = "kg",
                 factor: float = LBS_PER_KG) -> DataFrame:
    """Add ``display_weight`` / ``display_unit``: kg as stored, or lbs =
    round(kg * factor, 2) in exact decimal arithmetic."""
    if unit == "kg":
        w = F.col(col)
    elif unit == "lbs":
        w = F.round(F.col(col) * F.lit(factor).cast("decimal(10,4)"), 2)
    else:
        raise ValueError(f"unknown unit {unit!r}")
    return df.withColumn("display_weight", w.cast("decimal(10,2)")) \
             .withColumn("display_unit", F.lit(unit))
