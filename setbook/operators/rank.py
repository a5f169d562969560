"""Top-ranked rows per group (ties kept)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_ranked(df: DataFrame, partition, order, keep: int = 1) -> DataFrame:
    """Rows whose RANK() within ``partition`` ordered by ``order`` is <= keep.

    ``order`` is a list of Columns (e.g. ``F.desc('total_workouts')``).
    Catalyst inserts a WindowGroupLimit below the window, so each task
    keeps only the leading rows per group before the final rank.
    """
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).where(F.col("_rk") <= keep).drop("_rk")
