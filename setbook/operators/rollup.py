"""Additive rollups, distinct-session counts and conditional shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percentage
from .distinct import BITS, count_bits

# grain -> time columns of the output (in output order)
GRAINS = {
    "day": ("date",),
    "month": ("year", "month_int", "month"),
    "year": ("year",),
    "all": (),
}


def rollup_sum(df: DataFrame, grain: str, measure, name: str, keys=("exercise",),
               tail=("added_weight", "weight_unit"), where: Column | None = None,
               by=(), cast: str = "bigint") -> DataFrame:
    """SUM(measure) per (by, grain columns, keys, tail).

    Output columns: by, grain columns, keys, ``name``, tail — the order of
    the original marts (the measure sits between exercise and weight).
    Sums are BIGINT (the original SMALLINT overflows on real volumes).
    Spark plans a partial (map-side) aggregate before the shuffle, so a
    hot key costs one row per map task on the wire.
    """
    src = df.where(where) if where is not None else df
    group = [*by, *GRAINS[grain], *keys, *tail]
    m = F.col(measure) if isinstance(measure, str) else measure
    agg = src.groupBy(*group).agg(F.sum(m).cast(cast).alias(name))
    return agg.select(*by, *GRAINS[grain], *keys, name, *tail)


def count_sessions(df: DataFrame, keys, session_col: str = "workout_counter",
                   name: str = "total_workouts", by=()) -> DataFrame:
    """Exact COUNT(DISTINCT session_col) per (by, keys).

    Over rows it is planned as two aggregation phases keyed first by (keys,
    session) — so a hot group is spread over many tasks — then by keys; over
    a table of bitmaps (``plans.cubes.session_bits``) as their union.
    """
    group = [*by, *keys]
    if BITS in df.columns:
        return count_bits(df, group, name)
    return (df.groupBy(*group)
              .agg(F.count_distinct(session_col).cast("bigint").alias(name))
              .select(*group, name))


def share(df: DataFrame, keys, parts: dict, by=(), scale: int = 2,
          suffix: str = "_percentage", rows: str | None = None) -> DataFrame:
    """Conditional counts and their percentage of the counted total.

    ``parts`` maps a count name (e.g. ``bodyweight_sets``) to a predicate.
    Each percentage is count * 100 / (sum of all counts), exact decimal,
    NULL when the total is 0.  Output: by, keys, counts, percentages.
    ``rows`` names a row-count column when ``df`` is pre-aggregated.
    """
    group = [*by, *keys]
    if rows:
        counts = [F.coalesce(F.sum(F.when(p, F.col(rows))), F.lit(0)).cast("bigint").alias(n)
                  for n, p in parts.items()]
    else:
        counts = [F.count(F.when(p, F.lit(1))).cast("bigint").alias(n) for n, p in parts.items()]
    agg = df.groupBy(*group).agg(*counts)
    total = sum((F.col(n) for n in parts), F.lit(0))
    pct_cols = [percentage(F.col(n), total, scale).alias(n.rsplit("_", 1)[0] + suffix)
                for n in parts]
    return agg.select(*group, *parts.keys(), *pct_cols)
