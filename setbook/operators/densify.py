"""Gap filling: dense month grids and year x category grids.

No cross joins: the month axis is generated per entity with
``explode(sequence(lo, hi, 1 month))`` where ``lo``/``hi`` are global
bounds computed as scalar subqueries (one tiny aggregate, merged by
Catalyst) or, for many logs, one bounds row per log attached by key.  The grid is hash-partitioned once on the entity key; the
"is this month already present?" test is a window over that partition, so
no join is needed either, and later windows on the same key (period
changes) reuse the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_name, month_start

GEN = "_generated"


def fill_month_gaps(facts: DataFrame, entity, lo: Column, hi: Column,
                    fill: dict, by=(), order_extra=(), partition=None) -> DataFrame:
    """Add one row per (by, entity, month in [lo, hi]) that has no fact row.

    ``facts`` has columns (by, entity, year, month_int, month, ...); rows
    whose ``month_int`` is NULL never cover a month.  Generated rows get
    ``year``/``month_int``/``month`` from the axis and the literals in
    ``fill`` for the other columns.  ``lo``/``hi`` may be literals, scalar
    subqueries or columns of ``facts`` (per-log bounds).  Result: facts ∪
    missing rows, with a boolean ``_generated`` column, hash-partitioned on
    ``partition`` (default (by, entity); any subset of it also serves the
    windows here and the period-change windows downstream).

    Every entity generates the axis exactly once: the first fact row of
    the entity (row_number over the entity partition) carries the month
    sequence, so the facts are read once and nothing is joined.
    """
    key = [*by, *entity]
    cols = [c for c in facts.columns]
    facts = facts.repartition(*(partition or key))
    w_first = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last()
                                                 for c in ("year", "month_int", *order_extra)])
    # bounds are bound to columns after the entity sort, so per-log window
    # bounds (partitioned by a prefix of the entity key) reuse that sort
    marked = (facts.withColumn("_first", F.row_number().over(w_first) == 1)
                   .withColumn("_axis_lo", lo).withColumn("_axis_hi", hi))
    # element NULL = "this fact row itself"; a date = "generated row for that month"
    axis = F.sequence(F.col("_axis_lo"), F.col("_axis_hi"), F.expr("INTERVAL 1 MONTH"))
    slots = F.when(F.col("_first"), F.concat(F.array(F.lit(None).cast("date")), axis)) \
             .otherwise(F.array(F.lit(None).cast("date")))
    exploded = marked.select(*cols, F.explode(slots).alias("_m"))
    gen = F.col("_m").isNotNull()
    out = []
    for c in cols:
        if c == "year":
            v = F.when(gen, F.year("_m").cast("smallint")).otherwise(F.col(c))
        elif c == "month_int":
            v = F.when(gen, F.month("_m").cast("smallint")).otherwise(F.col(c))
        elif c == "month":
            v = F.when(gen, month_name("_m")).otherwise(F.col(c))
        elif c in fill:
            v = F.when(gen, F.lit(fill[c])).otherwise(F.col(c))
        else:
            v = F.col(c)
        out.append(v.alias(c))
    rows = exploded.select(*out, gen.alias(GEN))
    # a generated month is covered when a fact row of the entity has the
    # same (year, month_int): facts sort just before it (generated last)
    # same leading order as later (year, month_int) windows -> they reuse this sort
    w_cover = Window.partitionBy(*key).orderBy(
        F.col("year").asc_nulls_last(), F.col("month_int").asc_nulls_last(), F.col(GEN).asc())
    prev_y = F.lag("year").over(w_cover)
    prev_m = F.lag("month_int").over(w_cover)
    prev_g = F.lag(GEN).over(w_cover)
    covered = (F.col(GEN) & (prev_y == F.col("year")) & (prev_m == F.col("month_int"))
               & ~prev_g)
    return rows.withColumn("_covered", F.coalesce(covered, F.lit(False))) \
               .where(~F.col("_covered")).drop("_covered")


def month_bounds(df: DataFrame, date_col: str = "date", floor: str | None = None):
    """(lo, hi) month-start DATE columns as scalar subqueries over ``df``.

    lo = least(floor, first data month) — NULL bounds are skipped by
    ``least``; hi = last data month.  An empty input gives NULL -> no axis.
    """
    b = df.agg(F.min(month_start(F.col(date_col))).alias("lo"),
               F.max(month_start(F.col(date_col))).alias("hi"))
    lo = b.select("lo").scalar()
    hi = b.select("hi").scalar()
    if floor is not None:
        lo = F.least(F.lit(floor).cast("date"), lo)
    return lo, hi

