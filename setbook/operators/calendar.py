"""Calendars: presence of activity per calendar day, active-day shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import padded_month_name, year_length, year_start
from ..functions.numeric import percentage


def calendar_presence(df: DataFrame, date_col: str = "date", by=()) -> DataFrame:
    """Every day from 1 January of the first active year to the last active
    day, flagged ``rest`` = no row of ``df`` on that day.

    The distinct days come first (combined map-side, one row per day and
    task); every active day then generates the rest days up to the next one,
    and the first one those since 1 January.  One scan, no join; the window
    sees one row per active day of a log.
    """
    days = df.select(*by, F.col(date_col).alias("date")).where(F.col("date").isNotNull()).distinct()
    w = Window.partitionBy(*by).orderBy("date")
    until = F.coalesce(F.date_sub(F.lead("date").over(w), 1), F.col("date"))
    since = F.when(F.lag("date").over(w).isNull(), year_start(F.col("date"))).otherwise(F.col("date"))
    gaps = days.select(*by, "date", since.alias("since"), until.alias("until"))
    flagged = gaps.select(*by, F.col("date").alias("active"),
                          F.explode(F.sequence("since", "until", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return flagged.select(
        *by,
        F.year("date").cast("smallint").alias("year"),
        F.month("date").cast("smallint").alias("month_int"),
        padded_month_name(F.col("date")).alias("month"),
        F.col("date"),
        (F.col("date") != F.col("active")).alias("rest"),
    )


def active_day_share(df: DataFrame, date_col: str = "date", year_col: str = "year",
                     by=()) -> DataFrame:
    """Per year with at least one active day: days in the year, active days,
    and active / rest shares in percent of the full year.

    Active days are exactly the distinct dates of ``df`` (the calendar's
    non-rest days), so the calendar itself is not materialised.
    """
    per_year = df.groupBy(*by, year_col).agg(
        F.count_distinct(date_col).cast("bigint").alias("workout_days"))
    total = year_length(F.col(year_col))
    return per_year.select(
        *by,
        F.col(year_col).alias("year"),
        total.cast("bigint").alias("total_days"),
        F.col("workout_days"),
        percentage(F.col("workout_days"), total).alias("workout_percentage"),
        percentage(total - F.col("workout_days"), total).alias("rest_percentage"),
    )
