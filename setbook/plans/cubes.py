"""Shared pre-aggregates: compute once, derive most marts from them.

Every additive or distinct-count mart needs only a few journal columns at
a coarser grain than one row per set.  Two cubes cover all of them:

* ``day_cube``     — Σ amount and the row count per (by, date, month text,
  exercise, added_weight, weight_unit): feeds the day / month / year /
  all-time sums, the dense month grid (and through it MoM / YoY), the
  added volume (Σ w·a = w·Σa inside a group of equal w), the bodyweight
  split (Σ rows) and the exercise dimensions.
* ``session_bits`` — bitmaps of session numbers per (by, year, month text,
  weekday text, workout_type): every distinct-session count is a union of
  them (``operators.distinct``), so month, year, weekday and type counts and
  the busiest-month ranking come from one table.  The calendars read the
  distinct days of the day cube.

Both are staged-fact shaped (``year``/``month_int``/``weekday_int``/
``bodyweight`` re-derived exactly as staging does), so the mart functions
run on them unchanged.  Each cube is one partially-aggregated shuffle of
the journal; written once, they replace a full journal scan per mart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_number, weekday_number
from ..operators.distinct import BITS, WORD, number_bits

DAY_MARTS = (
    "exercises_calculated_in_reps", "exercises_calculated_in_seconds",
    "daily_reps_per_exercise_weight", "daily_seconds_per_exercise_weight",
    "monthly_reps_per_exercise_weight", "monthly_seconds_per_exercise_weight",
    "yearly_reps_per_exercise_weight", "yearly_seconds_per_exercise_weight",
    "total_reps_per_exercise_weight", "total_seconds_per_exercise_weight",
    "monthly_aggregates_every_possible_combination", "monthly_added_volume_lifted",
    "monthly_bodyweight_vs_weighted_workouts", "yearly_bodyweight_vs_weighted_workouts",
    "_grid_corrected", "workout_vs_rest_days", "workout_days_per_year_percentage",
)
COUNT_MARTS = (
    "workouts_per_month_per_year", "month_with_most_workouts_per_year",
    "workout_sessions_per_year", "yearly_workouts_per_type", "workout_frequency_weekday",
)
# what the cube of single sessions serves: the same counts, and the calendars
SESSION_MARTS = (*COUNT_MARTS, "workout_vs_rest_days", "workout_days_per_year_percentage")


def day_cube(stg: DataFrame, by=()) -> DataFrame:
    agg = stg.groupBy(*by, "date", "month", "exercise", "added_weight", "weight_unit").agg(
        F.sum("amount").cast("bigint").alias("amount"), F.count(F.lit(1)).alias("_rows"))
    return agg.select(
        *by, "date", F.year("date").cast("smallint").alias("year"), "month",
        month_number("month").alias("month_int"), "exercise", "added_weight", "weight_unit",
        F.coalesce(F.col("added_weight") == 0, F.lit(False)).alias("bodyweight"), "amount", "_rows")


def session_cube(stg: DataFrame, by=()) -> DataFrame:
    """One row per session, with its date: where single sessions are wanted rather than their counts."""
    d = stg.select(*by, "date", "month", "weekday", "workout_type", "workout_counter").distinct()
    return d.select(
        *by, "date", F.year("date").cast("smallint").alias("year"), "month",
        month_number("month").alias("month_int"), "weekday", weekday_number("weekday").alias("weekday_int"),
        "workout_type", "workout_counter")


def session_bits(stg: DataFrame, by=()) -> DataFrame:
    keys = (*by, "year", "month", "weekday", "workout_type")
    d = number_bits(stg, keys, "workout_counter")
    return d.select(
        *by, "year", "month", month_number("month").alias("month_int"), "weekday",
        weekday_number("weekday").alias("weekday_int"), "workout_type", WORD, BITS)
