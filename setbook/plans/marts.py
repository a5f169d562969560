"""The 29 named marts of the training log, as lazy DataFrame plans.

Each function takes the staged fact table (``stage_journal`` output) and
returns a DataFrame; marts that build on other marts call them directly,
so Catalyst always optimises one plan per requested mart.  ``by`` adds
extra leading grouping keys (e.g. an athlete id) to every group, window
and axis so many logs are processed in one job.

Sort order (``-`` = descending): the original tables are written in a fixed order, which a
table does not keep; ``SORT_KEYS`` records it and ``ordered()`` applies it
at read time.  No mart sorts globally.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import month_start

from ..functions.vocab import MAIN_EXERCISES, MONTH_AXIS_FLOOR
from ..operators.calendar import active_day_share, calendar_presence
from ..operators.change import period_change
from ..operators.classify import classify, is_reps_exercise, is_seconds_exercise, restrict_to
from ..operators.densify import fill_month_gaps, month_bounds
from ..operators.rank import top_ranked
from ..operators.rollup import count_sessions, rollup_sum, share

MONTH = ("year", "month_int", "month")


# ---- dimensions --------------------------------------------------------------

def main_exercises(stg: DataFrame, names=MAIN_EXERCISES, by=()) -> DataFrame:
    """One row per set of a listed exercise (not distinct, like the original)."""
    return stg.where(F.col("exercise").isin(*names)).select(*by, "exercise")


def exercises_calculated_in_reps(stg: DataFrame, by=()) -> DataFrame:
    return classify(stg, "exercise", is_reps_exercise(), by)


def exercises_calculated_in_seconds(stg: DataFrame, by=()) -> DataFrame:
    return classify(stg, "exercise", is_seconds_exercise(), by)


# ---- additive rollups (join with the exercise dimension == class filter) ----

def _sum(stg, grain, reps: bool, by):
    pred = is_reps_exercise() if reps else is_seconds_exercise()
    name = "total_reps" if reps else "total_seconds"
    return rollup_sum(restrict_to(stg, pred), grain, "amount", name, by=by)


def daily_reps_per_exercise_weight(stg, by=()):
    return _sum(stg, "day", True, by)


def daily_seconds_per_exercise_weight(stg, by=()):
    return _sum(stg, "day", False, by)


def monthly_reps_per_exercise_weight(stg, by=()):
    return _sum(stg, "month", True, by)


def monthly_seconds_per_exercise_weight(stg, by=()):
    return _sum(stg, "month", False, by)


def yearly_reps_per_exercise_weight(stg, by=()):
    return _sum(stg, "year", True, by)


def yearly_seconds_per_exercise_weight(stg, by=()):
    return _sum(stg, "year", False, by)


def total_reps_per_exercise_weight(stg, by=()):
    return _sum(stg, "all", True, by)


def total_seconds_per_exercise_weight(stg, by=()):
    return _sum(stg, "all", False, by)


def monthly_added_volume_lifted(stg, by=()):
    """Σ added_weight × amount over weighted sets of rep exercises (DECIMAL)."""
    src = stg.where(~F.col("bodyweight") & is_reps_exercise())
    agg = src.groupBy(*by, *MONTH, "exercise", "weight_unit").agg(
        F.sum(F.col("added_weight") * F.col("amount")).alias("total_added_volume"))
    return agg.select(*by, *MONTH, "exercise", "total_added_volume", "weight_unit")


# ---- dense month grid and period changes -----------------------------------

def monthly_aggregates_every_possible_combination(stg, by=(), floor=MONTH_AXIS_FLOOR,
                                                  corrected: bool = False):
    """Every month of the axis × every (exercise, added_weight) seen, zero filled.

    Axis: least(floor, first data month) .. last data month.  A cell's
    value is the month's rep total for rep exercises and 0 otherwise (the
    original joins the seconds totals but never reads them); with
    ``corrected`` seconds exercises carry their seconds total.  One
    aggregate of the facts, one exchange on (by, exercise, added_weight).
    """
    reps, secs = is_reps_exercise(), is_seconds_exercise()
    known = F.col("month_int").isNotNull()
    valued = (reps | secs) if corrected else reps
    unit_key = F.when(known & (reps | secs), F.col("weight_unit"))
    facts = (stg.groupBy(*by, "exercise", "added_weight", *MONTH, unit_key.alias("_unit"))
                .agg(F.sum("amount").cast("bigint").alias("_sum")))
    facts = facts.select(
        *by, *MONTH, "exercise",
        # the original's COALESCE(total, 0) / COALESCE(unit, 'kg') over the joined month totals
        F.coalesce(F.when(known & valued, F.col("_sum")), F.lit(0)).cast("bigint").alias("total_reps"),
        "added_weight",
        F.coalesce(F.when(known & valued, F.col("_unit")), F.lit("kg")).alias("weight_unit"))
    fill = {"total_reps": 0, "weight_unit": "kg"}
    if by:
        # each log's own axis: one bounds row per log, attached by a null-safe
        # equi-join (AQE broadcasts it when small, else a skew-split sort-merge
        # join); the grid stays partitioned on (log, exercise, weight), so a
        # hot log is spread over its entities instead of landing in one task
        bounds = stg.groupBy(*by).agg(
            F.least(F.lit(floor).cast("date"), F.min(month_start(F.col("date")))).alias("_lo"),
            F.max(month_start(F.col("date"))).alias("_hi"))
        b = bounds.select(*[F.col(k).alias(f"_b_{k}") for k in by], "_lo", "_hi")
        cond = None
        for k in by:
            c = facts[k].eqNullSafe(b[f"_b_{k}"])
            cond = c if cond is None else cond & c
        facts = facts.join(b, cond, "inner").drop(*[f"_b_{k}" for k in by])
        grid = fill_month_gaps(facts, ("exercise", "added_weight"), F.col("_lo"), F.col("_hi"), fill,
                               by=by, order_extra=("weight_unit",))
        return grid.drop("_generated", "_lo", "_hi")
    lo, hi = month_bounds(stg, "date", floor)
    grid = fill_month_gaps(facts, ("exercise", "added_weight"), lo, hi, fill, by=by,
                           order_extra=("weight_unit",))
    return grid.drop("_generated")


def _grid_key(by):
    return (*by, "exercise", "added_weight")


def mom_changes(stg, by=(), corrected: bool = False, grid=None):
    grid = grid if grid is not None else monthly_aggregates_every_possible_combination(
        stg, by, corrected=corrected)
    out = period_change(grid, _grid_key(by), ("year", "month_int"), "total_reps", 1,
                        "last_month_reps", "mom_percentage_change", "mom_absolute_change")
    return out.select(*by, *MONTH, "exercise", "last_month_reps", "total_reps", "added_weight",
                      "weight_unit", "mom_percentage_change", "mom_absolute_change")


def mom_changes_reps(stg, by=(), mom=None):
    """Rep exercises; a NULL % (first month, 0 -> 0) becomes -100.00."""
    mc = restrict_to(mom if mom is not None else mom_changes(stg, by), is_reps_exercise())
    return mc.withColumn("mom_percentage_change",
                         F.coalesce(F.col("mom_percentage_change"),
                                    F.lit(-100).cast("decimal(18,2)")))


def mom_changes_seconds(stg, by=(), corrected: bool = False, mom=None, grid=None):
    mc = mom if mom is not None else mom_changes(stg, by, corrected=corrected, grid=grid)
    mc = restrict_to(mc, is_seconds_exercise())
    return (mc.withColumnRenamed("last_month_reps", "last_month_seconds")
              .withColumnRenamed("total_reps", "total_seconds"))


def yoy_changes(stg, by=(), corrected: bool = False, grid=None):
    """Same month a year earlier (lag 12 on the dense grid, guarded by
    month_int); the absolute change is unguarded, as in the original."""
    grid = grid if grid is not None else monthly_aggregates_every_possible_combination(
        stg, by, corrected=corrected)
    out = period_change(grid, _grid_key(by), ("year", "month_int"), "total_reps", 12,
                        "last_year_reps", "yoy_percentage_change", "yoy_absolute_change",
                        guard="month_int", pct_rule="positive")
    return out.select(*by, *MONTH, "exercise", "last_year_reps", "total_reps", "added_weight",
                      "weight_unit", "yoy_percentage_change", "yoy_absolute_change")


def yoy_changes_reps(stg, by=(), yoy=None):
    return restrict_to(yoy if yoy is not None else yoy_changes(stg, by), is_reps_exercise())


def yoy_changes_seconds(stg, by=(), corrected: bool = False, yoy=None, grid=None):
    yc = yoy if yoy is not None else yoy_changes(stg, by, corrected=corrected, grid=grid)
    yc = restrict_to(yc, is_seconds_exercise())
    return (yc.withColumnRenamed("last_year_reps", "last_year_seconds")
              .withColumnRenamed("total_reps", "total_seconds"))


def mom_changes_seconds_corrected(stg, by=(), grid=None):
    return mom_changes_seconds(stg, by, corrected=True, grid=grid)


def yoy_changes_seconds_corrected(stg, by=(), grid=None):
    return yoy_changes_seconds(stg, by, corrected=True, grid=grid)


# ---- shares, sessions, ranking ----------------------------------------------

def _rows_col(stg):
    """Row-count column of a pre-aggregated input (``plans.cubes``), if any."""
    return "_rows" if "_rows" in stg.columns else None


def _split():
    return {
        "bodyweight_sets": F.col("added_weight") == 0,
        "weighted_sets": F.col("added_weight") > 0,
    }


def monthly_bodyweight_vs_weighted_workouts(stg, by=()):
    return share(stg, MONTH, _split(), by=by, rows=_rows_col(stg))


def yearly_bodyweight_vs_weighted_workouts(stg, by=()):
    return share(stg, ("year",), _split(), by=by, rows=_rows_col(stg))


def workouts_per_month_per_year(stg, by=()):
    return count_sessions(stg, MONTH, by=by)


def month_with_most_workouts_per_year(stg, by=()):
    monthly = count_sessions(stg, MONTH, by=by)
    return top_ranked(monthly, (*by, "year"), [F.col("total_workouts").desc()])


def workout_sessions_per_year(stg, by=()):
    return count_sessions(stg, ("year",), by=by)


def yearly_workouts_per_type(stg, by=()):
    return count_sessions(stg, ("year", "workout_type"), by=by)


# ---- calendars -----------------------------------------------------------------

def workout_vs_rest_days(stg, by=()):
    return calendar_presence(stg, "date", by=by)


def workout_days_per_year_percentage(stg, by=()):
    return active_day_share(stg, "date", "year", by=by)


def workout_frequency_weekday(stg, by=()):
    """(year axis × weekdays present) with distinct sessions, zero filled.

    Everything comes from one aggregate — the session counts per (log,
    year, weekday): its weekdays and year range define the axis, whose
    rows (count 0) are unioned with the counts and reduced with max() per
    cell — a left join without the join.  Counts with an unknown weekday
    never match an axis cell (as in the original join on weekday_int).
    """
    counted = count_sessions(stg, ("year", "weekday_int", "weekday"), by=by) \
        .withColumn("year", F.col("year").cast("int"))
    # one row per log with its cells (at most years x weekday texts): the
    # axis is made from it, and the journal is scanned once
    cell = F.struct(F.col("year"), F.col("weekday_int"), F.col("weekday"), F.col("total_workouts"))
    packed = counted.groupBy(*by).agg(F.collect_list(cell).alias("cells"), F.min("year").alias("lo"),
                                      F.max("year").alias("hi"))
    days = F.array_distinct(F.transform("cells", lambda x: F.struct(x["weekday_int"].alias("d"), x["weekday"].alias("t"))))
    zero = F.flatten(F.transform(F.sequence("lo", "hi"), lambda y: F.transform(days, lambda d: F.struct(
        y.alias("year"), d["d"].alias("weekday_int"), d["t"].alias("weekday"),
        F.lit(0).cast("bigint").alias("total_workouts")))))
    seen = F.filter("cells", lambda x: x["weekday_int"].isNotNull())
    cells = packed.where(F.col("lo").isNotNull()).select(*by, F.inline(F.concat(zero, seen)))
    return (cells.groupBy(*by, "year", "weekday_int", "weekday")
                 .agg(F.max("total_workouts").alias("total_workouts")))


# ---- registry ----------------------------------------------------------------------

def stg_workout_journal(stg, by=()):
    return stg


MARTS = {
    "stg_workout_journal": stg_workout_journal,
    "main_exercises": main_exercises,
    "exercises_calculated_in_reps": exercises_calculated_in_reps,
    "exercises_calculated_in_seconds": exercises_calculated_in_seconds,
    "daily_reps_per_exercise_weight": daily_reps_per_exercise_weight,
    "daily_seconds_per_exercise_weight": daily_seconds_per_exercise_weight,
    "monthly_reps_per_exercise_weight": monthly_reps_per_exercise_weight,
    "monthly_seconds_per_exercise_weight": monthly_seconds_per_exercise_weight,
    "yearly_reps_per_exercise_weight": yearly_reps_per_exercise_weight,
    "yearly_seconds_per_exercise_weight": yearly_seconds_per_exercise_weight,
    "total_reps_per_exercise_weight": total_reps_per_exercise_weight,
    "total_seconds_per_exercise_weight": total_seconds_per_exercise_weight,
    "monthly_aggregates_every_possible_combination": monthly_aggregates_every_possible_combination,
    "mom_changes": mom_changes,
    "mom_changes_reps": mom_changes_reps,
    "mom_changes_seconds": mom_changes_seconds,
    "yoy_changes": yoy_changes,
    "yoy_changes_reps": yoy_changes_reps,
    "yoy_changes_seconds": yoy_changes_seconds,
    "monthly_added_volume_lifted": monthly_added_volume_lifted,
    "monthly_bodyweight_vs_weighted_workouts": monthly_bodyweight_vs_weighted_workouts,
    "yearly_bodyweight_vs_weighted_workouts": yearly_bodyweight_vs_weighted_workouts,
    "workouts_per_month_per_year": workouts_per_month_per_year,
    "month_with_most_workouts_per_year": month_with_most_workouts_per_year,
    "workout_sessions_per_year": workout_sessions_per_year,
    "yearly_workouts_per_type": yearly_workouts_per_type,
    "workout_vs_rest_days": workout_vs_rest_days,
    "workout_days_per_year_percentage": workout_days_per_year_percentage,
    "workout_frequency_weekday": workout_frequency_weekday,
    "mom_changes_seconds_corrected": mom_changes_seconds_corrected,
    "yoy_changes_seconds_corrected": yoy_changes_seconds_corrected,
}

SORT_KEYS = {
    "daily_reps_per_exercise_weight": ["date"],
    "daily_seconds_per_exercise_weight": ["date"],
    "exercises_calculated_in_reps": ["exercise"],
    "exercises_calculated_in_seconds": ["exercise"],
    "monthly_reps_per_exercise_weight": ["year", "month_int", "exercise"],
    "monthly_seconds_per_exercise_weight": ["year", "month_int", "exercise"],
    "monthly_added_volume_lifted": ["year", "month_int", "exercise"],
    "yearly_reps_per_exercise_weight": ["year", "-total_reps"],
    "yearly_seconds_per_exercise_weight": ["year", "-total_seconds"],
    "total_reps_per_exercise_weight": ["-total_reps"],
    "total_seconds_per_exercise_weight": ["-total_seconds"],
    "yearly_workouts_per_type": ["year", "-total_workouts"],
    "workout_frequency_weekday": ["year", "-total_workouts"],
    "workout_vs_rest_days": ["date"],
    "workout_sessions_per_year": ["year"],
    "workout_days_per_year_percentage": ["year"],
    "yearly_bodyweight_vs_weighted_workouts": ["year"],
    "monthly_bodyweight_vs_weighted_workouts": ["year", "month_int"],
    "workouts_per_month_per_year": ["year", "month_int", "month"],
    "month_with_most_workouts_per_year": ["year", "month_int"],
}
for _k in ("monthly_aggregates_every_possible_combination", "mom_changes", "mom_changes_reps",
           "mom_changes_seconds", "yoy_changes", "yoy_changes_reps", "yoy_changes_seconds",
           "mom_changes_seconds_corrected", "yoy_changes_seconds_corrected"):
    SORT_KEYS[_k] = ["year", "month_int", "exercise", "added_weight"]


def ordered(name: str, df: DataFrame) -> DataFrame:
    """Apply the original table order at read time (a range shuffle)."""
    keys = SORT_KEYS.get(name)
    if not keys:
        return df
    return df.orderBy(*[F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys])


def positioned(name: str, df: DataFrame) -> DataFrame:
    """Add each row's ``position`` among the rows that share the first sort key."""
    first, *rest = SORT_KEYS[name]
    w = Window.partitionBy(first).orderBy(*[F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in rest])
    return df.withColumn("position", F.rank().over(w))
