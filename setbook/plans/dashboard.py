"""Presentation queries (the dashboard's reads and transforms) as DataFrames.

The exercise list, the weekday year bound, the display unit and the
selected weight / year are parameters; ``as_of`` None reads the clock, a
(year, month) makes a result reproducible.  All of them are filters and projections over marts;
Catalyst pushes the filters below the windows where the partition keys
allow it (exercise filters reach the grid aggregation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vocab import DASHBOARD_EXERCISES, HEATMAP_WEEKDAY_ORDER, LBS_PER_KG, WEEKDAY_YEAR_BOUND
from ..operators.units import convert_unit
from .marts import mom_changes_reps, workout_frequency_weekday, yearly_reps_per_exercise_weight

MOM_VIEW = ("year", "month_int", "month", "exercise", "added_weight", "last_month_reps",
            "total_reps", "mom_percentage_change", "mom_absolute_change")


def dash_mom(stg: DataFrame, as_of=None, exercises=DASHBOARD_EXERCISES,
             mom_reps: DataFrame | None = None) -> DataFrame:
    """Monthly changes of the listed exercises up to and including ``as_of``.

    ``mom_reps`` is the materialised ``mom_changes_reps`` table when reading
    from built marts (``stg`` is then unused)."""
    if as_of is None:          # "now", as the original reads the clock
        y, m = F.year(F.current_date()), F.month(F.current_date())
    else:
        y, m = (F.lit(v) for v in as_of)
    mc = mom_reps if mom_reps is not None else mom_changes_reps(stg)
    upto = (F.col("year") < y) | ((F.col("year") == y) & (F.col("month_int") <= m))
    return mc.where(upto & F.col("exercise").isin(*exercises)).select(*MOM_VIEW)


def dash_yoy(stg: DataFrame, as_of=None, exercises=DASHBOARD_EXERCISES,
             yearly_reps: DataFrame | None = None) -> DataFrame:
    """Yearly rep totals of the listed exercises up to ``as_of`` year."""
    yr = yearly_reps if yearly_reps is not None else yearly_reps_per_exercise_weight(stg)
    y = F.year(F.current_date()) if as_of is None else F.lit(as_of[0])
    return (yr.where((F.col("year") <= y) & F.col("exercise").isin(*exercises))
              .select("year", "exercise", "added_weight", "total_reps"))


def dash_weekday(stg: DataFrame, year_bound: int = WEEKDAY_YEAR_BOUND,
                 weekday_matrix: DataFrame | None = None) -> DataFrame:
    wf = weekday_matrix if weekday_matrix is not None else workout_frequency_weekday(stg)
    return wf.where(F.col("year") < year_bound)


def dash_units(stg: DataFrame, unit: str = "lbs", **kw) -> DataFrame:
    """Monthly view with display_weight / display_unit in the chosen unit."""
    return convert_unit(dash_mom(stg, **kw), "added_weight", unit)


def dash_weight_options(stg: DataFrame, unit: str = "lbs", **kw) -> DataFrame:
    """Distinct display weights (the weight selector), ascending."""
    return dash_units(stg, unit, **kw).select("display_weight").distinct()


def dash_year_options(stg: DataFrame, **kw) -> DataFrame:
    """Distinct years of the monthly view (the year selector)."""
    return dash_mom(stg, **kw).select("year").distinct()


def _display(weight_kg: float, unit: str):
    w = F.lit(str(weight_kg)).cast("decimal(5,2)")
    if unit == "lbs":
        w = F.round(w * F.lit(LBS_PER_KG).cast("decimal(10,4)"), 2)
    return w.cast("decimal(10,2)")


def dash_filter(stg: DataFrame, weight_kg: float, unit: str = "lbs", **kw) -> DataFrame:
    """Monthly view restricted to the selected weight (given in kg, compared
    in the display unit, as the selector lists display weights)."""
    return dash_units(stg, unit, **kw).where(F.col("display_weight") == _display(weight_kg, unit))


def dash_month_date(stg: DataFrame, weight_kg: float, unit: str = "lbs", **kw) -> DataFrame:
    """The filtered monthly view with a first-of-month ``date`` for the time axis."""
    return dash_filter(stg, weight_kg, unit, **kw).withColumn(
        "date", F.make_date(F.col("year"), F.col("month_int"), F.lit(1)))


def dash_yearly_sorted(stg: DataFrame, year: int, unit: str = "lbs", **kw) -> DataFrame:
    """Yearly totals of the selected year in display units; read it with
    ``ordered('dash_yearly_sorted', df)`` for the chart order."""
    return convert_unit(dash_yoy(stg, **kw), "added_weight", unit).where(F.col("year") == year)


def dash_bubble(stg: DataFrame, year: int, unit: str = "lbs", **kw) -> DataFrame:
    """Weight progression of the selected year: the monthly view in display
    units restricted to one year (x = month_int, y = display_weight, size =
    total_reps)."""
    return dash_units(stg, unit, **kw).where(F.col("year") == year)


def dash_heatmap(stg: DataFrame, year_bound: int = WEEKDAY_YEAR_BOUND,
                 weekday_matrix: DataFrame | None = None) -> DataFrame:
    """Σ total_workouts per (year, weekday) cell of the heat map, with the
    display position of the weekday (sunday first)."""
    cells = dash_weekday(stg, year_bound, weekday_matrix).groupBy("year", "weekday").agg(
        F.sum("total_workouts").cast("bigint").alias("total_workouts"))
    order = F.array(*[F.lit(d) for d in HEATMAP_WEEKDAY_ORDER])
    return cells.withColumn("weekday_position", F.array_position(order, F.col("weekday")).cast("int"))


def dash_heatmap_wide(stg: DataFrame, year_bound: int = WEEKDAY_YEAR_BOUND, years=None,
                      weekday_matrix: DataFrame | None = None) -> DataFrame:
    """The heat map as a table: one row a weekday in display order, one column a year.

    A pivot needs its columns before the query runs; ``years`` None finds
    them first with a query of its own over the matrix (one row a year).
    A weekday without a cell in a year has NULL there.
    """
    cells = dash_weekday(stg, year_bound, weekday_matrix)
    if years is None:
        years = sorted(r["year"] for r in cells.select("year").distinct().collect())
    order = F.array(*[F.lit(d) for d in HEATMAP_WEEKDAY_ORDER])
    wide = cells.groupBy("weekday").pivot("year", list(years)).agg(F.sum("total_workouts").cast("bigint"))
    return wide.select(F.array_position(order, F.col("weekday")).cast("int").alias("weekday_position"), "weekday",
                       *[F.col(f"`{y}`").alias(f"y{y}") for y in years])


DASHBOARD = {
    "dash_mom": dash_mom,
    "dash_yoy": dash_yoy,
    "dash_weekday": dash_weekday,
    "dash_units": dash_units,
    "dash_weight_options": dash_weight_options,
    "dash_year_options": dash_year_options,
    "dash_filter": dash_filter,
    "dash_month_date": dash_month_date,
    "dash_yearly_sorted": dash_yearly_sorted,
    "dash_bubble": dash_bubble,
    "dash_heatmap": dash_heatmap,
    "dash_heatmap_wide": dash_heatmap_wide,
}

DASH_SORT_KEYS = {
    "dash_weight_options": ["display_weight"],
    "dash_year_options": ["year"],
    "dash_yearly_sorted": ["exercise", "total_reps", "display_weight"],
    "dash_heatmap": ["year", "weekday_position"],
}


def from_marts(spark, paths: dict, fmt: str = "parquet") -> dict:
    """Keyword arguments that make the presentation queries read built marts
    (``plans.build.build_marts`` paths) instead of recomputing them."""
    read = lambda n: spark.read.format(fmt).load(paths[n])
    return {
        "mom_reps": read("mom_changes_reps"),
        "yearly_reps": read("yearly_reps_per_exercise_weight"),
        "weekday_matrix": read("workout_frequency_weekday"),
    }


def ordered(name: str, df: DataFrame) -> DataFrame:
    """Apply a presentation query's display order (a range shuffle, at read)."""
    keys = DASH_SORT_KEYS.get(name)
    return df.orderBy(*keys) if keys else df


def positioned(name: str, df: DataFrame) -> DataFrame:
    """Add each row's ``position`` in the display order.  For the option lists
    and the chart of one year: a handful of rows, bounded by the listed
    exercises and the distinct weights or years."""
    return df.withColumn("position", F.rank().over(Window.orderBy(*DASH_SORT_KEYS[name])))
