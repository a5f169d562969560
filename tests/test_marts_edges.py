"""Hand-made edge rows (FIXTURES.md §4) through the marts."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import journal_row as J
from setbook.plans import marts as M


def rows_by(df, *keys):
    if len(keys) == 1:
        return {r[keys[0]]: r for r in df.collect()}
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_mom_first_month_gaps_and_zero_rules(make_stg):
    # months 2021-01 .. 2021-05 on the axis (floor 2021-01); data: 2021-02: 0 rows (gap),
    # 2021-03: 5 reps, 2021-04: gap, 2021-05: 7 reps.  Axis starts at the 2021-01 floor.
    stg = make_stg([J("2021-03-10", amount=5), J("2021-05-02", amount=7)])
    mc = rows_by(M.mom_changes(stg), "year", "month_int")
    assert set(mc) == {(2021, m) for m in range(1, 6)}
    first = mc[(2021, 1)]
    assert first.last_month_reps is None and first.mom_percentage_change is None
    assert first.mom_absolute_change == 0
    assert mc[(2021, 2)].mom_percentage_change is None            # 0 -> 0
    assert mc[(2021, 3)].mom_percentage_change == Decimal("100")  # 0 -> 5
    assert mc[(2021, 3)].mom_absolute_change == 5
    assert mc[(2021, 4)].mom_percentage_change == Decimal("-100")  # 5 -> 0
    reps = rows_by(M.mom_changes_reps(stg), "year", "month_int")
    assert reps[(2021, 1)].mom_percentage_change == Decimal("-100.00")
    assert reps[(2021, 2)].mom_percentage_change == Decimal("-100.00")


def test_yoy_first_twelve_months_and_guard(make_stg):
    stg = make_stg([J("2021-01-05", amount=4), J("2022-01-07", amount=6)])
    yc = rows_by(M.yoy_changes(stg), "year", "month_int")
    assert len(yc) == 13
    assert yc[(2021, 1)].last_year_reps is None and yc[(2021, 1)].yoy_percentage_change is None
    assert yc[(2021, 1)].yoy_absolute_change == 4          # absolute change is unguarded
    assert yc[(2022, 1)].last_year_reps == 4
    assert yc[(2022, 1)].yoy_percentage_change == Decimal("50.00")


def test_seconds_and_combo_exercises(make_stg):
    stg = make_stg([J("2021-01-05", exercise="plank (s)", amount=60),
                    J("2021-01-05", exercise="pull-ups + dips", amount=8),
                    J("2021-01-05", exercise="hang + plank (s)", amount=30),
                    J("2021-01-05", exercise="pull-ups", amount=10)])
    reps = {r.exercise for r in M.exercises_calculated_in_reps(stg).collect()}
    secs = {r.exercise for r in M.exercises_calculated_in_seconds(stg).collect()}
    assert reps == {"pull-ups"} and secs == {"plank (s)", "hang + plank (s)"}
    grid = rows_by(M.monthly_aggregates_every_possible_combination(stg), "exercise")
    assert grid["plank (s)"].total_reps == 0          # seconds never reach the grid (faithful)
    assert grid["pull-ups + dips"].total_reps == 0    # combos are in neither dimension
    assert grid["pull-ups"].total_reps == 10
    corrected = rows_by(M.mom_changes_seconds_corrected(stg), "exercise")
    assert corrected["plank (s)"].total_seconds == 60
    faithful = rows_by(M.mom_changes_seconds(stg), "exercise")
    assert faithful["plank (s)"].total_seconds == 0


def test_rank_ties_are_kept(make_stg):
    stg = make_stg([J("2022-01-03", counter=1), J("2022-02-07", counter=2), J("2022-03-07", counter=3),
                    J("2022-03-08", counter=4)])
    top = M.month_with_most_workouts_per_year(stg).collect()
    assert [r.month_int for r in top] == [3]
    stg2 = make_stg([J("2022-01-03", counter=1), J("2022-02-07", counter=2)])
    assert sorted(r.month_int for r in M.month_with_most_workouts_per_year(stg2).collect()) == [1, 2]


def test_year_share_rounding(make_stg, spark):
    import datetime as dt
    start = dt.date(2024, 1, 1)
    rows = [J(start + dt.timedelta(days=i)) for i in range(107)]
    share = M.workout_days_per_year_percentage(make_stg(rows)).collect()[0]
    assert (share.total_days, share.workout_days) == (366, 107)
    assert share.workout_percentage == Decimal("29.23") and share.rest_percentage == Decimal("70.77")
    rows = [J(start + dt.timedelta(days=i)) for i in range(290)]
    share = M.workout_days_per_year_percentage(make_stg(rows)).collect()[0]
    assert share.workout_percentage == Decimal("79.23")


def test_negative_weight_counts_in_neither_split(make_stg):
    stg = make_stg([J("2022-01-03", weight="-10.00")])
    r = M.monthly_bodyweight_vs_weighted_workouts(stg).collect()[0]
    assert (r.bodyweight_sets, r.weighted_sets) == (0, 0)
    assert r.bodyweight_percentage is None and r.weighted_percentage is None


def test_unknown_names_and_deload_domain(make_stg):
    stg = make_stg([J("2022-01-03", month="jan", deload=2)])
    r = stg.collect()[0]
    assert r.month_int is None and r.deload_bool is None and r.year == 2022


def test_weekday_matrix_only_trained_weekdays(make_stg):
    # 2022-01-03 is a monday, 2023-01-04 a wednesday
    stg = make_stg([J("2022-01-03", counter=1), J("2023-01-04", counter=1)])
    m = rows_by(M.workout_frequency_weekday(stg), "year", "weekday")
    assert set(m) == {(2022, "monday"), (2022, "wednesday"), (2023, "monday"), (2023, "wednesday")}
    assert m[(2022, "wednesday")].total_workouts == 0 and m[(2022, "monday")].total_workouts == 1


def test_rest_day_calendar(make_stg):
    stg = make_stg([J("2024-05-01"), J("2024-05-03")])
    cal = rows_by(M.workout_vs_rest_days(stg), "date")
    assert len(cal) == 31 + 29 + 31 + 30 + 3        # 1 January .. 3 May 2024
    import datetime as dt
    assert cal[dt.date(2024, 5, 1)].rest is False and cal[dt.date(2024, 5, 2)].rest is True
    assert cal[dt.date(2024, 5, 1)].month == "may      "


def test_empty_journal_gives_empty_marts(make_stg):
    stg = make_stg([])
    for name, fn in M.MARTS.items():
        assert fn(stg).count() == 0, name


def test_rollups_are_consistent(make_stg):
    stg = make_stg([J("2022-01-03", amount=5), J("2022-01-03", amount=6), J("2022-02-03", amount=7),
                    J("2023-02-03", amount=1, weight="10.00")])
    total = lambda df, c: df.agg(F.sum(c)).collect()[0][0]
    assert total(M.daily_reps_per_exercise_weight(stg), "total_reps") == 19
    assert total(M.monthly_reps_per_exercise_weight(stg), "total_reps") == 19
    assert total(M.yearly_reps_per_exercise_weight(stg), "total_reps") == 19
    assert total(M.total_reps_per_exercise_weight(stg), "total_reps") == 19
    vol = M.monthly_added_volume_lifted(stg).collect()
    assert [(r.year, r.total_added_volume) for r in vol] == [(2023, Decimal("10.00"))]


def test_grid_defaults_for_null_unit_and_amount(spark):
    from setbook.operators.staging import stage_journal
    from pyspark.sql import types as T
    from setbook.sources.journal import JOURNAL_SCHEMA
    loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in JOURNAL_SCHEMA.fields])
    a = list(J("2021-01-05", exercise="dips")); a[10] = None          # NULL unit
    b = list(J("2021-01-05", exercise="rows")); b[12] = None          # NULL amount
    stg = stage_journal(spark.createDataFrame([tuple(a), tuple(b)], loose))
    grid = rows_by(M.monthly_aggregates_every_possible_combination(stg), "exercise")
    assert (grid["dips"].total_reps, grid["dips"].weight_unit) == (10, "kg")
    assert (grid["rows"].total_reps, grid["rows"].weight_unit) == (0, "kg")


def test_semi_join_with_external_dimension(make_stg, spark):
    from setbook.operators.classify import semi_join
    stg = make_stg([J("2022-01-03", exercise="dips"), J("2022-01-04", exercise="rows"),
                    J("2022-01-05", exercise="dips")])
    dim = spark.createDataFrame([("dips",), ("squats",)], "exercise string")
    assert sorted(r.date.day for r in semi_join(stg, dim, "exercise").collect()) == [3, 5]


def test_dashboard_now(make_stg):
    import datetime as dt
    from setbook.plans.dashboard import dash_mom
    stg = make_stg([J("2021-03-10", exercise="dips"), J("2099-05-01", exercise="dips")])
    rows = dash_mom(stg, as_of=None, exercises=("dips",)).collect()
    today = dt.date.today()
    assert rows and all((r.year, r.month_int) <= (today.year, today.month) for r in rows)
