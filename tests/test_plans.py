"""Physical-plan properties that matter at scale."""

import pytest

from conftest import SF_SMALL
from setbook.plans import catalog

QUERIES = catalog.queries()


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_no_nested_loop_no_python(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas"):
        assert bad not in plan, f"{name}: {bad}"


def test_dimension_joins_become_filters(spark):
    plan = plan_text(QUERIES["daily_reps_per_exercise_weight"](spark, SF_SMALL))
    assert "Join" not in plan and "Contains(exercise" in plan


def test_month_grid_single_entity_exchange(spark):
    """Grid + change windows: one partial aggregate exchange and one
    exchange on (exercise, added_weight); no extra exchange for windows."""
    plan = plan_text(QUERIES["mom_changes_reps"](spark, SF_SMALL))
    # lines of scalar-subquery subtrees carry a ':' before their '+-' marker
    main = [ln for ln in plan.splitlines() if ":" not in ln.split("+-")[0]]
    assert sum("Exchange hashpartitioning" in ln for ln in main) == 2
    assert not any("Join" in ln for ln in main)


def test_registered_queries_scan_few_columns(spark):
    plan = plan_text(QUERIES["dash_yoy"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(exercise)" in plan and "StringContains(exercise,(s))" in plan
    assert "ReadSchema: struct<date:date,exercise:string,weight:decimal(5,2),weight_unit:string,amount:smallint>" in plan
    plan = plan_text(QUERIES["workout_vs_rest_days"](spark, SF_SMALL))
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<date:date>" in plan
    for name in ("workout_frequency_weekday", "daily_reps_per_exercise_weight", "yearly_workouts_per_type"):
        assert plan_text(QUERIES[name](spark, SF_SMALL)).count("FileScan") == 1, name


def test_filters_reach_the_scan(spark):
    from setbook.sources.journal import read_journal, write_journal, derive_journal
    import tempfile
    path = tempfile.mkdtemp(prefix="setbook-test-") + "/journal"
    write_journal(derive_journal(spark, SF_SMALL), path)
    from setbook.plans.dashboard import dash_yoy
    from setbook.operators.staging import stage_journal
    df = dash_yoy(stage_journal(read_journal(spark, path)), exercises=("brand#1",))
    plan = plan_text(df)
    assert "PushedFilters: [IsNotNull(exercise)" in plan, plan
    assert "StringContains(exercise,(s))" in plan, plan          # class predicate reaches parquet
    assert "ReadSchema: struct<date:date,exercise:string,weight:decimal(5,2),weight_unit:string," \
           "amount:smallint>" in plan, plan                       # 5 of 14 columns read


def test_refused_rows_work_out_each_rule_once(spark):
    """No filter repeats the rules and the columns they are made of, and names of days are looked up, not formatted."""
    plan = QUERIES["rejected_rows"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("CASE WHEN" in ln for ln in plan.splitlines() if ln.split("+- ")[-1].startswith("Filter"))
    assert "date_format" not in plan and plan.count("THEN 8192 ELSE") == 1
