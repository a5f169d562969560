"""Materialised marts equal the lazily computed ones."""

import tempfile

from setbook.operators.staging import stage_journal
from setbook.plans import marts as M
from setbook.plans.build import build_marts, build_order, read_mart
from setbook.sources.journal import derive_journal, read_journal, write_journal

from conftest import SF_SMALL, same_rows


def test_build_order_puts_upstream_first():
    order = build_order(["mom_changes_reps", "yoy_changes"])
    assert order.index("monthly_aggregates_every_possible_combination") < order.index("mom_changes")
    assert order.index("mom_changes") < order.index("mom_changes_reps")


def test_build_matches_lazy_marts(spark):
    root = tempfile.mkdtemp(prefix="setbook-build-")
    write_journal(derive_journal(spark, SF_SMALL), f"{root}/journal", partition_by_year=True)
    journal = read_journal(spark, f"{root}/journal")
    names = ["mom_changes_reps", "yoy_changes_seconds", "workout_frequency_weekday",
             "daily_reps_per_exercise_weight"]
    paths = build_marts(spark, journal, f"{root}/marts", names)
    stg = stage_journal(journal)
    for n in names:
        built = read_mart(spark, paths, n)
        lazy = M.MARTS[n](stg)
        assert same_rows(built, lazy) and built.count() > 0, n
    ordered = read_mart(spark, paths, "daily_reps_per_exercise_weight", ordered=True).collect()
    assert [r.date for r in ordered] == sorted(r.date for r in ordered)


def test_cube_built_marts_equal_direct_marts(spark):
    """All marts built through the shared cubes equal the direct plans."""
    import tempfile as tf
    root = tf.mkdtemp(prefix="setbook-cubes-")
    write_journal(derive_journal(spark, SF_SMALL), f"{root}/journal")
    journal = read_journal(spark, f"{root}/journal")
    paths = build_marts(spark, journal, f"{root}/marts")
    stg = stage_journal(journal)
    for n in paths:
        built = read_mart(spark, paths, n)
        lazy = M.MARTS[n](stg)
        assert same_rows(built, lazy), n


def test_dashboard_reads_built_marts(spark):
    import tempfile as tf
    from setbook.plans import dashboard as D
    root = tf.mkdtemp(prefix="setbook-dash-")
    write_journal(derive_journal(spark, SF_SMALL), f"{root}/journal")
    journal = read_journal(spark, f"{root}/journal")
    paths = build_marts(spark, journal, f"{root}/marts",
                        ["mom_changes_reps", "yearly_reps_per_exercise_weight", "workout_frequency_weekday"])
    src = D.from_marts(spark, paths)
    stg = stage_journal(journal)
    ex = tuple(f"brand#{i}" for i in range(1, 10))
    pairs = [
        (D.dash_mom(None, exercises=ex, mom_reps=src["mom_reps"]), D.dash_mom(stg, exercises=ex)),
        (D.dash_yoy(None, exercises=ex, yearly_reps=src["yearly_reps"]), D.dash_yoy(stg, exercises=ex)),
        (D.dash_heatmap(None, weekday_matrix=src["weekday_matrix"]), D.dash_heatmap(stg)),
        (D.dash_filter(None, 10, exercises=ex, mom_reps=src["mom_reps"]), D.dash_filter(stg, 10, exercises=ex)),
    ]
    for built, lazy in pairs:
        assert built.count() == lazy.count() > 0
        assert built.exceptAll(lazy).count() == 0
    rows = D.ordered("dash_yearly_sorted", D.dash_yearly_sorted(stg, 2024, exercises=ex)).collect()
    keys = [(r.exercise, r.total_reps, r.display_weight) for r in rows]
    assert keys == sorted(keys)


def test_cube_built_marts_with_log_keys(spark):
    """Cubes + by keys: every mart built for two logs at once equals the direct per-log plan."""
    import tempfile as tf
    from pyspark.sql import functions as F
    from setbook.sources.journal import journal_for
    root = tf.mkdtemp(prefix="setbook-cubes-by-")
    j = journal_for(spark, SF_SMALL)
    both = j.withColumn("athlete", F.when(F.col("date") < "2025-01-01", F.lit("a")).otherwise(F.lit("b")))
    paths = build_marts(spark, both, f"{root}/marts", by=("athlete",))
    stg = stage_journal(both, by=("athlete",))
    for n, path in paths.items():
        built = spark.read.parquet(path)
        assert "athlete" in built.columns, n
        assert same_rows(built, M.MARTS[n](stg, by=("athlete",))), n
