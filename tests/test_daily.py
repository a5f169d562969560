"""The daily job end to end on the table-derived workbook."""

import tempfile

from setbook.plans.daily import main
from setbook.sources.cells import cells_from_tables
from setbook.sources.journal import read_journal
from setbook.sources.versions import published

from cells_journal import journal_from_cells_fixture
from conftest import SF_SMALL


def test_daily_job(spark):
    root = tempfile.mkdtemp(prefix="setbook-daily-")
    cells_from_tables(spark, SF_SMALL).write.parquet(f"{root}/cells")
    main(["--cells", f"{root}/cells", "--journal", f"{root}/journal", "--marts", f"{root}/marts",
          "--report", f"{root}/report"])
    from conftest import same_rows
    journal = read_journal(spark, f"{root}/journal")
    assert same_rows(journal, journal_from_cells_fixture(spark, SF_SMALL))
    report = {r.rule: r.violations for r in spark.read.parquet(published(spark, f"{root}/report")).collect()}
    assert all(v == 0 for v in report.values()), report
    assert spark.read.parquet(published(spark, f"{root}/marts/mom_changes_reps")).count() > 0
    assert spark.read.parquet(published(spark, f"{root}/marts/workout_vs_rest_days")).count() > 0


def test_year_partitions_prune(spark):
    root = tempfile.mkdtemp(prefix="setbook-years-")
    from setbook.sources.journal import journal_for, write_journal
    write_journal(journal_for(spark, SF_SMALL), f"{root}/j", partition_by_year=True)
    df = read_journal(spark, f"{root}/j", years=[2024])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert {r.date.year for r in df.select("date").distinct().collect()} == {2024}
    assert len(df.columns) == 14


def test_daily_job_per_workbook(spark):
    """Many logs: the journal keeps workbook_id and every mart is per workbook."""
    from pyspark.sql import functions as F
    from setbook.operators.staging import stage_journal
    from setbook.plans import marts as M
    root = tempfile.mkdtemp(prefix="setbook-daily-wb-")
    cells_from_tables(spark, SF_SMALL).write.parquet(f"{root}/cells")
    main(["--cells", f"{root}/cells", "--journal", f"{root}/journal", "--marts", f"{root}/marts",
          "--per-workbook"])
    journal = read_journal(spark, f"{root}/journal", keys=("workbook_id",))
    assert journal.select("workbook_id").distinct().count() > 100
    built = spark.read.parquet(published(spark, f"{root}/marts/workout_sessions_per_year"))
    lazy = M.workout_sessions_per_year(stage_journal(journal, by=("workbook_id",)), by=("workbook_id",))
    from conftest import same_rows
    assert "workbook_id" in built.columns and same_rows(built, lazy)
    one = journal.select("workbook_id").first()[0]
    single = M.mom_changes_reps(stage_journal(journal.where(F.col("workbook_id") == one).drop("workbook_id")))
    per_log = spark.read.parquet(published(spark, f"{root}/marts/mom_changes_reps")).where(F.col("workbook_id") == one) \
        .drop("workbook_id")
    assert same_rows(per_log, single)


CELLS = [  # one session: month, header, section, headers, sets
    (0, 0, "May", None), (1, 0, None, 45413.0), (1, 1, "", None), (1, 2, "Wednesday", None), (1, 3, "Pull", None),
    (1, 4, "7/365", None), (2, 0, "Pull", None)]


def cells_with(sets, mode=None, sheet="2024", workbook=1 << 40):
    rows = CELLS + [(3 + i, c, None if isinstance(v, float) else v, v if isinstance(v, float) else None)
                    for i, s in enumerate(sets) for c, v in enumerate(s)]
    return [(workbook, sheet, r + 1, c, sv, nv, mode) for r, c, sv, nv in rows]


def run_ingest(spark, root, cells, **kw):
    from setbook.plans.daily import ingest
    from setbook.sources.cells import CELLS_SCHEMA
    path = tempfile.mkdtemp(prefix="setbook-cells-")
    spark.createDataFrame(cells, CELLS_SCHEMA).write.mode("overwrite").parquet(path)
    ingest(spark, path, f"{root}/j", **kw)
    return read_journal(spark, f"{root}/j").collect()


def test_bad_rows_never_reach_the_journal(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="setbook-bad-")
    sets = [("Dips", "10kg", "wide", 5.0, 60.0), ("Dips", "red band", "wide", 5.0, 60.0),
            ("Dips", "2.125kg", "wide", "7.5", 60.0), ("Dips", "10dkg", "wide", 6.0, 60.0), ("Rows", "2.125kg", "wide", 9.0, 60.0)]
    rows = run_ingest(spark, root, cells_with(sets), report_path=f"{root}/report", per_workbook=True)
    assert sorted((r.exercise, str(r.weight), r.amount) for r in rows) == [("dips", "10.00", 5), ("rows", "2.12", 9)]
    assert spark.read.parquet(published(spark, f"{root}/j_rejected")).count() == 3
    report = {(r.workbook_id, r.rule): r.violations for r in spark.read.parquet(published(spark, f"{root}/report")).collect()}
    assert report[1 << 40, "not_null_weight"] == 2 and report[1 << 40, "not_null_amount"] == 1
    with pytest.raises(ValueError):
        run_ingest(spark, root, cells_with(sets[1:2]), on_bad="fail")
    assert len(read_journal(spark, f"{root}/j").collect()) == 2


def test_date_mode_of_the_cells_is_used(spark):
    import datetime as dt
    root = tempfile.mkdtemp(prefix="setbook-1904-")
    one = [("Dips", "10kg", "wide", 5.0, 60.0)]
    assert run_ingest(spark, root, cells_with(one, 1))[0].date == dt.date(2028, 5, 2)
    assert run_ingest(spark, root, cells_with(one, 0))[0].date == dt.date(2024, 5, 1)
    assert run_ingest(spark, root, cells_with(one), date_mode=1)[0].date == dt.date(2028, 5, 2)


def test_failed_refresh_leaves_the_old_rows(spark):
    import pytest
    from pyspark.sql import functions as F
    from setbook.sources.journal import journal_for, write_journal
    root = tempfile.mkdtemp(prefix="setbook-fail-")
    good = journal_for(spark, SF_SMALL)
    write_journal(good, f"{root}/j")
    n = read_journal(spark, f"{root}/j").count()
    broken = good.withColumn("grip", F.when(F.col("amount") > 40, F.raise_error(F.lit("disk lost"))).otherwise(F.col("grip")))
    with pytest.raises(Exception, match="disk lost"):
        write_journal(broken, f"{root}/j")
    assert read_journal(spark, f"{root}/j").count() == n == 6000
    for k in range(3):
        write_journal(good.limit(10 + k), f"{root}/j")
    assert read_journal(spark, f"{root}/j").count() == 12
