"""Many logs in one job: ``by`` keys give exactly the per-log results."""

import pytest
from pyspark.sql import functions as F

from setbook.operators.staging import stage_journal
from setbook.plans import marts as M
from setbook.sources.journal import journal_for

from conftest import SF_SMALL, same_rows


@pytest.fixture(scope="module")
def logs(spark):
    a = journal_for(spark, SF_SMALL)
    # a second, shorter log (other first/last dates, other weekday years)
    b = a.where(F.col("date").between("2024-01-01", "2026-06-30")).withColumn(
        "amount", (F.col("amount") * 2).cast("smallint"))
    both = a.withColumn("athlete", F.lit("a")).unionByName(b.withColumn("athlete", F.lit("b")))
    return stage_journal(a), stage_journal(b), stage_journal(both, by=("athlete",))


@pytest.mark.parametrize("name", [n for n in M.MARTS if n not in ("stg_workout_journal", "main_exercises")])
def test_by_equals_separate_runs(logs, name):
    sa, sb, sboth = logs
    fn = M.MARTS[name]
    together = fn(sboth, by=("athlete",))
    assert together.columns[0] == "athlete"
    for key, single in (("a", sa), ("b", sb)):
        part = together.where(F.col("athlete") == key).drop("athlete")
        assert same_rows(part, fn(single)), (name, key)


def test_hot_log_is_spread_over_partitions(spark):
    """One log with a third of all rows: its month grid and change windows
    run on many partitions (keyed by log, exercise and weight), not one."""
    from setbook.sources.journal import journal_for
    j = journal_for(spark, SF_SMALL)
    hot = F.when(F.col("workout_counter") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("a"), (F.col("workout_counter") % 97).cast("string")))
    stg = stage_journal(j.withColumn("athlete", hot), by=("athlete",))
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        grid = M.mom_changes(stg, by=("athlete",))
        per_part = (grid.where(F.col("athlete") == "hot")
                        .groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    counts = sorted(r["count"] for r in per_part)
    assert len(counts) >= 4, counts                      # spread, not a single task
    assert counts[-1] < 0.5 * sum(counts), counts
