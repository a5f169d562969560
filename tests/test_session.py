"""Checkpoint-folder policy."""

from setbook.session import checkpoint_dir, ensure_checkpoint_dir


def test_checkpoint_dir_is_set_in_local_mode(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and checkpoint_dir(spark) == d
    assert ensure_checkpoint_dir(spark) == d          # stable: never replaced once set


def test_derived_journal_is_a_table_of_every_line(spark, tmp_path):
    import shutil
    import duckdb
    from setbook.sources.journal import journal_for
    from conftest import SF_SMALL
    j = journal_for(spark, SF_SMALL)
    assert j.inputFiles() == journal_for(spark, SF_SMALL).inputFiles()           # written once
    assert j.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    for t in ("orders", "part", "lineitem"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path)
    a = journal_for(spark, str(tmp_path))
    duckdb.sql(f"COPY (FROM '{SF_SMALL}/lineitem.parquet' LIMIT 50) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    b = journal_for(spark, str(tmp_path))                                         # changed input is noticed
    assert (a.count(), b.count()) == (6000, 50)
