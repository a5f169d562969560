"""Intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import delete_at_end, ensure_checkpoint_dir


def scratch_folder(spark, label: str) -> str:
    """A fresh folder name below the shared checkpoint folder; it goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    delete_at_end(spark, path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table and read again: later steps read the columns they need, and a lost
    executor re-reads files instead of recomputing what stands before."""
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
