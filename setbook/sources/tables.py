"""Reads of the driver tables (parquet), always column-projected."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    """``spark.read.parquet`` of ``{sf_dir}/{name}.parquet`` with an explicit projection.

    Selecting the columns right at the scan keeps the ``ReadSchema`` narrow
    even before Catalyst's own pruning runs.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
