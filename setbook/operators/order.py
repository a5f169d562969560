"""Global order of a table in parallel: positions and sorted files.

``global_position`` gives every row its rank in the whole table's order
without a window over all rows: the distinct sort keys are counted (copies
of a hot key fold inside the tasks), dealt to ranges, summed inside each
range, and shifted by the number of rows in the ranges before.  Only one
number a range reaches the driver.

``write_sorted`` writes range-partitioned files, each sorted, whose names
follow the order; a reader that takes them in turn reads the table sorted,
and Parquet's min/max statistics skip files on the leading keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def sort_columns(keys) -> list[Column]:
    """Sort expressions of keys like ``year`` or ``-total`` (descending); NULL counts as the largest value, as in the original's tables."""
    return [F.col(k[1:]).desc_nulls_first() if k.startswith("-") else F.col(k).asc_nulls_last() for k in keys]


def _names(keys) -> list[str]:
    return [k.lstrip("-") for k in keys]


def global_position(df: DataFrame, keys, name: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's rank (ties share the smallest) in the order ``keys``, from 1.

    ``ranges`` is the number of ranges (default: the shuffle partitions).
    A NULL key is a value of its own; an empty table stays empty.
    """
    spark, names = df.sparkSession, _names(keys)
    rows = written(df, "ordered")                          # read twice: its keys, then the rows
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    dealt = written(counted.repartitionByRange(ranges, *sort_columns(keys))
                    .withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("_range").agg(F.sum("_n").alias("n")).collect()            # one row a range
    base, starts = 0, []
    for r in sorted(sizes, key=lambda r: r["_range"]):
        starts.append((r["_range"], base))
        base += r["n"]
    offsets = spark.createDataFrame(starts, "_range int, _base long")
    before = (Window.partitionBy("_range").orderBy(*sort_columns(keys))
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (dealt.withColumn("_in", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .join(F.broadcast(offsets), "_range")         # at most ``ranges`` rows
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)],
                      (F.col("_base") + F.col("_in") + 1).cast("bigint").alias(name)))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(names)])
    return rows.join(placed, same).select(*rows.columns, name)


def sorted_rows(df: DataFrame, keys, files: int | None = None) -> DataFrame:
    """``df`` dealt to ranges of ``keys``, each sorted: written as it stands, its files follow the order by name and inside.

    A range holds whole keys; rows of one key beyond a file's share are one
    file, as the order needs.
    """
    files = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = sort_columns(keys)
    return df.repartitionByRange(files, *columns).sortWithinPartitions(*columns)


def write_sorted(df: DataFrame, path: str, keys, files: int | None = None) -> None:
    sorted_rows(df, keys, files).write.parquet(path)
