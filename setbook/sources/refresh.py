"""Refresh of single years of a year-partitioned table, and of sums over it.

A daily load brings all years again, but mostly one has changed.
``year_marks`` fingerprints every year of both sides (an order-independent
checksum per year, one small aggregate); ``refresh_years`` writes only the
years whose fingerprint differs.  Sums over all years are not computed anew:
``corrected_sums`` subtracts the old rows of those years and adds the new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import published


def year_of(date: str = "date") -> Column:
    return F.year(date)


def year_marks(df: DataFrame, date: str = "date") -> DataFrame:
    """(year, rows, mark): how many rows a year has and a checksum of them, whatever their order."""
    columns = sorted(df.columns)
    one = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")
    nulls = F.xxhash64(*[F.col(f"`{c}`").isNull() for c in columns], one).cast("decimal(38,0)")
    return df.groupBy(year_of(date).alias("year")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(one + nulls).alias("mark"))


def changed_years(old: DataFrame, new: DataFrame, date: str = "date") -> list:
    """Years whose rows differ between two tables of the same columns, one of them possibly without the year."""
    a, b = year_marks(old, date), year_marks(new, date).withColumnsRenamed({"year": "y", "rows": "r", "mark": "m"})
    same = a["year"].eqNullSafe(b["y"])
    differs = ~(a["rows"].eqNullSafe(b["r"]) & a["mark"].eqNullSafe(b["m"]))
    found = a.join(b, same, "full_outer").where(differs).select(F.coalesce("year", "y").alias("year")).collect()
    return sorted((r["year"] for r in found), key=lambda y: (y is not None, y))            # one row a year


def in_years(df: DataFrame, years, date: str = "date") -> DataFrame:
    known = [y for y in years if y is not None]
    hit = year_of(date).isin(*known) if known else F.lit(False)
    return df.where(hit | year_of(date).isNull()) if None in years else df.where(hit)


def refresh_years(spark: SparkSession, new: DataFrame, path: str, years, date: str = "date") -> None:
    """Replace the folders of ``years`` in the table ``path`` (partitioned by ``year``) with the rows of ``new``.

    Other years' files are not touched.  Spark commits all of them together
    at the end of the job.  A year without rows in ``new`` is emptied.
    """
    path = published(spark, path)
    rows = in_years(new, years, date).withColumn("year", year_of(date))
    (rows.repartition("year", F.pmod(F.xxhash64(*new.columns), F.lit(32))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("year").parquet(path))
    left = {r["year"] for r in rows.select("year").distinct().collect()}                    # at most ``years``
    _clear(spark, path, [y for y in years if y not in left])


def _clear(spark: SparkSession, path: str, years) -> None:
    """Remove the folders of years that have no rows any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for y in years:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/year={'__HIVE_DEFAULT_PARTITION__' if y is None else y}")
        folder.getFileSystem(conf).delete(folder, True)


def corrected_sums(sums: DataFrame, keys, measures, old: DataFrame, new: DataFrame, rows: str = "_rows") -> DataFrame:
    """``sums`` (keys, measures, rows) after ``old`` rows were replaced by ``new`` ones.

    ``old`` and ``new`` hold the keys and measures of the replaced rows only.
    A group that has no rows left goes.
    """
    def signed(df, sign):
        part = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias(rows))
        return part.select(*keys, *[(F.lit(sign) * F.col(c)).alias(c) for c in (*measures, rows)])

    both = sums.select(*keys, *measures, rows).unionByName(signed(old, -1)).unionByName(signed(new, 1))
    total = both.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in (*measures, rows)])
    return total.where(F.col(rows) > 0)
