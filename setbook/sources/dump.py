"""The text dump of parsed records: one folder a year, one record a line.

The original writes each year's parsed records to a text file.  A line here
is a JSON array of the record's values as text, in column order, so that
quotes, separators and line ends inside a value cannot break a line, and
the dump can be read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEAR = "_year"


def write_dump(df: DataFrame, path: str, year: str) -> None:
    """Dump all columns of ``df`` below ``path``, one folder for each value of the column ``year``.

    NULL years have a folder of their own (Spark's default partition).
    """
    values = F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns]), {"ignoreNullFields": "false"})
    lines = df.select(F.col(f"`{year}`").cast("int").alias(YEAR), values.alias("value"))
    lines.repartition(YEAR, F.pmod(F.xxhash64("value"), F.lit(16))).write.partitionBy(YEAR).text(path)


def read_dump(spark: SparkSession, path: str, schema: T.StructType, years=None) -> DataFrame:
    """The records of a dump as columns of ``schema``; ``years`` reads only their folders.

    A value that does not fit its type is NULL.  Lines that are no record of
    as many values are kept as rows of NULLs rather than lost.
    """
    lines = spark.read.text(path)
    if years is not None:
        lines = lines.where(F.col(YEAR).isin(*years))
    values = F.from_json("value", "array<string>")
    whole = F.when(F.size(values) == len(schema.fields), values)
    return lines.select(whole.alias("v")).select(
        *[F.get("v", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
