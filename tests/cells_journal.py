"""The journal rows that the parser must recover from the cells fixture."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setbook.functions.calendar import month_name, weekday_name
from setbook.sources.cells import _lines, _sessions


def journal_from_cells_fixture(spark: SparkSession, sf_dir: str, workbooks: int | None = None) -> DataFrame:
    """The rows the parser must recover from ``cells_from_tables`` (the
    round-trip oracle, computed directly from the tables)."""
    s = _sessions(spark, sf_dir, workbooks)
    lines = _lines(spark, sf_dir, s)
    exercise = F.concat(F.lower("p_brand"),
                        F.when(F.col("p_size") % 10 == 0, F.lit(" hold (s)"))
                         .when(F.col("p_size") % 10 == 1, F.lit(" + dips")).otherwise(F.lit("")))
    return lines.where(F.col("sheet") != "2023").select(
        month_name("dt").alias("month"),
        weekday_name("dt").alias("weekday"),
        F.col("dt").alias("date"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).cast("smallint").alias("deload"),
        F.dayofyear("dt").cast("smallint").alias("workout_counter"),
        F.col("set_idx").cast("smallint").alias("set_counter"),
        F.lower("o_orderpriority").alias("type"),
        F.when(F.col("l_linestatus") == "F", "pull").otherwise("push").alias("section"),
        exercise.alias("exercise"),
        F.col("w_kg").alias("weight"),
        F.lit("kg").alias("weight_unit"),
        F.lower("l_returnflag").alias("grip"),
        F.col("l_quantity").cast("smallint").alias("amount"),
        (F.round(F.col("l_tax") * 100).cast("int") * 15).cast("smallint").alias("rest"),
    )
