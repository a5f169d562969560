"""Journal -> typed, enriched fact table (one row per set)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import month_number, weekday_number

STG_COLUMNS = (
    "month", "month_int", "weekday", "weekday_int", "year", "date", "deload_bool",
    "workout_counter", "set_counter", "workout_type", "workout_section", "exercise",
    "added_weight", "weight_unit", "bodyweight", "grip", "amount", "rest",
)


def stage_journal(journal: DataFrame, by=()) -> DataFrame:
    """Pure projection (no shuffle): names -> numbers, year, flags, renames.

    ``month_int`` comes from the month *text* and ``year`` from the date, as
    in the original model; a mismatch between them is reported by
    ``check_journal`` rather than silently fixed.
    """
    deload = F.col("deload")
    return journal.select(
        *[F.col(b) for b in by],
        F.col("month"),
        month_number("month").alias("month_int"),
        F.col("weekday"),
        weekday_number("weekday").alias("weekday_int"),
        F.year("date").cast("smallint").alias("year"),
        F.col("date"),
        F.when(deload == 1, F.lit(True)).when(deload == 0, F.lit(False)).alias("deload_bool"),
        F.col("workout_counter"),
        F.col("set_counter"),
        F.col("type").alias("workout_type"),
        F.col("section").alias("workout_section"),
        F.col("exercise"),
        F.col("weight").cast("decimal(5,2)").alias("added_weight"),
        F.col("weight_unit"),
        F.coalesce(F.col("weight") == 0, F.lit(False)).alias("bodyweight"),
        F.col("grip"),
        F.col("amount"),
        F.col("rest"),
    )
