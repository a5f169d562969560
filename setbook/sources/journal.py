"""The journal: one row per recorded set (the raw fact table).

Sources
-------
* ``derive_journal``   — builds a journal from the driver's TPC-H-like tables
                         (lineitem ⋈ orders ⋈ part), the test/bench input.
* ``read_journal``     — reads a journal written by ``write_journal``.
* ``write_journal``    — full refresh: a new version of the table, published
                         only when it is complete (``sources.versions``).
* ``journal_for``      — derive once per application and input state, written
                         as a parquet table in the shared folder, so that
                         queries scan only the columns and rows they need.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import month_name, weekday_name
from ..session import app_id
from .scratch import scratch_folder
from .tables import read_table
from .versions import publish, published

JOURNAL_SCHEMA = T.StructType([
    T.StructField("month", T.StringType(), False),
    T.StructField("weekday", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("deload", T.ShortType(), False),
    T.StructField("workout_counter", T.ShortType(), False),
    T.StructField("set_counter", T.ShortType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("section", T.StringType(), False),
    T.StructField("exercise", T.StringType(), False),
    T.StructField("weight", T.DecimalType(5, 2), False),
    T.StructField("weight_unit", T.StringType(), False),
    T.StructField("grip", T.StringType(), False),
    T.StructField("amount", T.ShortType(), False),
    T.StructField("rest", T.ShortType(), False),
])
JOURNAL_COLUMNS = tuple(f.name for f in JOURNAL_SCHEMA.fields)

# Fixture mapping parameters (how driver tables are turned into a log).
DATE_SHIFT_MONTHS = 324          # 27 years: data then starts after the 2021-01 month floor
REST_DAY_RESIDUES = (0, 3)       # dayofyear % 7 in this set -> rest day (row moved to the next day)

# A journal with faults, for the checks: SQL of both engines over the derived
# journal's columns and the line's keys (FIXTURES.md §2).
ODD_SQL = {
    "month": "CASE l_partkey % 17 WHEN 0 THEN 'brumaire' WHEN 1 THEN 'january' WHEN 2 THEN NULL ELSE month END",
    "weekday": "CASE l_partkey % 19 WHEN 0 THEN 'blursday' WHEN 1 THEN 'monday' WHEN 2 THEN NULL ELSE weekday END",
    "date": "CASE WHEN l_suppkey % 43 = 0 THEN NULL ELSE date END",
    "deload": "CASE l_suppkey % 23 WHEN 0 THEN 2 WHEN 1 THEN NULL ELSE deload END",
    "workout_counter": "CASE WHEN l_partkey % 47 = 0 THEN NULL ELSE workout_counter END",
    "set_counter": "CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE set_counter END",
    "type": "CASE WHEN l_partkey % 59 = 0 THEN NULL ELSE type END",
    "section": "CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE section END",
    "exercise": "CASE WHEN l_partkey % 67 = 0 THEN NULL ELSE exercise END",
    "weight": "CASE l_partkey % 29 WHEN 0 THEN NULL WHEN 1 THEN 1000.00 ELSE weight END",
    "weight_unit": "CASE l_partkey % 31 WHEN 0 THEN 'st' WHEN 1 THEN 'lbs' WHEN 2 THEN NULL ELSE weight_unit END",
    "grip": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE grip END",
    "amount": "CASE l_partkey % 37 WHEN 0 THEN -amount WHEN 1 THEN NULL ELSE amount END",
    "rest": "CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE rest END",
    "weight_text": """CASE l_partkey % 16 WHEN 0 THEN 'Bodyweight' WHEN 1 THEN 'Bodyweight + 10kg' WHEN 2 THEN '10dkg'
        WHEN 3 THEN 'red band' WHEN 4 THEN '1e1kg' WHEN 5 THEN ' 7.5 kg' WHEN 6 THEN '.5kg' WHEN 7 THEN '5.kg extra'
        WHEN 8 THEN '-2.5kg' WHEN 9 THEN '10 KG' WHEN 10 THEN 'kg' WHEN 11 THEN '12,5kg' WHEN 12 THEN '1000kg'
        WHEN 13 THEN NULL
        ELSE CAST(CAST(l_quantity AS INT) AS STRING)
             || CASE l_linenumber % 4 WHEN 0 THEN '.125' WHEN 1 THEN '.375' WHEN 2 THEN '.25' ELSE '' END || 'kg' END""",
}


def exercise_from_part(brand: Column, size: Column) -> Column:
    """lower(brand) + ' hold (s)' (size%10=0) / ' + dips' (size%10=1) / ''."""
    suffix = (F.when(size % 10 == 0, F.lit(" hold (s)"))
              .when(size % 10 == 1, F.lit(" + dips"))
              .otherwise(F.lit("")))
    return F.concat(F.lower(brand), suffix)


def derive_journal(spark: SparkSession, sf_dir: str, odd: bool = False) -> DataFrame:
    """Journal rows from ``lineitem ⋈ orders ⋈ part`` (see FIXTURES.md §2),
    one for every line.  ``odd`` puts faults into every column (``ODD_SQL``).

    Only the needed columns are scanned.  The joins are plain equi-joins: at
    small scale AQE turns them into broadcast joins after measuring the
    build side, at large scale they stay sort-merge joins on the (uniformly
    distributed) order and part keys.
    """
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])

    moved = F.add_months(F.col("l_shipdate").cast("date"), DATE_SHIFT_MONTHS)
    resting = (F.dayofyear("moved") % 7).isin(*REST_DAY_RESIDUES)
    li = li.withColumn("moved", moved).withColumn(
        "dt", F.when(resting, F.date_add("moved", 1)).otherwise(F.col("moved")))
    joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                .join(part, li.l_partkey == part.p_partkey))
    rows = joined.select(
        "l_partkey", "l_suppkey",
        month_name("dt").alias("month"),
        weekday_name("dt").alias("weekday"),
        F.col("dt").alias("date"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("smallint").alias("deload"),
        F.dayofyear("dt").cast("smallint").alias("workout_counter"),
        F.col("l_linenumber").cast("smallint").alias("set_counter"),
        F.lower("o_orderpriority").alias("type"),
        F.lower("l_linestatus").alias("section"),
        exercise_from_part(F.col("p_brand"), F.col("p_size")).alias("exercise"),
        (F.round(F.col("l_discount") * 100).cast("int") * 2.5).cast("decimal(5,2)").alias("weight"),
        F.lit("kg").alias("weight_unit"),
        F.lower("l_returnflag").alias("grip"),
        F.col("l_quantity").cast("smallint").alias("amount"),
        (F.round(F.col("l_tax") * 100).cast("int") * 15).cast("smallint").alias("rest"),
    )
    if odd:
        return rows.select(*[F.expr(ODD_SQL[c]).alias(c) for c in JOURNAL_COLUMNS])
    return rows.select(*JOURNAL_COLUMNS)


def odd_weight_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct weight texts of the faulty fixture, one column ``weight_text``."""
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_linenumber", "l_quantity"])
    return li.select(F.expr(ODD_SQL["weight_text"]).alias("weight_text")).distinct()


def conform_journal(df: DataFrame) -> DataFrame:
    """Project/cast any journal-like DataFrame onto the 14 journal columns."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOURNAL_SCHEMA.fields])


def read_journal(spark: SparkSession, path: str, years=None, keys=()) -> DataFrame:
    """The 14 journal columns of the published version of the table; on a
    year-partitioned table ``years`` prunes whole directories.  ``keys`` keeps
    log-key columns such as ``workbook_id`` (for ``by=``); other partition
    columns are not returned."""
    path = published(spark, path)
    df = spark.read.parquet(path) if keys else spark.read.schema(JOURNAL_SCHEMA).parquet(path)
    if years is not None and "year" in df.columns:
        df = df.where(F.col("year").isin(*years))
    return df.select(*keys, *[F.col(f.name).cast(f.dataType) for f in JOURNAL_SCHEMA.fields])


def write_journal(df: DataFrame, path: str, partition_by_year: bool = False, keys=()) -> None:
    """Full refresh: writes a new version and publishes it when it is complete;
    a failed run leaves the published rows as they were.

    With ``partition_by_year`` a ``year`` directory level is added (the
    original loads year by year); readers then prune by year.  ``keys`` are
    log-key columns kept in front of the journal columns.
    """
    out = df.select(*keys, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in JOURNAL_SCHEMA.fields])
    if partition_by_year:
        publish(out.withColumn("year", F.year("date")), path, partition_by=("year",))
    else:
        publish(out, path)


_MEMO: dict = {}
_LOCK = threading.RLock()         # making a table may need another one
INPUTS = ("lineitem", "orders", "part")


def _input_state(spark: SparkSession, sf_dir: str, tables=INPUTS) -> tuple:
    """(name, size, time) of every input file, from the file system alone: changes when any of them does."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for t in tables:
        at = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        files = at.getFileSystem(conf).listFiles(at, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def table_for(spark: SparkSession, sf_dir: str, label: str, make, tables=INPUTS) -> DataFrame:
    """``make()`` written once per application and state of the input ``tables``, and read from there.

    A parquet table in the shared folder: a lost executor re-reads files,
    and every query scans only the columns and row groups it needs.  The
    folder goes when the application ends.
    """
    key = (app_id(spark), label, sf_dir.rstrip("/"), _input_state(spark, sf_dir, tables))
    with _LOCK:
        if key not in _MEMO:
            df = make()
            path = scratch_folder(spark, label)
            df.write.parquet(path)
            _MEMO[key] = path, df.schema
    path, schema = _MEMO[key]
    return spark.read.schema(schema).parquet(path)


def journal_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived journal for ``sf_dir``, written once per application and input state."""
    return conform_journal(table_for(spark, sf_dir, "journal", lambda: derive_journal(spark, sf_dir)))
