"""Spreadsheet cells: the grid input of the parser, and a fixture that
renders the driver tables as a training-log workbook (FIXTURES.md §5).

Layout of one session (one order) inside sheet ``year(dt)`` of workbook
``o_custkey`` (one log per customer; ``workbooks=n`` folds them into n
workbooks instead), rows at ``base = n*10^4``, n the number of the session
within its sheet by date and order key:

  base+0        Month name
  base+1        [date serial, 'Deload' | '', Weekday, type, 'N/365']
  base+S        section name ('Pull' for finished lines, else 'Push');
                S = 1000 / 5000
  base+S+1      column headers
  base+S+1+i    set i: exercise, weight text, grip, amount, rest
  base+S+3000   'Total Reps' and a number (must be ignored)

Rows need no global numbering, so cells are produced by narrow
transformations plus two windows (session order inside a sheet, set order
inside a section).  One log per
customer keeps every sheet small at any scale, as real logs are (a sheet
is bounded by the workbook format); folding all customers into a fixed
number of workbooks would make sheets grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vocab import COLUMN_HEADERS, EXCEL_EPOCH_1900, EXCEL_EPOCH_1904
from .journal import DATE_SHIFT_MONTHS
from .tables import read_table

CELLS_SCHEMA = T.StructType([
    T.StructField("workbook_id", T.LongType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("r", T.LongType()),
    T.StructField("c", T.IntegerType()),
    T.StructField("sv", T.StringType()),
    T.StructField("nv", T.DoubleType()),
    T.StructField("date_mode", T.IntegerType()),     # 0 = 1900 epoch, 1 = 1904; NULL = the reader's default
])

SECTION_ROW = {"F": 1000, "other": 5000}
TOTAL_ROW = 3000
# set order within a section: a total order over every column that reaches the output
SET_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag")


def _cell(r, c, sv=None, nv=None):
    return F.struct(r.cast("bigint").alias("r"), F.lit(c).cast("int").alias("c"),
                    (sv if sv is not None else F.lit(None)).cast("string").alias("sv"),
                    (nv if nv is not None else F.lit(None)).cast("double").alias("nv"))


def _sessions(spark: SparkSession, sf_dir: str, workbooks: int | None) -> DataFrame:
    o = read_table(spark, sf_dir, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    dt = F.add_months(F.col("o_orderdate").cast("date"), DATE_SHIFT_MONTHS)
    sessions = o.select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        (F.col("o_custkey") % workbooks if workbooks else F.col("o_custkey")).cast("bigint").alias("workbook_id"),
        dt.alias("dt"),
        F.year(dt).cast("string").alias("sheet"))
    in_sheet = Window.partitionBy("workbook_id", "sheet").orderBy("dt", "o_orderkey")
    return sessions.withColumn("base", F.row_number().over(in_sheet).cast("bigint") * 10**4)


def _lines(spark: SparkSession, sf_dir: str, sessions: DataFrame) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_size"])
    w = Window.partitionBy("l_orderkey", "l_linestatus").orderBy(*SET_ORDER)
    return (li.join(part, li.l_partkey == part.p_partkey)
              .join(sessions, li.l_orderkey == sessions.o_orderkey)
              .withColumn("set_idx", F.row_number().over(w))
              .withColumn("sec_off", F.when(F.col("l_linestatus") == "F", SECTION_ROW["F"])
                                      .otherwise(SECTION_ROW["other"]))
              .withColumn("w_kg", (F.round(F.col("l_discount") * 100).cast("int") * 2.5)
                                   .cast("decimal(5,2)")))


def cells_from_tables(spark: SparkSession, sf_dir: str, workbooks: int | None = None,
                      date_mode: int | None = None) -> DataFrame:
    """The driver tables rendered as workbook cells (see module doc); ``date_mode`` 1 counts days from 1904 and says so."""
    epoch = EXCEL_EPOCH_1904 if date_mode == 1 else EXCEL_EPOCH_1900
    s = _sessions(spark, sf_dir, workbooks)
    b = F.col("base")
    header = s.select("workbook_id", "sheet", F.inline(F.array(
        _cell(b, 0, sv=F.date_format("dt", "MMMM")),
        _cell(b + 1, 0, nv=F.datediff("dt", F.lit(epoch).cast("date"))),
        _cell(b + 1, 1, sv=F.when(F.col("o_orderstatus") == "P", "Deload").otherwise("")),
        _cell(b + 1, 2, sv=F.date_format("dt", "EEEE")),
        _cell(b + 1, 3, sv=F.col("o_orderpriority")),
        _cell(b + 1, 4, sv=F.concat(F.dayofyear("dt").cast("string"), F.lit("/365"))),
    )))
    lines = _lines(spark, sf_dir, s)
    rs = b + F.col("sec_off")
    exercise = F.concat(F.col("p_brand"),
                        F.when(F.col("p_size") % 10 == 0, F.lit(" Hold (s)"))
                         .when(F.col("p_size") % 10 == 1, F.lit(" + Dips")).otherwise(F.lit("")))
    weight = F.when(F.col("w_kg") == 0, F.lit("Bodyweight")) \
              .otherwise(F.concat(F.col("w_kg").cast("string"), F.lit("kg")))
    rv = rs + 1 + F.col("set_idx")
    value_cells = F.array(
        _cell(rv, 0, sv=exercise),
        _cell(rv, 1, sv=weight),
        _cell(rv, 2, sv=F.col("l_returnflag")),
        _cell(rv, 3, nv=F.col("l_quantity")),
        _cell(rv, 4, nv=F.round(F.col("l_tax") * 100) * 15),
    )
    section = F.when(F.col("l_linestatus") == "F", F.lit("Pull")).otherwise(F.lit("Push"))
    frame_cells = F.array(
        _cell(rs, 0, sv=section),
        *[_cell(rs + 1, i, sv=F.lit(h)) for i, h in enumerate(COLUMN_HEADERS)],
        _cell(rs + TOTAL_ROW, 0, sv=F.lit("Total Reps")),
        _cell(rs + TOTAL_ROW, 3, nv=F.lit(999.0)),
    )
    # one pass over the lines: every line writes its set, the first line of
    # a section also writes the section frame (name, headers, total row)
    per_line = F.when(F.col("set_idx") == 1, F.concat(value_cells, frame_cells)).otherwise(value_cells)
    body = lines.select("workbook_id", "sheet", F.inline(per_line))
    return header.unionByName(body).withColumn("date_mode", F.lit(date_mode).cast("int"))

