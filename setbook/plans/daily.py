"""The daily refresh as one Spark application.

    spark-submit --py-files setbook.zip daily_job.py --cells CELLS --journal JOURNAL --marts MARTS [--report REPORT]
    python -m setbook.plans.daily ...   (local or configured master)

cells (parquet ``workbook_id, sheet, r, c, sv, nv, date_mode``, or a folder
of .xlsx workbooks with ``--workbooks``) -> parse -> clean -> quality report
-> rows that break a constraint apart -> journal (a new version, published
when complete, year-partitioned) -> every mart in dependency order.  ``--journal-only`` stops after the journal;
``--from-journal`` skips parsing and rebuilds the marts from an existing
journal.  Nothing is collected to the driver; every stage reads the table
the previous one wrote, so a failed run is re-run from its last table.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.grid import clean_journal, parse_journal_cells
from ..operators.quality import accepted, broken_rules, check_journal, enforced_bits, reasons
from ..session import delete_at_end, ensure_checkpoint_dir, get_spark
from ..sources.cells import CELLS_SCHEMA
from ..sources.journal import read_journal, write_journal
from ..sources.versions import publish
from ..sources.xlsx import read_xlsx_cells
from .build import build_marts


def ingest(spark: SparkSession, cells_path: str | None, journal_path: str, report_path: str | None = None,
           date_mode: int = 0, workbooks_path: str | None = None, rows_per_chunk: int | None = None,
           per_workbook: bool = False, on_bad: str = "quarantine") -> None:
    """Parse the workbook cells (a cells table, or .xlsx files) and replace the journal table.

    Rows that break a constraint of the table never reach it: ``on_bad``
    "quarantine" publishes them as ``<journal>_rejected`` instead, with the
    bits and names of the rules they break; "fail" raises and publishes
    nothing.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError(f"on_bad: {on_bad}")
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex[:12]}"
    delete_at_end(spark, scratch)
    if workbooks_path:               # every workbook is decoded once
        read_xlsx_cells(spark, workbooks_path).write.parquet(f"{scratch}/cells")
        cells_path = f"{scratch}/cells"
    cells = spark.read.schema(CELLS_SCHEMA).parquet(cells_path)
    keep = ("workbook_id",) if per_workbook else ()
    # one pass parses, marks each row with the rules it breaks and parts the refused rows from the others
    rows = clean_journal(parse_journal_cells(cells, date_mode=date_mode, rows_per_chunk=rows_per_chunk), keep=keep)
    marked = rows.withColumn("broken", broken_rules())
    (marked.withColumn("accepted", accepted(F.col("broken"))).write.partitionBy("accepted")
           .parquet(f"{scratch}/rows"))
    split = spark.read.schema(T.StructType([*marked.schema.fields, T.StructField("accepted", T.BooleanType())])).parquet(f"{scratch}/rows")
    refused, good = split.where(~F.col("accepted")), split.where(F.col("accepted"))      # a folder each
    if report_path:
        publish(check_journal(split, by=keep, mask="broken")[1], report_path)
    if on_bad == "fail" and not refused.isEmpty():
        raise ValueError("rows break the journal's constraints; nothing was published")
    refused = refused.drop("accepted").withColumn("broken", F.col("broken").bitwiseAND(F.lit(enforced_bits())))
    publish(refused.withColumn("reasons", reasons(F.col("broken"))), f"{journal_path.rstrip('/')}_rejected")
    write_journal(good.drop("accepted", "broken"), journal_path, partition_by_year=True, keys=keep)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description="daily refresh: cells -> journal -> marts")
    ap.add_argument("--cells", help="cells table (parquet)")
    ap.add_argument("--workbooks", help="folder of .xlsx workbook files")
    ap.add_argument("--journal", required=True, help="journal table folder (replaced on ingest)")
    ap.add_argument("--marts", help="folder receiving one table per mart")
    ap.add_argument("--report", help="folder for the journal quality report")
    ap.add_argument("--journal-only", action="store_true", help="stop after writing the journal")
    ap.add_argument("--from-journal", action="store_true", help="skip parsing; rebuild marts from --journal")
    ap.add_argument("--date-mode", type=int, default=0, help="serial date epoch for cells tables: 0 = 1900, 1 = 1904")
    ap.add_argument("--per-workbook", action="store_true",
                    help="keep workbook_id in the journal and build every mart per workbook (one log each)")
    ap.add_argument("--rows-per-chunk", type=int, help="parse sheets in parallel chunks of this many rows")
    ap.add_argument("--on-bad", choices=("quarantine", "fail"), default="quarantine",
                    help="rows that break the journal's constraints: set them apart, or fail")
    args = ap.parse_args(argv)
    spark = get_spark()
    if not args.from_journal:
        if not (args.cells or args.workbooks):
            ap.error("--cells or --workbooks is required unless --from-journal")
        ingest(spark, args.cells, args.journal, args.report, date_mode=args.date_mode,
               workbooks_path=args.workbooks, rows_per_chunk=args.rows_per_chunk,
               per_workbook=args.per_workbook, on_bad=args.on_bad)
    if not args.journal_only:
        if not args.marts:
            ap.error("--marts is required unless --journal-only")
        keys = ("workbook_id",) if args.per_workbook else ()
        build_marts(spark, read_journal(spark, args.journal, keys=keys), args.marts, by=keys)


if __name__ == "__main__":
    main()
