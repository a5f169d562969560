"""Workbook files (.xlsx) -> the cells table.

Spark has no spreadsheet reader, so each file is decoded inside a task:
``binaryFile`` lists and distributes the files (many per task when they
are small), ``mapInPandas`` turns every file into its cell rows with the
standard library (an .xlsx file is a zip of XML parts), and everything
after that — sheet selection, parsing, cleaning — is the Spark plan.  A
workbook is bounded by the file format, so no task holds more than one
file's cells at a time.

Output: ``path, workbook_id (xxhash64 of the path), sheet, r, c, sv, nv,
date_mode`` with 0-based row/column indices, text in ``sv`` and numbers in
``nv``; empty cells are absent (the parser reads them as empty).
"""

from __future__ import annotations

import io
import re
import zipfile
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
      "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
RAW_SCHEMA = "path string, sheet string, r long, c int, sv string, nv double, date_mode int"
_REF = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(node) -> str:
    """All text runs of a string item (plain or rich text)."""
    return "".join(t.text or "" for t in node.iter(f"{{{NS['m']}}}t"))


def _open(content: bytes):
    """Zip handle, sheet (name, part) list, shared strings and date mode."""
    z = zipfile.ZipFile(io.BytesIO(content))
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    pr = wb.find("m:workbookPr", NS)
    date_mode = 1 if pr is not None and pr.get("date1904") in ("1", "true") else 0
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", NS)}
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", NS)]
    sheets = []
    for sh in wb.find("m:sheets", NS).findall("m:sheet", NS):
        part = target[sh.get(f"{{{NS['r']}}}id")].lstrip("/")
        sheets.append((sh.get("name"), part if part.startswith("xl/") else "xl/" + part))
    return z, sheets, shared, date_mode


def _value(c, shared):
    """(sv, nv) of one <c> element, or None for an empty cell."""
    t, v = c.get("t", "n"), c.find("m:v", NS)
    if t == "s":
        sv, nv = shared[int(v.text)], None
    elif t == "inlineStr":
        sv, nv = _text(c.find("m:is", NS)), None
    elif t in ("str", "e"):
        sv, nv = (v.text if v is not None else ""), None
    else:                               # numbers, booleans (1/0)
        if v is None or v.text is None:
            return None
        sv, nv = None, float(v.text)
    return None if sv == "" else (sv, nv)


def workbook_cells(content: bytes, batch: int = 50_000):
    """Yield (date_mode, [(sheet, r, c, sv, nv), ...]) batches for one file.

    Sheets are read with ``iterparse`` and finished rows are released, so
    memory holds the shared strings and one batch, not the whole sheet.  A
    row or cell without its optional place stands behind the one before it.
    """
    z, sheets, shared, date_mode = _open(content)
    cell_tag, row_tag = f"{{{NS['m']}}}c", f"{{{NS['m']}}}row"
    out = []
    for name, part in sheets:
        with z.open(part) as fh:
            row, col = -1, -1
            for event, el in ET.iterparse(fh, events=("start", "end")):
                if event == "start":
                    if el.tag == row_tag:
                        row, col = int(el.get("r") or row + 2) - 1, -1
                elif el.tag == cell_tag:
                    col = _col_index(_REF.match(el.get("r")).group(1)) if el.get("r") else col + 1
                    val = _value(el, shared)
                    if val is not None:
                        out.append((name, row, col, *val))
                elif el.tag == row_tag:
                    el.clear()
                    if len(out) >= batch:
                        yield date_mode, out
                        out = []
    if out:
        yield date_mode, out


def _decode(batches):
    import pandas as pd

    cols = ["path", "sheet", "r", "c", "sv", "nv", "date_mode"]
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            for mode, cells in workbook_cells(bytes(content)):
                yield pd.DataFrame([(path, *cell, mode) for cell in cells], columns=cols)


def cells_of_files(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows (path, content) -> cells (batch or micro-batch)."""
    raw = files.select("path", "content").mapInPandas(_decode, RAW_SCHEMA)
    return raw.select("path", F.xxhash64("path").alias("workbook_id"), "sheet", "r", "c", "sv", "nv",
                      "date_mode")


def read_xlsx_cells(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return cells_of_files(files)
