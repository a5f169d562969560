"""Workbook files -> cells -> parser equals parsing the same cells directly."""

import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from setbook.operators.grid import clean_journal, parse_journal_cells
from setbook.sources.cells import CELLS_SCHEMA
from setbook.sources.xlsx import read_xlsx_cells

from test_grid_bruteforce import random_sheet, to_cells
from xlsx_writer import write_xlsx


def parsed_rows(df):
    cols = ["month", "weekday", "date", "deload", "workout_counter", "set_counter", "type", "section",
            "exercise", "weight", "grip", "amount", "rest"]
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


def test_workbook_files_parse_like_cells(spark):
    root = tempfile.mkdtemp(prefix="setbook-xlsx-")
    rnd = random.Random(21)
    direct = []
    for wb in range(4):
        sheets = {name: random_sheet(rnd) for name in ("2022", "2023", "2024")}
        write_xlsx(os.path.join(root, f"log{wb}.xlsx"), sheets, inline=(wb % 2 == 1))
        for name, rows in sheets.items():
            direct += to_cells(wb, name, rows)[0]
    from_files = read_xlsx_cells(spark, root)
    assert from_files.select("path").distinct().count() == 4
    a = clean_journal(parse_journal_cells(from_files))
    b = clean_journal(parse_journal_cells(spark.createDataFrame(direct, CELLS_SCHEMA)))
    assert a.count() == b.count() > 50
    assert parsed_rows(a) == parsed_rows(b)


def test_1904_date_mode(spark):
    root = tempfile.mkdtemp(prefix="setbook-xlsx1904-")
    serial = float((dt.date(2024, 5, 6) - dt.date(1904, 1, 1)).days)
    rows = [["title"], ["May"], [serial, "", "Monday", "Pull", "127/365"], ["Pull"],
            ["Exercise", "Weight", "Grip", "Amount", "Rest (s)"], ["Dips", "20kg", "Neutral", 8.0, 120.0]]
    write_xlsx(os.path.join(root, "old.xlsx"), {"2024": rows}, date1904=True)
    cells = read_xlsx_cells(spark, root)
    assert cells.select(F.max("date_mode")).first()[0] == 1
    got = clean_journal(parse_journal_cells(cells)).collect()
    assert len(got) == 1 and str(got[0].date) == "2024-05-06" and str(got[0].weight) == "20.00"


def test_rows_and_cells_without_their_optional_place():
    import io
    import re
    import zipfile

    from setbook.sources.xlsx import workbook_cells
    folder = tempfile.mkdtemp(prefix="setbook-xlsx-bare-")
    rows = [["title", 1.0], [None, "x", None, 2.5], ["y"]]
    write_xlsx(f"{folder}/full.xlsx", {"2024": rows})
    with open(f"{folder}/full.xlsx", "rb") as f:
        full = f.read()
    bare = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(full)) as src, zipfile.ZipFile(bare, "w") as out:
        for name in src.namelist():
            data = src.read(name)
            if "worksheets" in name:
                data = re.sub(rb'<row r="[0-9]+">', b"<row>", data)
                data = re.sub(rb'<c r="([AC-Z])([0-9]+)"', rb"<c", data)         # B keeps its place
            out.writestr(name, data)
    want = [c for _, cells in workbook_cells(full) for c in cells]
    got = [c for _, cells in workbook_cells(bare.getvalue()) for c in cells]
    assert [(r, c) for _, r, c, _, _ in want] == [(0, 0), (0, 1), (1, 1), (1, 3), (2, 0)]
    assert [(r, c) for _, r, c, _, _ in got] == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 0)]
    assert [c[3:] for c in got] == [c[3:] for c in want]
