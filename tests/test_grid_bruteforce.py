"""The window-based parser vs a sequential reading of the rules, on random
messy workbooks (brute force on small fixtures).

The model below visits one sheet cell by cell and keeps the running
contexts in plain Python; positions outside a row count as empty cells.
"""

import datetime as dt
import random

import pytest

from setbook.functions.vocab import (
    COLUMN_HEADERS, MONTH_NAMES, SECTION_NAMES, WEEKDAY_NAMES,
)
from setbook.operators.grid import parse_journal_cells
from setbook.sources.cells import CELLS_SCHEMA

EPOCH = dt.date(1899, 12, 30)


def as_text(v):
    if isinstance(v, float):
        return repr(v) if v != int(v) else f"{int(v)}.0"
    return v


class SheetModel:
    """The parsing rules of one sheet as two tables, applied cell by cell.

    ``SETS``: what a cell tells about the session.  ``ENDS``: the first rule
    that holds decides what becomes of the cell; one that no rule takes is a
    value.
    """

    SETS = (
        (lambda m, v: v in MONTH_NAMES, lambda m, v: {"month": v}),
        (lambda m, v: v in WEEKDAY_NAMES, lambda m, v: {
            "weekday": v, "deload": int(m.near(-1) == "Deload"), "type": m.near(1),
            "date": EPOCH + dt.timedelta(days=int(m.near(-2))) if isinstance(m.near(-2), float) else None}),
        (lambda m, v: isinstance(v, str) and "/365" in v, lambda m, v: {"counter": v}),
    )
    ENDS = (
        (lambda m, v: m.is_context(v), "skip"),
        (lambda m, v: len(as_text(v)) == 7 and m.near(2) in WEEKDAY_NAMES, "skip"),
        (lambda m, v: v in COLUMN_HEADERS or v == "", "skip"),
        (lambda m, v: isinstance(v, str) and "Total" in v, "end of row"),
        (lambda m, v: v in SECTION_NAMES, "section"),
    )

    def __init__(self, grid):
        self.grid = grid            # {(r, c): value}
        self.session = {"type": "", "deload": 0}
        self.section, self.records_before, self.values, self.out = None, 0, [], []

    def near(self, offset):
        r, c = self.place
        return self.grid.get((r, c + offset), "")

    def is_context(self, v):
        s = self.session
        day = s["date"].strftime("%d-%m-%Y") if s.get("date") else None
        return v in (s.get("month"), s.get("weekday"), s["type"], s.get("counter", 0), day, "Deload")

    def run(self):
        for r in sorted({r for r, _ in self.grid if r > 0}):
            for c in range(1 + max(c for q, c in self.grid if q == r)):
                self.place, v = (r, c), self.grid.get((r, c), "")
                for holds, told in self.SETS:
                    if holds(self, v):
                        self.session.update(told(self, v))
                fate = next((f for holds, f in self.ENDS if holds(self, v)), "value")
                if fate == "end of row":
                    break
                if fate == "section":
                    self.section, self.records_before = v, len(self.out)
                if fate == "value":
                    self.take(str(int(v)) if isinstance(v, float) else v)
        return self.out

    def take(self, value):
        self.values.append(value)
        if len(self.values) == 5:
            s = self.session
            self.out.append((s.get("month") or "", s.get("weekday") or "", s.get("date"), s["deload"], s.get("counter"),
                             len(self.out) + 1 - self.records_before, as_text(s["type"]), self.section or "", *self.values))
            self.values = []


def random_sheet(rnd, totals=True):
    """``totals``: workout types may hold the word that ends a row."""
    rows = [["header row"]]
    noise = ["May", "Push", "Weights", "Squats!", "Total", "Deload", 0.0, 7.5, "", "Legs"]
    for _ in range(rnd.randint(1, 4)):
        d = dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 360))
        type_ = rnd.choice(["Pull", "Push", "Legs", "Full", 7.0, "Totals day" if totals else "Weights"])
        if rnd.random() < 0.9:
            rows.append([MONTH_NAMES[d.month - 1]])
        counter = f"{d.timetuple().tm_yday}/365" if rnd.random() < 0.9 else ""
        rows.append([float((d - EPOCH).days), rnd.choice(["Deload", ""]), WEEKDAY_NAMES[d.weekday()],
                     type_, counter])
        for _ in range(rnd.randint(1, 3)):
            rows.append([rnd.choice(SECTION_NAMES)])
            rows.append(list(COLUMN_HEADERS))
            for _ in range(rnd.randint(1, 4)):
                rec = [rnd.choice(["Pull-ups", "Dips", "Brand#1", "Plank (s)"]),
                       rnd.choice(["Bodyweight", "12.5kg", "20kg"]), rnd.choice(["Wide", "Neutral", ""]),
                       float(rnd.choice([5, 8, 10, 12])) + rnd.choice([0.0, 0.5]), float(rnd.choice([0, 60, 90]))]
                if rnd.random() < 0.15:
                    rec[rnd.randrange(5)] = rnd.choice(noise)
                rows.append(rec)
            if rnd.random() < 0.5:
                rows.append(["Total Reps", "", 31.0, "March", "x/365"])
            if rnd.random() < 0.4:      # a session's marks right of a break are never read
                rows.append([rnd.choice(["Total", "Totals day"]), 45000.0, "Deload", "Tuesday", "Totals day" if totals else "Push", "9/365"])
                rows.append([rnd.choice(["Totals day", 7.0]), "a", "b", "c", "d", "e"])
    return rows


def to_cells(wb, sheet, rows):
    out, grid = [], {}
    for r, row in enumerate(rows):
        for c, v in enumerate(row):
            if v is None:
                continue
            grid[(r, c)] = v
            out.append((wb, sheet, r, c, v if isinstance(v, str) else None, v if isinstance(v, float) else None, None))
    return out, grid


@pytest.mark.parametrize("seed", [11, 12, 13])
def test_parser_matches_sequential_model(spark, seed):
    rnd = random.Random(seed)
    cells, expected = [], []
    for wb in range(8):
        for sheet in ("2022", "2023", "2024"):
            out, grid = to_cells(wb, sheet, random_sheet(rnd))
            cells += out
            if sheet != "2023":
                expected += [(wb, sheet) + rec for rec in SheetModel(grid).run()]
    df = parse_journal_cells(spark.createDataFrame(cells, CELLS_SCHEMA))
    got = [tuple(r) for r in df.collect()]
    norm = lambda rows: sorted(tuple("∅" if v is None else str(v) for v in row) for row in rows)
    assert len(got) == len(expected)
    assert norm(got) == norm(expected)


@pytest.mark.parametrize("seed,rows", [(11, 3), (12, 7), (14, 1)])
def test_chunked_parser_matches_sequential_model(spark, seed, rows):
    """Tiny row chunks put sessions, sections and records across chunk boundaries."""
    rnd = random.Random(seed)
    cells, expected = [], []
    for wb in range(6):
        for sheet in ("2022", "2023", "2024"):
            out, grid = to_cells(wb, sheet, random_sheet(rnd))
            cells += out
            if sheet != "2023":
                expected += [(wb, sheet) + rec for rec in SheetModel(grid).run()]
    df = parse_journal_cells(spark.createDataFrame(cells, CELLS_SCHEMA), rows_per_chunk=rows)
    got = [tuple(r) for r in df.collect()]
    norm = lambda rows_: sorted(tuple("∅" if v is None else str(v) for v in row) for row in rows_)
    assert len(got) == len(expected)
    assert norm(got) == norm(expected)


@pytest.mark.parametrize("seed,rows", [(21, 1), (22, 2), (23, 5), (24, 11), (25, 1000)])
def test_block_parser_without_ambiguous_totals(spark, seed, rows, monkeypatch):
    """No sheet has to be parsed whole: all of it comes from composed blocks."""
    from setbook.operators import grid
    rnd = random.Random(seed)
    cells, expected = [], []
    for wb in (1, 2, 3, 4, None):
        for sheet in ("2022", "2023", "2024"):
            out, model = to_cells(wb, sheet, random_sheet(rnd, totals=False))
            cells += out
            if sheet != "2023":
                expected += [(wb, sheet) + rec for rec in SheetModel(model).run()]
    # a sheet whose header comes late, and one without any header
    late = [["x"], ["Pull"], ["a", "b", "c", "d", "e"]] + [["f", "g", 0.0, "h", 1.5, "Pull"]] * 4 + [["May"], ["", "", "Friday", "Pull", "3/365"]]
    late += [["Pull"], ["Push"], ["i", "j", 0.0, "k", 2.0, "Pull", "Friday"]] * 3 + [["Total", "Monday"], ["l", "m", "n", "o", "p"]]
    for name, grid_rows in (("2025", late), ("2026", late[:7])):
        out, model = to_cells(9, name, grid_rows)
        cells += out
        expected += [(9, name) + rec for rec in SheetModel(model).run()]

    def whole(*args):
        raise AssertionError("a sheet was parsed whole")
    monkeypatch.setattr(grid, "_parse_sheets", whole)
    got = [tuple(r) for r in parse_journal_cells(spark.createDataFrame(cells, CELLS_SCHEMA), rows_per_chunk=rows).collect()]
    norm = lambda rows_: sorted(tuple("∅" if v is None else str(v) for v in row) for row in rows_)
    assert norm(got) == norm(expected)


@pytest.mark.parametrize("rows", [1000, 6])
def test_first_blocks_give_their_records_at_once(spark, rows, monkeypatch):
    """Of a sheet's first block the parser keeps a row a record and its last cell; only values of later blocks are
    numbered and grouped."""
    from setbook.operators import grid
    rnd = random.Random(41)
    cells, expected, ends, later = [], [], set(), 0
    for wb in (1, 2, 3, None):
        out, model = to_cells(wb, "2024", random_sheet(rnd, totals=False))
        cells += out
        expected += [(wb, "2024") + rec for rec in SheetModel(model).run()]
        ends |= {(wb, r // rows) for r, _ in model if r > 0}
        later += sum(r // rows > 0 for r, _ in model)
    kept = {}

    def count(df, label):
        df = written(df, label)
        kept[label] = df.count()
        return df
    written = grid.written
    monkeypatch.setattr(grid, "written", count)
    got = [tuple(r) for r in parse_journal_cells(spark.createDataFrame(cells, CELLS_SCHEMA), rows_per_chunk=rows).collect()]
    norm = lambda rows_: sorted(tuple("∅" if v is None else str(v) for v in row) for row in rows_)
    assert norm(got) == norm(expected)
    if rows == 1000:
        assert kept["parse-blocks"] <= len(expected) + len(ends) and not kept["parse-summaries"]
    else:
        assert later and kept["parse-blocks"] <= len(expected) + len(ends) + later


@pytest.mark.parametrize("rows", [None, 1, 4, 1000])
def test_contexts_as_texts_and_numbers(spark, rows):
    """The session's day as a text is hidden, another day's is a value; a number hides the numeric type only; empty
    texts are missing cells; a section before nothing is kept for what comes later."""
    from setbook.operators import grid
    day = dt.date(2024, 5, 6)
    sheet = [["x"], ["May"], [float((day - EPOCH).days), "", "Monday", 7.0, "127/365"], ["Pull"], list(COLUMN_HEADERS),
             ["a", "", "06-05-2024", "07-05-2024", 7.0, "7.0", 8.0, "", "b"], ["Total", 1.0], ["Push"], [""], ["Legs"],
             ["c", "d", "e-05-2024", "", 6.0, "f"], ["06-05-2024", "g"], ["", "", ""], ["Warm-Up"], list(COLUMN_HEADERS),
             [float((day - EPOCH).days) + 1, "Deload", "Tuesday", "", "128/365"], ["h", "06-05-2024", "07-05-2024", 0.0, "i"],
             ["Pull"], ["j", 1.0, 2.0, "Total"], ["Push"], [""]]
    cells, model = to_cells(1, "2024", sheet)
    expected = [(1, "2024") + rec for rec in SheetModel(model).run()]
    got = [tuple(r) for r in grid.parse_journal_cells(spark.createDataFrame(cells, CELLS_SCHEMA), rows_per_chunk=rows).collect()]
    norm = lambda rows_: sorted(tuple("∅" if v is None else str(v) for v in row) for row in rows_)
    assert len(expected) == 3 and norm(got) == norm(expected)


def test_sheets_without_hidden_totals_take_four_windows(spark, monkeypatch):
    """All passes are for sheets that could hide a total; the others share one sort and four windows."""
    from setbook.operators import grid
    rnd = random.Random(31)
    cells, expected = [], []
    for wb in (1, 2, None):
        out, model = to_cells(wb, "2024", random_sheet(rnd, totals=False))
        cells += out
        expected += [(wb, "2024") + rec for rec in SheetModel(model).run()]
    df = spark.createDataFrame(cells, CELLS_SCHEMA)
    plan = grid._parse_plain(df, 0, ())._jdf.queryExecution().optimizedPlan().toString()
    assert sum(ln.split("+- ")[-1].startswith("Window") for ln in plan.splitlines()) == 4

    def whole(*args):
        raise AssertionError("a sheet went through all passes")
    monkeypatch.setattr(grid, "_parse_hidden_totals", whole)
    got = [tuple(r) for r in parse_journal_cells(df).collect()]
    norm = lambda rows_: sorted(tuple("∅" if v is None else str(v) for v in row) for row in rows_)
    assert norm(got) == norm(expected)
