"""Grid parser on hand-made sheets and on the table-derived workbook."""

import datetime as dt

from setbook.operators.grid import clean_journal, parse_journal_cells
from cells_journal import journal_from_cells_fixture
from setbook.sources.cells import CELLS_SCHEMA, cells_from_tables

from conftest import SF_SMALL

HEAD = ["Exercise", "Weight", "Grip", "Amount", "Rest (s)"]
SERIAL_2024_05_06 = float((dt.date(2024, 5, 6) - dt.date(1899, 12, 30)).days)   # a monday


def sheet_cells(rows, sheet="2024", workbook=1):
    """rows: list of lists (row 0 = header row, skipped); None = missing cell."""
    out = []
    for r, row in enumerate(rows):
        for c, v in enumerate(row):
            if v is None:
                continue
            if isinstance(v, str):
                out.append((workbook, sheet, r, c, v, None, None))
            else:
                out.append((workbook, sheet, r, c, None, float(v), None))
    return out


def session(type_="Pull", deload="", counter="127/365"):
    return [["May"], [SERIAL_2024_05_06, deload, "Monday", type_, counter]]


def parse(spark, cells):
    df = spark.createDataFrame(cells, CELLS_SCHEMA)
    return clean_journal(parse_journal_cells(df)).orderBy("workout_counter", "section", "set_counter").collect()


def test_basic_session_and_total_row(spark):
    rows = [["title"], *session(), ["Warm-Up"], HEAD,
            ["Pull-ups", "Bodyweight", "Wide", 10.0, 60.0],
            ["Pull-ups", "12.5kg", "Wide", 7.5, 90.0],
            ["Total Reps", None, None, 17.0, "ignored", "Push"],
            ["Push"], HEAD, ["Dips", "20kg", "Neutral", 8.0, 120.0]]
    got = parse(spark, sheet_cells(rows))
    assert [(r.section, r.set_counter, r.exercise, str(r.weight), r.amount, r.rest) for r in got] == [
        ("push", 1, "dips", "20.00", 8, 120),
        ("warm-up", 1, "pull-ups", "0.00", 10, 60),
        ("warm-up", 2, "pull-ups", "12.50", 7, 90),       # 7.5 truncated
    ]
    r = got[0]
    assert (r.month, r.weekday, str(r.date), r.deload, r.workout_counter, r.type) == (
        "may", "monday", "2024-05-06", 0, 127, "pull")


def test_blank_value_shifts_later_chunks(spark):
    rows = [["t"], *session(type_="Legs"), ["Pull"], HEAD,
            ["Pull-ups", "Bodyweight", "", 10.0, 60.0],      # blank grip: chunk takes the next cell
            ["Dips", "20kg", "Neutral", 8.0, 120.0]]
    got = parse(spark, sheet_cells(rows))
    assert len(got) == 1
    r = got[0]
    assert (r.exercise, r.grip, r.amount, r.rest) == ("pull-ups", "10", 60, None)   # 'Dips' as rest -> NULL


def test_section_equal_to_type_is_invisible(spark):
    rows = [["t"], *session(type_="Pull"), ["Warm-Up"], HEAD,
            ["A", "Bodyweight", "w", 1.0, 1.0],
            ["Pull"], HEAD,                                   # equals the workout type -> not a section
            ["B", "Bodyweight", "w", 2.0, 2.0]]
    got = parse(spark, sheet_cells(rows))
    assert [(r.section, r.set_counter, r.exercise) for r in got] == [
        ("warm-up", 1, "a"), ("warm-up", 2, "b")]


def test_deload_flag_and_excluded_sheet(spark):
    rows = [["t"], *session(type_="Push", deload="Deload"), ["Pull"], HEAD, ["X", "5kg", "w", 3.0, 30.0]]
    cells = sheet_cells(rows) + sheet_cells(rows, sheet="2023", workbook=2)
    got = parse(spark, cells)
    assert len(got) == 1 and got[0].deload == 1 and str(got[0].weight) == "5.00"


def test_counter_zero_before_label_hides_zero_numbers(spark):
    # before any 'N/365' label the counter is 0, so numeric 0 cells are invisible
    rows = [["t"], ["May"], [SERIAL_2024_05_06, "", "Monday", "Pull", ""], ["Pull"], HEAD,
            ["A", "Bodyweight", "w", 0.0, 5.0, "B", "Bodyweight", "w", 4.0, 5.0]]
    got = parse(spark, sheet_cells(rows))
    assert [(r.exercise, r.amount, r.rest) for r in got] == [("a", 5, None)]


def test_roundtrip_from_tables(spark):
    parsed = clean_journal(parse_journal_cells(cells_from_tables(spark, SF_SMALL)))
    expected = journal_from_cells_fixture(spark, SF_SMALL)
    from conftest import digest
    d = digest(parsed)
    assert d == digest(expected) and d[0] > 1000
