"""Spreadsheet grid -> journal records (the cell parser), as window passes.

Input ``cells(workbook_id, sheet, r, c, sv, nv)``: one row per cell, text in
``sv`` ('' = empty) or a number in ``nv``.  Missing positions count as
empty.  The original reads each sheet cell by cell, keeping running
contexts; every rule is either a *running last value* (contexts), a
*running count* (the 5-cell chunking and the set counter) or a positional
lookup within the row — all window functions over one partition per
(workbook, sheet) ordered by (r, c).  All passes share that one sort; the
per-sheet plan has no join, no group-by and no Python.

Rules (cell visited in row-major order, row 0 skipped):
  month / weekday names set the current month / weekday; at a weekday the
  date is the serial two cells left, the deload flag is "left cell is
  'Deload'", the workout type is the cell to the right; text with '/365'
  sets the session counter.  A cell equal to any current context (or the
  text 'Deload') is invisible.  Visible cells are skipped when they are a
  7-character date cell with a weekday two to the right, or a column
  header; visible text with 'Total' ends the row; visible section names
  start a section (set counter 0).  Remaining non-empty cells are chunked
  by 5 — (exercise, weight, grip, amount, rest) — across rows and sections,
  and each 5th cell emits a record with the contexts current there.

Parallelism is one task per sheet, which the workbook format bounds
(65,536 x 256 cells in the legacy format, 1,048,576 rows in .xlsx); many
sheets and workbooks spread across the cluster.  For inputs whose sheets
are too big for one task, ``rows_per_chunk`` splits every sheet into blocks
of rows that are parsed alone; one row a block sums up how it acts on what
comes after, and prefixes over those rows compose the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import serial_to_date
from ..functions.text import weight_kg, weight_unit
from ..functions.vocab import (
    COLUMN_HEADERS, COUNTER_MARK, DATE_CELL_LENGTH, DELOAD_MARK, EXCLUDED_SHEETS, MONTH_NAMES,
    RECORD_WIDTH, SECTION_NAMES, TOTAL_MARK, WEEKDAY_NAMES,
)
from ..sources.scratch import written

SHEET = ("workbook_id", "sheet")
RECORD_FIELDS = ("exercise", "weight", "grip", "amount", "rest")


def select_sheets(cells: DataFrame, exclude=EXCLUDED_SHEETS) -> DataFrame:
    """Drop excluded sheets and the header row 0."""
    return cells.where(~F.col("sheet").isin(*exclude) & (F.col("r") > 0))


def _text(sv: Column, nv: Column) -> Column:
    """Python ``str(cell)``: text as is, numbers as repr of a float ('7.0')."""
    whole = nv == F.floor(nv)
    as_num = F.when(whole, F.concat(nv.cast("bigint").cast("string"), F.lit(".0"))) \
              .otherwise(nv.cast("string"))
    return F.coalesce(sv, as_num)


def _value(sv: Column, nv: Column) -> Column:
    """Record value: text as is, numbers truncated to int (7.5 -> '7')."""
    return F.coalesce(sv, nv.cast("bigint").cast("string"))


_CTX_FIELDS = ("weekday", "deload", "date", "type", "type_nv")


def _events(cells: DataFrame, key, date_mode, exclude_sheets) -> DataFrame:
    """Pass A: positional neighbours inside the row (missing = empty), the
    context events of each cell, the date-cell flag; inert cells dropped but
    for the last of the partition (``_end``).  ``_after`` says that a text
    with 'Total' stands further left in the row.

    ``key`` partitions the window; it must keep whole rows together.
    """
    w = Window.partitionBy(*key).orderBy("r", "c")
    sv, nv = F.col("sv"), F.col("nv")
    weekdays = [F.lit(d) for d in WEEKDAY_NAMES]

    def at(offset: int, col: str):
        """value of ``col`` at column c+offset of the same row, else NULL."""
        sign, hit = (-1 if offset < 0 else 1), F
        for s in range(1, abs(offset) + 1):
            near = f"_{sign * s}_"
            hit = hit.when((F.col(f"{near}r") == F.col("r")) & (F.col(f"{near}c") == F.col("c") + offset),
                           F.col(f"{near}{col}"))
        return hit

    # a per-workbook date mode column (workbook files) wins over the argument
    mode = F.coalesce("date_mode", F.lit(date_mode)) if "date_mode" in cells.columns else F.lit(date_mode)
    # every neighbour is looked up once: an expression that names it twice would make it two window functions
    around = [(n, c) for n, cols in ((-2, "nv"), (-1, "sv nv"), (1, "sv nv"), (2, "sv")) for c in ("r", "c", *cols.split())]
    # an empty text says what a missing cell says, so it need not be shuffled
    base = select_sheets(cells, exclude_sheets).where((sv != "") | sv.isNull() | nv.isNotNull())
    base = base.withColumn("_date_mode", mode).select(
        "_date_mode", *key, "r", "c", "sv", "nv",
        *[(F.lag(c, -n) if n < 0 else F.lead(c, n)).over(w).alias(f"_{n}_{c}") for n, c in around],
        F.last(F.when(sv.contains(TOTAL_MARK), F.col("r")), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)).alias("_total_r"),
    )
    # Empty cells and column headers matter only as neighbours:
    # they never set a context, section, break or value.
    base = base.where(~_inert() | F.col("_1_r").isNull())
    base = base.select(
        "_date_mode", *key, "r", "c", "sv", "nv", "_total_r", F.col("_1_r").isNull().alias("_end"),
        at(-1, "sv").alias("l1_sv"), at(-2, "nv").alias("l2_nv"),
        at(1, "sv").alias("r1_sv"), at(1, "nv").alias("r1_nv"), at(2, "sv").alias("r2_sv"),
    )
    # a weekday cell sets weekday, deload, date and type together
    wd_event = F.struct(
        sv.alias("weekday"),
        F.when(F.col("l1_sv") == DELOAD_MARK, 1).otherwise(0).alias("deload"),
        (F.when(F.col("_date_mode") == 1, serial_to_date(F.col("l2_nv"), 1))
          .otherwise(serial_to_date(F.col("l2_nv"), 0))).alias("date"),
        F.coalesce(_text(F.col("r1_sv"), F.col("r1_nv")), F.lit("")).alias("type"),
        F.col("r1_nv").alias("type_nv"),
    )
    # a 7-character cell (e.g. the serial '45413.0') with a weekday two to
    # the right is the session's date cell: decided here, carried as a flag
    # (the neighbour first: few cells have one, and only they are written as text)
    skip_date = F.coalesce(F.col("r2_sv").isin(*weekdays), F.lit(False)) & (
        F.length(_text(sv, nv)) == DATE_CELL_LENGTH)
    return base.select(
        *key, "r", "c", "sv", "nv",
        F.when(sv.isin(*[F.lit(m) for m in MONTH_NAMES]), sv).alias("e_month"),
        F.when(sv.isin(*weekdays), wd_event).alias("e_wd"),
        F.when(sv.contains(COUNTER_MARK), sv).alias("e_counter"),
        skip_date.alias("_dskip"), (F.coalesce(F.col("_total_r"), F.lit(0)) == F.col("r")).alias("_after"), "_end",
    )


def _inert() -> Column:
    return F.coalesce(F.col("sv") == "", F.lit(False)) | F.coalesce(F.col("sv").isin(*COLUMN_HEADERS), F.lit(False))


def _expand(df: DataFrame, wd: str = "_wd") -> DataFrame:
    return df.select("*", *[F.col(f"{wd}.{f}").alias(f"x_{f}") for f in _CTX_FIELDS]).drop(wd)


def _visible() -> Column:
    """Not equal to a current context nor the text 'Deload'.  Contexts start
    as '' (the counter as 0), so before the first month/weekday only empty
    cells match — and empty cells never act anyway."""
    # a number equals the initial counter 0 until a label is seen
    return ~_hidden(F.col("x_month"), lambda f: F.col(f"x_{f}"), F.col("x_counter"), at_start=F.col("x_counter").isNull())


def _may_break() -> Column:
    """Text with 'Total' outside a date cell: ends its row unless it equals a context."""
    return ~F.col("_dskip") & F.coalesce(F.col("sv").contains(TOTAL_MARK), F.lit(False))


_EVENTS = ("month", "wd", "counter")


def _heard(df: DataFrame, stop: Column | None = None) -> DataFrame:
    """The cells' events as h_*: NULL for those right of column ``stop`` of their row (NULL: all count)."""
    heard = F.lit(True) if stop is None else stop.isNull() | (F.col("c") <= stop)
    return df.withColumns({f"h_{e}": F.when(heard, F.col(f"e_{e}")) for e in _EVENTS})


def _is_break() -> Column:
    return _visible() & ~F.col("_dskip") & F.coalesce(F.col("sv").contains(TOTAL_MARK), F.lit(False))


def _section_and_value(brk: Column):
    """(section event, value cell) flags given the row's break column."""
    vis = _visible()
    at_break = F.col("c") == F.coalesce(brk, F.lit(-1))
    active = vis & ~F.col("_dskip") & ~at_break
    section_ev = active & F.coalesce(F.col("sv").isin(*SECTION_NAMES), F.lit(False))
    return section_ev, active & ~section_ev


def _records(df: DataFrame, key, fields) -> DataFrame:
    """Final record columns from per-record contexts and the 5 values."""
    set_counter = (F.col("_k") / RECORD_WIDTH).cast("bigint") - F.floor(
        F.coalesce(F.col("_k_at_sec"), F.lit(0)) / RECORD_WIDTH).cast("bigint")
    return df.select(
        *key,
        F.coalesce(F.col("x_month"), F.lit("")).alias("month"),
        F.coalesce(F.col("x_weekday"), F.lit("")).alias("weekday"),
        F.col("x_date").alias("date"),
        F.coalesce(F.col("x_deload"), F.lit(0)).alias("deload"),
        F.col("x_counter").alias("workout_counter"),
        set_counter.alias("set_counter"),
        F.coalesce(F.col("x_type"), F.lit("")).alias("type"),
        F.coalesce(F.col("x_section"), F.lit("")).alias("section"),
        *[f.alias(n) for f, n in zip(fields, RECORD_FIELDS)],
    )


def _ambiguous() -> Column:
    """The cell could keep a "Total" from ending its row: a workout type or counter label that contains it and so
    hides it, a total that is a date cell, or one that is a number as well."""
    total = F.coalesce(F.col("sv").contains(TOTAL_MARK), F.lit(False))
    return (F.coalesce(F.col("e_wd.type_nv").isNull() & F.col("e_wd.type").contains(TOTAL_MARK), F.lit(False))
            | F.coalesce(F.col("e_counter").contains(TOTAL_MARK), F.lit(False))
            | (total & (F.col("_dskip") | F.col("nv").isNotNull())))


def _passes(cells: DataFrame, key, known: Column, date_mode, exclude_sheets) -> DataFrame:
    """The cells of each block (``key``) in (r, c) order as if each "Total" ended its row, in four windows that share
    one sort.  ``known`` says that nothing stands before the block: its start has no contexts, values or section.

    ``x_*`` are the contexts and section set inside the block, ``_k`` counts its values, ``_f0`` to ``_f3`` are the
    values before the cell (of known blocks).  Rows left: the fifth values (a record each, if the block is known), the block's
    last cell (``_end``: what it leaves to those after it), cells with ``_ambiguous``, and of other blocks each value
    and section; ``_pend`` marks those that an outer context could hide, with ``sv`` and ``nv``.
    """
    w = Window.partitionBy(*key).orderBy("r", "c")
    last = lambda c: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sv = F.col("sv")
    ev = _events(cells, key, date_mode, exclude_sheets)
    out = F.col("_after") | F.coalesce(sv.contains(TOTAL_MARK), F.lit(False))
    ev = ev.select(*key, "r", "c", "sv", "nv", "_end", _ambiguous().alias("_ambiguous"),
                   (out | F.col("_dskip") | _inert()).alias("_mute"),
                   *[F.when(~out, F.col(f"e_{e}")).alias(f"e_{e}") for e in _EVENTS])
    # ---- contexts, and what they leave visible
    b = ev.select(*key, "r", "c", "sv", "nv", "_end", "_ambiguous", "_mute",
                  *[last(f"e_{e}").alias(f"x_{e}") for e in _EVENTS])
    marks = F.col("_ambiguous") | F.col("_end")
    b = b.where(~F.col("_mute") | marks)
    month, wd, counter = now = [F.col(f"x_{e}") for e in _EVENTS]
    shown = ~F.col("_mute") & ~_hidden(month, wd.getField, counter, at_start=known & counter.isNull())
    pend = ~known & (month.isNull() | wd.isNull() | counter.isNull())
    value, named = _value(sv, F.col("nv")), F.coalesce(sv.isin(*SECTION_NAMES), F.lit(False))
    b = b.select(*key, "r", "c", value.alias("_v"), F.when(pend, F.struct("sv", "nv")).alias("_pend"),
                 F.struct(*now).alias("_x"), shown.alias("_shown"), named.alias("_named"), "_end", "_ambiguous")
    # rows are copied often from here on: few columns, the contexts as one
    b = b.select(*key, "r", "c", "_v", "_pend", "_x", (F.col("_shown") & ~F.col("_named")).cast("int").alias("_val"),
                 F.when(F.col("_shown") & F.col("_named"), F.col("_v")).alias("_sec"), "_end", "_ambiguous")
    own, is_value = F.when(F.col("_pend").isNull(), F.col("_sec")), F.col("_val") == 1
    b = b.where(is_value | F.col("_sec").isNotNull() | marks)
    # ---- running value count, current section
    k = b.select("*", F.sum("_val").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_k"),
                 last(own).alias("x_section"), F.lag(own).over(w).isNotNull().alias("_opened"))
    # the cell after a section says that one began, so that its own row can go
    later = ~known & (is_value | F.col("_sec").isNotNull())
    k = k.where(is_value | later | marks)
    # ---- 5-cell records at the 5th value, the count at the section
    at_sec = F.when(own.isNotNull(), F.col("_k")).when(F.col("_opened"), F.col("_k") - F.col("_val"))
    rec = k.select("*", last(at_sec).alias("_k_at_sec"),
                   *[F.lag("_v", RECORD_WIDTH - 1 - i).over(w).alias(f"_f{i}") for i in range(RECORD_WIDTH - 1)])
    rec = rec.where((is_value & (F.col("_k") % RECORD_WIDTH == 0)) | later | marks)
    return rec.select(
        *key, "r", "c", "_v", "_pend.sv", "_pend.nv", F.col("_pend").isNotNull().alias("_pend"), is_value.alias("_val"),
        F.col("_sec").isNotNull().alias("_sec"), "_end", "_ambiguous", "_k", "x_section", "_k_at_sec",
        *[f"_f{i}" for i in range(RECORD_WIDTH - 1)], *[F.col(f"_x.x_{e}") for e in _EVENTS])


def _fifth() -> Column:
    return F.col("_val") & (F.col("_k") % RECORD_WIDTH == 0)


def _plain_records(rec: DataFrame, key) -> DataFrame:
    """Records of known blocks, from the rows of their fifth values."""
    rec = _expand(rec.withColumnRenamed("x_wd", "_wd"))
    return _records(rec, key, [*[F.col(f"_f{i}") for i in range(RECORD_WIDTH - 1)], F.col("_v")])


def _parse_plain(cells: DataFrame, date_mode, exclude_sheets) -> DataFrame:
    """The records of every sheet as if each "Total" ended its row (``_passes``).

    Rows with ``_ambiguous`` are no records: they name the sheets in which
    that does not hold, whose records here are void.
    """
    rec = _passes(cells, SHEET, F.lit(True), date_mode, exclude_sheets)
    return _plain_records(rec.where(_fifth() | F.col("_ambiguous")), [*SHEET, "_ambiguous"])


def _parse_sheets(cells: DataFrame, date_mode, exclude_sheets) -> DataFrame:
    """One partition per sheet.  All sheets are parsed in few windows as if no "Total" were hidden, and the records
    written; sheets in which one could be, if any, are parsed again with all passes (``_parse_hidden_totals``)."""
    records = written(_parse_plain(cells, date_mode, exclude_sheets), "parse-records")
    special, out = records.where("_ambiguous").select(*SHEET).distinct(), records.drop("_ambiguous")
    if special.isEmpty():
        return out
    hidden = _parse_hidden_totals(_attach(cells, special, SHEET, "left_semi"), date_mode, exclude_sheets)
    return _attach(out, special, SHEET, "left_anti").unionByName(hidden)


def _parse_hidden_totals(cells: DataFrame, date_mode, exclude_sheets) -> DataFrame:
    """One partition per sheet: every pass is a window over (workbook,
    sheet) ordered by (r, c), all sharing one sort."""
    key = list(SHEET)
    w = Window.partitionBy(*key).orderBy("r", "c")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row_w = Window.partitionBy(*key, "r")
    last = lambda c: F.last(c, ignorenulls=True).over(run)

    def contexts(df: DataFrame, stop: Column | None) -> DataFrame:
        df = _heard(df, stop)
        return _expand(df.select(*[c for c in df.columns if not c.startswith("h_")],
                                 last("h_month").alias("x_month"), last("h_wd").alias("_wd"),
                                 last("h_counter").alias("x_counter")))

    def break_of(df: DataFrame, name: str) -> DataFrame:
        df = df.withColumn(name, F.min(F.when(_is_break(), F.col("c"))).over(row_w))
        return df.drop("x_month", "x_counter", *[f"x_{f}" for f in _CTX_FIELDS])

    ev = _events(cells, key, date_mode, exclude_sheets).where(~_inert()).drop("_after", "_end")
    # ---- "Total" ends the row.  The original never visits what is right of a
    # break, so that must not set contexts: the first pass is deaf to all that
    # is right of a possible break, the second to what is right of those found
    ev = ev.withColumn("_first", F.min(F.when(_may_break(), F.col("c"))).over(row_w))
    a = break_of(contexts(ev, F.col("_first")), "_stop")
    a = break_of(contexts(a, F.col("_stop")), "_brk")
    kept = a.where(F.col("_brk").isNull() | (F.col("c") <= F.col("_brk")))
    # ---- pass B: contexts over the cells actually visited ----------------
    b = contexts(kept, None)
    section_ev, is_value = _section_and_value(F.col("_brk"))
    b = b.select("*", section_ev.alias("_sec"), is_value.alias("_val"))
    # ---- pass C: running value count, current section, count at section --
    k = F.sum(F.col("_val").cast("int")).over(run)
    c_df = b.select(
        "*", k.alias("_k"),
        F.last(F.when(F.col("_sec"), F.col("sv")), ignorenulls=True).over(run).alias("x_section"),
        # value cells seen before the latest section start
        F.last(F.when(F.col("_sec"), k), ignorenulls=True).over(run).alias("_k_at_sec"),
    )
    # ---- pass D: 5-cell records, emitted at the 5th value cell ------------
    vals = c_df.where(F.col("_val")).withColumn("_v", _value(F.col("sv"), F.col("nv")))
    lagged = [F.lag("_v", RECORD_WIDTH - 1 - i).over(w) for i in range(RECORD_WIDTH - 1)]
    rec = vals.select("*", *[lg.alias(f"_f{i}") for i, lg in enumerate(lagged)]) \
              .where(F.col("_k") % RECORD_WIDTH == 0)
    fields = [F.col(f"_f{i}") for i in range(RECORD_WIDTH - 1)] + [F.col("_v")]
    return _records(rec, key, fields)


def _same(left: DataFrame, right: DataFrame, key) -> tuple:
    """(right with its key renamed, null-safe condition, names to drop)."""
    names = {k: f"_r{k}" for k in key}
    right = right.withColumnsRenamed(names)
    cond = F.lit(True)
    for k, n in names.items():
        cond = cond & left[k].eqNullSafe(right[n])
    return right, cond, list(names.values())


def _attach(left: DataFrame, right: DataFrame, key, how: str = "left") -> DataFrame:
    right, cond, names = _same(left, right, key)
    out = left.join(right, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names)


def _hidden(month: Column, day, counter: Column, at_start: Column | None = None) -> Column:
    """The cell equals one of the contexts (``day``: a field of the weekday's) or the text 'Deload'; with ``at_start``
    (no counter was seen yet) also the number 0, which equals the initial counter.  A type that is a text equals texts
    only, one that is a number numbers only; the date is compared as the text 'DD-MM-YYYY'."""
    sv, nv = F.col("sv"), F.col("nv")
    tests = [sv == month, sv == day("weekday"), day("type_nv").isNull() & (sv == day("type")), sv == counter,
             # only such texts are worth writing the date for
             F.when(F.substring(sv, 3, 1) == "-", sv == F.date_format(day("date"), "dd-MM-yyyy")),
             nv == day("type_nv"), sv == DELOAD_MARK]
    out = F.lit(False)
    for t in tests:
        out = out | F.coalesce(t, F.lit(False))
    return out if at_start is None else out | (at_start & F.coalesce(nv == 0, F.lit(False)))


def _parse_blocks(cells: DataFrame, date_mode, exclude_sheets, rows_per_chunk: int) -> DataFrame:
    """Oversized sheets: blocks of rows parsed alone, their effects composed along the sheet.

    1. Every block is read once, by itself (``_passes``), and what it holds
       is written as a table.  Nothing stands before a sheet's first rows, so
       block 0 gives its records there; the rest is for later blocks.
    2. A block's last cell is its summary, how it acts on what comes after:
       the contexts it leaves, the values it adds, the section it ends in.
       One exclusive prefix over a sheet's summaries gives the contexts at
       each block's start; only the cells before a block's own header
       (``_pend``) are looked at again with them, and what they hide corrects
       the block's counts.  A second prefix, over one row a block, numbers
       the values.
    3. Five consecutive values, wherever their blocks are, make a record:
       one grouping by record number, combined inside the tasks first; of
       block 0 only the values beyond its last record take part.

    A sheet in which a workout type or counter label contains 'Total' could
    hide a total from ending its row; such sheets, if any, are parsed whole.
    """
    key = [*SHEET, "_h"]
    chunked = cells.withColumn("_h", F.floor(F.col("r") / rows_per_chunk).cast("long"))
    blocks = written(_passes(chunked, key, F.col("_h") == 0, date_mode, exclude_sheets), "parse-blocks")
    special, whole = blocks.where("_ambiguous").select(*SHEET).distinct(), None
    if not special.isEmpty():
        blocks = _attach(blocks, special, SHEET, "left_anti")
        whole = _parse_sheets(_attach(cells, special, SHEET, "left_semi"), date_mode, exclude_sheets)
    first, later = blocks.where((F.col("_h") == 0) & _fifth()), blocks.where(F.col("_h") > 0)
    own = F.when(F.col("x_section").isNotNull(), F.struct(F.col("x_section").alias("name"), F.col("_k_at_sec").alias("at")))
    # what each block leaves behind, and the contexts at its start; a sheet of block 0 alone needs neither
    order = Window.partitionBy(*SHEET).orderBy("_h")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fields = [f"_f{i}" for i in range(RECORD_WIDTH - 1)]
    m = (F.col("_k") % RECORD_WIDTH).cast("int")
    tail = F.slice(F.when(F.col("_val"), F.array(*fields[1:], "_v")).otherwise(F.array(*fields)), RECORD_WIDTH - m, m)
    left = blocks.where("_end").select(
        *key, F.col("_k").alias("_n0"), own.alias("_osec"), F.when(F.col("_h") == 0, tail).alias("_tail"),
        F.lead("_h").over(order).alias("_next"),
        *[F.last(f"x_{e}", ignorenulls=True).over(before).alias(f"c_{e}") for e in _EVENTS])
    left = written(left.where((F.col("_h") > 0) | F.col("_next").isNotNull()), "parse-summaries")
    # cells before a block's own header, with the contexts that hold there
    now = [F.coalesce(f"x_{e}", f"c_{e}") for e in _EVENTS]
    run = Window.partitionBy(*key).orderBy("r", "c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = _attach(later.where(F.col("_pend") & (F.col("_val") | F.col("_sec"))), left, key)
    head = head.withColumn("_hid", _hidden(now[0], now[1].getField, now[2], at_start=now[2].isNull()))
    head = head.withColumn("_gone", F.sum((F.col("_val") & F.col("_hid")).cast("long")).over(run))
    head = head.withColumn("_at", F.col("_k") - F.col("_gone"))
    shown = F.when(F.col("_sec") & ~F.col("_hid"), F.struct(F.col("sv").alias("name"), F.col("_at").alias("at")))
    head = written(head.select(
        *key, "r", "c", "_val", "_hid", "_gone", "_at", "_v", *[n.alias(f"x_{e}") for n, e in zip(now, _EVENTS)],
        F.last(shown, ignorenulls=True).over(run).alias("_hsec")), "parse-heads")
    latest = F.max_by("_hsec", F.when(F.col("_hsec").isNotNull(), F.struct("r", "c")))
    heads = head.groupBy(*key).agg(F.max("_gone").alias("_gone"), latest.alias("_hsec"))
    # numbers of the values: what the blocks before add, less what their contexts hid
    gone = F.coalesce(F.col("_gone"), F.lit(0))
    shift = lambda sec, by: F.when(sec.isNotNull(), F.struct(sec["name"].alias("name"), (sec["at"] + by).alias("at")))
    sums = _attach(left, heads, key)
    sums = sums.withColumn("_kb", F.coalesce(F.sum(F.col("_n0") - gone).over(before), F.lit(0)))
    sums = sums.select(
        *key, "_kb", gone.alias("_less"), shift(F.col("_hsec"), F.col("_kb")).alias("_hsec"),
        F.coalesce(shift(F.col("_osec"), F.col("_kb") - gone), shift(F.col("_hsec"), F.col("_kb"))).alias("_end"))
    sums = sums.select(*[c for c in sums.columns if c != "_end"],
                       F.last("_end", ignorenulls=True).over(before).alias("_csec"))
    contexts = [f"x_{e}" for e in _EVENTS]
    body = later.where(F.col("_val") & ~F.col("_pend")).select(
        *key, "_v", F.col("_k").alias("_at"), F.lit(True).alias("_body"), *contexts, own.alias("_own"))
    top = head.where(F.col("_val") & ~F.col("_hid")).select(
        *key, "_v", "_at", F.lit(False).alias("_body"), *contexts, F.col("_hsec").alias("_own"))
    v = _attach(body.unionByName(top), sums, key)
    add = F.col("_kb") - F.when(F.col("_body"), F.col("_less")).otherwise(0)
    section = F.coalesce(shift(F.col("_own"), add), F.when(F.col("_body"), F.col("_hsec")), F.col("_csec"))
    v = v.select(*SHEET, "_v", (F.col("_at") + add).alias("_k"), section.alias("_section"), *contexts)
    # values of block 0 beyond its last record; the record's contexts are those of its fifth value, never one of these
    over = left.where(F.size("_tail") > 0).select(*SHEET, "_n0", F.size("_tail").alias("_m"), F.posexplode("_tail").alias("_i", "_v"))
    over = over.select(*SHEET, "_v", (F.col("_n0") - F.col("_m") + F.col("_i") + 1).alias("_k"))
    v = v.unionByName(over, allowMissingColumns=True)
    # records: five consecutive values; the fifth has the contexts
    pos = (F.col("_k") - 1) % RECORD_WIDTH
    fifth = F.struct("_section", "_k", *contexts)
    rec = v.groupBy(*SHEET, ((F.col("_k") - 1) / RECORD_WIDTH).cast("long").alias("_g")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(F.when(pos == i, F.col("_v"))).alias(f"_f{i}") for i in range(RECORD_WIDTH)],
        F.max_by(fifth, F.col("_k")).alias("_fifth")).where(F.col("_n") == RECORD_WIDTH)
    rec = rec.select(*SHEET, *[f"_f{i}" for i in range(RECORD_WIDTH)], "_fifth.*")
    rec = _expand(rec.select(*SHEET, *[f"_f{i}" for i in range(RECORD_WIDTH)], "_k", "x_month", "x_counter",
                             F.col("x_wd").alias("_wd"), F.col("_section.name").alias("x_section"),
                             F.col("_section.at").alias("_k_at_sec")))
    out = _plain_records(first, SHEET).unionByName(
        _records(rec, list(SHEET), [F.col(f"_f{i}") for i in range(RECORD_WIDTH)]))
    return out if whole is None else out.unionByName(whole)


def parse_journal_cells(cells: DataFrame, date_mode: int = 0, exclude_sheets=EXCLUDED_SHEETS,
                        rows_per_chunk: int | None = None) -> DataFrame:
    """Parse cells into records: month, weekday, date, deload,
    workout_counter (text 'N/365'), set_counter, type, section, exercise,
    weight (text), grip, amount, rest (text values) plus workbook_id/sheet.
    ``date_mode`` 1 reads serial dates from the 1904 epoch where the cells
    do not say otherwise.

    Every sheet is one window partition.  With ``rows_per_chunk`` all sheets
    are instead split into blocks of so many row numbers (``r`` ranges),
    which are parsed alone and then composed (``_parse_blocks``): the
    caller's choice for sheets too large for a task, with the same result.
    """
    if rows_per_chunk is None:
        return _parse_sheets(cells, date_mode, exclude_sheets)
    return _parse_blocks(cells, date_mode, exclude_sheets, rows_per_chunk)


def clean_journal(parsed: DataFrame, keep=()) -> DataFrame:
    """Parsed text records -> the 14 typed journal columns.

    Weight text -> (kg, unit) with native expressions; lower-case labels;
    '/365' stripped from the counter.  Casts are ``try_cast`` so a bad
    value becomes NULL and is reported by ``check_journal`` instead of
    aborting the load.
    """
    return parsed.select(
        *keep,
        F.lower("month").alias("month"),
        F.lower("weekday").alias("weekday"),
        F.col("date"),
        F.col("deload").cast("smallint").alias("deload"),
        F.regexp_replace("workout_counter", "/365", "").try_cast("smallint").alias("workout_counter"),
        F.col("set_counter").try_cast("smallint").alias("set_counter"),
        F.lower("type").alias("type"),
        F.lower("section").alias("section"),
        F.lower("exercise").alias("exercise"),
        weight_kg("weight").alias("weight"),
        F.lower(weight_unit("weight")).alias("weight_unit"),
        F.lower("grip").alias("grip"),
        # numbers arrive truncated; a text must be a whole number as it stands
        F.col("amount").try_cast("smallint").alias("amount"),
        F.col("rest").try_cast("smallint").alias("rest"),
    )
