"""Calendar expressions (all return Columns; nothing leaves the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocab import EXCEL_EPOCH_1900, EXCEL_EPOCH_1904, MONTH_NAMES, WEEKDAY_NAMES


def _position_in(names, col: Column) -> Column:
    """1-based position of ``col`` in ``names``; NULL when absent or NULL."""
    pos = F.array_position(F.array(*[F.lit(n) for n in names]), col)
    return F.nullif(pos, F.lit(0)).cast("smallint")


def month_number(col) -> Column:
    """'january' -> 1 … 'december' -> 12; anything else -> NULL (exact match)."""
    return _position_in([m.lower() for m in MONTH_NAMES], F.col(col) if isinstance(col, str) else col)


def weekday_number(col) -> Column:
    """'monday' -> 1 … 'sunday' -> 7; anything else -> NULL (exact match)."""
    return _position_in([d.lower() for d in WEEKDAY_NAMES], F.col(col) if isinstance(col, str) else col)


def _name_at(names, position: Column) -> Column:
    """The lower-case name at a 1-based position; NULL at NULL (``element_at`` calls itself never NULL, so that tests
    for NULL are dropped).  A lookup costs a row far less than formatting a date."""
    return F.try_element_at(F.array(*[F.lit(n.lower()) for n in names]), position)


def month_name(date_col) -> Column:
    """Lower-case English month name of a DATE, e.g. 'may'."""
    return _name_at(MONTH_NAMES, F.month(date_col))


def padded_month_name(date_col) -> Column:
    """Month name blank-padded to 9 characters, e.g. 'may      '."""
    return F.rpad(month_name(date_col), 9, " ")


def weekday_name(date_col) -> Column:
    """Lower-case English weekday name of a DATE."""
    return _name_at(WEEKDAY_NAMES, F.weekday(date_col) + 1)


def year_length(year_col) -> Column:
    """366 for Gregorian leap years, else 365 (SMALLINT)."""
    y = F.col(year_col) if isinstance(year_col, str) else year_col
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(leap, F.lit(366)).otherwise(F.lit(365)).cast("smallint")


def month_start(date_col) -> Column:
    """First day of the month as DATE (``trunc`` keeps DATE, unlike ``date_trunc``)."""
    return F.trunc(date_col, "MM")


def year_start(date_col) -> Column:
    return F.trunc(date_col, "YEAR")


def serial_to_date(serial_col, date_mode: int = 0) -> Column:
    """Spreadsheet serial day number -> DATE (fractional part = time of day, dropped)."""
    epoch = EXCEL_EPOCH_1904 if date_mode == 1 else EXCEL_EPOCH_1900
    s = F.col(serial_col) if isinstance(serial_col, str) else serial_col
    return F.date_add(F.lit(epoch).cast("date"), F.floor(s).cast("int"))
