"""Column-expression helpers and the fixed vocabulary of the log format."""

from .calendar import (
    month_name,
    month_number,
    month_start,
    padded_month_name,
    serial_to_date,
    weekday_name,
    weekday_number,
    year_length,
    year_start,
)
from .numeric import percentage, relative_change
from .text import weight_kg, weight_unit

__all__ = [
    "month_name", "month_number", "month_start", "padded_month_name", "serial_to_date",
    "weekday_name", "weekday_number", "year_length", "year_start", "percentage",
    "relative_change", "weight_kg", "weight_unit",
]
