"""Generic DataFrame operators; marts in ``setbook.plans`` are compositions."""

from .calendar import active_day_share, calendar_presence
from .change import period_change
from .classify import classify, is_reps_exercise, is_seconds_exercise, like_predicate, restrict_to, semi_join
from .grid import clean_journal, parse_journal_cells, select_sheets
from .quality import check_journal
from .densify import fill_month_gaps, month_bounds
from .rank import top_ranked
from .rollup import count_sessions, rollup_sum, share
from .staging import STG_COLUMNS, stage_journal
from .units import convert_unit

__all__ = [
    "active_day_share", "calendar_presence", "period_change", "classify", "is_reps_exercise",
    "is_seconds_exercise", "like_predicate", "restrict_to", "semi_join", "fill_month_gaps",
    "month_bounds", "top_ranked", "count_sessions", "rollup_sum", "share",
    "STG_COLUMNS", "stage_journal", "convert_unit", "clean_journal", "parse_journal_cells",
    "select_sheets", "check_journal",
]
