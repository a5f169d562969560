"""Sources and sinks: driver tables, the journal table, spreadsheet cells."""

from .journal import (
    JOURNAL_COLUMNS,
    JOURNAL_SCHEMA,
    conform_journal,
    derive_journal,
    journal_for,
    read_journal,
    write_journal,
)
from .tables import read_table

__all__ = [
    "JOURNAL_COLUMNS", "JOURNAL_SCHEMA", "conform_journal", "derive_journal", "journal_for",
    "read_journal", "write_journal", "read_table",
]
