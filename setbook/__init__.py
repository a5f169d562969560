"""setbook — a Spark-native analytics engine for training logs.

A training log arrives as spreadsheet cells (one sheet per year) or as an
already-parsed journal table (one row per recorded set).  Everything here is
expressed as lazy DataFrame plans: the journal is staged into a typed fact
table and rolled up into marts (day / month / year / all-time sums, a dense
month grid, month-over-month and year-over-year changes, shares, session
counts, calendars, weekday matrices) plus parameterised presentation queries.

Layout
------
functions/  column-expression helpers (calendar names, safe percentages,
            weight text parsing) and the fixed vocabulary of the log format
sources/    table reads, journal derivation / materialisation, cell grids
operators/  generic DataFrame operators (rollups, densify, period change,
            ranking, calendars, grid parser, quality checks)
plans/      the named marts and presentation queries, plus their DuckDB
            oracle SQL
"""

__version__ = "0.1.0"
