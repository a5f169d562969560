"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query starts from the journal derived from all rows of the driver
tables in ``sf_dir`` (written once per application as a parquet table) or, as
in a build, from one of the two cubes over all its rows, and runs one mart
or presentation query over the whole data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import weight_kg, weight_unit
from ..operators.classify import semi_join
from ..operators.grid import clean_journal, parse_journal_cells
from ..operators.order import global_position
from ..operators.quality import check_journal, rejected_rows
from ..operators.staging import stage_journal
from ..session import app_id
from ..sources.cells import cells_from_tables
from ..sources.dump import read_dump, write_dump
from ..sources.journal import (
    _LOCK, _input_state, derive_journal, exercise_from_part, journal_for, odd_weight_texts, read_journal, table_for,
    write_journal,
)
from ..sources.refresh import changed_years, corrected_sums, in_years, refresh_years
from ..sources.scratch import scratch_folder, written
from ..sources.tables import read_table
from . import oracle
from .build import UPSTREAM
from .cubes import COUNT_MARTS, day_cube, session_bits
from .dashboard import DASHBOARD
from .dashboard import positioned as dash_positioned
from .marts import MARTS, SORT_KEYS, main_exercises, positioned
from .warehouse import Marts, build_tables, open_marts

# fixture parameters for parameterised queries (FIXTURES.md §3)
FIXTURE_MAIN_EXERCISES = tuple(f"brand#{i}" for i in range(1, 11))
FIXTURE_DASHBOARD_EXERCISES = tuple(f"brand#{i}" for i in range(1, 10))
FIXTURE_AS_OF = (2026, 6)
FIXTURE_WEIGHT_KG = "10.00"
FIXTURE_YEAR = 2024
# marts whose order is registered as a position among the rows that share the first sort key
ORDERED = ("yearly_reps_per_exercise_weight", "yearly_seconds_per_exercise_weight", "yearly_workouts_per_type",
           "workout_frequency_weekday")
# and as a position in the whole table
ORDERED_WHOLE = tuple(n for n in SORT_KEYS if n not in ORDERED and not n.endswith("_corrected"))
BY_LOG = ("mom_changes", "workout_frequency_weekday", "workout_vs_rest_days", "yearly_workouts_per_type")


def dashboard_parameters(name: str) -> dict:
    """The fixture's parameters of a presentation query."""
    kw = {} if name in ("dash_weekday", "dash_heatmap", "dash_heatmap_wide") else {
        "exercises": FIXTURE_DASHBOARD_EXERCISES, "as_of": FIXTURE_AS_OF}
    if name in ("dash_filter", "dash_month_date"):
        kw["weight_kg"] = FIXTURE_WEIGHT_KG
    if name in ("dash_yearly_sorted", "dash_bubble"):
        kw["year"] = FIXTURE_YEAR
    return kw

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def edge(df: DataFrame) -> DataFrame:
    """Driver-edge typing: integers -> BIGINT, decimals -> DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, _INTS):
            cols.append(F.col(f.name).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_journal(journal_for(spark, sf_dir))


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day cube of the journal, written once per application and input state."""
    return table_for(spark, sf_dir, "day-cube", lambda: day_cube(staged(spark, sf_dir)))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bitmaps of session numbers, written once per application and input state."""
    return table_for(spark, sf_dir, "session-bits", lambda: session_bits(staged(spark, sf_dir)))


def source(name: str):
    """What a mart is derived from: the bitmaps for distinct counts; the day cube for the month grid and its
    changes, which read it more than once (axis bounds, cells); else the staged journal."""
    if name in COUNT_MARTS:
        return sessions
    return days if name == GRID or name in UPSTREAM else staged


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return MARTS[name](source(name)(spark, sf_dir))


def _mart_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return edge(mart(spark, sf_dir, name))

    run.__name__ = name
    return run


def _main_exercises(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(main_exercises(staged(spark, sf_dir), FIXTURE_MAIN_EXERCISES))


def marts_for(spark: SparkSession, sf_dir: str) -> Marts:
    """The dashboard's marts as catalog tables, built once per application and input state."""
    key = (app_id(spark), sf_dir.rstrip("/"), _input_state(spark, sf_dir))
    with _LOCK:
        if key not in _BUILDS:
            base = "setbook_" + "".join(c if c.isalnum() else "_" for c in f"{app_id(spark)}_{len(_BUILDS)}".lower())
            build_tables(spark, journal_for(spark, sf_dir), base, scratch_folder(spark, "catalog"), DASHBOARD_MARTS)
            _BUILDS[key] = open_marts(spark, base)
    return _BUILDS[key]


_BUILDS: dict = {}
GRID = "monthly_aggregates_every_possible_combination"
DASHBOARD_MARTS = ("mom_changes_reps", "yearly_reps_per_exercise_weight", "workout_frequency_weekday")
_READS = {"dash_yoy": "yearly_reps", "dash_yearly_sorted": "yearly_reps", "dash_weekday": "weekday_matrix",
          "dash_heatmap": "weekday_matrix", "dash_heatmap_wide": "weekday_matrix"}


def _shown(name: str, out: DataFrame) -> DataFrame:
    out = edge(out)
    if name in ("dash_weight_options", "dash_year_options", "dash_yearly_sorted"):
        out = edge(dash_positioned(name, out))
    return out


def _dash_query(name: str, **more) -> Callable[[SparkSession, str], DataFrame]:
    fn = DASHBOARD[name]
    read = {"weekday_matrix": sessions, "yearly_reps": staged}.get(_READS.get(name), days)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _shown(name, fn(read(spark, sf_dir), **dashboard_parameters(name), **more))

    run.__name__ = name
    return run


def _catalog_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A presentation query over the catalog tables of the current build."""
    fn, table = DASHBOARD[name], _READS.get(name, "mom_reps")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = marts_for(spark, sf_dir).for_dashboard()
        return _shown(name, fn(None, **dashboard_parameters(name), **{table: tables[table]}))

    run.__name__ = f"catalog_{name}"
    return run


def _ordered_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A mart with its order: within the first sort key for ``ORDERED``, in the whole table for the others."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = mart(spark, sf_dir, name)
        return edge(positioned(name, rows) if name in ORDERED else global_position(rows, SORT_KEYS[name]))

    run.__name__ = f"ordered_{name}"
    return run


def _by_log_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A mart of several logs at once: the journal's section stands for the log."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        journal = journal_for(spark, sf_dir).withColumn("log", F.col("section"))
        return edge(MARTS[name](stage_journal(journal, by=("log",)), by=("log",)))

    run.__name__ = f"{name}_by_log"
    return run


def _stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal as an earlier load left it: rows of one year are missing, others of it differ."""
    year = F.year("date") == FIXTURE_YEAR
    journal = journal_for(spark, sf_dir).where(F.coalesce(~(year & (F.col("set_counter") == 1)), F.lit(True)))
    return journal.withColumn("amount", F.when(year, F.col("amount") + 1).otherwise(F.col("amount")).cast("smallint"))


def refresh_year_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An old journal table in which only the years that changed were replaced, read back."""
    path, new = scratch_folder(spark, "refreshed"), journal_for(spark, sf_dir)
    write_journal(_stale(spark, sf_dir), path, partition_by_year=True)
    refresh_years(spark, new, path, changed_years(read_journal(spark, path), new))
    return edge(read_journal(spark, path))


def refresh_year_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-time sums of an old journal, corrected by the old and the new rows of the changed years."""
    keys = ("exercise", "added_weight", "weight_unit")
    old, new = stage_journal(_stale(spark, sf_dir)), staged(spark, sf_dir)
    sums = old.groupBy(*keys).agg(F.sum("amount").cast("bigint").alias("amount"), F.count(F.lit(1)).alias("_rows"))
    years = changed_years(old, new)
    part = lambda df: in_years(df, years).select(*keys, "amount")
    out = corrected_sums(written(sums, "sums"), keys, ("amount",), part(old), part(new))
    return edge(out.select(*keys, F.col("amount").alias("total_amount")))


def dump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal dumped as text, one folder a year, and read back."""
    path = scratch_folder(spark, "dump")
    journal = journal_for(spark, sf_dir).withColumn("year", F.year("date"))
    write_dump(journal, path, "year")
    return edge(read_dump(spark, path, journal.schema).drop("year"))


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the faulty journal that the table refuses, with the rules they break."""
    return edge(rejected_rows(derive_journal(spark, sf_dir, odd=True)))


def semi_join_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of the exercises in a dimension of its own: those of the ECONOMY parts of brands 10 to 19."""
    part = read_table(spark, sf_dir, "part", ["p_brand", "p_size", "p_type"])
    dim = part.where(F.col("p_brand").like("Brand#1_") & (F.col("p_type") == "ECONOMY")).select(
        exercise_from_part(F.col("p_brand"), F.col("p_size")).alias("exercise"))
    return edge(semi_join(staged(spark, sf_dir), dim, "exercise").select("date", "exercise", "added_weight", "amount"))


def parse_cells_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables -> workbook cells -> parser -> cleaned journal rows."""
    return edge(clean_journal(parse_journal_cells(cells_from_tables(spark, sf_dir))))


def parse_cells_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the row-chunk parser."""
    return edge(clean_journal(parse_journal_cells(cells_from_tables(spark, sf_dir), rows_per_chunk=50_000)))


def parse_cells_1904(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks whose dates count from 1904."""
    return edge(clean_journal(parse_journal_cells(cells_from_tables(spark, sf_dir, date_mode=1))))


def clean_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct weight text of the faulty fixture, parsed to (kg, unit)."""
    return edge(odd_weight_texts(spark, sf_dir).select(
        "weight_text", weight_kg("weight_text").alias("weight"),
        weight_unit("weight_text").alias("weight_unit")))


def check_journal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violation counts per rule over a journal with faults in every column."""
    _, report = check_journal(derive_journal(spark, sf_dir, odd=True))
    return edge(report)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {name: _mart_query(name) for name in MARTS}
    q["main_exercises"] = _main_exercises
    q.update({name: _dash_query(name) for name in DASHBOARD})
    q["dash_units_kg"] = _dash_query("dash_units", unit="kg")
    q.update({f"catalog_{name}": _catalog_query(name) for name in DASHBOARD})
    q.update({f"ordered_{name}": _ordered_query(name) for name in (*ORDERED, *ORDERED_WHOLE)})
    q.update({f"{name}_by_log": _by_log_query(name) for name in BY_LOG})
    q["refresh_year_journal"] = refresh_year_journal
    q["refresh_year_totals"] = refresh_year_totals
    q["dump_roundtrip"] = dump_roundtrip
    q["rejected_rows"] = rejected
    q["semi_join_dimension"] = semi_join_dimension
    q["parse_cells_1904"] = parse_cells_1904
    q["parse_cells_roundtrip"] = parse_cells_roundtrip
    q["parse_cells_chunked"] = parse_cells_chunked
    q["clean_weight"] = clean_weight
    q["check_journal"] = check_journal_report
    return q


def oracle_sql() -> dict[str, str]:
    out = {name: oracle.mart_sql(name) for name in MARTS if name in oracle.MARTS}
    out["main_exercises"] = oracle.main_exercises_sql(FIXTURE_MAIN_EXERCISES)
    dash = oracle.dashboard_sql(FIXTURE_DASHBOARD_EXERCISES, FIXTURE_AS_OF, FIXTURE_WEIGHT_KG, FIXTURE_YEAR)
    out.update(dash)
    out.update({f"catalog_{name}": dash[name] for name in DASHBOARD})
    out.update({f"ordered_{name}": oracle.ordered_sql(name, SORT_KEYS[name]) for name in ORDERED})
    out.update({f"ordered_{name}": oracle.placed_sql(name, SORT_KEYS[name]) for name in ORDERED_WHOLE})
    out.update({f"{name}_by_log": oracle.by_log_sql(name) for name in BY_LOG})
    out.update(oracle.TABLES)
    out["parse_cells_1904"] = oracle.ROUNDTRIP
    out["parse_cells_roundtrip"] = oracle.ROUNDTRIP
    out["parse_cells_chunked"] = oracle.ROUNDTRIP
    out["clean_weight"] = oracle.CLEAN_WEIGHT
    out["check_journal"] = oracle.CHECK_JOURNAL
    return out
