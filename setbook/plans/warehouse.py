"""Built marts as catalog tables, with one swap a build.

A build writes every mart with ``saveAsTable`` into a database of its own,
in dependency order, downstream marts reading the upstream tables.  Which
build is current is one property of the *base* database, set in one catalog
operation after all tables exist.  ``open_marts`` reads that property once;
all tables it then returns are of the same build, so a reader never mixes
two, and a build that fails half-way changes nothing that is read.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.staging import stage_journal
from . import marts as M
from .build import SHARED, UPSTREAM, build_order
from .build import _depth as depth
from .cubes import COUNT_MARTS, DAY_MARTS, day_cube, session_bits

CURRENT = "current_build"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _properties(spark: SparkSession, base: str) -> dict[str, str]:
    rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE EXTENDED {_quoted(base)}").collect()}
    text = rows.get("Properties", "").strip("()")
    pairs = [p.strip("() ").split(",", 1) for p in text.split("), (")] if text else []
    return {k.strip(): v.strip() for k, v in pairs}


def current_build(spark: SparkSession, base: str) -> str | None:
    """The database of the current build; None before the first."""
    return _properties(spark, base).get(CURRENT) if spark.catalog.databaseExists(base) else None


def build_tables(spark: SparkSession, journal: DataFrame, base: str, location: str, names=None, by=(),
                 threads: int = 8, keep: int = 2, marts=None) -> str:
    """Build the marts ``names`` (default all) of ``journal`` and make them current; returns the build's database.

    ``location`` is a shared folder; a build's tables lie in a folder of
    their own below it.  The newest ``keep`` builds stay for readers that
    opened them; older ones are dropped.  ``marts`` replaces mart functions.
    """
    by, made = tuple(by), {**M.MARTS, **(marts or {})}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(base)} LOCATION '{location}/base'")
    build = f"{base}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {_quoted(build)} LOCATION '{location}/{build}'")
    wanted = list(names) if names else [n for n in M.MARTS if n != "stg_workout_journal"]
    order = build_order(wanted)
    stg = stage_journal(journal, by=by)
    try:
        source = {}
        for cube, fn, served in (("_cube_day", day_cube, DAY_MARTS), ("_cube_sessions", session_bits, COUNT_MARTS)):
            if any(n in served for n in order):
                fn(stg, by=by).write.saveAsTable(f"{_quoted(build)}.{cube}")
                source.update({n: spark.table(f"{_quoted(build)}.{cube}") for n in served})

        def write(name: str) -> None:
            kw = {}
            if name in UPSTREAM:
                up, arg = UPSTREAM[name]
                kw[arg] = spark.table(f"{_quoted(build)}.{up}")
            fn = SHARED.get(name) or made[name]
            fn(source.get(name, stg), by=by, **kw).write.saveAsTable(f"{_quoted(build)}.{name}")

        for level in range(max(depth(n) for n in order) + 1):
            with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
                list(pool.map(write, [n for n in order if depth(n) == level]))      # re-raises the first failure
    except BaseException:
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(build)} CASCADE")
        raise
    before = _properties(spark, base)
    earlier = [b for b in before.get("earlier_builds", "").split(" ") if b]
    if CURRENT in before:
        earlier.insert(0, before[CURRENT])
    spark.sql(f"ALTER DATABASE {_quoted(base)} SET DBPROPERTIES "
              f"('{CURRENT}' = '{build}', 'earlier_builds' = '{' '.join(earlier[:keep - 1])}')")
    for old in earlier[keep - 1:]:
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(old)} CASCADE")
    return build


class Marts:
    """The tables of one build."""

    def __init__(self, spark: SparkSession, build: str):
        self.spark, self.build = spark, build

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.table(f"{_quoted(self.build)}.{name}")

    def for_dashboard(self) -> dict[str, DataFrame]:
        """Keyword arguments that make the presentation queries read this build."""
        return {"mom_reps": self["mom_changes_reps"], "yearly_reps": self["yearly_reps_per_exercise_weight"],
                "weekday_matrix": self["workout_frequency_weekday"]}


def open_marts(spark: SparkSession, base: str) -> Marts:
    """The current build's tables; they stay those of one build however many builds follow."""
    build = current_build(spark, base)
    if build is None:
        raise LookupError(f"no build of {base}")
    return Marts(spark, build)
