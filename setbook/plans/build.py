"""Materialise the marts as tables, in dependency order (full refresh).

Like the original model DAG, a mart that builds on another one reads the
*written* upstream table instead of recomputing it: the dense month grid
is computed once and read by the change marts, the change marts once and
read by their reps / seconds views.  Each mart is written as a new version
of its table (``sources.versions``), and all are published after the last
one is written: a failed build publishes none of them.  (``plans.warehouse``
swaps all tables of a build in one step.)  Writing also cuts the lineage, so a lost executor only recomputes
from the last written table.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators.order import sorted_rows
from ..operators.staging import stage_journal
from ..sources.versions import discard, point_to, published, write_version
from . import marts as M
from .cubes import COUNT_MARTS, DAY_MARTS, day_cube, session_bits

# mart -> (upstream mart it reads, keyword the function takes it as)
UPSTREAM = {
    "mom_changes": ("monthly_aggregates_every_possible_combination", "grid"),
    "yoy_changes": ("monthly_aggregates_every_possible_combination", "grid"),
    "mom_changes_reps": ("mom_changes", "mom"),
    "mom_changes_seconds": ("mom_changes", "mom"),
    "yoy_changes_reps": ("yoy_changes", "yoy"),
    "yoy_changes_seconds": ("yoy_changes", "yoy"),
    "mom_changes_seconds_corrected": ("_grid_corrected", "grid"),
    "yoy_changes_seconds_corrected": ("_grid_corrected", "grid"),
}
# shared inputs that are no marts themselves
SHARED = {"_grid_corrected": lambda stg, by=(): M.monthly_aggregates_every_possible_combination(
    stg, by, corrected=True)}


def build_order(names) -> list[str]:
    """Topological order of ``names`` plus the upstream marts they need."""
    out: list[str] = []

    def visit(n):
        if n in out:
            return
        if n in UPSTREAM:
            visit(UPSTREAM[n][0])
        out.append(n)

    for n in names:
        visit(n)
    return out


def _depth(name: str) -> int:
    return 0 if name not in UPSTREAM else 1 + _depth(UPSTREAM[name][0])


def build_marts(spark: SparkSession, journal: DataFrame, out_dir: str, names=None,
                fmt: str = "parquet", cubes: bool = True, threads: int = 8, by=(), in_order: bool = False) -> dict[str, str]:
    """Publish each requested mart below ``{out_dir}/{name}``; return name -> folder of its new version.

    ``journal`` should be a table scan (``read_journal``) so every mart
    starts from columnar files with pushdown.  With ``cubes`` (default) the
    two shared pre-aggregates are written first (``_cube_day``,
    ``_cube_sessions``) and the marts are derived from them, so the journal
    is scanned twice instead of once per mart.  Marts of one dependency
    level are independent Spark jobs and are submitted from ``threads``
    threads at once (small marts then share the cluster instead of
    queueing one after another).  ``by`` names log-key columns of
    ``journal``: every mart is then computed per log.  With ``in_order`` the
    files of a mart follow its order (``marts.SORT_KEYS``).
    """
    by = tuple(by)
    stg = stage_journal(journal, by=by)
    wanted = list(names) if names else [n for n in M.MARTS if n != "stg_workout_journal"]
    order = build_order(wanted)
    out = out_dir.rstrip("/")
    source: dict = {}
    folders: dict[str, str] = {}
    try:
        _write_all(spark, stg, order, out, fmt, cubes, threads, by, source, folders, in_order)
    except BaseException:
        for folder in folders.values():
            discard(spark, folder)
        raise
    for name, folder in folders.items():
        point_to(spark, f"{out}/{name}", folder)
    return {n: folders[n] for n in order if n in M.MARTS}


def _write_all(spark, stg, order, out, fmt, cubes, threads, by, source, folders, in_order) -> None:
    """Write the versions of a build; ``folders`` collects them, by table."""
    if cubes:
        for cube_name, fn, marts in (("_cube_day", day_cube, DAY_MARTS),
                                     ("_cube_sessions", session_bits, COUNT_MARTS)):
            if any(n in marts for n in order):
                folders[cube_name] = write_version(fn(stg, by=by), f"{out}/{cube_name}", fmt=fmt)
                table = spark.read.format(fmt).load(folders[cube_name])
                source.update({n: table for n in marts})

    def write(name: str) -> None:
        kw = {}
        if name in UPSTREAM:
            up, arg = UPSTREAM[name]
            kw[arg] = spark.read.format(fmt).load(folders[up])
        fn = SHARED.get(name) or M.MARTS[name]
        df = fn(source.get(name, stg), by=by, **kw)
        if in_order and name in M.SORT_KEYS:
            df = sorted_rows(df, [*by, *M.SORT_KEYS[name]])
        folders[name] = write_version(df, f"{out}/{name}", fmt=fmt)

    for level in range(max(_depth(n) for n in order) + 1):
        batch = [n for n in order if _depth(n) == level]
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            list(pool.map(write, batch))          # re-raises the first failure


def read_mart(spark: SparkSession, paths: dict[str, str], name: str, fmt: str = "parquet",
              ordered: bool = False) -> DataFrame:
    df = spark.read.format(fmt).load(published(spark, paths[name]))
    return M.ordered(name, df) if ordered else df
