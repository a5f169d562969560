"""Spark marts vs the DuckDB oracle on seeded messy journals.

The driver tables are well formed; these journals are not: month and
weekday texts that disagree with the date or are unknown, several units in one cell,
negative and bodyweight weights, deload values outside 0/1, seconds and
combination exercises, sparse months.  Both engines start from the same
journal rows.
"""

import datetime as dt
import os
import random
import sys
from decimal import Decimal

import duckdb
import pandas as pd
import pytest

from setbook.operators.staging import stage_journal
from setbook.plans import marts as M
from setbook.plans import oracle
from setbook.plans.catalog import edge
from setbook.plans.cubes import DAY_MARTS, SESSION_MARTS, day_cube, session_cube
from setbook.sources.journal import JOURNAL_SCHEMA

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import digest  # noqa: E402

EXERCISES = ["pull-ups", "dips", "plank (s)", "pull-ups + dips", "hang + plank (s)", "squats"]
WEIGHTS = ["0.00", "2.50", "10.00", "-5.00"]
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]


def messy_journal(seed: int, multi_unit: bool):
    rnd = random.Random(seed)
    rows = []
    start = dt.date(2020, 11, 1)
    odd_month_used = False
    for _ in range(rnd.randint(150, 300)):
        d = start + dt.timedelta(days=rnd.randint(0, 900))
        month = MONTHS[d.month - 1]
        r = rnd.random()
        if r < 0.03:
            month = MONTHS[(d.month % 12)]            # text disagrees with the date
        elif r < 0.04 and not odd_month_used:
            month, odd_month_used = "jan", True       # unknown text (at most once: LAG ties)
        weekday = d.strftime("%A").lower()
        w = rnd.random()
        if w < 0.02:
            weekday = "mon"                            # unknown text -> weekday_int NULL
        elif w < 0.04:
            weekday = rnd.choice(["monday", "friday"])  # may disagree with the date
        ex = rnd.choice(EXERCISES)
        unit = "kg"
        if multi_unit and rnd.random() < 0.3:
            unit = "lbs"
        rows.append((month, weekday, d, rnd.choice([0, 0, 0, 1, 2]),
                     d.timetuple().tm_yday // rnd.choice([1, 2]), rnd.randint(1, 5),
                     rnd.choice(["pull", "push"]), rnd.choice(["warm-up", "pull"]), ex,
                     Decimal(rnd.choice(WEIGHTS)), unit, "wide", rnd.randint(0, 30), 60))
    return rows


# marts whose window order has no ties whatever the data (no LAG over duplicated months)
ALL = [n for n in oracle.MARTS if n in M.MARTS]
NO_LAG = [n for n in ALL if not n.startswith(("mom_", "yoy_"))]


def run_both(spark, rows, names, via_cubes=False):
    sdf = spark.createDataFrame(rows, JOURNAL_SCHEMA)
    stg = stage_journal(sdf)
    source = {}
    if via_cubes:
        source.update({n: day_cube(stg) for n in DAY_MARTS})
        source.update({n: session_cube(stg) for n in SESSION_MARTS})
        names = [n for n in names if n in source]
    con = duckdb.connect()
    pdf = pd.DataFrame(rows, columns=[f.name for f in JOURNAL_SCHEMA.fields])
    con.register("journal_pd", pdf)
    con.sql("CREATE VIEW journal AS SELECT month, weekday, CAST(date AS DATE) AS date, "
            "CAST(deload AS SMALLINT) AS deload, CAST(workout_counter AS SMALLINT) AS workout_counter, "
            "CAST(set_counter AS SMALLINT) AS set_counter, type, section, exercise, "
            "CAST(weight AS DECIMAL(5,2)) AS weight, weight_unit, grip, CAST(amount AS SMALLINT) AS amount, "
            "CAST(rest AS SMALLINT) AS rest FROM journal_pd")
    bad = []
    for name in names:
        df = edge(M.MARTS[name](source.get(name, stg)))
        srows = [tuple(r) for r in df.collect()]
        rel = con.sql(oracle.mart_sql_on_journal(name))
        orows = rel.fetchall()
        if sorted(df.columns) != sorted(rel.columns) or len(srows) != len(orows) or \
                digest(df.columns, srows)[0] != digest(rel.columns, orows)[0]:
            bad.append((name, len(srows), len(orows)))
    return bad


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_messy_single_unit(spark, seed):
    assert run_both(spark, messy_journal(seed, multi_unit=False), ALL) == []


@pytest.mark.parametrize("seed", [4, 5])
def test_messy_multi_unit(spark, seed):
    assert run_both(spark, messy_journal(seed, multi_unit=True), NO_LAG) == []


@pytest.mark.parametrize("seed", [6, 7])
def test_messy_through_cubes(spark, seed):
    assert run_both(spark, messy_journal(seed, multi_unit=False), ALL, via_cubes=True) == []
    assert run_both(spark, messy_journal(seed + 10, multi_unit=True), NO_LAG, via_cubes=True) == []
