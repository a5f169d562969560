import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from setbook.session import get_spark

    s = get_spark("local[*]", app="setbook-tests", shuffle_partitions=8)
    yield s
    s.stop()


def journal_row(date, exercise="pull-ups", amount=10, weight="0.00", unit="kg", counter=None,
                month=None, weekday=None, deload=0, set_counter=1, type_="pull", section="pull",
                grip="wide", rest=60):
    """One journal row with sensible defaults (month/weekday from the date)."""
    d = dt.date.fromisoformat(date) if isinstance(date, str) else date
    return (
        month if month is not None else d.strftime("%B").lower(),
        weekday if weekday is not None else d.strftime("%A").lower(),
        d, deload,
        counter if counter is not None else d.timetuple().tm_yday,
        set_counter, type_, section, exercise, Decimal(weight), unit, grip, amount, rest,
    )


@pytest.fixture
def make_stg(spark):
    from setbook.operators.staging import stage_journal
    from setbook.sources.journal import JOURNAL_SCHEMA

    def build(rows):
        return stage_journal(spark.createDataFrame(rows, JOURNAL_SCHEMA))

    return build


def digest(df):
    """Order-insensitive multiset digest of a DataFrame in one job: row count
    and exact sums of two independent 64-bit row hashes."""
    from pyspark.sql import functions as F
    cols = sorted(df.columns)
    h1 = F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")
    h2 = F.hash(*[F.col(c) for c in cols], F.lit("salt")).cast("decimal(38,0)")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h1).alias("s1"), F.sum(h2).alias("s2")).first()
    return r["n"], r["s1"], r["s2"]


def same_rows(a, b):
    """True when a and b hold the same multiset of rows (columns by name)."""
    da, db = digest(a), digest(b)
    return da == db and da[0] is not None
