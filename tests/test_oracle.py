"""Every registered query against its DuckDB oracle on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from setbook.plans import catalog

sys_path_tools = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools")
import sys  # noqa: E402

sys.path.insert(0, sys_path_tools)
from check_oracle import TABLES, digest  # noqa: E402

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "mom_percentage_change" in df.columns
