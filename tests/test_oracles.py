"""Every registered query equals its SQL oracle (DuckDB) on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from perkflow.plans.catalog import REGISTRY as QUERIES
from tools.oracle_check import TABLES, rows_of

from .conftest import SF_SMALL

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["snapshot_date", "employee_id"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    got = QUERIES[key](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLES[key]).df()
    gc, gr = rows_of(got)
    wc, wr = rows_of(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
