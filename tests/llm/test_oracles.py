"""Queries with SQL equal it on the sf0.001 tables; native queries run no Python; plans pair nothing."""

import duckdb
import pytest

import __spark_entry__ as entry
from perkflow.llm import mixing, queries
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert rows_of(queries.QUERIES[key](spark, SF).toPandas()) == rows_of(con.execute(queries.ORACLE_SQL[key]).df())


def test_entry_registers_every_operator_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("key", ["op1_pii_boosting", "op2_mixing", "op9_license_scan"])
def test_native_plans_hold_no_python(spark, key):
    plan = plan_of(queries.QUERIES[key](spark, SF))
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_plans_pair_nothing(spark, key):
    plan = plan_of(queries.QUERIES[key](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_mix_reads_no_text_for_its_plan(spark):
    """The emitted documents' texts never go through a shuffle: the source table is the small side."""
    plan = plan_of(mixing.mix(spark.read.parquet(f"{SF}/documents.parquet")))
    assert "Exchange hashpartitioning" not in plan
