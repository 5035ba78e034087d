"""Every registered query against its SQL at the smallest scale, and what its plan must not contain."""

import duckdb
import pytest

from __spark_entry__ import entry
from sampletide.plans import catalogue, oracle
from verify import TABLES, bag

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalogue.queries(), oracle.oracle_sql()
# Built and checked end to end in test_lake; verify.py compares its rows with SQL.
SLOW = {"evidence_run"}


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return made


def test_every_statement_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    plan = got._jdf.queryExecution().executedPlan().toString()
    # No pairing of all rows with all rows, no row-at-a-time Python.
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas"):
        assert banned not in plan, banned
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        names, want = bag([d[0] for d in cur.description], cur.fetchall())
        assert (names, want) == bag(got.columns, rows)


def test_entry(spark):
    assert entry(spark).count() > 0
