"""Every registered query against its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pytest
from conftest import ROOT, SMALL

import __spark_entry__ as entry
from sparkrecon import registry

sys.path.insert(0, os.path.join(ROOT, "tools"))
import parity  # noqa: E402

# No query may fall back to a product of rows, or leave the JVM.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(registry.queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", list(registry.queries()))
def test_equal_to_sql(spark, db, key):
    df = entry.queries()[key](spark, SMALL)
    got = parity.rows(df.columns, df.collect())
    cursor = db.execute(entry.oracle_sql()[key])
    want = parity.rows([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want
    run = df._jdf.queryExecution().executedPlan().toString()
    assert [w for w in UNWANTED if w in run] == []


def test_entry_is_lazy_and_stable(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "key" and df.count() > 0
