"""Every registered query against its SQL on the smallest data set, and its plan."""

import math
import os

import duckdb
import pytest
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as registry
from shelfline.catalog.oracle import ORACLE_SQL as ORACLE
from shelfline.catalog.queries import QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def database():
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{file}'")
    return con


def canonical(rows):
    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(v) for v in row) for row in rows), key=str)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registry.queries()) and set(ORACLE) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.fixture
def written_plans(monkeypatch):
    """The plans of all tables that a query writes on its way."""
    plans = []
    write = DataFrameWriter.parquet

    def noted(self, path, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    return plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name, written_plans):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    con = database()
    wanted = con.execute(ORACLE[name])
    assert sorted(c[0] for c in wanted.description) == columns
    order = ", ".join(f'"{c}"' for c in columns)
    wanted = con.execute(f"SELECT {order} FROM ({ORACLE[name]})").fetchall()
    assert canonical(df.select(*columns).collect()) == canonical(wanted)

    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan or "Exchange SinglePartition" not in plan
    for plan in (plan, *written_plans):
        assert not [operator for operator in UNWANTED if operator in plan], plan


def test_entry(spark):
    assert registry.entry(spark).count() > 0
