"""Every registered query against its SQL in DuckDB, and its plan."""

import __spark_entry__ as entry_point
import pytest
from compare import _canon, difference, duck
from conftest import DATA

from touchline.workload import registry

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
QUERIES, SQL = registry.QUERIES, registry.ORACLES  # the llm folder has tests of its own


@pytest.fixture(scope="module")
def con():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
        types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
        assert {c: TYPES.get(t, t) for c, t in df.dtypes} == types
    else:
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"chunk_recursive"}
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


def test_comparison_sees_differences(spark, con):
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert difference(df, con, "SELECT 'x' AS b, 1 AS a") is None
    assert difference(df, con, "SELECT 'y' AS b, 1 AS a") is not None
    assert difference(df, con, "SELECT 'x' AS b, 1 AS c") is not None
    assert difference(df, con, "SELECT 'x' AS b, 1 AS a UNION ALL SELECT 'x', 1") is not None
    assert _canon(["a"], [(1.0,)]) != _canon(["a"], [(1.0000001,)])
