"""Every registered query against its SQL counterpart."""

import glob
import os

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from skytally import oracle, registry


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows]
    return sorted(cells, key=str)


def test_every_query_has_its_sql():
    assert set(oracle.statements()) == set(registry.QUERIES)
    assert set(oracle.statements()) <= set(contract.oracle_sql()) and set(registry.QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, sql, name):
    result = contract.queries()[name](spark, SF_DIR)
    cursor = sql.execute(contract.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == sorted(result.columns)
    expected = rows_of(cursor.fetchall(), names)
    assert rows_of(result.collect(), result.columns) == expected
    assert expected
    # Streams and builds included: what is returned forms no pairs and runs no Python.
    plan = result._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInArrow", "MapInPandas", "InPandas"):
        assert word not in plan, word


def test_no_result_identifies_an_aircraft(spark):
    from skytally.operators.quality import identity_columns

    skip = ("stream", "late", "full", "reconcile", "built")
    for name, query in contract.queries().items():
        if not name.startswith(skip):
            assert identity_columns(query(spark, SF_DIR).schema) == [], name


def test_entry(spark):
    assert contract.entry(spark).count() > 0
