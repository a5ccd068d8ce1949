"""Every query of the subpackage: it runs, equals its SQL where it has one, and can be left out."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest
from conftest import ROOT, SF_DIR

import __spark_entry__ as contract
from skytally.llm import oracle, queries


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_all_are_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}
    assert set(queries.QUERIES) <= set(contract.queries()) and set(oracle.STATEMENTS) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(oracle.STATEMENTS))
def test_query_matches_sql(spark, sql, name):
    cursor = sql.execute(oracle.STATEMENTS[name])
    names = sorted(column[0] for column in cursor.description)
    order = [[c[0] for c in cursor.description].index(n) for n in names]
    expected = sorted(repr([row[i] for i in order]) for row in cursor.fetchall())
    assert sorted(repr(list(row)) for row in queries.QUERIES[name](spark, SF_DIR).select(names).collect()) == expected
    assert expected


def test_native_queries_run_no_python(spark):
    for name in ("op2_positional_index", "op3_disclosure_spans", "op9_simhash_edits", "op10_redirect_filter"):
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "ExistingRDD")), name


def test_entry_works_without_the_subpackage():
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == "skytally.llm" or name.startswith("skytally.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name="skytally.llm")
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
assert e.queries() and not any(n.startswith("op") or n == "pipeline" for n in e.queries())
assert set(e.queries()) == set(e.oracle_sql())
"""
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_the_subpackage():
    for path in glob.glob(f"{ROOT}/skytally/**/*.py", recursive=True):
        if "/llm/" not in path:
            with open(path) as f:
                assert "llm" not in f.read(), path
