"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, plain
from snapflow import queries as registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'").fetchall()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'").fetchall()
    return con


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == registry.SQL.keys()
    assert registry.QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted([plain(r[c]) for c in columns] for r in df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert mine == sorted([plain(r[names.index(c)]) for c in columns] for r in cursor.fetchall())


@pytest.mark.parametrize("hidden", ["xxhash", "zstandard", "snapflow.llm", "corpus_pipeline"])
def test_entry_without_what_only_text_operators_need(hidden):
    """In a process of its own: the other queries are all there."""
    code = f"""
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {hidden!r} or name.startswith({hidden!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as entry
print(len([q for q in entry.queries() if not q.startswith("op") and q != "pipeline"]))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(entry.__file__))
    assert done.stdout.strip() == str(len(registry.QUERIES)), done.stderr
    assert "left out" in done.stderr or hidden.startswith(("snapflow", "corpus"))


def test_entry_does_not_hide_a_missing_module_of_its_own():
    code = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == "snapflow.operators.joins":
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(entry.__file__))
    assert done.returncode != 0 and "snapflow.operators.joins" in done.stderr
