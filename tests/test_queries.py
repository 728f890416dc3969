"""Every registered query against its SQL, over whole tables at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from sluiceway.plans.oracles import all_oracles
from sluiceway.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def shown(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    ours = sorted(tuple(map(shown, row)) for row in frame.select(*columns).collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(shown(row[names.index(c)]) for c in columns) for row in result.fetchall())
    assert ours == theirs and ours


def test_all_are_registered():
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_queries_without_the_corpus_package(tmp_path):
    """A checkout without the removable folders still lists its own queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(driver.__file__))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "sluiceway"), tmp_path / "sluiceway", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as d; print(len(d.queries()), sorted(d.queries()) == sorted(d.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), "True"], done.stderr
