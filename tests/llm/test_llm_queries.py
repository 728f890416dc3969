"""Every numbered query with SQL against that SQL, over whole tables at the smallest scale."""

import glob
import os

import duckdb
import pytest

from sluiceway.llm.queries import corpus_oracles, corpus_queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(corpus_oracles()))
def test_query_matches_sql(spark, duck, name):
    frame = corpus_queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    ours = sorted(map(repr, (tuple(row) for row in frame.select(*columns).collect())))
    result = duck.execute(corpus_oracles()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
    assert ours == theirs and ours
