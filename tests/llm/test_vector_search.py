"""Vector search against brute force: exact values always, and nearly all of the true neighbours."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceway.llm import vector_search
from sluiceway.llm.queries import corpus_queries
from tests.llm.conftest import EMBEDDINGS

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, asked, k=10):
    """The k nearest other rows of each asked id, by brute force over distinct usable rows."""
    known = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, v in known:
        if asked(i):
            others = [(float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), j) for j, w in known if len(w) == len(v) and (j, w) != (i, v)]
            out[i] = sorted(others)[:k]
    return out


def found(spark, rows, **options):
    out = {}
    for r in vector_search.search(spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("vec_id") % 5 == 0, **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.distance, r.id))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def cloud(seed, n, size, spread=0.6, centers=4):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(centers, size))
    return [(middle[i % centers] + spread * draw.normal(size=size)).tolist() for i in range(n)]


@pytest.mark.parametrize("size", [3, 20, 64])
def test_recall_and_exact_values(spark, size):
    rows = list(enumerate(cloud(size, 900, size)))
    got, expected = found(spark, rows), plain(rows, lambda i: i % 5 == 0)
    assert set(got) == set(expected) and all(len(v) == 10 for v in got.values())
    vectors = dict(rows)
    for q, near in got.items():
        for distance, i in near:
            assert distance == pytest.approx(math.dist(vectors[q], vectors[i]), rel=1e-12)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in expected[q]}) for q in got)
    assert hits >= 0.93 * sum(map(len, expected.values()))


def test_odd_rows(spark):
    """Unusable vectors, rows without an id, repeated rows, another length, few rows of that length, equal distances."""
    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate(cloud(1, 60, 4))]
    rows += [(100, None), (105, []), (110, [0.0] * 4), (115, [1.0, None, 2.0, 3.0]), (120, [nan, 1.0, 1.0, 1.0]), (125, [1.0, inf, 1.0, 1.0]), (None, [1.0, 2.0, 3.0, 4.0])]
    rows += [rows[5]] * 7 + [(130, [1.0, 2.0]), (131, [1.0, 2.0]), (132, [-3.0, 1e-200])]
    rows += [(200 + i, [float(x), float(y), 0.0, 50.0]) for i, (x, y) in enumerate((x, y) for x in range(-3, 4) for y in range(-3, 4))]
    got, expected = found(spark, rows, target=1.0), plain(rows, lambda i: i % 5 == 0)
    assert set(got) == set(expected) and 130 in got and len(got[130]) == 2 and 100 not in got
    for q in expected:
        assert [i for _, i in got[q]] == [i for _, i in expected[q]], q


def test_copies_and_one_id_with_two_vectors(spark):
    """A third of all rows is one vector: each query still gets the ten smallest ids among equals."""
    rows = [(i, [1.0, 1.0, 0.5]) for i in range(200)] + [(200 + i, v) for i, v in enumerate(cloud(2, 300, 3))]
    rows += [(6, [1.0, 1.0, 0.25]), (900, [1.0, 1.0, 0.5])]
    got = found(spark, rows, target=1.0)
    expected = plain(rows, lambda i: i % 5 == 0)
    assert [i for _, i in got[10]] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9] and [i for _, i in got[0]] == list(range(1, 11))
    assert all([i for _, i in got[q]] == [i for _, i in expected[q]] for q in expected)


def test_blocks_give_the_same(spark, monkeypatch):
    rows = list(enumerate(cloud(3, 500, 8)))
    whole = found(spark, rows)
    monkeypatch.setattr(vector_search, "POINTS", 7)
    monkeypatch.setattr(vector_search, "QUERIES", 3)
    assert found(spark, rows) == whole


def test_several_axes_a_bucket(spark, monkeypatch):
    """Buckets of two axes, as for very many rows, and queries that look into many of them."""
    monkeypatch.setattr(vector_search, "BUCKET", 8)
    rows = list(enumerate(cloud(4, 700, 6)))
    got, expected = found(spark, rows), plain(rows, lambda i: i % 5 == 0)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in expected[q]}) for q in expected)
    assert hits >= 0.93 * sum(map(len, expected.values()))


def test_who_finds_too_few_is_compared_with_all(spark, monkeypatch):
    """An index that meets nothing but a vector's own bucket still gives ten each."""
    monkeypatch.setattr(vector_search, "fit", lambda *_: vector_search.Index(2, 0.0))
    rows = list(enumerate(cloud(5, 300, 30, spread=2.0)))
    got, expected = found(spark, rows), plain(rows, lambda i: i % 5 == 0)
    assert all(len(got[q]) == 10 for q in expected)


def test_rotations_keep_lengths_and_codes_are_the_nearest_axes():
    units = vector_search._unit(np.random.default_rng(1).normal(size=(50, 13)))
    rotated = vector_search._rotated(units, 2, 0)
    assert np.allclose(np.linalg.norm(rotated, axis=1), 1)
    both = np.concatenate([rotated, -rotated], 1)
    assert (vector_search.codes(units, 2, 1) == both.argmax(1)).all()
    lag = vector_search.behind(units, 2, 2)
    assert all(vector_search.probes(x, 0.0).tolist() == [c] for x, c in zip(lag, vector_search.codes(units, 2, 2)))


def test_query_on_odd_tables(spark, tmp_path):
    """The registered query on an empty table, and on one with columns that are named like its own."""
    spark.createDataFrame([], EMBEDDINGS).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert corpus_queries()["op11_vector_search"](spark, f"{tmp_path}/none").collect() == []
    rows = [(i, [float(x) for x in v], 1, "ids", "bucket", "q") for i, v in enumerate(cloud(6, 120, 5))]
    spark.createDataFrame(rows, EMBEDDINGS).write.parquet(f"{tmp_path}/some/embeddings.parquet")
    got = corpus_queries()["op11_vector_search"](spark, f"{tmp_path}/some")
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and sorted({r.query_id for r in got.collect()}) == [0, 100] and got.count() == 20
