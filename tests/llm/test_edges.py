"""Odd rows: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import glob
import hashlib
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluiceway.llm import decontamination, mixing, near_dedup, quality_rules, secrets, substring_dedup
from sluiceway.llm.queries import corpus_oracles, corpus_queries
from tests.llm.conftest import SCHEMA, edge_rows, prose

QUERIES = corpus_queries()
#: Queries over other tables have edge tests of their own.
OWN_TABLES = {"op11_vector_search", "op12_conversation_repair"}


@pytest.mark.parametrize("name", sorted(set(corpus_oracles()) - OWN_TABLES))
def test_edges_match_sql(spark, edge, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{edge}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}/*.parquet'")
    frame = QUERIES[name](spark, edge)
    columns = sorted(frame.columns)
    result = duck.execute(corpus_oracles()[name])
    names = [d[0] for d in result.description]
    ours = sorted((repr(tuple(r)) for r in frame.select(*columns).collect()))
    assert ours == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OWN_TABLES))
def test_every_row_once(spark, nasty, name):
    """A row for each row, null ids and repeated rows too."""
    ids = sorted(str(r.doc_id) for r in QUERIES[name](spark, nasty).select("doc_id").collect())
    expected = sorted(str(r[0]) for r in edge_rows())
    assert ids == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OWN_TABLES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_pipeline_on_odd_rows(spark, nasty, empty):
    docs = spark.read.parquet(f"{nasty}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, nasty)
        if name != "mixing":
            assert docs.columns == before.columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.columns[0] == "training_position" and docs.count() > 0
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_pipeline_stages_by_brute_force(spark, edge):
    """What each stage keeps, from plain Python over the same input."""
    docs = spark.read.parquet(f"{edge}/documents.parquet")
    kept = {r.doc_id for r in QUERIES["op10_quality_rules"](spark, edge).where("kept").collect()}
    docs = spark.createDataFrame(corpus_pipeline.quality(spark, docs, edge).collect(), SCHEMA)
    assert {r.doc_id for r in docs.collect()} == kept
    docs = spark.createDataFrame(corpus_pipeline.lines(spark, docs, edge).collect(), SCHEMA)
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: set(zip(w, w[1:])) or set(w) for i, w in ((i, t.lower().split()) for i, t in texts.items())}
    linked = {i: {j for j in sets if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])} | {i} for i in sets}
    for _ in sets:
        linked = {i: set().union(*(linked[j] for j in js)) for i, js in linked.items()}
    once = corpus_pipeline.near_duplicates(spark, docs, edge)
    assert {r.doc_id for r in once.collect()} == {i for i in sets if min(linked[i]) == i}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("group", [2, 1 << 16])
def test_substrings_by_brute_force(spark, nasty, group):
    """Short and long prefixes give the same."""
    docs = spark.read.parquet(f"{nasty}/documents.parquet")
    found = substring_dedup.dedup(docs, F.struct("doc_id", "text"), group=group)
    seen = {}
    texts = [r[1] for r in edge_rows()]
    for text in texts:
        w = words_of(text)
        for i in range(len(w) - 34):
            seen[tuple(w[i : i + 35])] = seen.get(tuple(w[i : i + 35]), 0) + 1
    expected = []
    for text in texts:
        w, gone = words_of(text), set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone |= set(range(i, i + 35))
        expected.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert sorted((r.n_words, r.n_removed, r.kept) for r in found.collect()) == sorted(expected)


def test_blocks_of_the_benchmark(spark, nasty):
    docs, items = spark.read.parquet(f"{nasty}/documents.parquet"), spark.read.parquet(f"{nasty}/benchmark.parquet")
    one = decontamination.scan(docs, items, F.struct("doc_id"), clean=True)
    many = decontamination.scan(docs, items, F.struct("doc_id"), clean=True, block_windows=2)
    rows = [sorted(map(repr, f.select("n_words", "n_hit", "hits", "items", "text").collect())) for f in (one, many)]
    assert rows[0] == rows[1]
    cut = {r.row.doc_id: r for r in one.collect()}
    assert cut[20].n_hit == 12 and cut[20]["items"] == ["1", "11"] and prose(9, 12).split()[3] not in cut[20].text.split()


def spans_by_hand(text):
    found = []
    pattern = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found += [(m.start(), 0, m.end(), "assign") for m in re.finditer(pattern, text or "") if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(found)


def test_secrets_by_hand(spark, nasty):
    found = {r.doc_id: r for r in QUERIES["op7_secret_scan"](spark, nasty).where("doc_id IS NOT NULL").collect()}
    for row in edge_rows(False):
        base = spans_by_hand(row[1])
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in base).encode()).hexdigest()
        got = found[row[0]]
        assert (got.n_assign, got.n_access, got.n_hex, got.base_sha256) == (*[sum(x[1] == k for x in base) for k in range(3)], digest), row[0]
    assert found[29].spans == "entropy:15:46,hex:88:112"  # the UUID between is on the allow list


def test_entropy_windows(spark):
    """The sliding sum equals the entropy of each window."""
    import math

    value = "q7Zp2Lm9Xc4Vb8Nt1Ks6Wd3Rf5Hg0JyAAAAAAAAAAAAAAAAAAAAAAAAA"
    docs = spark.createDataFrame([(1, f"x {value} y")], "doc_id long, text string")
    spans = secrets.scan(docs, F.struct("doc_id")).first().spans
    high = []
    for i in range(len(value) - secrets.WINDOW + 1):
        window = value[i : i + secrets.WINDOW]
        bits = -sum(window.count(c) / len(window) * math.log2(window.count(c) / len(window)) for c in set(window))
        if bits >= 3.6:
            high.append(i)
    assert [(s.start, s.end, s.kind) for s in spans] == [(2 + high[0], 2 + high[-1] + secrets.WINDOW, "entropy")]


def test_mix_keeps_its_targets(spark):
    rows = [(i, "w " * (i % 40 + 1), "hot" if i % 3 else (None if i % 2 else "small")) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.assigned(mixing.sized(docs, F.struct("doc_id"))).collect()
    for source in ("hot", "small", None):
        mine = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 41 and mine[0].target <= 2 * mine[0].source_size
    assert abs(sum({r.source: r.target for r in out}.values()) - 1.5 * sum(r.size for r in out)) < 1e-6
    assert all(0 <= p <= 1 for r in out for p in r.positions) and all(r.taken <= 2 * r.size for r in out)
    order = [r.training_position for r in mixing.training_order(docs).collect()]
    assert order == sorted(order)


def test_mixing_query_takes_what_the_curriculum_places(spark, tmp_path, monkeypatch):
    """A document that the schedule puts after the end of training is not taken by the registered query."""
    rows = [(i, "w " * 9, "a" if i % 2 else "b") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    mixing_query = QUERIES["op5_mixing"]
    plain = mixing_query(spark, str(tmp_path)).where("taken > 0").count()
    monkeypatch.setattr(mixing, "position", lambda demand, slope: demand + 0.5)
    late = mixing_query(spark, str(tmp_path)).select(F.sum("taken")).first()[0]
    monkeypatch.setattr(mixing, "position", lambda demand, slope: demand + 1.0)
    assert plain > 0 and late > 0 and mixing_query(spark, str(tmp_path)).where("taken > 0").isEmpty()


def test_near_copies_in_blocks(spark, monkeypatch):
    """Long lists in many blocks, with few rounds before, lose no link."""
    monkeypatch.setattr(near_dedup, "ROUNDS", 1)
    monkeypatch.setattr(near_dedup, "LEADS", 1)
    monkeypatch.setattr(near_dedup, "ASKING", 3)
    monkeypatch.setattr(near_dedup, "ASKED", 4)
    base = prose(21, 120).split()
    rows = []
    for i in range(60):
        words = list(base)
        for k in range(i % 9):
            words[(i * 13 + k * 29) % 120] = f"x{i}y{k}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component for r in near_dedup.classes(docs).collect()}
    sets = {i: set(zip(t.split(), t.split()[1:])) for i, t in rows}
    label = {i: i for i in sets}
    for _ in range(10):
        for i in sets:
            for j in sets:
                if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert got == label


def test_rules_keep_the_documents_columns(spark, nasty):
    docs = spark.read.parquet(f"{nasty}/documents.parquet")
    assert quality_rules.filter_documents(docs).columns == docs.columns


@pytest.mark.parametrize("frame,condition", [
    (lambda docs: quality_rules.measured(docs), "n_words > 5 AND n_repeat_words < 3 AND n_dup_lines = 0"),
    (lambda docs: secrets.scan(docs, F.struct("doc_id")), "size(spans) > 0 AND spans[0].kind = 'hex'"),
])
def test_a_filter_does_not_repeat_the_work(spark, nasty, frame, condition):
    """The optimised plan evaluates patterns and word splits as often with a filter on the result as without."""
    result = frame(spark.read.parquet(f"{nasty}/documents.parquet"))

    def work(plan):
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        return sum(text.count(x) for x in ("split(", "regexp_extract_all(", "RLIKE", "xxhash64("))

    assert work(result.where(condition)) == work(result) > 0


def test_random_strings_of_each_class_are_found(spark):
    """At least nine of ten random strings of 20 and 32 characters; lower-case letters alone are left out on purpose."""
    import random
    import string

    pick, rows = random.Random(3), []
    classes = {"digits": string.digits, "hex": "0123456789ABCDEF", "alnum": string.ascii_letters + string.digits, "lower": string.ascii_lowercase + string.digits,
               "letters": string.ascii_letters, "capitals": string.ascii_uppercase, "base64": string.ascii_letters + string.digits + "+/"}
    for name, letters in classes.items():
        for size in (20, 32):
            rows += [(name, size, "see " + "".join(pick.choice(letters) for _ in range(size)) + " here") for _ in range(120)]
    words = ["Donaudampfschifffahrtsgesellschaft", "internationalization-of-everything", "a" * 23, "A" * 30, "1" * 23]
    rows += [("none", 0, w) for w in words]
    docs = spark.createDataFrame(rows, "name string, size int, text string")
    found = secrets.scan(docs, F.struct("name", "size")).select("row.*", (F.size("spans") > 0).cast("double").alias("hit")).groupBy("name", "size").agg(F.avg("hit").alias("share"))
    share = {(r.name, r["size"]): r.share for r in found.collect()}
    assert share.pop(("none", 0)) == 0 and min(share.values()) >= 0.9, share


def test_many_matches_in_one_text(spark):
    text = " ".join(f"{i:024x}" for i in range(4000))
    spans = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), F.struct("doc_id")).first().spans
    assert [(s.start, s.end) for s in spans] == [(25 * i, 25 * i + 24) for i in range(4000)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_one_row_of_each_class_stays(spark, kind):
    """Repeated rows, copies without an id, ids of text, an id with two texts, and a column with an operator's own name."""
    a, b = prose(61, 90), prose(62, 90)
    rows = [(3, a), (1, a), (1, a), (None, a), (None, b), (None, b), (4, None), (4, None), (5, prose(63, 90)), (5, prose(64, 90)), (None, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _gone string").withColumn("doc_id", F.col("doc_id").cast(kind))
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert got == sorted([("1", a), ("None", b), ("4", ""), ("4", ""), ("5", prose(63, 90)), ("5", prose(64, 90)), ("None", "")])
    classes = near_dedup.row_classes(docs, F.struct("doc_id")).collect()
    assert sorted((str(r.id), str(r.component), r["first"]) for r in classes if r.n_shingles and r.n_shingles > 0)[:4] == [("1", "1", False), ("1", "1", True), ("3", "1", False), ("5", "5", True)]
    assert len(classes) == len(rows)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_substrings_of_rows_that_share_an_id(spark, kind):
    """One text of an id repeats a passage, the other is short or unlike it; nothing is cut from the wrong one."""
    passage, own = prose(71, 60), prose(72, 200)
    rows = [(1, f"{prose(73, 300)}\n{passage}"), (2, f"{prose(74, 400)} {passage}"), (2, "short text"), (2, own), (None, passage), (None, own + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast(kind))
    got = {(str(r.row.doc_id), r.n_words): r.n_removed for r in substring_dedup.dedup(docs, F.struct("doc_id")).collect()}
    assert got == {("1", 360): 60, ("2", 460): 60, ("2", 2): 0, ("2", 200): 200, ("None", 60): 60, ("None", 201): 200}
