from datetime import datetime

from pyspark.sql import functions as F

from sluiceway.operators.entities import entity_occurrences
from sluiceway.operators.parse import bad_lines, good_events, parse_lines
from sluiceway.sources.lines import parquet_lines
from tests.conftest import ATOMIC, entity, line, lines_of, uri


def parse(spark, *lines):
    return parse_lines(lines_of(spark, *lines), ATOMIC)


def errors(spark, text):
    return [(e["error"], e["value"], e["expected"]) for e in parse(spark, text).first()["parse_errors"]]


def test_good_line(spark):
    text = line(height="12", flash="1", unstruct=entity("cart", {"itemCount": 1}))
    row = parse(spark, text).first()
    assert row["parse_errors"] == []
    assert (row["event_id"], row["doc_height"], row["has_flash"]) == ("e1", 12, True)
    assert row["collector_tstamp"] == datetime(2024, 5, 1, 10)
    assert row["unstruct_entity"]["schema"] == uri("cart")
    assert row["context_entities"] == []
    assert row["n_bytes"] == len(text.encode())


def test_empty_optional_fields_are_null(spark):
    row = parse(spark, line(name="")).first()
    assert row["parse_errors"] == []
    assert row["event_name"] is None and row["doc_height"] is None and row["unstruct_entity"] is None


def test_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = parse(spark, line()).select(F.unix_micros("collector_tstamp")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros == 1714557600000000


def test_wrong_field_count(spark):
    assert errors(spark, "nonsense") == [("FieldCountMismatch", "1", "8")]
    assert errors(spark, line() + "\textra") == [("FieldCountMismatch", "9", "8")]
    assert errors(spark, "") == [("FieldCountMismatch", "1", "8")]


def test_undecodable_fields_are_all_reported(spark):
    assert errors(spark, line(event_id="", tstamp="yesterday", height="tall", flash="yes")) == [
        ("FieldDecodingError", None, "event_id string"),
        ("FieldDecodingError", "yesterday", "collector_tstamp timestamp"),
        ("FieldDecodingError", "tall", "doc_height int"),
        ("FieldDecodingError", "yes", "has_flash boolean"),
    ]


def test_malformed_entities(spark):
    good = line().split("\t")
    for at, text in ((5, "{"), (5, '{"data":1}'), (5, '{"schema":"x","data":{"schema":"nope","data":{}}}'),
                     (6, '{"schema":"x","data":{"a":1}}'), (6, '{"schema":"x","data":[{"schema":"nope","data":{}}]}'),
                     (6, '{"schema":"x","data":[null]}'), (7, "[]")):
        fields = list(good)
        fields[at] = text
        found = errors(spark, "\t".join(fields))
        assert [e[0] for e in found] == ["FieldDecodingError"], text


def test_empty_context_list_is_legal(spark):
    row = parse(spark, line(contexts=[])).first()
    assert row["parse_errors"] == [] and row["context_entities"] == []


def test_contexts_come_before_derived_contexts(spark):
    text = line(contexts=[entity("a", {}), entity("b", {})], derived=[entity("a", {"n": 2})])
    row = parse(spark, text).select(F.transform("context_entities", lambda e: e["schema"]).alias("s")).first()
    assert row["s"] == [uri("a"), uri("b"), uri("a")]
    found = entity_occurrences(parse(spark, text), "event_id").collect()
    assert [(r["position"], r["entity"], r["uri"]) for r in found] == [
        (1, "context", uri("a")), (2, "context", uri("b")), (3, "context", uri("a")),
    ]


def test_invalid_utf8_in_a_binary_line(spark):
    lines = spark.createDataFrame([(bytearray(b"ab\xffc"),)], "value binary")
    row = bad_lines(parse_lines(lines, ATOMIC)).first()
    assert row["payload"] == "ab�c"
    assert row["n_bytes"] == 4


def test_keys_alone(spark):
    text = line(unstruct=entity("cart", {"itemCount": 1}), contexts=[entity("a", {})])
    row = parse_lines(lines_of(spark, text), ATOMIC, with_data=False).first()
    assert row["parse_errors"] == [] and row["unstruct_entity"].asDict() == {"schema": uri("cart")}
    assert [c.asDict() for c in row["context_entities"]] == [{"schema": uri("a")}]
    plan = parse_lines(lines_of(spark, text), ATOMIC, with_data=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "VariantType" not in plan


def test_good_and_bad_split(spark):
    parsed = parse(spark, line(), "x", line("e2"))
    assert {r["event_id"] for r in good_events(parsed, "event_id").collect()} == {"e1", "e2"}
    assert [r["payload"] for r in bad_lines(parsed).collect()] == ["x"]


def test_filters_do_not_repeat_the_parse(spark):
    plan = good_events(parse(spark, line()), "event_id", "unstruct_entity")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 4


def test_compact_lines_are_dealt_to_all_cores(spark, tmp_path):
    """One small file, which is one split, is parsed in several tasks of equal shares, and no line is lost."""
    spark.range(8000).selectExpr("concat('line', id) AS value").coalesce(1).write.parquet(f"{tmp_path}/lines")
    shares = [len(part) for part in parquet_lines(spark, f"{tmp_path}/lines").rdd.glom().collect()]
    assert sum(shares) == 8000 and len(shares) >= spark.sparkContext.defaultParallelism and max(shares) <= 2 * min(shares)
