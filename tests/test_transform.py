import datetime

from pyspark.sql import functions as F

from sluiceway.operators.conform import conform
from sluiceway.operators.entities import entity_versions
from sluiceway.operators.failed import failed_events, processor, serialised
from sluiceway.operators.parse import parse_lines
from sluiceway.operators.registry import resolve
from sluiceway.operators.transform import failures, good_rows, transform_events
from sluiceway.sources.table import initial_schema
from sluiceway.operators.fields import merge_columns
from pyspark.sql import types as T
from tests.conftest import ATOMIC, entity, line, lines_of, uri

NOW = datetime.datetime(2024, 6, 1, 12, tzinfo=datetime.timezone.utc)
CART = "unstruct_event_org_shop_cart_1"
CARTS = "contexts_org_shop_cart_1"


def transform(spark, registry, *lines, **criteria):
    parsed = parse_lines(lines_of(spark, *lines), ATOMIC)
    resolved = resolve(entity_versions(parsed), registry, **criteria)
    return resolved, transform_events(parsed, ATOMIC, resolved, F.lit(NOW), **criteria, keep=("event_id",))


def rows(spark, registry, *lines, **criteria):
    return {r["event_id"]: r for r in good_rows(transform(spark, registry, *lines, **criteria)[1]).collect()}


def errors(spark, registry, *lines, **criteria):
    found = failures(transform(spark, registry, *lines, **criteria)[1], "event_id").collect()
    return {r["event_id"]: [(e["error"], e["schema_key"], e["value"], e["expected"]) for e in r["failure"]["errors"]]
            for r in found}


def test_atomic_only(spark, registry):
    row = rows(spark, registry, line())["e1"]
    assert row.asDict() == {
        "event_id": "e1", "collector_tstamp": datetime.datetime(2024, 5, 1, 10), "event_name": "page",
        "doc_height": None, "has_flash": None, "load_tstamp": datetime.datetime(2024, 6, 1, 12),
    }


def test_unstruct_and_contexts(spark, registry):
    got = rows(
        spark, registry,
        line("u", unstruct=entity("cart", {"itemCount": 3})),
        line("c", contexts=[entity("cart", {"itemCount": 1}), entity("any-thing", [1])],
             derived=[entity("cart", {"itemCount": 2, "note": "x"}, "1-0-1")]),
    )
    assert got["u"][CART]["item_count"] == 3 and got["u"][CARTS] is None
    assert [(e["item_count"], e["note"]) for e in got["c"][CARTS]] == [(1, None), (2, "x")]
    assert got["c"]["contexts_org_shop_any_thing_1"] == ["[1]"]
    assert got["c"][CART] is None


def test_no_matching_context_is_null_and_not_empty(spark, registry):
    got = rows(spark, registry, line("a", contexts=[]), line("b", contexts=[entity("cart", {"itemCount": 1})]))
    assert got["a"][CARTS] is None


def test_legacy_columns_match_exact_versions(spark, registry):
    legacy = ["iglu:org.shop/cart/jsonschema/1-*-*"]
    got = rows(spark, registry, line("a", unstruct=entity("cart", {"itemCount": 1})),
               line("b", unstruct=entity("cart", {"itemCount": 2, "note": "n"}, "1-0-1")), legacy_schemas=legacy)
    assert got["a"][CART + "_0_0"]["item_count"] == 1 and got["a"][CART + "_0_1"] is None
    assert got["b"][CART + "_0_1"].asDict() == {"item_count": 2, "note": "n"} and got["b"][CART + "_0_0"] is None


def test_nested_types(spark, registry):
    data = {"outerBox": {"innerId": "i", "marks": [{"score": 1}, {}]}, "when": "2031-11-02T07:45:10.5Z", "day": None,
            "price": 1.5, "shade": "red", "mixed": 7}
    got = rows(spark, registry, line(unstruct=entity("deepOne", data)))["e1"]["unstruct_event_org_shop_deep_one_1"]
    assert got["outer_box"]["inner_id"] == "i"
    assert [m["score"] for m in got["outer_box"]["marks"]] == [1, None]
    assert got["when"] == datetime.datetime(2031, 11, 2, 7, 45, 10, 500000)
    assert (str(got["price"]), got["shade"], got["mixed"], got["day"]) == ("1.50", "red", "7", None)


def test_wrong_types_of_all_entities_are_collected(spark, registry):
    text = line(unstruct=entity("cart", {"itemCount": "x"}),
                contexts=[entity("cart", {"itemCount": 1}), entity("cart", {}), entity("cart", {"itemCount": True})])
    assert errors(spark, registry, text)["e1"] == [
        ("WrongType", uri("cart"), "null", "Integer"), ("WrongType", uri("cart"), "true", "Integer"),
        ("WrongType", uri("cart"), '"x"', "Integer"),
    ]


def test_unknown_schema_fails_only_its_events_and_hides_wrong_types(spark, registry):
    got = errors(
        spark, registry, line("good", unstruct=entity("cart", {"itemCount": 1})),
        line("u", unstruct=entity("cart", {}, "1-0-9"), contexts=[entity("cart", {"itemCount": "x"})]),
        line("c", contexts=[entity("cart", {"itemCount": 1}), entity("gone", {})]),
        line("d", derived=[entity("gone", {}), entity("broken", {})]),
    )
    assert got == {
        "u": [("SchemaNotFound", uri("cart", "1-0-9"), None, None)],
        "c": [("SchemaNotFound", uri("gone"), None, None)],
        "d": [("SchemaNotFound", uri("gone"), None, None), ("InvalidSchema", uri("broken"), None, None)],
    }


def test_main_style_failure_hides_legacy_failure(spark, registry):
    text = line(unstruct=entity("cart", {"itemCount": "x"}), contexts=[entity("gone", {})])
    got = errors(spark, registry, text, legacy_schemas=["iglu:org.shop/gone/jsonschema/1-0-*"])
    assert got["e1"] == [("WrongType", uri("cart"), '"x"', "Integer")]
    got = errors(spark, registry, text, legacy_schemas=["iglu:org.shop/cart/jsonschema/1-0-*"])
    assert got["e1"] == [("SchemaNotFound", uri("gone"), None, None)]
    got = errors(spark, registry, line(unstruct=entity("cart", {"itemCount": "x"})), legacy_mode=True)
    assert got["e1"] == [("WrongType", uri("cart"), '"x"', "Long")]


def test_skipped_schema_never_fails(spark, registry):
    skip = ["iglu:org.shop/gone/jsonschema/*-*-*", "iglu:org.shop/cart/jsonschema/1-*-*"]
    got = rows(spark, registry, line(unstruct=entity("cart", {"itemCount": "x"}), contexts=[entity("gone", {})]),
               skip_schemas=skip)
    assert set(got) == {"e1"} and CART not in got["e1"].asDict()


def test_recovered_version_goes_to_its_own_column(spark, registry):
    got = rows(spark, registry, line("a", unstruct=entity("cart", {"itemCount": "many"}, "1-2-0")),
               line("b", unstruct=entity("cart", {"itemCount": 1})))
    assert got["a"][CART] is None and got["a"][CART + "_recovered_2_0"]["item_count"] == "many"
    assert got["b"][CART]["item_count"] == 1.0 and got["b"][CART + "_recovered_2_0"] is None


def test_null_entity_data(spark, registry):
    got = rows(spark, registry, line("a", unstruct=entity("cart", None)),
               line("b", contexts=[entity("cart", None), entity("cart", {"itemCount": 4})]))
    assert got["a"][CART] is None
    assert [c["item_count"] for c in got["b"][CARTS]] == [4]


def test_good_rows_evaluate_the_transform_once(spark, registry):
    _, frame = transform(spark, registry, line(unstruct=entity("cart", {"itemCount": 1})))
    plan = good_rows(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 4 and "Exchange" not in plan


# Fitting the table

BASE = initial_schema(ATOMIC)


def misfits(spark, registry, table, *lines):
    _, frame = transform(spark, registry, *lines)
    found = failures(conform(frame, table), "event_id").collect()
    return {r["event_id"]: (r["failure"]["kind"], [(e["error"], e["expected"]) for e in r["failure"]["errors"]]) for r in found}


def table_with(*fields):
    return T.StructType(BASE.fields + list(fields))


def test_unknown_column_fails_only_rows_that_fill_it(spark, registry):
    got = misfits(spark, registry, BASE, line("a"), line("b", unstruct=entity("cart", {"itemCount": 1})))
    assert got == {"b": ("loader_runtime_error", [("UnknownField", CART)])}


def test_wrong_shapes(spark, registry):
    carts = T.StructField(CARTS, T.ArrayType(T.StructType([T.StructField("note", T.LongType())])))
    cart = T.StructField(CART, T.StringType())
    got = misfits(
        spark, registry, table_with(carts, cart), line("a", unstruct=entity("cart", {"itemCount": 1})),
        line("b", contexts=[entity("cart", {"itemCount": 1, "note": "n"}, "1-0-1")]),
    )
    assert got == {
        "a": ("loader_runtime_error", [("WrongType", f"{CART} String")]),
        "b": ("loader_runtime_error", [("UnknownField", f"{CARTS}[].item_count"), ("WrongType", f"{CARTS}[].note Long")]),
    }


def test_required_table_fields(spark, registry):
    cart = T.StructField(CART, T.StructType([
        T.StructField("item_count", T.LongType(), False), T.StructField("note", T.StringType(), False)]))
    top = T.StructField("must", T.StringType(), False)
    text = line("a", unstruct=entity("cart", {"itemCount": 1}, "1-0-1"))
    assert misfits(spark, registry, table_with(cart), line("b"), text) == {
        "a": ("loader_runtime_error", [("MissingRequiredField", f"{CART}.note")])}
    assert misfits(spark, registry, table_with(top), line("b"))["b"][1] == [("MissingRequiredField", "must")]


def test_rows_take_the_shape_of_the_table(spark, registry):
    resolved, frame = transform(spark, registry, line("a", unstruct=entity("cart", {"itemCount": 1}, "1-0-1")))
    wide = merge_columns(table_with(T.StructField("later", T.DoubleType())), resolved.fields)
    row = good_rows(conform(frame, wide))
    assert row.columns == wide.fieldNames()
    assert row.schema[CART].dataType["item_count"].dataType == T.LongType()
    assert row.first()["later"] is None and row.first()[CART]["item_count"] == 1


def test_bad_line_yields_no_values(spark, registry):
    parsed = parse_lines(lines_of(spark, line(height="x", unstruct=entity("cart", {"itemCount": 1}))), ATOMIC)
    row = parsed.first()
    assert row["event_id"] is None and row["collector_tstamp"] is None
    assert row["unstruct_entity"] is None and row["context_entities"] == []


def test_conform_keeps_an_earlier_failure(spark, registry):
    assert misfits(spark, registry, BASE, "nonsense")[None][0] == "loader_parsing_error"


# Failed events

def test_failed_event_record(spark, registry):
    import json
    _, frame = transform(spark, registry, "nonsense", line(unstruct=entity("gone", {})))
    got = [json.loads(r["value"]) for r in serialised(failed_events(frame, processor("app", "9"))).collect()]
    assert got[0] == {
        "kind": "loader_parsing_error", "processor": {"artifact": "app", "version": "9"}, "payload": "nonsense",
        "errors": [{"error": "FieldCountMismatch", "value": "1", "expected": "8"}],
    }
    assert got[1]["kind"] == "loader_schema_error" and got[1]["payload"].startswith("e1\t")


def test_oversized_failed_event_is_replaced(spark, registry):
    import json
    _, frame = transform(spark, registry, "x" * 5000, "y")
    big, small = [json.loads(r["value"]) for r in serialised(failed_events(frame, processor("app", "9")), 2000).collect()]
    assert big["kind"] == "size_violation" and small["kind"] == "loader_parsing_error"
    assert big["failure"]["maximum_bytes"] == 2000 and big["failure"]["actual_bytes"] > 5000
    assert big["payload"] == "x" * 200
