import json

import pytest
from pyspark.sql import types as T

from sluiceway.operators.entities import entity_versions
from sluiceway.operators.parse import parse_lines
from sluiceway.operators.registry import (
    compile_registry, field_catalog, registry_from_directory, registry_from_rows, resolve, unresolved,
)
from tests.conftest import ATOMIC, DOCS, INT, entity, line, lines_of, schema, uri


def versions(spark, *unstructs, contexts=()):
    lines = [line(f"u{i}", unstruct=u) for i, u in enumerate(unstructs)]
    lines += [line(f"c{i}", contexts=list(c)) for i, c in enumerate(contexts)]
    return entity_versions(parse_lines(lines_of(spark, *lines), ATOMIC))


def fields(dtype):
    return [(f.name, f.dataType, f.nullable) for f in dtype.fields]


def test_catalog(spark):
    rows = field_catalog(registry_from_rows(spark, [d for d in DOCS if d[0] == uri("deepOne")])).collect()
    found = {".".join(r["path"]): (r["name"], r["kind"], r["nullable"]) for r in rows}
    assert found == {
        "": (None, "struct", False),
        "outerBox": ("outer_box", "struct", True),
        "outerBox.innerId": ("inner_id", "string", False),
        "outerBox.marks": ("marks", "array", True),
        "outerBox.marks.[]": ("[]", "struct", False),
        "outerBox.marks.[].score": ("score", "bigint", True),
        "when": ("when", "timestamp", False),
        "day": ("day", "date", True),
        "price": ("price", "decimal(6,2)", True),
        "shade": ("shade", "string", True),
        "mixed": ("mixed", "json", True),
    }


def test_registry_directory(spark, tmp_path):
    folder = tmp_path / "schemas" / "org.shop" / "cart" / "jsonschema"
    folder.mkdir(parents=True)
    (folder / "1-0-0").write_text(schema({"itemCount": INT}, ["itemCount"]))
    (folder / "readme.txt").write_text("not a schema")
    rows = compile_registry(registry_from_directory(spark, str(tmp_path / "schemas"))).collect()
    assert [(r["uri"], r["legal"], len(r["nodes"])) for r in rows] == [(uri("cart"), True, 2)]


def test_any_depth(spark):
    node = {"type": "string"}
    for _ in range(20):
        node = {"type": "object", "properties": {"a": node}}
    rows = field_catalog(registry_from_rows(spark, [(uri("deep"), json.dumps(node))])).collect()
    assert max(len(r["path"]) for r in rows) == 20


def test_legacy_column_per_version(spark, registry):
    found = resolve(versions(spark, entity("cart", {}), entity("cart", {}, "1-0-1")), registry,
                    legacy_schemas=["iglu:org.shop/cart/jsonschema/1-*-*"])
    assert [c.name for c in found.columns] == [
        "unstruct_event_org_shop_cart_1_0_0", "unstruct_event_org_shop_cart_1_0_1",
    ]
    assert fields(found.columns[1].data_type) == [
        ("item_count", T.LongType(), False), ("note", T.VariantType(), True),
    ]
    assert found.columns[1].batch_field.dataType["note"].dataType == T.StringType()
    assert found.columns[0].data_type["item_count"].metadata == {"accessors": ["itemCount"]}


def test_v2_merges_up_to_the_highest_version_present(spark, registry):
    found = resolve(versions(spark, entity("cart", {}, "1-0-1")), registry)
    column, = found.columns
    assert column.name == "unstruct_event_org_shop_cart_1"
    assert column.uris == (uri("cart"), uri("cart", "1-0-1"))
    assert fields(column.data_type) == [("item_count", T.IntegerType(), False), ("note", T.StringType(), True)]


def test_v2_widens_and_recovers(spark, registry):
    found = resolve(versions(spark, entity("cart", {}, "1-2-0"), entity("cart", {}, "2-0-0")), registry)
    assert [(c.name, len(c.uris)) for c in found.columns] == [
        ("unstruct_event_org_shop_cart_1", 3), ("unstruct_event_org_shop_cart_1_recovered_2_0", 1),
        ("unstruct_event_org_shop_cart_2", 1),
    ]
    assert fields(found.columns[0].data_type)[0] == ("item_count", T.DoubleType(), True)
    assert fields(found.columns[1].data_type)[0] == ("item_count", T.StringType(), True)


@pytest.mark.parametrize("name,column", [("nothing", "nothing"), ("any-thing", "any_thing")])
def test_empty_and_permissive_schemas_are_json(spark, registry, name, column):
    item = entity(name, {})
    found = resolve(versions(spark, item, contexts=[[item]]), registry)
    assert [(c.name, c.data_type, c.field.dataType) for c in found.columns] == [
        (f"contexts_org_shop_{column}_1", T.VariantType(), T.ArrayType(T.VariantType())),
        (f"unstruct_event_org_shop_{column}_1", T.VariantType(), T.VariantType()),
    ]


def test_criteria_that_do_not_match_leave_the_main_style(spark, registry):
    found = resolve(versions(spark, entity("cart", {})), registry,
                    legacy_schemas=["iglu:org.shop/other/jsonschema/1-*-*"])
    assert [c.mode for c in found.columns] == ["v2"]


def test_legacy_mode_takes_everything_and_ignores_skips(spark, registry):
    found = resolve(versions(spark, entity("cart", {})), registry, legacy_mode=True,
                    skip_schemas=["iglu:org.shop/cart/jsonschema/*-*-*"],
                    legacy_schemas=["iglu:org.shop/other/jsonschema/1-*-*"])
    assert [c.name for c in found.columns] == ["unstruct_event_org_shop_cart_1_0_0"]


def test_skipped_schema_gets_no_column_unless_legacy(spark, registry):
    skip = ["iglu:org.shop/cart/jsonschema/1-0-*"]
    assert resolve(versions(spark, entity("cart", {})), registry, skip_schemas=skip).columns == ()
    found = resolve(versions(spark, entity("cart", {})), registry, skip_schemas=skip, legacy_schemas=skip)
    assert [c.mode for c in found.columns] == ["legacy"]


def test_unknown_and_invalid_schemas(spark, registry):
    batch = versions(spark, entity("cart", {}, "1-0-9"), entity("broken", {}), entity("no_json", {}))
    found = resolve(batch, registry)
    assert found.columns == ()
    assert found.invalid == (uri("broken"), uri("no_json"))
    assert [r["uri"] for r in unresolved(batch, registry).collect()] == [uri("cart", "1-0-9")]


def test_entities_of_bad_lines_are_ignored(spark):
    lines = lines_of(spark, line(tstamp="bad", unstruct=entity("cart", {})))
    assert entity_versions(parse_lines(lines, ATOMIC)).count() == 0


def test_versions_aggregate_before_the_shuffle(spark):
    plan = versions(spark, entity("cart", {}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan
