import pytest
from pyspark.sql import functions as F

from sluiceway.functions.keys import column_name, is_key, key_columns, legacy_column_name, matches_any, snake


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("name,expected", [
    ("colCamel", "col_camel"), ("any-thing", "any_thing"), ("mySchema", "my_schema"), ("userId", "user_id"),
    ("siteID", "site_id"), ("HTMLBody", "html_body"), ("already_snake", "already_snake"), ("v2Name", "v2_name"),
    ("with space", "with_space"),
])
def test_snake_case(spark, name, expected):
    assert one(spark, snake, name) == expected


@pytest.mark.parametrize("text,expected", [
    ("iglu:com.acme/ad-click/jsonschema/1-0-12", True),
    ("iglu:com.acme/ad/jsonschema/0-0-1", False),
    ("iglu:com.acme/ad/jsonschema/1-00-1", False),
    ("iglu:com.acme/ad/jsonschema/1-0", False),
    ("com.acme/ad/jsonschema/1-0-0", False),
    ("iglu:com.acme/ad/jsonschema/99999999999-0-0", False),
    ("iglu:com.acme/ad/jsonschema/2147483647-0-1999999999", True),
    ("iglu:com.acme/ad/jsonschema/2147483648-0-0", False),
    ("iglu:com.acme/ad/jsonschema/1-3000000000-0", False),
])
def test_key_grammar(spark, text, expected):
    assert one(spark, is_key, text) is expected


def test_key_parts(spark):
    row = spark.createDataFrame([("iglu:com.acme/ad/jsonschema/3-12-0",), ("bad",)], "x string").select(
        *[c.alias(n) for n, c in key_columns(F.col("x")).items()]
    ).collect()
    assert tuple(row[0]) == ("com.acme", "ad", "jsonschema", 3, 12, 0)
    assert tuple(row[1]) == (None,) * 6


def test_column_names(spark):
    frame = spark.createDataFrame(
        [("unstruct", "com.acme-x", "adClick", 1, 2, 3), ("context", "com.acme-x", "adClick", 1, 2, 3)],
        "e string, v string, n string, m int, r int, a int",
    )
    cols = [F.col(c) for c in "evnmra"]
    rows = frame.select(column_name(*cols[:4]), legacy_column_name(*cols)).collect()
    assert [tuple(r) for r in rows] == [
        ("unstruct_event_com_acme_x_ad_click_1", "unstruct_event_com_acme_x_ad_click_1_2_3"),
        ("contexts_com_acme_x_ad_click_1", "contexts_com_acme_x_ad_click_1_2_3"),
    ]


@pytest.mark.parametrize("criterion,version,expected", [
    ("1-0-0", "1-0-0", True), ("1-0-0", "1-0-1", False), ("1-0-*", "1-0-7", True), ("1-0-*", "1-1-0", False),
    ("1-*-*", "1-4-2", True), ("1-*-*", "2-0-0", False), ("*-*-*", "9-9-9", True),
])
def test_criteria(spark, criterion, version, expected):
    found = one(spark, lambda u: matches_any(u, [f"iglu:com.acme/ad/jsonschema/{criterion}"]),
                f"iglu:com.acme/ad/jsonschema/{version}")
    assert found is expected


def test_criteria_treat_names_literally(spark):
    assert one(spark, lambda u: matches_any(u, ["iglu:com.acme/ad/jsonschema/*-*-*"]),
               "iglu:comXacme/ad/jsonschema/1-0-0") is False
    assert one(spark, lambda u: matches_any(u, []), "x") is False
    with pytest.raises(ValueError):
        matches_any(F.col("x"), ["iglu:com.acme/ad/1-0-0"])
