import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.casting import LEGACY, V2, cast_errors, cast_ok, cast_value, compacted, json_text_type, members_of, narrowed

INT, LONG, DOUBLE, BOOL, TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.StringType()
JSON, DATE, TSTAMP = T.VariantType(), T.DateType(), T.TimestampType()


def cast_all(spark, docs, dtype, mode=V2, nullable=False, grouped=True):
    """(value, errors) of each JSON document; the boolean check must agree with the errors."""
    text_type = json_text_type(dtype)
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, j string").select(
        "i", F.parse_json("j").alias("v"),
        (F.lit(None) if text_type is None else F.col("j") if isinstance(text_type, T.StringType)
         else F.from_json("j", text_type)).alias("t"),
    )
    members = members_of("v", dtype) if grouped else None
    text = None if text_type is None else "t"
    frame = frame.withColumn("r", F.expr(cast_value("v", dtype, mode, text, members=members)))
    rows = frame.select(
        "i", F.expr(compacted("r", dtype)).alias("r"), F.expr(cast_ok("r", "v", dtype, nullable, mode, members=members)).alias("ok"),
        F.expr(cast_errors("r", "v", dtype, nullable, "'key'", mode)).alias("errors"),
    ).sort("i").collect()
    out = []
    for row in rows:
        found = [(e["error"], e["value"], e["expected"]) for e in row["errors"] or []]
        assert row["ok"] is (not found)
        out.append((row["r"], found))
    return out


def record(dtype, nullable=False):
    return T.StructType([T.StructField("a", dtype, nullable, {"accessors": ["anA"]})])


@pytest.mark.parametrize("grouped", [True, False])
@pytest.mark.parametrize("dtype,text,expected", [
    (INT, "42", 42), (INT, "42.0", 42), (INT, "42.5", None), (INT, '"12"', None), (INT, "true", None),
    (INT, "3000000000", None), (INT, "{}", None), (INT, "[1]", None),
    (LONG, "9007199254740993", 9007199254740993), (LONG, "92233720368547758070", None),
    (DOUBLE, "-0.0625", -0.0625), (DOUBLE, "1", 1.0), (DOUBLE, "1e3", 1000.0), (DOUBLE, '"1"', None),
    (BOOL, "true", True), (BOOL, "1", None), (BOOL, '"true"', None),
    (TEXT, '"abc"', "abc"), (TEXT, "1", None), (TEXT, "{}", None),
    (T.DecimalType(9, 2), "7.05", Decimal("7.05")), (T.DecimalType(9, 2), "7.50", Decimal("7.50")),
    (T.DecimalType(9, 2), "5", Decimal("5.00")), (T.DecimalType(9, 2), "7.051", None),
    (T.DecimalType(9, 2), "123456789.1", None), (T.DecimalType(9, 2), '"7.05"', None),
    (T.DecimalType(38, 9), "1e2", Decimal("100.000000000")),
    (DATE, '"2031-11-02"', datetime.date(2031, 11, 2)), (DATE, '"2024"', None), (DATE, '"2024-02-31"', None), (DATE, "19801", None),
    (TSTAMP, '"2031-11-02T07:45:10Z"', datetime.datetime(2031, 11, 2, 7, 45, 10)),
    (TSTAMP, '"2031-11-02T07:45:10.654321+02:00"', datetime.datetime(2031, 11, 2, 5, 45, 10, 654000)),
    (TSTAMP, '"2031-11-02"', None), (TSTAMP, "1951372800", None),
])
def test_scalars_are_strict(spark, dtype, text, expected, grouped):
    (value, errors), = cast_all(spark, [f'{{"anA":{text}}}'], record(dtype), grouped=grouped)
    assert value["a"] == expected
    assert len(errors) == (0 if expected is not None else 1)
    if errors:
        assert errors[0][0] == "WrongType"


def test_error_names_value_and_type(spark):
    (_, errors), = cast_all(spark, ['{"anA":"xyz"}'], record(INT))
    assert errors == [("WrongType", '"xyz"', "Integer")]


def test_required_missing_or_null(spark):
    for doc in ("{}", '{"anA":null}'):
        (_, errors), = cast_all(spark, [doc], record(INT))
        assert errors == [("WrongType", "null", "Integer")]


def test_nullable_missing_or_null(spark):
    for doc in ("{}", '{"anA":null}'):
        (value, errors), = cast_all(spark, [doc], record(INT, True))
        assert value["a"] is None and errors == []
    (_, errors), = cast_all(spark, ['{"anA":"x"}'], record(INT, True))
    assert errors == [("WrongType", '"x"', "Integer")]


def test_root_that_is_no_object(spark):
    (value, errors), = cast_all(spark, ["[1]"], record(INT))
    assert value is None and errors == [("WrongType", "[1]", "Struct")]


def test_all_errors_are_collected(spark):
    dtype = T.StructType([
        T.StructField("a", INT, False), T.StructField("b", TEXT, False),
        T.StructField("c", T.StructType([T.StructField("d", BOOL, False)]), False),
        T.StructField("e", T.ArrayType(INT, False), False),
    ])
    (_, errors), = cast_all(spark, ['{"a":"x","b":1,"c":{"d":0},"e":[1,"y",null]}'], dtype)
    assert errors == [
        ("WrongType", '"x"', "Integer"), ("WrongType", "1", "String"), ("WrongType", "0", "Boolean"),
        ("WrongType", '"y"', "Integer"), ("WrongType", "null", "Integer"),
    ]


def test_arrays_drop_nulls(spark):
    docs = ['{"anA":[1,null,3]}', '{"anA":[]}', '{"anA":[null]}', '{"anA":5}']
    got = cast_all(spark, docs, record(T.ArrayType(INT, True)))
    assert [g[0]["a"] for g in got] == [[1, 3], [], [], None]
    assert [len(g[1]) for g in got] == [0, 0, 0, 1]


def test_nested_arrays_and_records(spark):
    dtype = record(T.ArrayType(T.ArrayType(T.StructType([T.StructField("x", LONG, False)]), True), True))
    (value, errors), = cast_all(spark, ['{"anA":[[{"x":1},{"x":2}],[],null]}'], dtype)
    assert errors == []
    assert [[e["x"] for e in inner] for inner in value["a"]] == [[1, 2], []]


def test_json_text(spark):
    docs = ['{"anA":"a \\"b\\""}', '{"anA":{"z": 1, "a": [1, "q r"]}}', '{"anA":7}', '{"anA":true}', '{"anA":{}}', '{"anA":[]}']
    got = [g[0]["a"] for g in cast_all(spark, docs, record(JSON))]
    assert got == ['"a \\"b\\""', '{"z":1,"a":[1,"q r"]}', "7", "true", "{}", "[]"]
    got = [g[0]["a"] for g in cast_all(spark, docs, record(JSON), LEGACY)]
    assert got == ['a "b"', '{"z":1,"a":[1,"q r"]}', "7", "true", "{}", "[]"]


def test_json_inside_arrays_and_records_keeps_key_order(spark):
    dtype = record(T.ArrayType(T.StructType([T.StructField("j", JSON, True), T.StructField("n", INT, True)]), True))
    (value, errors), = cast_all(spark, ['{"anA":[{"j":{"b":1,"a":2},"n":1},null,{"j":"s"}]}'], dtype)
    assert errors == []
    assert [e["j"] for e in value["a"]] == ['{"b":1,"a":2}', '"s"']


def test_missing_json_is_reported_as_string_in_legacy_columns(spark):
    assert cast_all(spark, ["{}"], record(JSON))[0][1] == [("WrongType", "null", "Json")]
    assert cast_all(spark, ["{}"], record(JSON), LEGACY)[0][1] == [("WrongType", "null", "String")]


def test_root_json(spark):
    got = cast_all(spark, ['{"b":1,"a":2}', '"s"', "null"], JSON, nullable=True)
    assert got == [('{"b":1,"a":2}', []), ('"s"', []), (None, [])]


def test_last_duplicate_key_wins(spark):
    (value, _), = cast_all(spark, ['{"anA":1,"anA":2}'], record(INT))
    assert value["a"] == 2


def test_property_names_that_differ_by_case_only(spark):
    dtype = T.StructType([
        T.StructField("a_b", INT, True, {"accessors": ["aB"]}), T.StructField("ab", INT, True, {"accessors": ["AB"]}),
    ])
    (value, errors), = cast_all(spark, ['{"aB":1,"AB":2}'], dtype)
    assert (value["a_b"], value["ab"]) == (1, 2) and errors == []


def test_several_properties_for_one_field(spark):
    dtype = T.StructType([T.StructField("my_x", INT, False, {"accessors": ["myX", "my_x"]})])
    got = cast_all(spark, ['{"my_x":1}', '{"myX":2}'], dtype)
    assert [g[0]["my_x"] for g in got] == [1, 2]


@pytest.mark.parametrize("name", ["it's", "a.b", "x y", "a-b", "tick`", 'quo"te', "back\\slash"])
def test_unusual_property_names(spark, name):
    import json
    dtype = T.StructType([T.StructField("f", INT, False, {"accessors": [name]})])
    (value, errors), = cast_all(spark, [json.dumps({name: 1})], dtype)
    assert value["f"] == 1 and errors == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(-2**70, 2**70), st.floats(allow_nan=False, allow_infinity=False, width=32),
                          st.text(max_size=5), st.booleans(), st.none()), min_size=1, max_size=20))
def test_long_casts_agree_with_python(spark, values):
    import json
    got = cast_all(spark, [json.dumps({"anA": v}) for v in values], record(LONG))
    for v, (value, errors) in zip(values, got):
        if isinstance(v, bool) or not isinstance(v, int):
            # Whole numbers written as decimals may count as integers; anything else may not.
            if not (isinstance(v, float) and v.is_integer()):
                assert value["a"] is None and len(errors) == 1
        elif -2**63 <= v < 2**63:
            assert value["a"] == v and errors == []
        else:
            assert value["a"] is None and len(errors) == 1


def test_text_grows_with_the_fields(spark):
    """Twice the fields give twice the text, also inside arrays of records; once it grew with the square."""
    def size(n):
        inner = T.StructType([T.StructField(f"field_{i}", TEXT, True) for i in range(n)])
        dtype = T.StructType([T.StructField("rows", T.ArrayType(T.StructType([T.StructField("deep", T.ArrayType(inner), True)])), False)])
        value = cast_value("v", dtype, members="m")
        return sum(map(len, (value, cast_ok("r", "v", dtype, False, members="m"), cast_errors("r", "v", dtype, False, "'k'"), compacted("r", dtype))))

    assert size(100) < 2.2 * size(50) and size(100) < 200_000


def test_arrays_in_arrays_and_records_in_arrays(spark):
    dtype = record(T.ArrayType(T.ArrayType(T.StructType([T.StructField("k", INT, False), T.StructField("j", JSON, True)]), False), True))
    (value, errors), (_, wrong), (_, inside) = cast_all(spark, [
        '{"anA":[[{"k":1,"j":{"z":1,"a":2}}],null,[]]}', '{"anA":[[{"k":1}],[{"k":"x"},3]]}', '{"anA":[[{"k":1},null]]}'], dtype)
    assert [[r.asDict() for r in x] for x in value["a"]] == [[{"k": 1, "j": '{"z":1,"a":2}'}], []] and errors == []
    assert wrong == [("WrongType", '"x"', "Integer"), ("WrongType", "3", "Struct")] and inside == [("WrongType", "null", "Struct")]


def test_narrowed_keeps_the_named_fields():
    inner = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.VariantType())])
    tree = T.StructType([T.StructField("x", inner, False), T.StructField("y", T.StringType()), T.StructField("z", inner)])
    assert narrowed(tree) == tree and narrowed(tree, "y", "x").fieldNames() == ["x", "y"]
    part = narrowed(tree, "x.b")
    assert part == T.StructType([T.StructField("x", T.StructType([inner["b"]]), False)])


@pytest.mark.parametrize("name, unused", [
    ("json_text_v2", "regexp_extract"), ("json_text_legacy", "date_trunc"), ("cast_all_types", "from_json(StructField(label")])
def test_queries_cast_the_fields_they_show(spark, name, unused):
    """The JSON text queries cast no dates, moments and decimals that they do not show, and a query without JSON texts parses none."""
    from sluiceway.plans import queries

    plan = getattr(queries, name)(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "variant" in plan and unused not in plan
