from pyspark.sql import types as T

from sluiceway.operators.fields import (
    column_count, drop_json, fields_to_alter, flat_paths, has_fields, legacy_type, merge_columns, merge_series,
    merge_types, table_type,
)

INT, LONG, DOUBLE, TEXT, JSON = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.VariantType()


def f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


def struct(*fields):
    return T.StructType(list(fields))


TABLE = struct(
    f("event_id", TEXT, False), f("u", struct(f("my_string", TEXT))),
    f("c", T.ArrayType(struct(f("x", LONG, False)), False)), f("d", DOUBLE), f("t", TEXT),
)
BATCH = [
    f("event_id", TEXT, False), f("u", struct(f("my_string", TEXT), f("my_integer", LONG))),
    f("c", T.ArrayType(struct(f("x", LONG)), True)), f("t", LONG),
]


def test_diff_compares_names_and_nullability_only():
    assert [x.name for x in fields_to_alter(TABLE, BATCH)] == ["u", "c"]
    assert not has_fields(TABLE, BATCH)


def test_merge_keeps_order_and_types():
    merged = merge_columns(TABLE, BATCH + [f("new", INT)])
    assert flat_paths(merged) == [
        ("event_id", "string", False), ("u", "struct", True), ("u.my_string", "string", True),
        ("u.my_integer", "bigint", True), ("c[]", "struct", True), ("c[].x", "bigint", True), ("d", "double", True),
        ("t", "string", True), ("new", "bigint", True),
    ]
    assert has_fields(merged, BATCH)
    assert merge_columns(merged, BATCH) == merged


def test_required_is_relaxed_and_never_tightened():
    table = struct(f("a", LONG, False), f("b", LONG))
    merged = merge_columns(table, [f("a", LONG), f("b", LONG, False)])
    assert [x.nullable for x in merged.fields] == [True, True]


def test_a_scalar_column_is_left_alone_by_a_record():
    table = struct(f("a", TEXT))
    record = [f("a", struct(f("x", LONG)))]
    assert fields_to_alter(table, record) == []
    assert merge_columns(table, record) == table


def test_names_are_compared_exactly():
    assert [x.name for x in fields_to_alter(struct(f("A", LONG)), [f("a", LONG)])] == ["a"]


def test_legacy_bridge():
    got = legacy_type(struct(f("s", TEXT), f("i", INT), f("d", T.DecimalType(9, 2)), f("a", T.ArrayType(TEXT, False)),
                             f("b", T.BooleanType()), f("n", struct(f("x", T.DateType())))))
    assert [x.dataType for x in got.fields] == [
        JSON, LONG, T.DecimalType(38, 9), T.ArrayType(JSON, True), T.BooleanType(), struct(f("x", T.DateType())),
    ]


def test_json_becomes_string():
    dtype = T.ArrayType(struct(f("a", JSON), f("b", T.ArrayType(JSON, False)), f("c", INT)), True)
    assert drop_json(dtype) == T.ArrayType(struct(f("a", TEXT), f("b", T.ArrayType(TEXT, False)), f("c", INT)), True)


def test_table_type_marks_json_and_widens():
    got = table_type(struct(f("a", JSON), f("b", INT, False), f("c", T.ArrayType(INT, True), False)))
    assert got.fields[0].metadata == {"json": True}
    assert [x.dataType for x in got.fields] == [TEXT, LONG, T.ArrayType(LONG, False)]
    assert [x.nullable for x in got.fields] == [True, False, True]


def test_numeric_widening():
    assert merge_types(INT, LONG) == LONG
    assert merge_types(LONG, DOUBLE) == DOUBLE
    assert merge_types(INT, T.DecimalType(9, 2)) == T.DecimalType(12, 2)
    assert merge_types(T.DecimalType(9, 2), T.DecimalType(9, 4)) == T.DecimalType(11, 4)
    assert merge_types(T.DecimalType(38, 20), LONG) == DOUBLE
    assert merge_types(INT, TEXT) is None
    assert merge_types(JSON, TEXT) is None
    assert merge_types(T.ArrayType(INT, False), T.ArrayType(LONG, True)) == T.ArrayType(LONG, True)


def test_series_in_order():
    one = struct(f("a", INT, False))
    two = struct(f("a", LONG, False), f("b", TEXT, False))
    bad = struct(f("a", TEXT, False))
    merged, members, recoveries = merge_series([((1, 0), bad), ((0, 0), one), ((0, 1), two)])
    assert [(x.name, x.dataType, x.nullable) for x in merged.fields] == [("a", LONG, False), ("b", TEXT, True)]
    assert members == [(0, 0), (0, 1)]
    assert recoveries == [((1, 0), bad)]


def test_leaf_count():
    assert column_count(TABLE) == 5
