"""Field trees: building, bridging, merging and comparing Spark types.

A tree is a Spark data type with ``VariantType`` for JSON and the source property names kept as
``accessors`` in the field metadata. Trees are table metadata, a handful per schema, and live on the
driver like any DataFrame schema.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

from sluiceway.functions.casting import ACCESSORS, accessors

ARRAY_STEP = "[]"
JSON_MARK = "json"


# Building a tree from catalog rows

def build_tree(rows: Iterable) -> T.DataType:
    """Assemble catalog rows of one schema (``path``, ``name``, ``kind``, ``nullable``) into a type."""
    by_parent: dict[tuple, list] = {}
    root = None
    for row in rows:
        path = tuple(row["path"])
        if not path:
            root = row
        else:
            by_parent.setdefault(path[:-1], []).append(row)

    def build(row) -> T.DataType:
        children = by_parent.get(tuple(row["path"]), [])
        if row["kind"] == "struct":
            return T.StructType(normalized([
                T.StructField(c["name"], build(c), c["nullable"], {ACCESSORS: [c["path"][-1]]})
                for c in children
            ]))
        if row["kind"] == "array":
            return T.ArrayType(build(children[0]), children[0]["nullable"])
        return T.VariantType() if row["kind"] == "json" else T.DataType.fromDDL(row["kind"])

    return build(root)


def normalized(fields: list[T.StructField]) -> list[T.StructField]:
    """Fields in name order; properties whose names become equal share a field if their types agree."""
    merged: dict[str, T.StructField] = {}
    for field in sorted(fields, key=lambda f: (f.name, accessors(f))):
        known = merged.get(field.name)
        if known is None:
            merged[field.name] = field
            continue
        dtype = merge_types(known.dataType, field.dataType) or T.VariantType()
        merged[field.name] = T.StructField(
            field.name, dtype, known.nullable and field.nullable,
            {ACCESSORS: accessors(known) + accessors(field)},
        )
    return list(merged.values())


# Legacy style

def legacy_type(dtype: T.DataType) -> T.DataType:
    """Type of a legacy column: strings load as JSON, integers as long, decimals as decimal(38,9)."""
    if isinstance(dtype, T.StructType):
        return T.StructType([
            T.StructField(f.name, legacy_type(f.dataType), f.nullable, f.metadata) for f in dtype.fields
        ])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(legacy_type(dtype.elementType), True)
    if isinstance(dtype, T.StringType):
        return T.VariantType()
    if isinstance(dtype, T.IntegerType):
        return T.LongType()
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, 9)
    return dtype


def drop_json(dtype: T.DataType) -> T.DataType:
    """JSON to string at every level; run after the transform and before evolution."""
    if isinstance(dtype, T.StructType):
        return T.StructType([
            T.StructField(f.name, drop_json(f.dataType), f.nullable, f.metadata) for f in dtype.fields
        ])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(drop_json(dtype.elementType), dtype.containsNull)
    return T.StringType() if isinstance(dtype, T.VariantType) else dtype


def table_type(dtype: T.DataType) -> T.DataType:
    """Stored type: integers widen to long, arrays hold no nulls, JSON is text marked in metadata."""
    if isinstance(dtype, T.StructType):
        return T.StructType([table_field(f) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(table_type(dtype.elementType), False)
    if isinstance(dtype, T.VariantType):
        return T.StringType()
    return T.LongType() if isinstance(dtype, T.IntegerType) else dtype


def table_field(field: T.StructField) -> T.StructField:
    leaf = field.dataType
    while isinstance(leaf, T.ArrayType):
        leaf = leaf.elementType
    marked = isinstance(leaf, T.VariantType) or (field.metadata or {}).get(JSON_MARK)
    # An array column has no nullability of its own: it is repeated, and absent means empty.
    nullable = field.nullable or isinstance(field.dataType, T.ArrayType)
    return T.StructField(field.name, table_type(field.dataType), nullable, {JSON_MARK: True} if marked else {})


# Merging the versions of one schema family

_WIDTH = {T.IntegerType: 10, T.LongType: 19}


def merge_types(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """Smallest common type of two versions of a field, or None if there is none."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merge_structs(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = merge_types(a.elementType, b.elementType)
        return None if element is None else T.ArrayType(element, a.containsNull or b.containsNull)
    if type(a) is type(b) and not isinstance(a, T.DecimalType):
        return a
    numeric = (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType)
    if not (isinstance(a, numeric) and isinstance(b, numeric)):
        return None
    if isinstance(a, T.DoubleType) or isinstance(b, T.DoubleType):
        return T.DoubleType()
    if not isinstance(a, T.DecimalType) and not isinstance(b, T.DecimalType):
        return T.LongType()
    whole, scale = 0, 0
    for t in (a, b):
        if isinstance(t, T.DecimalType):
            whole, scale = max(whole, t.precision - t.scale), max(scale, t.scale)
        else:
            whole = max(whole, _WIDTH[type(t)])
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def _merge_structs(a: T.StructType, b: T.StructType) -> T.StructType | None:
    fields = []
    names = a.fieldNames() + [n for n in b.fieldNames() if n not in a.fieldNames()]
    for name in names:
        left = a[name] if name in a.fieldNames() else None
        right = b[name] if name in b.fieldNames() else None
        if left is None or right is None:
            only = left or right
            fields.append(T.StructField(name, only.dataType, True, only.metadata))
            continue
        dtype = merge_types(left.dataType, right.dataType)
        if dtype is None:
            return None
        sources = accessors(left) + [x for x in accessors(right) if x not in accessors(left)]
        fields.append(T.StructField(name, dtype, left.nullable or right.nullable, {ACCESSORS: sources}))
    return T.StructType(sorted(fields, key=lambda f: f.name))


def merge_series(series: list[tuple[tuple, T.DataType]]):
    """Merge versions in order. Returns the merged type, the versions in it, and the other versions.

    A version that does not fit what came before keeps its own type and later gets a recovery column.
    """
    merged, members, recoveries = None, [], []
    for version, dtype in sorted(series, key=lambda s: s[0]):
        wider = dtype if merged is None else merge_types(merged, dtype)
        if wider is None:
            recoveries.append((version, dtype))
        else:
            merged = wider
            members.append(version)
    return merged, members, recoveries


# Comparing with the table and evolving it

def _record(dtype: T.DataType) -> T.StructType | None:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    return dtype if isinstance(dtype, T.StructType) else None


def fields_to_alter(table: T.StructType, batch: Iterable[T.StructField]) -> list[T.StructField]:
    """Batch fields the table must change for: missing, to be relaxed, or either one below.

    Types are not compared: a column that exists with another type is left as it is.
    """
    existing = {f.name: f for f in table.fields}

    def differs(field: T.StructField) -> bool:
        known = existing.get(field.name)
        if known is None:
            return True
        relax = not known.nullable and field.nullable and not isinstance(known.dataType, T.ArrayType)
        outer, inner = _record(known.dataType), _record(field.dataType)
        return relax or (
            outer is not None and inner is not None and bool(fields_to_alter(outer, inner.fields))
        )

    return [f for f in batch if differs(f)]


def changes(table: T.StructType, batch: Iterable[T.StructField]) -> list[T.StructField]:
    """What :func:`fields_to_alter` gives, cut down to what is new: of a record only the fields that change it."""
    existing = {f.name: f for f in table.fields}

    def narrowed(dtype: T.DataType, inner: list[T.StructField]) -> T.DataType:
        return T.ArrayType(narrowed(dtype.elementType, inner), dtype.containsNull) if isinstance(dtype, T.ArrayType) else T.StructType(inner)

    out = []
    for field in fields_to_alter(table, batch):
        known = existing.get(field.name)
        outer, inner = _record(known.dataType) if known else None, _record(field.dataType)
        if outer is not None and inner is not None:
            field = T.StructField(field.name, narrowed(field.dataType, changes(outer, inner.fields)), field.nullable, field.metadata)
        out.append(field)
    return out


def has_fields(table: T.StructType, expected: Iterable[T.StructField]) -> bool:
    """Whether the table already satisfies the expected fields."""
    return not fields_to_alter(table, expected)


def merge_columns(table: T.StructType, batch: Iterable[T.StructField]) -> T.StructType:
    """Table schema with the batch fields merged in: order kept, new fields last, types unchanged."""
    incoming = {f.name: f for f in batch}
    kept = [_merge_field(f, incoming[f.name]) if f.name in incoming else f for f in table.fields]
    known = set(table.fieldNames())
    return T.StructType(kept + [table_field(f) for n, f in incoming.items() if n not in known])


def _merge_field(known: T.StructField, field: T.StructField) -> T.StructField:
    def deepen(dtype: T.DataType, inner: T.StructType) -> T.DataType:
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(deepen(dtype.elementType, inner), dtype.containsNull)
        return merge_columns(dtype, inner.fields) if isinstance(dtype, T.StructType) else dtype

    inner = _record(field.dataType)
    dtype = known.dataType if inner is None else deepen(known.dataType, inner)
    return T.StructField(known.name, dtype, known.nullable or field.nullable, known.metadata)


def column_count(dtype: T.DataType) -> int:
    """Leaf fields of a table schema, the number a column cap is compared with."""
    inner = _record(dtype)
    return 1 if inner is None else sum(column_count(f.dataType) for f in inner.fields)


def flat_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, str, bool]]:
    """Every field as (path, type, nullable); array levels appear as ``[]`` in the path."""
    rows = []
    for field in schema.fields:
        path, dtype = prefix + field.name, field.dataType
        while isinstance(dtype, T.ArrayType):
            path, dtype = path + ARRAY_STEP, dtype.elementType
        inner = isinstance(dtype, T.StructType)
        rows.append((path, "struct" if inner else dtype.simpleString(), field.nullable))
        if inner:
            rows.extend(flat_paths(dtype, path + "."))
    return rows
