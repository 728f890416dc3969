"""Strict casting of VARIANT values to typed columns.

A field tree is a plain Spark data type in which ``VariantType`` stands for a JSON column. Every
function takes and returns SQL text, so a whole entity casts inside one projection. A value that does
not have the wanted type becomes null in :func:`cast_value`; :func:`cast_ok` and :func:`cast_errors`
then tell a legal null from a wrong type by looking at the value beside its source, and :func:`compacted` drops the nulls of arrays at last. Arrays keep
their nulls until then, so that each member stands beside its source: nothing is cast twice, and the text grows with the number of fields only.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import types as T

from sluiceway.functions import errors as E
from sluiceway.functions.sql import every, field, first_found, quoted, record

ACCESSORS = "accessors"
V2 = "v2"
LEGACY = "legacy"

DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?(Z|[+-][0-9]{2}:[0-9]{2})$"
)


def accessors(field: T.StructField) -> list[str]:
    """Property names in the source JSON that feed a field."""
    return list((field.metadata or {}).get(ACCESSORS) or [field.name])


def type_name(dtype: T.DataType, mode: str = V2) -> str:
    """Name of an expected type in an error. Legacy columns report JSON as String."""
    if isinstance(dtype, T.VariantType):
        return "String" if mode == LEGACY else "Json"
    if isinstance(dtype, T.DecimalType):
        return f"Decimal({dtype.precision},{dtype.scale})"
    for cls, name in (
        (T.StringType, "String"), (T.BooleanType, "Boolean"), (T.IntegerType, "Integer"),
        (T.LongType, "Long"), (T.DoubleType, "Double"), (T.DateType, "Date"),
        (T.TimestampType, "Timestamp"), (T.ArrayType, "Array"), (T.StructType, "Struct"),
    ):
        if isinstance(dtype, cls):
            return name
    raise TypeError(f"no cast for {dtype}")


def json_text_type(dtype: T.DataType) -> T.DataType | None:
    """The part of a tree that leads to JSON leaves, keyed by source property, leaves as strings.

    VARIANT sorts object keys, so the text of a JSON leaf comes from ``from_json`` with this type,
    which keeps the key order of the input and reads nothing else.
    """
    if isinstance(dtype, T.StructType):
        if _ambiguous(dtype):
            return None
        kept = {}
        for field in dtype.fields:
            below = json_text_type(field.dataType)
            if below is not None:
                for accessor in accessors(field):
                    kept[accessor] = T.StructField(accessor, below)
        return T.StructType(list(kept.values())) if kept else None
    if isinstance(dtype, T.ArrayType):
        below = json_text_type(dtype.elementType)
        return None if below is None else T.ArrayType(below)
    return T.StringType() if isinstance(dtype, T.VariantType) else None


def narrowed(dtype: T.StructType, *paths: str) -> T.StructType:
    """The part of a record that holds the fields with these dotted names; all of it if there are none.

    Spark's column pruning does not see through the conditions around a record, so a reader of few fields asks for them before the cast.
    """
    if not paths:
        return dtype
    kept = []
    for f in dtype.fields:
        below = [p.split(".", 1)[1] for p in paths if p.startswith(f"{f.name}.")]
        if f.name in paths:
            kept.append(f)
        elif below:
            kept.append(T.StructField(f.name, narrowed(f.dataType, *below), f.nullable, f.metadata))
    return T.StructType(kept)


def _ambiguous(dtype: T.StructType) -> bool:
    """Whether two property names differ by case only, so that Spark cannot tell them apart."""
    names = [a.lower() for f in dtype.fields for a in accessors(f)]
    return len(set(names)) < len(names)


def members_of(node: str, dtype: T.DataType) -> str | None:
    """The properties of a record, all taken from its VARIANT in one step; null if it is no object.

    Passed as ``members`` to the functions below it saves them a walk from the root per property.
    """
    if not isinstance(dtype, T.StructType) or _ambiguous(dtype):
        return None
    names = [a for f in dtype.fields for a in accessors(f)]
    if any("`" in n for n in names):
        return None
    wanted = "struct<" + ",".join(f"`{n}`:variant" for n in names) + ">"
    return f"try_variant_get({node}, '$', {quoted(wanted)})"


def _member(members: str, f: T.StructField) -> str:
    return first_found([field(members, a) for a in accessors(f)])


def _step(accessor: str) -> str:
    if "'" not in accessor:
        return f"['{accessor}']"
    if '"' not in accessor:
        return f'["{accessor}"]'
    raise ValueError(f"property name cannot be addressed by a JSON path: {accessor!r}")


def _get(node: str, paths: list[str], wanted: str) -> str:
    found = []
    for path in paths:
        if wanted == "variant":
            found.append(node if path == "$" else f"variant_get({node}, {quoted(path)}, 'variant')")
        else:
            found.append(f"try_variant_get({node}, {quoted(path)}, {quoted(wanted)})")
    return first_found(found)


def _below(paths: list[str], f: T.StructField) -> list[str]:
    return [path + _step(accessor) for path, accessor in product(paths, accessors(f))]


def _text_below(text: str | None, f: T.StructField) -> str | None:
    if text is None or json_text_type(f.dataType) is None:
        return None
    return first_found([field(text, a) for a in accessors(f)])


def _nullish(node: str) -> str:
    return f"({node} IS NULL OR is_variant_null({node}))"


def _items(node: str, paths: list[str], dtype: T.ArrayType, depth: int) -> tuple[str, str, str | None]:
    """The members of an array, and of one member its VARIANT and its properties. Properties of records are taken from each member in one step."""
    items, e = _get(node, paths, "array<variant>"), f"e{depth}"
    members = members_of(e, dtype.elementType)
    if members is None:
        return items, e, None
    return f"transform({items}, {e} -> named_struct('data', {e}, 'members', {members}))", f"{e}.data", f"{e}.members"


def _has_arrays(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.ArrayType) or (isinstance(dtype, T.StructType) and any(_has_arrays(f.dataType) for f in dtype.fields))


def compacted(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """The result of :func:`cast_value` without the nulls in its arrays, at every level."""
    if not _has_arrays(dtype):
        return value
    if isinstance(dtype, T.StructType):
        fields = [(f.name, compacted(field(value, f.name), f.dataType, depth)) for f in dtype.fields]
        return f"CASE WHEN {value} IS NOT NULL THEN {record(fields)} END"
    c = f"c{depth}"
    kept = f"filter({value}, {c} -> {c} IS NOT NULL)"
    return f"transform({kept}, {c} -> {compacted(c, dtype.elementType, depth + 1)})" if _has_arrays(dtype.elementType) else kept


def _scalar(node: str, paths: list[str], dtype: T.DataType, tag: str) -> str:
    """Value of a scalar whose JSON type is the wanted one."""
    string = _get(node, paths, "string")
    if isinstance(dtype, (T.IntegerType, T.LongType)):
        whole = f"{tag} = 'BIGINT' OR (startswith({tag}, 'DECIMAL') AND endswith({tag}, ',0)'))"
        return f"CASE WHEN {whole} THEN {_get(node, paths, dtype.simpleString())} END"
    if isinstance(dtype, T.DoubleType):
        # Objects and arrays are no doubles for the function itself; text and booleans would be.
        return f"CASE WHEN {tag} NOT IN ('STRING', 'BOOLEAN') THEN {_get(node, paths, 'double')} END"
    if isinstance(dtype, T.DecimalType):
        cast = _get(node, paths, dtype.simpleString())
        digits = f"try_cast(regexp_extract({tag}, ',([0-9]+)', 1) AS int)"
        return (
            f"CASE WHEN {tag} = 'BIGINT' THEN {cast} "
            f"WHEN startswith({tag}, 'DECIMAL') AND {digits} <= {dtype.scale} THEN {cast} "
            f"WHEN {tag} = 'DOUBLE' AND CAST({cast} AS double) = {_get(node, paths, 'double')} THEN {cast} END"
        )
    if isinstance(dtype, T.BooleanType):
        return f"CASE WHEN {tag} = 'BOOLEAN' THEN {_get(node, paths, 'boolean')} END"
    if isinstance(dtype, T.StringType):
        return f"CASE WHEN {tag} = 'STRING' THEN {string} END"
    # No other JSON value looks like a date or a moment, so the pattern tells the type as well.
    if isinstance(dtype, T.DateType):
        return f"try_cast(regexp_extract({string}, {quoted(DATE_PATTERN)}, 0) AS date)"
    if isinstance(dtype, T.TimestampType):
        return f"date_trunc('millisecond', try_cast(regexp_extract({string}, {quoted(TIMESTAMP_PATTERN)}, 0) AS timestamp))"
    raise TypeError(f"no cast for {dtype}")


def cast_value(node: str, dtype: T.DataType, mode: str = V2, text: str | None = None,
               paths: list[str] | None = None, members: str | None = None, depth: int = 0) -> str:
    """Typed value of a VARIANT, or null where the JSON type is not the wanted one. Arrays keep a null for each such member.

    ``text`` is the matching part of the :func:`json_text_type` parse, needed for JSON leaves only.
    """
    paths = paths or ["$"]
    if members is not None:
        fields = [(f.name, cast_value(_member(members, f), f.dataType, mode, _text_below(text, f), depth=depth))
                  for f in dtype.fields]
        return f"CASE WHEN {members} IS NOT NULL THEN {record(fields)} END"
    found = _get(node, paths, "variant")
    tag = f"schema_of_variant({found})"
    if isinstance(dtype, T.StructType):
        fields = [(f.name, cast_value(node, f.dataType, mode, _text_below(text, f), _below(paths, f), depth=depth))
                  for f in dtype.fields]
        return f"CASE WHEN startswith({tag}, 'OBJECT') THEN {record(fields)} END"
    if isinstance(dtype, T.ArrayType):
        items, data, members = _items(node, paths, dtype, depth)
        e, t = f"e{depth}", f"t{depth}"
        texts = text if json_text_type(dtype.elementType) is not None else None
        one = cast_value(data, dtype.elementType, mode, t if texts is not None else None, members=members, depth=depth + 1)
        return f"transform({items}, {e} -> {one})" if texts is None else f"zip_with({items}, coalesce({texts}, array()), ({e}, {t}) -> {one})"
    if isinstance(dtype, T.VariantType):
        plain = _get(node, paths, "string") if mode == LEGACY else f"to_json({found})"
        nested = f"to_json({found})" if text is None else f"coalesce({text}, to_json({found}))"
        return (
            f"CASE WHEN {tag} = 'STRING' THEN {plain} "
            f"WHEN startswith({tag}, 'OBJECT') OR startswith({tag}, 'ARRAY') THEN {nested} "
            f"WHEN {tag} <> 'VOID' THEN to_json({found}) END"
        )
    return _scalar(node, paths, dtype, tag)


def cast_ok(value: str, node: str, dtype: T.DataType, nullable: bool, mode: str = V2,
            paths: list[str] | None = None, members: str | None = None, depth: int = 0) -> str:
    """Whether ``value``, the result of :func:`cast_value`, is a legal reading of the VARIANT."""
    paths = paths or ["$"]
    present = [f"{value} IS NOT NULL"]
    if members is not None:
        present += [cast_ok(field(value, f.name), _member(members, f), f.dataType, f.nullable, mode, depth=depth)
                    for f in dtype.fields]
    elif isinstance(dtype, T.StructType):
        present += [cast_ok(field(value, f.name), node, f.dataType, f.nullable, mode, _below(paths, f), depth=depth)
                    for f in dtype.fields]
    elif isinstance(dtype, T.ArrayType):
        items, data, inner = _items(node, paths, dtype, depth)
        e, v = f"e{depth}", f"v{depth}"
        legal = cast_ok(v, data, dtype.elementType, dtype.containsNull, mode, members=inner, depth=depth + 1)
        present.append(f"forall(zip_with({value}, {items}, ({v}, {e}) -> {legal}), {e} -> {e})")
    if nullable:
        return f"CASE WHEN {value} IS NULL THEN {_nullish(_get(node, paths, 'variant'))} ELSE {every(present)} END"
    return every(present)


def cast_errors(value: str, node: str, dtype: T.DataType, nullable: bool, key: str, mode: str = V2,
                paths: list[str] | None = None, depth: int = 0) -> str:
    """All wrong types below a VARIANT, one error record per bad leaf; null if there is none."""
    paths = paths or ["$"]
    found = _get(node, paths, "variant")
    shown = f"coalesce(to_json({found}), 'null')"
    wrong = f"array({E.error(E.WRONG_TYPE, key, shown, type_name(dtype, mode))})"
    if nullable:
        wrong = f"CASE WHEN NOT {_nullish(found)} THEN {wrong} END"
    if isinstance(dtype, T.StructType):
        below = E.join_errors([
            cast_errors(field(value, f.name), node, f.dataType, f.nullable, key, mode, _below(paths, f), depth)
            for f in dtype.fields
        ])
    elif isinstance(dtype, T.ArrayType):
        e, v = f"e{depth}", f"v{depth}"
        inner = cast_errors(v, e, dtype.elementType, dtype.containsNull, key, mode, depth=depth + 1)
        below = f"flatten(array_compact(zip_with({value}, {_get(node, paths, 'array<variant>')}, ({v}, {e}) -> {inner})))"
    else:
        return f"CASE WHEN {value} IS NULL THEN {wrong} END"
    return f"CASE WHEN {value} IS NULL THEN {wrong} ELSE {below} END"
