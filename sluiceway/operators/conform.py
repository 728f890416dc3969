"""Fitting rows to the table: which rows cannot be stored, and the cast of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluiceway.functions import errors as E
from sluiceway.functions.casting import type_name
from sluiceway.functions.sql import field, name, record


def fits(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of a scalar type can be stored in another without loss."""
    if isinstance(source, T.VariantType):
        source = T.StringType()
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType):
        return (source.scale <= target.scale
                and source.precision - source.scale <= target.precision - target.scale)
    if isinstance(source, (T.IntegerType, T.LongType)) and isinstance(target, T.DecimalType):
        return target.precision - target.scale >= (10 if isinstance(source, T.IntegerType) else 19)
    if isinstance(source, T.IntegerType):
        return isinstance(target, (T.IntegerType, T.LongType, T.DoubleType))
    return type(source) is type(target)


def misfits(value: str, source: T.DataType, target: T.DataType | None, nullable: bool, path: str,
            depth: int = 0) -> str | None:
    """Errors that keep a value out of its table column, or None if no value of the type can have any.

    An unknown field or a wrong shape fails a row only where it holds a value.
    """
    def when(condition: str, kind: str, expected: str) -> str:
        return f"CASE WHEN {value} {condition} THEN array({E.error(kind, expected=expected)}) END"

    if target is None:
        return when("IS NOT NULL", E.NOT_IN_TABLE, path)
    found = []
    if not nullable and not isinstance(target, T.ArrayType):
        found.append(when("IS NULL", E.MISSING_REQUIRED, path))
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        known = {f.name: f for f in target.fields}
        for f in source.fields:
            match = known.get(f.name)
            below = misfits(field(value, f.name), f.dataType, match.dataType if match else None,
                            match.nullable if match else True, f"{path}.{f.name}", depth)
            if below is not None:
                found.append(f"CASE WHEN {value} IS NOT NULL THEN {below} END")
        for f in target.fields:
            if not f.nullable and f.name not in source.fieldNames() and not isinstance(f.dataType, T.ArrayType):
                found.append(when("IS NOT NULL", E.MISSING_REQUIRED, f"{path}.{f.name}"))
    elif isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        e = f"m{depth}"
        below = misfits(e, source.elementType, target.elementType, True, f"{path}[]", depth + 1)
        if below is not None:
            found.append(f"flatten(array_compact(transform({value}, {e} -> {below})))")
    elif isinstance(source, (T.StructType, T.ArrayType)) or not fits(source, target):
        found.append(when("IS NOT NULL", E.WRONG_TYPE, f"{path} {type_name(target)}"))
    if not found:
        return None
    return found[0] if len(found) == 1 else E.join_errors(found)


def aligned(value: str, source: T.DataType, target: T.DataType, depth: int = 0) -> str:
    """A fitting value in the type of its table column; absent fields become null."""
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        if [f.name for f in source.fields] == [f.name for f in target.fields] and all(
            s.dataType == t.dataType and not isinstance(s.dataType, (T.StructType, T.ArrayType))
            for s, t in zip(source.fields, target.fields)
        ):
            return value
        members = [
            (f.name, aligned(field(value, f.name), source[f.name].dataType, f.dataType, depth)
             if f.name in source.fieldNames() else _absent(f.dataType))
            for f in target.fields
        ]
        return f"CASE WHEN {value} IS NOT NULL THEN {record(members)} END"
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        e = f"a{depth}"
        one = aligned(e, source.elementType, target.elementType, depth + 1)
        return value if one == e else f"transform({value}, {e} -> {one})"
    if isinstance(source, (T.StructType, T.ArrayType)) or not fits(source, target):
        return _absent(target)
    return value if source == target else f"CAST({value} AS {target.simpleString()})"


def _absent(dtype: T.DataType) -> str:
    return f"CAST(NULL AS {dtype.simpleString()})"


def conform(transformed: DataFrame, table: T.StructType) -> DataFrame:
    """Fail the rows that do not fit the table and shape the others like it.

    Runs before the single append, so one bad row never makes the good ones be written twice. A row
    that has failed earlier keeps its first failure.
    """
    source = transformed.schema["row"].dataType
    known = {f.name: f for f in table.fields}
    found = []
    for f in source.fields:
        match = known.get(f.name)
        errors = misfits(name("row", f.name), f.dataType, match.dataType if match else None,
                         match.nullable if match else True, f.name)
        if errors is not None:
            found.append(errors)
    for f in table.fields:
        if not f.nullable and f.name not in source.fieldNames():
            found.append(f"array({E.error(E.MISSING_REQUIRED, expected=f.name)})")
    row = record([
        (f.name, aligned(name("row", f.name), source[f.name].dataType, f.dataType)
         if f.name in source.fieldNames() else _absent(f.dataType))
        for f in table.fields
    ])
    others = [name(c) for c in transformed.columns if c not in ("failure", "row")]
    misfit = f"CASE WHEN failure IS NULL THEN {E.join_errors(found)} END" if found else E.NO_ERRORS
    return transformed.selectExpr("*", f"{misfit} AS misfit_").selectExpr(
        *others,
        f"CASE WHEN failure IS NOT NULL THEN failure WHEN size(misfit_) > 0 THEN {E.failure(E.RUNTIME, 'misfit_')} END AS failure",
        f"{row} AS row",
    )
