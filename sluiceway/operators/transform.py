"""Events to table rows: typed entity columns, load time and the errors of each event.

All work is row-local. The projections are layered so that each VARIANT is selected once and each
entity is cast once; nothing is exchanged.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions import errors as E
from sluiceway.functions.casting import LEGACY, V2, cast_errors, cast_ok, cast_value, compacted, json_text_type, members_of
from sluiceway.functions.sql import every, name, one_of, quoted, record
from sluiceway.operators.entities import is_legacy, is_skipped
from sluiceway.operators.parse import ENTITY_TEXT, entities_of
from sluiceway.operators.registry import EntityColumn, Resolved

CONTEXT_TEXTS = "context_texts_"
UNSTRUCT_TEXT = "unstruct_text_"


def unknown_uris(resolved: Resolved, skip_schemas=(), legacy_schemas=(), legacy_mode: bool = False) -> Column:
    """Schema URIs of the event that are wanted but absent from the registry or invalid there.

    The known keys are literals, so an event is checked without a join and an unknown key in the
    data never has to be listed anywhere.
    """
    def unknown(uri: Column, text: str) -> Column:
        known = F.expr(one_of(text, resolved.uris))
        return ~known & ~is_skipped(uri, skip_schemas, legacy_schemas, legacy_mode)

    entity = F.col("unstruct_entity.schema")
    contexts = F.filter(
        F.expr("array_distinct(filter(transform(context_entities, e -> e.schema), u -> NOT " + one_of("u", resolved.uris) + "))"),
        lambda u: ~is_skipped(u, skip_schemas, legacy_schemas, legacy_mode),
    )
    wanted = entity.isNotNull() & unknown(entity, "unstruct_entity.schema")
    return F.when(wanted, F.concat(F.array(entity), contexts)).otherwise(contexts)


def lookup_errors(resolved: Resolved, style: str) -> str:
    """One error per unknown URI of one column style, from the column that lists them."""
    invalid = one_of("u", resolved.invalid)
    named = E.error(E.NOT_FOUND, key="u")
    if resolved.invalid:
        named = f"CASE WHEN {invalid} THEN {E.error(E.INVALID_SCHEMA, key='u')} ELSE {named} END"
    return f"transform(array_distinct(unknown_{style}_), u -> {named})"


def with_entity_texts(parsed: DataFrame, columns: Iterable[EntityColumn], unstruct: str = "unstruct_event",
                      contexts: tuple[str, ...] = ("contexts", "derived_contexts"),
                      enveloped: bool = True) -> DataFrame:
    """Add the JSON text of the entities, but only if a column of the batch stores JSON."""
    needing = {c.entity for c in columns if json_text_type(c.data_type) is not None}
    added = {}
    if "unstruct" in needing:
        added[UNSTRUCT_TEXT] = entities_of(F.col(unstruct), "unstruct", enveloped, ENTITY_TEXT)
    if "context" in needing:
        present = [c for c in contexts if c in parsed.columns]
        added[CONTEXT_TEXTS] = F.concat(*[
            F.coalesce(entities_of(F.col(c), "contexts", enveloped, ENTITY_TEXT),
                       F.array().cast(f"array<{ENTITY_TEXT}>"))
            for c in present
        ])
    return parsed.withColumns(added) if added else parsed


def _text_of(text: str, column: EntityColumn) -> str:
    wanted = json_text_type(column.data_type)
    return text if isinstance(wanted, T.StringType) else f"from_json({text}, {quoted(wanted.simpleString())})"


class _Stages(NamedTuple):
    """SQL of one entity column, in the order of evaluation; each step refers to the ones before."""

    source: str
    value: str
    ok: str
    errors: str
    final: str


def _prepared(schema: str, data: str, text: str | None, c: EntityColumn) -> str:
    parts = [("schema", schema), ("data", data)]
    members = members_of(data, c.data_type)
    if members is not None:
        parts.append(("members", members))
    if text is not None:
        parts.append(("text", _text_of(text, c)))
    return record(parts)


def _stages(i: int, c: EntityColumn) -> _Stages:
    source, value = f"source_{i}_", f"raw_{i}_"
    grouped = members_of("x", c.data_type) is not None
    text_too = json_text_type(c.data_type) is not None

    def members(e: str) -> str | None:
        return f"{e}.members" if grouped else None

    def cast(e: str) -> str:
        return cast_value(f"{e}.data", c.data_type, c.mode, f"{e}.text" if text_too else None, members=members(e))

    if c.entity == "unstruct":
        mine = one_of("unstruct_entity.schema", c.uris)
        text = f"{UNSTRUCT_TEXT}.data" if text_too else None
        ok = cast_ok(value, f"{source}.data", c.data_type, True, c.mode, members=members(source))
        errors = cast_errors(value, f"{source}.data", c.data_type, True, f"{source}.schema", c.mode)
        # An event without the entity is no error, and neither is a root that is JSON null.
        return _Stages(
            f"CASE WHEN {mine} THEN {_prepared('unstruct_entity.schema', 'unstruct_entity.data', text, c)} END",
            f"CASE WHEN {source} IS NOT NULL THEN {cast(source)} END",
            f"CASE WHEN {source} IS NULL THEN true ELSE {ok} END",
            f"CASE WHEN {source} IS NOT NULL THEN {errors} END",
            compacted(value, c.data_type),
        )
    mine = f"filter(context_entities, c -> {one_of('c.schema', c.uris)})"
    prepared = f"transform({mine}, c -> {_prepared('c.schema', 'c.data', None, c)})"
    if text_too:
        both = f"""zip_with(context_entities, {CONTEXT_TEXTS}, (e, t) ->
            named_struct('schema', e.schema, 'data', e.data, 'text', t.data))"""
        mine = f"filter({both}, c -> {one_of('c.schema', c.uris)})"
        prepared = f"transform({mine}, c -> {_prepared('c.schema', 'c.data', 'c.text', c)})"
    ok = cast_ok("v", "s.data", c.data_type, True, c.mode, members=members("s"))
    errors = cast_errors("v", "s.data", c.data_type, True, "s.schema", c.mode)
    # Contexts lose null members and become null, never an empty array, when nothing matched.
    return _Stages(
        prepared,
        f"transform({source}, c -> {cast('c')})",
        f"forall(zip_with({value}, {source}, (v, s) -> {ok}), fine -> fine)",
        f"flatten(array_compact(zip_with({value}, {source}, (v, s) -> {errors})))",
        f"CASE WHEN size({value}) > 0 THEN {compacted(value, T.ArrayType(c.data_type))} END",
    )


def _with(frame: DataFrame, added: dict[str, str]) -> DataFrame:
    return frame.selectExpr("*", *[f"{sql} AS {column}" for column, sql in added.items()]) if added else frame


def transform_events(parsed: DataFrame, atomic: T.StructType, resolved: Resolved, load_tstamp: Column,
                     unstruct: str = "unstruct_event",
                     contexts: tuple[str, ...] = ("contexts", "derived_contexts"), enveloped: bool = True,
                     skip_schemas=(), legacy_schemas=(), legacy_mode: bool = False,
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Turn parsed lines into table rows.

    Result: ``payload``, ``n_bytes``, the columns in ``keep``, ``failure`` (null for a good row, else
    ``struct<kind, errors>``), ``row`` (a struct of the atomic columns without the raw entity JSON,
    ``load_tstamp`` and the entity columns). One pass serves good rows, failed events and counts.

    Per entity column three projections follow each other: the matching entities, their cast value and
    whether the cast went well. Errors come in a fixed order, and the first list that is not empty is
    the failure: unknown schemas, wrong types, then the same for legacy columns.
    """
    columns = resolved.columns
    stages = [_stages(i, c) for i, c in enumerate(columns)]
    fixed = [f.name for f in atomic.fields if f.name != unstruct and f.name not in contexts]
    staged = with_entity_texts(parsed, columns, unstruct, contexts, enveloped)
    staged = staged.withColumn("unknown_", unknown_uris(resolved, skip_schemas, legacy_schemas, legacy_mode))
    staged = _with(staged, {f"source_{i}_": s.source for i, s in enumerate(stages)})
    staged = _with(staged, {f"raw_{i}_": s.value for i, s in enumerate(stages)})
    clean = ["size(parse_errors) = 0", "size(unknown_) = 0", *[s.ok for s in stages]]
    staged = staged.withColumns({
        "clean_": F.expr(every(clean)),
        "stamp_": load_tstamp,
        "unknown_legacy_": F.filter("unknown_", lambda u: is_legacy(u, legacy_schemas, legacy_mode)),
        "unknown_v2_": F.filter("unknown_", lambda u: ~is_legacy(u, legacy_schemas, legacy_mode)),
    })
    # Error records are built for failing events only; the others stop at the boolean.
    schema_errors = E.first_non_empty([
        step for style in (V2, LEGACY)
        for step in (
            lookup_errors(resolved, style),
            E.join_errors([s.errors for s, c in zip(stages, columns) if c.mode == style]),
        )
    ])
    failure = f"""CASE WHEN clean_ THEN NULL
        WHEN size(parse_errors) > 0 THEN {E.failure(E.PARSING, 'parse_errors')}
        ELSE {E.failure(E.SCHEMA, schema_errors)} END"""
    finals = {c.name: s.final for c, s in zip(columns, stages)}  # names are told apart when columns are resolved
    row = record([(f, name(f)) for f in fixed] + [("load_tstamp", "stamp_"), *finals.items()])
    return staged.selectExpr(
        "payload", "n_bytes", *[name(c) for c in keep], f"{failure} AS failure", f"{row} AS row"
    )


def good_rows(transformed: DataFrame) -> DataFrame:
    rows = E.settled(transformed.select(F.col("failure").isNull().alias("good_"), "row"))
    return rows.filter("good_").select("row.*")


def failures(transformed: DataFrame, *keep: str) -> DataFrame:
    rows = E.settled(transformed.select("payload", "failure", *keep))
    return rows.filter(F.col("failure").isNotNull())
