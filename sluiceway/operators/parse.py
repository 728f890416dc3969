"""Tab-separated lines to typed events: one narrow projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions import errors as E
from sluiceway.functions.keys import URI_PATTERN
from sluiceway.functions.sql import every, name, quoted

TSTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
ENTITY = "struct<schema:string,data:variant>"
ENTITY_TEXT = "struct<schema:string,data:string>"
ENTITY_KEY = "struct<schema:string>"


def payload_text(value: Column, dtype: T.DataType) -> Column:
    """The line as valid UTF-8: bad bytes become the replacement character."""
    return F.make_valid_utf8(value.cast("string")) if isinstance(dtype, T.BinaryType) else (
        F.make_valid_utf8(value)
    )


def _typed(text: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.BooleanType):
        return f"CASE {text} WHEN '1' THEN true WHEN '0' THEN false END"
    if isinstance(dtype, T.TimestampType):
        # Times on the wire are UTC, whatever the session time zone is.
        return f"CASE WHEN {text} RLIKE {quoted(TSTAMP_PATTERN)} THEN try_cast(concat({text}, '+00:00') AS timestamp) END"
    return f"try_cast({text} AS {dtype.simpleString()})"


def entities_of(text: Column, kind: str, enveloped: bool, element: str = ENTITY) -> Column:
    """Entities in a JSON column: a struct for ``unstruct``, an array of structs for ``contexts``.

    With an envelope the JSON is ``{"schema": ..., "data": <entities>}``. The ``data`` of an entity is
    a VARIANT, or its text with ``element=ENTITY_TEXT``.
    """
    inner = element if kind == "unstruct" else f"array<{element}>"
    if enveloped:
        return F.from_json(text, f"struct<schema:string,data:{inner}>").getField("data")
    return F.from_json(text, inner)


def parse_lines(lines: DataFrame, atomic: T.StructType, unstruct: str = "unstruct_event",
                contexts: tuple[str, ...] = ("contexts", "derived_contexts"),
                enveloped: bool = True, with_data: bool = True) -> DataFrame:
    """Parse ``value`` into the atomic columns.

    Adds ``payload`` (text of the line), ``n_bytes`` (of every line, good or bad), ``parse_errors``
    (empty for a good event), ``unstruct_entity`` and ``context_entities``. The two entity columns
    hold null for an absent entity and an empty array for no contexts. A bad line has nulls in all
    atomic columns. Other columns of ``lines`` pass through.

    With ``with_data=False`` the entities carry their schema key only, which is all that finding the
    schemas of a batch needs; the data of the entities is then never decoded.
    """
    element = ENTITY if with_data else ENTITY_KEY
    contexts = tuple(c for c in contexts if c in atomic.fieldNames())
    value_type = lines.schema["value"].dataType
    extra = [c for c in lines.columns if c != "value"]
    split = lines.select(
        *extra,
        payload_text(F.col("value"), value_type).alias("payload"),
        F.octet_length("value").cast("long").alias("n_bytes"),
    ).withColumn("parts_", F.split("payload", "\t", -1))

    texts = {f.name: f"nullif(get(parts_, {i}), '')" for i, f in enumerate(atomic.fields)}
    typed = split.selectExpr(
        *[name(c) for c in extra], "payload", "n_bytes", "size(parts_) AS n_fields_",
        *[f"{_typed(texts[f.name], f.dataType)} AS {name(f.name)}" for f in atomic.fields],
        *[f"{texts[f.name]} AS {name(f'text_{f.name}_')}" for f in atomic.fields
          if not isinstance(f.dataType, T.StringType)],
    )
    with_entities = typed.withColumns({
        "unstruct_": entities_of(F.col(unstruct), "unstruct", enveloped, element),
        **{f"contexts_{c}_": entities_of(F.col(c), "contexts", enveloped, element) for c in contexts},
    })

    # Whether a line is good is one boolean; error records are built for bad lines only.
    fine, bad = [f"n_fields_ = {len(atomic.fields)}"], []

    def check(condition: str, text: str, expected: str) -> None:
        fine.append(condition)
        bad.append(f"CASE WHEN NOT ({condition}) THEN {E.error(E.FIELD_DECODING, value=text, expected=expected)} END")

    for field in atomic.fields:
        is_text = isinstance(field.dataType, T.StringType)
        column, text = name(field.name), name(field.name if is_text else f"text_{field.name}_")
        decoded = f"{column} IS NOT NULL"
        if not field.nullable:
            check(decoded, text, f"{field.name} {field.dataType.simpleString()}")
        elif not is_text:
            check(f"{decoded} OR {text} IS NULL", text, f"{field.name} {field.dataType.simpleString()}")
    valid = f"RLIKE {quoted(URI_PATTERN)}"
    check(f"{name(unstruct)} IS NULL OR coalesce(unstruct_.schema {valid}, false)", name(unstruct), f"{unstruct} entity")
    for c in contexts:
        # A malformed array reads as null or as an array with null members: both are failures.
        legal = f"forall({name(f'contexts_{c}_')}, e -> coalesce(e.schema {valid}, false))"
        check(f"{name(c)} IS NULL OR coalesce({legal}, false)", name(c), f"{c} entities")
    count_error = E.error(E.FIELD_COUNT, value="n_fields_", expected=str(len(atomic.fields)))
    errors = f"""CASE WHEN fine_ THEN {E.NO_ERRORS}
        WHEN n_fields_ <> {len(atomic.fields)} THEN array({count_error})
        ELSE array_compact(array({', '.join(bad)})) END"""
    with_entities = with_entities.withColumn("fine_", F.expr(every(fine)))
    # A line that does not parse yields no values at all, only its payload and its errors.
    none = F.array().cast(f"array<{element}>")
    found = [F.coalesce(F.col(f"contexts_{c}_"), none) for c in contexts]
    return with_entities.select(
        *extra, "payload", "n_bytes",
        F.expr(errors).alias("parse_errors"),
        *[F.expr(f"CASE WHEN fine_ THEN {name(f.name)} END AS {name(f.name)}") for f in atomic.fields],
        F.when(F.col("fine_"), F.col("unstruct_")).alias("unstruct_entity"),
        F.when(F.col("fine_"), F.concat(*found)).otherwise(none).alias("context_entities") if found
        else none.alias("context_entities"),
    )


def good_events(parsed: DataFrame, *columns: str) -> DataFrame:
    """Events that parsed; only the named columns, so that no other has to be computed."""
    return E.settled(parsed.select("parse_errors", *columns)).filter(F.size("parse_errors") == 0).select(*columns)


def bad_lines(parsed: DataFrame) -> DataFrame:
    return E.settled(parsed.select("payload", "n_bytes", "parse_errors")).filter(F.size("parse_errors") > 0)
