"""The error record shared by every stage that can reject an event, as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.sql import quoted, record

ERROR_TYPE = "struct<error:string,schema_key:string,value:string,expected:string>"

# Error names, then kinds of failed event.
FIELD_COUNT = "FieldCountMismatch"
FIELD_DECODING = "FieldDecodingError"
NOT_FOUND = "SchemaNotFound"
INVALID_SCHEMA = "InvalidSchema"
WRONG_TYPE = "WrongType"
NOT_IN_TABLE = "UnknownField"
MISSING_REQUIRED = "MissingRequiredField"

PARSING = "loader_parsing_error"
SCHEMA = "loader_schema_error"
RUNTIME = "loader_runtime_error"
SIZE = "size_violation"

NO_ERRORS = f"CAST(array() AS array<{ERROR_TYPE}>)"


def error(name: str, key: str = "CAST(NULL AS STRING)", value: str = "CAST(NULL AS STRING)",
          expected: str | None = None) -> str:
    """One error record; ``name`` and ``expected`` are plain text, ``key`` and ``value`` SQL."""
    return record([
        ("error", f"CAST({quoted(name)} AS STRING)"), ("schema_key", f"CAST({key} AS STRING)"),
        ("value", f"CAST({value} AS STRING)"), ("expected", f"CAST({quoted(expected)} AS STRING)"),
    ])


def join_errors(lists: list[str]) -> str:
    """All errors of several lists, of which some may be null."""
    return f"flatten(array_compact(array({', '.join(lists)})))" if lists else NO_ERRORS


def first_non_empty(lists: list[str]) -> str:
    """The earliest list that has errors: a later stage is not reported once one has failed."""
    cases = " ".join(f"WHEN size({found}) > 0 THEN {found}" for found in lists)
    return f"CASE {cases} ELSE {NO_ERRORS} END"


def failure(kind: str, errors: str) -> str:
    return record([("kind", quoted(kind)), ("errors", errors)])


def settled(frame: DataFrame) -> DataFrame:
    """The same rows, computed once even if a filter on them follows.

    A filter on a derived column is pushed below the projections that compute it, which evaluates a
    whole parse or cast twice. Passing the columns through a generator keeps the filter above them.
    """
    return frame.select(F.inline(F.array(F.struct(*frame.columns))))
