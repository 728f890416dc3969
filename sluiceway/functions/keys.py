"""Schema keys: URI parsing, column naming and criteria, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

def _at_most(limit: str) -> str:
    """Pattern of the whole numbers from 1 to a limit, without leading zeros."""
    same_length = [
        f"{limit[:i]}[{0 if i else 1}-{int(digit) - 1}][0-9]{{{len(limit) - i - 1}}}"
        for i, digit in enumerate(limit) if int(digit) > (0 if i else 1)
    ]
    return "|".join([f"[1-9][0-9]{{0,{len(limit) - 2}}}", *same_length, limit])


# The schema URI scheme, its grammar and the two column prefixes. A version number fits an int.
URI_SCHEME = "iglu:"
_NUMBER = _at_most(str(2**31 - 1))
URI_PATTERN = (
    r"^iglu:([a-zA-Z0-9_.-]+)/([a-zA-Z0-9_-]+)/([a-zA-Z0-9_-]+)"
    rf"/({_NUMBER})-(0|{_NUMBER})-(0|{_NUMBER})$"
)
UNSTRUCT_PREFIX = "unstruct_event"
CONTEXTS_PREFIX = "contexts"

KEY_PARTS = ("vendor", "name", "format", "model", "revision", "addition")


def is_key(uri: Column) -> Column:
    """Whether a string is a complete schema URI."""
    return uri.rlike(URI_PATTERN)


def key_columns(uri: Column) -> dict[str, Column]:
    """The six parts of a schema URI by name; all null when the URI does not parse."""
    parts = {}
    for i, part in enumerate(KEY_PARTS, start=1):
        text = F.nullif(F.regexp_extract(uri, URI_PATTERN, i), F.lit(""))
        parts[part] = text if i <= 3 else text.cast("int")
    return parts


def snake(name: Column) -> Column:
    """Snake case: words split at case changes, an acronym run kept as one word."""
    split_acronym = F.regexp_replace(name, r"([A-Z]+)([A-Z][a-z])", "$1_$2")
    split_words = F.regexp_replace(split_acronym, r"([a-z0-9])([A-Z])", "$1_$2")
    return F.lower(F.regexp_replace(split_words, r"[^A-Za-z0-9_]", "_"))


def entity_prefix(entity: Column) -> Column:
    return F.when(entity == "unstruct", F.lit(UNSTRUCT_PREFIX)).otherwise(F.lit(CONTEXTS_PREFIX))


def column_name(entity: Column, vendor: Column, name: Column, model: Column) -> Column:
    """One column per schema family and model."""
    return F.concat_ws("_", entity_prefix(entity), snake(vendor), snake(name), model.cast("string"))


def legacy_column_name(
    entity: Column, vendor: Column, name: Column, model: Column, revision: Column, addition: Column
) -> Column:
    """One column per full schema version."""
    return F.concat_ws(
        "_", column_name(entity, vendor, name, model), revision.cast("string"), addition.cast("string")
    )


def criterion_pattern(criterion: str) -> str:
    """A criterion such as ``iglu:com.acme/ad/jsonschema/1-*-*`` as a URI regular expression."""
    body = criterion.removeprefix(URI_SCHEME).split("/")
    if len(body) != 4:
        raise ValueError(f"not a schema criterion: {criterion!r}")
    versions = body[3].split("-")
    if len(versions) != 3 or not all(v == "*" or v.isdigit() for v in versions):
        raise ValueError(f"not a schema criterion: {criterion!r}")
    fixed = "/".join(re.escape(part) for part in body[:3])
    version = "-".join("[0-9]+" if v == "*" else v for v in versions)
    return f"{re.escape(URI_SCHEME)}{fixed}/{version}"


def matches_any(uri: Column, criteria: list[str] | tuple[str, ...]) -> Column:
    """Whether a URI matches one of the criteria; criteria are configuration, so no join is needed."""
    if not criteria:
        return F.lit(False)
    return uri.rlike("^(?:" + "|".join(criterion_pattern(c) for c in criteria) + ")$")
