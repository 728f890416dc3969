"""Small helpers for expressions written as SQL text.

Expressions that are generated per field are built as text and handed to Spark once, because a table
may have thousands of fields and every Column call costs a round trip to the JVM.
"""

from __future__ import annotations

from collections.abc import Iterable


def quoted(text: str | None) -> str:
    """A string literal."""
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(*parts: str) -> str:
    """A column reference, or a field of one."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def field(parent: str, child: str) -> str:
    return f"{parent}.{name(child)}"


def one_of(value: str, options: Iterable[str]) -> str:
    listed = ", ".join(quoted(o) for o in options)
    return f"({value} IN ({listed}))" if listed else "false"


def every(conditions: Iterable[str]) -> str:
    return " AND ".join(f"({c})" for c in conditions) or "true"


def record(members: Iterable[tuple[str, str]]) -> str:
    return "named_struct(" + ", ".join(f"{quoted(n)}, {v}" for n, v in members) + ")"


def first_found(values: list[str]) -> str:
    return values[0] if len(values) == 1 else f"coalesce({', '.join(values)})"
