"""Schema registry: a DataFrame of JSON Schemas, its field catalog, and the columns of a batch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions.casting import LEGACY, V2
from sluiceway.functions.keys import URI_SCHEME, column_name, is_key, key_columns, legacy_column_name, snake
from sluiceway.operators.entities import with_style
from sluiceway.operators.fields import ARRAY_STEP, build_tree, drop_json, legacy_type, merge_series

INT_MIN, INT_MAX = -(2**31), 2**31 - 1


def registry_from_directory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Schemas below ``path``, or in a list of files, in the layout ``vendor/name/format/model-revision-addition``."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    key = F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+/[^/]+/[^/]+?)(?:\.json)?$", 1)
    return _keyed(files.select(F.concat(F.lit(URI_SCHEME), key).alias("uri"), F.col("value").alias("doc")))


def registry_from_rows(spark: SparkSession, rows: Iterable[tuple[str, str]]) -> DataFrame:
    """Schemas given as (URI, JSON text)."""
    return _keyed(spark.createDataFrame(list(rows), "uri string, doc string"))


def _keyed(docs: DataFrame) -> DataFrame:
    keyed = docs.filter(is_key(F.col("uri")))
    return keyed.select("uri", *[c.alias(n) for n, c in key_columns(F.col("uri")).items()], "doc")


# JSON Schema to field catalog

def _tag(node: Column, path: str) -> Column:
    return F.schema_of_variant(F.variant_get(node, path, "variant"))


def _with_shape(nodes: DataFrame) -> DataFrame:
    """Add the kind of each JSON Schema ``node``, whether it is legal, and the nodes below it.

    Done in steps, each a projection over the columns of the step before, so no expression repeats.
    """
    node = F.col("node")
    keywords = nodes.withColumns({
        "type_tag": _tag(node, "$.type"),
        "one_type": F.try_variant_get(node, "$.type", "string"),
        "many_types": F.try_variant_get(node, "$.type", "array<string>"),
        "properties": F.try_variant_get(node, "$.properties", "map<string,variant>"),
        "properties_tag": _tag(node, "$.properties"),
        "items": F.variant_get(node, "$.items", "variant"),
        "low": F.try_variant_get(node, "$.minimum", "decimal(38,0)"),
        "high": F.try_variant_get(node, "$.maximum", "decimal(38,0)"),
        "step": F.to_json(F.variant_get(node, "$.multipleOf", "variant")),
        "format_": F.try_variant_get(node, "$.format", "string"),
        "enum": F.try_variant_get(node, "$.enum", "array<variant>"),
        "required": F.try_variant_get(node, "$.required", "array<string>"),
        "required_tag": _tag(node, "$.required"),
    })
    listed = F.when(F.col("type_tag") == "STRING", F.array("one_type")).otherwise(F.col("many_types"))
    described = keywords.withColumns({
        "listed": listed,
        "items": F.when(F.schema_of_variant("items").startswith("OBJECT"), F.col("items")),
        "enum_is_text": F.forall("enum", lambda e: F.schema_of_variant(e) == "STRING"),
        # multipleOf 0.01 gives a decimal of scale 2; the bounds give the whole digits.
        "scale": F.length(F.regexp_extract("step", r"^0?\.(0*1)$", 1)),
        "digits": F.length(F.greatest(F.abs("low"), F.abs("high")).cast("string")),
    }).withColumn("types", F.array_sort(F.array_distinct(F.array_remove("listed", "null"))))
    typed = described.withColumn("only", F.when(F.size("types") == 1, F.get("types", F.lit(0))))
    only, scale, digits = F.col("only"), F.col("scale"), F.col("digits")
    kind = (
        F.when(F.col("enum").isNotNull() & ~F.col("enum_is_text"), "json")
        .when((only == "object") & (F.size("properties") > 0), "struct")
        .when((only == "array") & F.col("items").isNotNull(), "array")
        .when((only == "string") & (F.col("format_") == "date"), "date")
        .when((only == "string") & (F.col("format_") == "date-time"), "timestamp")
        .when(only == "string", "string")
        .when(only == "boolean", "boolean")
        .when((only == "integer") & (F.col("low") >= INT_MIN) & (F.col("high") <= INT_MAX), "int")
        .when(only == "integer", "bigint")
        .when((only == "number") & scale.between(1, 9) & (digits + scale <= 38),
              F.format_string("decimal(%d,%d)", digits + scale, scale))
        .when((only == "number") | (F.col("types") == F.array(F.lit("integer"), F.lit("number"))), "double")
        .when(only.isNull() & F.col("enum_is_text"), "string")
        .otherwise("json")
    )
    legal = (
        F.schema_of_variant(node).startswith("OBJECT")
        & (F.col("properties_tag").isNull() | F.col("properties").isNotNull())
        & (F.col("required_tag").isNull() | F.col("required").isNotNull())
        & (F.col("type_tag").isNull() | F.col("listed").isNotNull())
    )
    shaped = typed.withColumns({
        "kind": kind,
        "legal": F.coalesce(legal, F.lit(False)),
        "allows_null": F.coalesce(F.array_contains("listed", "null"), F.lit(False)),
        "required_names": F.coalesce("required", F.array().cast("array<string>")),
    })
    below = F.when(F.col("kind") == "struct", F.col("properties")).when(
        F.col("kind") == "array", F.map_from_arrays(F.array(F.lit(ARRAY_STEP)), F.array("items"))
    )
    return shaped.select(
        *nodes.columns, "kind", "legal", "allows_null", "required_names", below.alias("below")
    )


def compile_registry(docs: DataFrame) -> DataFrame:
    """One row per schema: its key, its ``nodes`` (a tree as a list) and whether it is ``legal``.

    This is the form the loader resolves against. It is built once and kept, not once per batch.
    """
    levels: list[DataFrame] = []
    compiled = compiled_schemas(docs, levels).persist()
    compiled.count()
    for level in levels:
        level.unpersist()
    return compiled


def compiled_schemas(docs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """What :func:`compile_registry` gives, not kept; the levels of the walk, kept while it runs, are added to ``levels``."""
    node = F.struct("path", "name", "kind", "nullable")
    by_schema = ["uri", "vendor", F.col("schema_name").alias("name"), "format", "model", "revision", "addition"]
    return field_catalog(docs, levels).groupBy(*by_schema).agg(
        F.collect_list(node).alias("nodes"), F.bool_and("legal").alias("legal")
    )


def field_catalog(docs: DataFrame, levels: list[DataFrame] | None = None) -> DataFrame:
    """One row per node of every schema: ``path``, snake-case ``name``, ``kind``, ``nullable``, ``legal``.

    The walk goes one level per step until nothing is left below, so it runs as many small jobs as
    the deepest schema has levels; a document is finite, so the walk ends. Levels are kept and listed in ``levels``, to be released by the caller.
    """
    keys = ["uri", "vendor", "name", "format", "model", "revision", "addition"]
    key_struct = F.struct(*keys).alias("key")
    level = docs.select(
        key_struct, F.array().cast("array<string>").alias("path"), F.lit(False).alias("optional"),
        F.try_parse_json("doc").alias("node"),
    )
    catalog = None
    while True:
        shaped = _with_shape(level)
        last = F.element_at("path", -1)
        rows = shaped.select(
            "key.uri", "key.vendor", F.col("key.name").alias("schema_name"), "key.format",
            "key.model", "key.revision", "key.addition", "path",
            F.when(F.size("path") > 0, F.when(last == ARRAY_STEP, last).otherwise(snake(last))).alias("name"),
            "kind", (F.col("optional") | F.col("allows_null")).alias("nullable"), "legal",
        )
        catalog = rows if catalog is None else catalog.unionByName(rows)
        # The outer form, because a filter on ``below`` would be pushed through every projection above
        # and repeat their expressions; a filter on what was exploded stays here.
        children = shaped.select(
            "key", "path", "required_names", "kind", F.explode_outer("below").alias("child", "below_node")
        ).filter(F.col("child").isNotNull())
        level = children.select(
            "key",
            F.concat("path", F.array("child")).alias("path"),
            ((F.col("kind") == "struct") & ~F.array_contains("required_names", F.col("child"))).alias("optional"),
            F.col("below_node").alias("node"),
        ).persist()
        if levels is not None:
            levels.append(level)
        if level.isEmpty():
            return catalog


# Resolving the entities of a batch

class EntityColumn(NamedTuple):
    """One derived column: the entity kind, the versions it takes, their type, the JSON style, and whose column it is."""

    name: str
    entity: str
    uris: tuple[str, ...]
    data_type: T.DataType
    mode: str
    owner: str

    @property
    def field(self) -> T.StructField:
        dtype = self.data_type
        if self.entity == "context":
            dtype = T.ArrayType(dtype, True)
        return T.StructField(self.name, dtype, True)

    @property
    def batch_field(self) -> T.StructField:
        """The field as it takes part in evolution: legacy columns keep no JSON type."""
        return T.StructField(self.name, drop_json(self.field.dataType), True) if self.mode == LEGACY else self.field


class Resolved(NamedTuple):
    """What a batch needs from the registry."""

    columns: tuple[EntityColumn, ...]
    invalid: tuple[str, ...]

    @property
    def uris(self) -> tuple[str, ...]:
        return tuple(sorted({u for c in self.columns for u in c.uris}))

    @property
    def fields(self) -> list[T.StructField]:
        return [column.batch_field for column in self.columns]

    @property
    def owners(self) -> dict[str, str]:
        """Column names with the schema family, version or recovery that each belongs to."""
        return {column.name: column.owner for column in self.columns}


def other_name(column: str, owner: str) -> str:
    """The name of a column whose own name belongs to another schema. It depends on the schema only, not on the order of arrival."""
    return f"{column}_{hashlib.sha256(owner.encode()).hexdigest()[:8]}"


class _Names:
    """Column names by owner; a name once given stays."""

    def __init__(self, owners: Mapping[str, str]):
        self.taken = dict(owners)
        self.given = {owner: column for column, owner in owners.items()}

    def claim(self, column: str, owner: str) -> str:
        if owner not in self.given:
            name = other_name(column, owner) if column in self.taken else column
            self.taken[name], self.given[owner] = owner, name
        return self.given[owner]


def match_registry(versions: DataFrame, registry: DataFrame) -> DataFrame:
    """Entity versions left-joined to the registry; ``found`` tells whether the schema exists.

    Both sides are distinct keys. No broadcast is forced: the planner broadcasts the smaller side
    when its size allows and joins by hash otherwise.
    """
    known = registry.select("uri", F.lit(True).alias("found"))
    return versions.join(known, "uri", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def unresolved(versions: DataFrame, registry: DataFrame) -> DataFrame:
    """Entity versions the registry does not have."""
    return versions.join(registry.select("uri"), "uri", "left_anti")


def wanted_schemas(found: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows that the found entity versions need.

    A legacy column needs its exact version. A v2 column needs every version of its family up to the
    highest one present, so its type does not depend on which older versions a batch happens to hold.
    """
    family = ["vendor", "name", "format", "model"]
    f, r = found.alias("f"), registry.alias("r")
    same = [F.col(f"f.{c}") == F.col(f"r.{c}") for c in family]
    up_to = F.struct("r.revision", "r.addition") <= F.struct("f.revision", "f.addition")
    exact = F.col("f.uri") == F.col("r.uri")
    return r.join(f, [*same, F.when(F.col("f.style") == LEGACY, exact).otherwise(up_to)], "left_semi")


def resolve(versions: DataFrame, registry: DataFrame, skip_schemas=(), legacy_schemas=(),
            legacy_mode: bool = False, owners: Mapping[str, str] | None = None) -> Resolved:
    """Derive the columns of a batch from its entity versions and a compiled registry."""
    styled = with_style(versions, skip_schemas, legacy_schemas, legacy_mode)
    return resolve_matched(match_registry(styled, registry), registry, owners=owners)


def resolve_matched(matched: DataFrame, registry: DataFrame, known: dict[tuple, Resolved] | None = None,
                    owners: Mapping[str, str] | None = None, version: int = 0) -> Resolved:
    """Derive columns from styled versions that were matched with the registry.

    Only versions that the registry holds reach the driver, as column metadata; however many
    unresolved keys the data has does not matter. ``known`` keeps the last result, since
    most batches of a stream hold the same schemas as the one before, in the same ``version`` of the registry. ``owners`` are the columns that
    the table has, with the schemas they belong to.
    """
    found = matched.filter("found")
    entity, vendor, name, model = (F.col(c) for c in ("entity", "vendor", "name", "model"))
    present = found.select(
        "entity", "style", "vendor", "name", "format", "model", "revision", "addition", "uri",
        F.when(F.col("style") == V2, column_name(entity, vendor, name, model)).otherwise(
            legacy_column_name(entity, vendor, name, model, F.col("revision"), F.col("addition"))
        ).alias("column"),
    ).collect()
    batch = (version, frozenset((r["entity"], r["style"], r["uri"]) for r in present))
    if known is not None and batch in known:
        return known[batch]
    schemas = {r["uri"]: r for r in wanted_schemas(found, registry).collect()} if present else {}
    resolved = _columns_of(present, schemas, owners or {})
    if known is not None:
        known.clear()
        known[batch] = resolved
    return resolved


def _columns_of(present: list, schemas: dict, owners: Mapping[str, str]) -> Resolved:
    """Group the schemas of a batch into columns, merging the versions of each family.

    Different schemas may come to the same column name, as names lose case and punctuation. The one that has the column in the table keeps it; among new ones
    legacy versions come first, then the least. Any other gets :func:`other_name`, so no value displaces another.
    """
    invalid = {uri for uri, r in schemas.items() if not r["legal"]}

    def family_of(row) -> tuple:
        return row["vendor"], row["name"], row["format"], row["model"]

    def sub(row) -> tuple:
        return row["revision"], row["addition"]

    series: dict[tuple, list] = {}
    for row in schemas.values():
        series.setdefault(family_of(row), []).append(row)
    families: dict[tuple, dict] = {}
    for row in present:
        own = sub(row) if row["style"] == LEGACY else ()
        members = families.setdefault((row["style"], row["entity"], row["column"], family_of(row), own), {})
        for schema in series.get(family_of(row), []):
            wanted = schema["uri"] == row["uri"] if row["style"] == LEGACY else sub(schema) <= sub(row)
            if wanted and schema["uri"] not in invalid:
                members[(*sub(schema), schema["uri"])] = schema
    names, legacy, main = _Names(owners), [], []
    for (style, kind, column, family, own), members in sorted(families.items(), key=lambda f: (f[0][0] != LEGACY, f[0])):
        trees = {version: build_tree(schema["nodes"]) for version, schema in members.items()}
        owner = f"{kind} {style} " + "/".join([*map(str, family), *map(str, own)])
        if style == LEGACY:
            legacy += [EntityColumn(names.claim(column, owner), kind, (v[2],), legacy_type(t), LEGACY, owner) for v, t in trees.items()]
            continue
        merged, inside, recoveries = merge_series(list(trees.items()))
        if inside:
            column = names.claim(column, owner)
            main.append(EntityColumn(column, kind, tuple(v[2] for v in inside), merged, V2, owner))
        for v, dtype in recoveries:
            recovered = f"{owner} recovered {v[0]}-{v[1]}"
            name = names.claim(f"{column}_recovered_{v[0]}_{v[1]}", recovered)
            main.append(EntityColumn(name, kind, (v[2],), dtype, V2, recovered))
    return Resolved((*main, *legacy), tuple(sorted(invalid)))
