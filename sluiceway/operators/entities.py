"""Which entities a batch holds, and how criteria split them between column styles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.keys import key_columns, matches_any

ENTITY_KEY = ("entity", "uri", "vendor", "name", "format", "model", "revision", "addition")


def entity_occurrences(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row per entity of a good event, with its kind and schema URI; contexts in event order."""
    unstruct = F.array(F.struct(
        F.lit("unstruct").alias("entity"), F.col("unstruct_entity.schema").alias("uri")
    ))
    contexts = F.transform("context_entities", lambda e: F.struct(
        F.lit("context").alias("entity"), e["schema"].alias("uri")
    ))
    found = F.when(F.size("parse_errors") == 0, F.concat(unstruct, contexts))
    # The outer form, so that no filter on the array is pushed into the parse and repeats it.
    exploded = parsed.select(*keep, F.posexplode_outer(found).alias("position", "found"))
    return exploded.filter(F.col("found.uri").isNotNull()).select(*keep, "position", "found.*")


def entity_versions(parsed: DataFrame) -> DataFrame:
    """Distinct entity versions of the good events of a batch, with the number of occurrences.

    Aggregated as one row per version, not as a set per family: partial aggregation runs before the
    exchange, so a hot schema costs one row per task and no group grows with the data.
    """
    counted = entity_occurrences(parsed).groupBy("entity", "uri").agg(F.count("*").alias("occurrences"))
    return counted.select("entity", "uri", *[
        c.alias(n) for n, c in key_columns(F.col("uri")).items()
    ], "occurrences")


def is_legacy(uri: Column, legacy_schemas=(), legacy_mode: bool = False) -> Column:
    """Schemas loaded in legacy style, one column per full version."""
    return F.lit(True) if legacy_mode else matches_any(uri, legacy_schemas)


def is_skipped(uri: Column, skip_schemas=(), legacy_schemas=(), legacy_mode: bool = False) -> Column:
    """Schemas that get no column. Skipping applies to the main style only, never to legacy columns."""
    return matches_any(uri, skip_schemas) & ~is_legacy(uri, legacy_schemas, legacy_mode)


def with_style(versions: DataFrame, skip_schemas=(), legacy_schemas=(), legacy_mode: bool = False) -> DataFrame:
    """Drop skipped versions and tag the others ``v2`` or ``legacy``."""
    uri = F.col("uri")
    return versions.filter(~is_skipped(uri, skip_schemas, legacy_schemas, legacy_mode)).withColumn(
        "style", F.when(is_legacy(uri, legacy_schemas, legacy_mode), F.lit("legacy")).otherwise(F.lit("v2"))
    )
