"""Failed events: one record shape for every stage, serialised under a size cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions import errors as E
from sluiceway.operators.transform import failures

# Fixed value: bytes a failed event may have before a size violation replaces it.
MAX_RECORD_BYTES = 1_000_000
SIZE_PREVIEW_CHARS = 1_000


def processor(name: str, version: str) -> Column:
    return F.struct(F.lit(name).alias("artifact"), F.lit(version).alias("version"))


def failed_events(transformed: DataFrame, stamp: Column, *keep: str) -> DataFrame:
    """Failed events of all stages, stamped with the processor that rejected them."""
    return failures(transformed, *keep).select(
        *keep,
        F.col("failure.kind").alias("kind"),
        stamp.alias("processor"),
        F.col("failure.errors").alias("errors"),
        F.col("payload"),
    )


def serialised(failed: DataFrame, max_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """One JSON ``value`` per failed event.

    A record above the cap is replaced by a size violation that states both sizes, the original
    kind and a key and shows the start of the payload; ``oversized`` holds the whole event then, with its reasons and the same key, to be kept beside it.
    """
    record = failed.select(
        F.col("kind"), "processor", "payload", "errors",
        F.to_json(F.struct("kind", "processor", "errors", "payload")).alias("json_"),
    )

    key = F.sha2(F.col("json_").cast("binary"), 256)

    def violation(chars: int) -> Column:
        return F.to_json(F.struct(
            F.lit(E.SIZE).alias("kind"),
            F.col("processor"),
            F.struct(
                F.lit(max_bytes).alias("maximum_bytes"),
                F.octet_length("json_").alias("actual_bytes"),
                F.col("kind").alias("original_kind"),
                key.alias("key"),
            ).alias("failure"),
            F.substring("payload", 1, chars).alias("payload"),
        ))

    preview = min(SIZE_PREVIEW_CHARS, max(max_bytes // 10, 0))
    return record.select(
        F.when(F.octet_length("json_") > max_bytes, violation(preview)).otherwise(F.col("json_")).alias("value"),
        F.when(F.octet_length("json_") > max_bytes, F.lit(E.SIZE)).otherwise(F.col("kind")).alias("kind"),
        F.when(F.octet_length("json_") > max_bytes, F.struct(key.alias("key"), "kind", "errors", "payload")).alias("oversized"),
    )
