"""Where event lines come from. Every reader gives ``value`` and, where known, ``source_tstamp``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default bytes of one micro-batch, and shares of the rows of a table for each core.
MAX_BATCH_BYTES = 10_000_000
SHARES = 2


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files, for backfills. Only a newline ends a line."""
    return _lines(spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path))


def _lines(files: DataFrame) -> DataFrame:
    return files.select("value", F.col("_metadata.file_modification_time").alias("source_tstamp"))


def parquet_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines kept in the ``value`` column of Parquet files."""
    return dealt(spark.read.parquet(path).select("value"))


def dealt(rows: DataFrame) -> DataFrame:
    """The rows in equal shares for all cores.

    A compact file has few splits, and a split without the start of a row group has no rows at all, while parsing or casting a
    row costs far more than moving it. No split becomes larger than it was.
    """
    parallelism = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(SHARES * parallelism, rows.rdd.getNumPartitions()))


def text_stream(spark: SparkSession, path: str, max_bytes: int = MAX_BATCH_BYTES,
                since: datetime | None = None) -> DataFrame:
    """Stream of text files in micro-batches of about ``max_bytes``.

    ``since`` leaves out files last changed before that moment; the filter is on file metadata, so
    their content is not read.
    """
    reader = spark.readStream.option("maxBytesPerTrigger", str(max_bytes)).option("lineSep", "\n")
    lines = _lines(reader.text(path))
    return lines if since is None else lines.filter(F.col("source_tstamp") >= F.lit(_utc(since)))


def kafka_options(bootstrap_servers: str, topic: str, start: str | datetime = "earliest",
                  max_offsets: int | None = None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options of the Kafka source. ``start`` is ``earliest``, ``latest`` or a moment."""
    options = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic}
    if isinstance(start, datetime):
        options["startingTimestamp"] = str(int(_utc(start).timestamp() * 1000))
    elif start in ("earliest", "latest"):
        options["startingOffsets"] = start
    else:
        raise ValueError(f"unknown start position: {start!r}")
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options | (extra or {})


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of Kafka records; needs the Spark Kafka package on the class path."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select("value", F.col("timestamp").alias("source_tstamp"))


def since(events: DataFrame, moment: datetime, column: str = "collector_tstamp") -> DataFrame:
    """Start of a backfill by event time."""
    return events.filter(F.col(column) >= F.lit(_utc(moment)))


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)
