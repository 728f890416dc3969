"""Places of rows within ordered groups, of which one may hold most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.stage import written

#: Bits of a row's number within its partition; the partition's number stands above them.
_ROW_BITS = 33


def in_order(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows sorted over all partitions, with `_at`, which grows in that order (with gaps between partitions); to be written.

    Ranges of the keys are dealt out, and equal keys are told apart by where a row was read, so neither a large group nor
    any number of copies of a row has to fit one task. Rows with equal keys may stand in any order.
    """
    spread = frame.withColumn("_spread", F.monotonically_increasing_id())
    order = [F.col(k) for k in (*keys, "_spread")]
    return spread.repartitionByRange(*order).sortWithinPartitions(*order).drop("_spread").withColumn("_at", F.monotonically_increasing_id())


def partition_of(at: str = "_at"):
    return F.shiftright(at, _ROW_BITS)


def numbered(frame: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Adds `rank`, the place of a row in its group from 0. `group` must not be null.

    Each partition counts its own rows of a group; the running sum over these counts has one row for a partition and group.
    """
    rows = written(in_order(frame, [group, *order])).withColumn("_part", partition_of())
    counts = rows.groupBy(group, "_part").agg(F.min("_at").alias("_start"), F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(group, "_part", "_start", F.coalesce(before, F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at") - F.col("_start")
    return rows.join(starts, [group, "_part"]).withColumn("rank", rank).drop("_part", "_start", "_before", "_at")
