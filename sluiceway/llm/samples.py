"""A bounded sample of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.stage import col, written


def labelled(docs: DataFrame, labels: DataFrame, sample: int, seed: int, id_column: str = "doc_id", text: str = "text", label: str = "label") -> DataFrame:
    """Rows `text`, `label` (0 or 1) of the documents with at most `sample` labels, chosen by a hash of the id; without null texts.

    Labels are drawn before documents are read, so no text is moved. The drawn ones have at most `sample` rows, which bounds the broadcast.
    """
    rows = labels.select(col(id_column).cast("string").alias("_id"), col(label).cast("int").alias("label")).where("_id IS NOT NULL AND label IN (0, 1)")
    order = F.xxhash64("_id", F.lit(seed))
    share = min(1.0, 1.1 * sample / max(1, rows.count()))
    chosen = written(rows.where(F.pmod(order, F.lit(1 << 20)) < share * (1 << 20)).orderBy(order, "label").limit(sample))
    texts = docs.select(col(id_column).cast("string").alias("id"), col(text).cast("string").alias("text")).where("text IS NOT NULL")
    return texts.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("text", "label")
