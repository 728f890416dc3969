"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.stage import written


def components(links: DataFrame) -> DataFrame:
    """Rows `node`, `least`: the smallest node that links `a`, `b` reach, for each node of a link.

    Each round every node takes the neighbour (or itself) that comes first in an order that is random anew in each round,
    and links are drawn between what their ends took. A constant share of the nodes goes in each round, so the number of
    rounds grows with the logarithm of the largest component. A node with any number of links is one row of a
    partial aggregate.
    """
    edges = written(links.select("a", "b").where("a <> b").distinct())
    labels, turn = None, 0
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.xxhash64(F.lit(turn), c)  # noqa: E731, B023
        took = both.groupBy("a").agg(F.min_by("b", rank(F.col("b"))).alias("b"))
        took = took.select(F.col("a").alias("node"), F.when(rank(F.col("b")) < rank(F.col("a")), F.col("b")).otherwise(F.col("a")).alias("to"))
        took = written(took)
        if labels is None:
            labels = took.withColumnRenamed("to", "label")
        else:
            labels = labels.join(took, F.col("label") == took["node"], "left").select(labels["node"], F.coalesce("to", "label").alias("label"))
        labels = written(labels)
        ends = edges.join(took, F.col("a") == F.col("node")).select(F.col("to").alias("a"), "b")
        ends = ends.join(took, F.col("b") == F.col("node")).select("a", F.col("to").alias("b")).where("a <> b")
        edges = written(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        turn += 1
        if edges.isEmpty():
            break
    least = written(labels.groupBy("label").agg(F.min("node").alias("least")))
    return labels.join(least, "label").select("node", F.least("node", "least").alias("least"))
