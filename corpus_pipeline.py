"""From raw documents to a training mix: the stages in order, each a function of the documents that its predecessor kept.

Every stage's result is written to the shared folder and read again, so a stage does not depend on executors that held the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm import decontamination, line_dedup, mixing, near_dedup, quality_rules
from sluiceway.llm.stage import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go from the texts."""
    return line_dedup.remove_repeated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark go, and documents that mostly consist of them."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, as often as the mix takes them."""
    return mixing.training_order(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near dedup", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
]

#: The near-duplicate stage and the order of training need more than one statement of SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
