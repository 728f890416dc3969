"""The numbered queries: each applies its operator to the whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import (
    conversation_repair, decontamination, language_id, line_dedup, manifest, mixing, near_dedup, quality_classifier, quality_rules, secrets, substring_dedup, toxicity, vector_search,
)
from sluiceway.llm.oracles import ORACLES
from sluiceway.llm.stage import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = line_dedup.dedup(docs, carry=F.lit(0))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", "n_chunks", _sha(F.col("kept")).alias("kept_sha256"))


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontamination.scan(docs, items, F.struct("doc_id"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        _sha(F.array_join("items", ",")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def substring_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup(_table(spark, sf_dir, "documents"), F.struct("doc_id"))
    return out.select("row.doc_id", "n_words", "n_removed", _sha(F.col("kept")).alias("kept_sha256"))


def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.row_classes(_table(spark, sf_dir, "documents"), F.struct("doc_id"))
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(False))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept"))


def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = written(mixing.sized(_table(spark, sf_dir, "documents"), F.struct("doc_id")))
    return mixing.assigned(sizes).select("row.doc_id", "size", "source_size", "target", "taken")


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"), F.struct("doc_id"))
    base = F.filter("spans", lambda x: x["rank"] < 3)
    count = lambda rank: F.size(F.filter("spans", lambda x: x["rank"] == rank)).cast("long")
    return found.select(
        "row.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        _sha(secrets.listed(base)).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


def _turn(parts: int) -> Column:
    """The remainder by which ids are dealt into folds."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(_turn(4) != 2))
    found = language_id.identify(docs, model, F.struct("doc_id", (_turn(4) == 2).alias("held_out")))
    return found.select("row.doc_id", "row.held_out", F.col("language").alias("lang_pred"), "score", "rejected")


def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    lexicon = toxicity.fit(docs, _table(spark, sf_dir, "labels").where(_turn(3) != 1), label="toxic")
    found = toxicity.score(docs, lexicon, F.struct("doc_id", (_turn(3) == 1).alias("held_out")))
    return found.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def quality_classifier_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, _table(spark, sf_dir, "labels").where(_turn(5) != 0), label="quality")
    found = quality_classifier.score(docs, model, F.struct("doc_id", (_turn(5) == 0).alias("held_out")))
    return found.select("row.doc_id", "row.held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def quality_rules_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.measured(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", quality_rules.base_failed().alias("base_failed"),
        (~quality_rules.base_failed() & quality_rules.verdict()).alias("kept"),
    )


def vector_search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_search.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), F.col("distance").alias("score"))


def conversation_repair_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    report = conversation_repair.repair(conversation_repair.damaged(rows)).report
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    found = ids.join(report, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        F.col("_id").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", _sha(F.lit(""))).alias("repaired_sha256"))


def manifest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    other = manifest.leaf([lowered if f == "text" else F.col(f) for f in manifest.FIELDS])
    out = manifest.manifest(docs, chosen, other)
    return out.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_QUERIES = {
    "op1_line_dedup": line_dedup_query,
    "op2_decontamination": decontamination_query,
    "op3_substring_dedup": substring_dedup_query,
    "op4_minhash_near_dedup": near_dedup_query,
    "op5_mixing": mixing_query,
    "op6_language_id": language_id_query,
    "op7_secret_scan": secrets_query,
    "op8_toxicity": toxicity_query,
    "op9_quality_classifier": quality_classifier_query,
    "op10_quality_rules": quality_rules_query,
    "op11_vector_search": vector_search_query,
    "op12_conversation_repair": conversation_repair_query,
    "op13_merkle_manifest": manifest_query,
}


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def corpus_oracles() -> dict[str, str]:
    return {name: sql for name, sql in ORACLES.items() if name in _QUERIES}
