"""Line dedup: content-defined chunks of lines, of which repeated ones are removed after comparing their bytes.

A text's lines are split at each newline. A rolling hash over the hashes of the last `WIDTH` lines starts a chunk
where it is divisible by `DIVISOR`; so the bounds move with the lines when text is put in front of them. A chunk
with at least `least` lines that hold a word is a candidate. Of equal candidates the first (least id, then place) stays, in the
same text too; the others are removed. A null text has no lines and stays null. Rows that share an id and a text (told by
its hash) are taken as one document: a chunk stays or goes in all of them. Texts of one id come in the order of their
hashes, and so do rows without an id, after all others.

Bounds are sparse, so chunks miss most passages of few lines. `remove_repeated`, which the pipeline uses, therefore puts a
window at every line that holds a word: `LEAST_LINES` such lines with what stands between. A window that repeats an earlier one
is removed, so every line of a run of that many lines that occurred before goes, wherever the run begins and ends. Windows that overlap
the first copy in its own text stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.stage import col, packed, written

WIDTH = 2
DIVISOR = 3
LEAST_LINES = 2
_WORD = r"[^ \t-\r]"


def _whole(text: Column) -> Column:
    """Tells texts apart that have the same id, or none."""
    return F.xxhash64(text)


def chunked(docs: DataFrame, id_column: str, text: str, carry: Column) -> DataFrame:
    """Rows `row`, `id`, `whole`, `lines` and `chunks` (start, end: half-open ranges of lines)."""
    staged = docs.select(carry.alias("row"), col(id_column).alias("id"), _whole(col(text)).alias("whole"), F.split(col(text), "\n").alias("lines"))
    bits = lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long")
    staged = staged.withColumn("_h", F.transform("lines", bits))
    after = F.when(F.size("_h") >= WIDTH, F.sequence(F.lit(WIDTH - 1), F.size("_h") - 1)).otherwise(F.array().cast("array<int>"))

    def rolling(i: Column) -> Column:
        value = F.lit(0).cast("long")
        for back in range(WIDTH - 1, -1, -1):
            value = F.pmod(value * 31 + F.get("_h", i - back), F.lit(2**32))
        return value

    staged = staged.withColumn("_b", F.filter(after, lambda i: F.pmod(rolling(i), F.lit(DIVISOR)) == 0))
    starts = F.concat(F.array(F.lit(0)), "_b")
    ends = F.concat("_b", F.array(F.size("lines")))
    chunks = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end")))
    return staged.withColumn("chunks", F.when(F.col("lines").isNotNull(), chunks)).drop("_h", "_b")


def _text_of(chunk: Column) -> Column:
    return F.array_join(F.slice("lines", chunk["start"] + 1, chunk["end"] - chunk["start"]), "\n")


def windows(docs: DataFrame, id_column: str, text: str, carry: Column, least: int = LEAST_LINES) -> DataFrame:
    """As `chunked`, with a chunk from each line that holds a word to the end of the `least`th of them."""
    staged = docs.select(carry.alias("row"), col(id_column).alias("id"), _whole(col(text)).alias("whole"), F.split(col(text), "\n").alias("lines"))
    numbered = F.transform("lines", lambda x, i: F.when(x.rlike(_WORD), i))
    staged = staged.withColumn("_w", F.filter(numbered, lambda i: i.isNotNull()))
    ends = F.slice("_w", least, F.greatest(F.size("_w") - least + 1, F.lit(0)))
    starts = F.slice("_w", 1, F.size(ends))
    chunks = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e + 1).alias("end")))
    return staged.withColumn("chunks", F.when(F.size("_w") >= least, chunks)).drop("_w")


def _gone(cut: DataFrame) -> DataFrame:
    """Rows `id`, `whole`, `start`, `end`: those of the `chunks` that are not the first of their text."""
    texts = F.transform("chunks", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), _text_of(c).alias("chunk")))
    # With explode Spark would add a filter on the size of `chunks` and compute them anew for it, below all projections.
    staged = cut.select("id", "whole", F.explode_outer(texts).alias("c")).where("c IS NOT NULL").select("id", "whole", "c.*")
    staged = staged.withColumn("key", F.xxhash64("chunk"))
    # Keys alone are counted first, with partial sums: most chunks are unique and go no further.
    twice = written(staged.groupBy("key").count().where("count > 1").select("key"))
    found = written(staged.join(twice.hint("merge"), "key", "left_semi"))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "whole", "start", "end")
    # Grouping by the text itself compares the bytes.
    first = written(found.groupBy("key", "chunk").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"))
    same = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("whole") == F.col("first.whole")) & (F.col("start") < F.col("first.end"))
    return found.join(first.select("key", "chunk", "first"), ["key", "chunk"]).where(~same).select("id", "whole", "start", "end")


def repeated(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST_LINES) -> DataFrame:
    """Rows `id`, `whole`, `starts`: the first lines of the chunks to remove from a document."""
    some = chunked(docs, id_column, text, F.lit(0))
    wordy = lambda c: F.size(F.filter(F.slice("lines", c["start"] + 1, c["end"] - c["start"]), lambda x: x.rlike(_WORD))) >= least
    gone = _gone(some.withColumn("chunks", F.filter("chunks", wordy)))
    return gone.groupBy("id", "whole").agg(F.collect_set("start").alias("starts"))


def _with_gone(docs: DataFrame, gone: DataFrame, id_column: str, text: str, carry: Column) -> DataFrame:
    """Rows `row`, `id`, `text` with what `gone` has for the document."""
    joined = docs.select(carry.alias("row"), col(id_column).alias("id"), col(text).alias("text"), _whole(col(text)).alias("whole"))
    gone = gone.withColumnsRenamed({"id": "_id", "whole": "_whole"}).hint("shuffle_hash")
    return joined.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("whole") == F.col("_whole")), "left").drop("_id", "whole", "_whole")


def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST_LINES, carry: Column | None = None) -> DataFrame:
    """Each row with its lines that stay: `row` (the document), `id`, `kept`, `n_lines`, `n_removed`, `n_chunks`."""
    gone = repeated(docs, id_column, text, least)
    joined = _with_gone(docs, gone, id_column, text, packed(docs.columns) if carry is None else carry)
    again = chunked(joined, "id", "text", F.struct("row", "starts")).select("row.*", "id", "lines", "chunks")
    drop = F.coalesce("starts", F.array().cast("array<int>"))
    stay = F.filter("chunks", lambda c: ~F.array_contains(drop, c["start"]))
    again = again.withColumns({"stay": stay, "starts": drop})
    count = F.aggregate("stay", F.lit(0), lambda a, c: a + c["end"] - c["start"])
    total = F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines"))
    return again.select(
        "row", "id", F.array_join(F.transform("stay", _text_of), "\n").alias("kept"), total.cast("long").alias("n_lines"),
        F.when(F.col("lines").isNull(), 0).otherwise(total - count).cast("long").alias("n_removed"), F.size("starts").cast("long").alias("n_chunks"),
    )


def remove_repeated(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without the runs of lines that occurred before, with their own columns."""
    gone = _gone(windows(docs, id_column, text, F.lit(0)))
    gone = gone.groupBy("id", "whole").agg(F.collect_set(F.struct("start", "end")).alias("gone"))
    out = _with_gone(docs, gone, id_column, text, packed(docs.columns)).withColumn("lines", F.split("text", "\n"))
    numbers = F.flatten(F.transform("gone", lambda g: F.sequence(g["start"], g["end"] - 1)))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), numbers)
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    return out.select(*[(kept if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
