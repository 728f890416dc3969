"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Words are runs of characters other than blanks and the controls 9 to 13. Every measure is a built-in
expression over the text; `verdict` turns `RULES` into one boolean. A null text has no words, so all counts are
0 and it fails `n_words`; a ratio without a denominator is 0. Every row gives one row, repeated rows too, and an empty table none; a text of any length is measured whole, in
time that grows with its length (windows that repeat are sorted). A filter on the measures stays above them, as it would else be worked out anew for each use.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.errors import settled
from sluiceway.llm.stage import col, packed

BLANKS = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"
# Frequent function words of the four languages.
STOP_WORDS = (
    "the", "and", "of", "to", "in", "is", "that", "it", "for", "was", "with", "as", "on", "be", "at", "by", "this", "are", "from", "or",
    "der", "die", "das", "und", "ist", "nicht", "von", "zu", "mit", "den", "dem", "ein", "eine", "auf", "im", "sich", "des",
    "le", "la", "les", "de", "des", "et", "un", "une", "est", "en", "que", "du", "pour", "dans", "au", "par", "sur",
    "el", "los", "las", "y", "que", "del", "se", "por", "para", "con", "no", "una", "es",
)
#: Name, measure, least and most allowed value (None: open). Loose on purpose: clean prose passes every one.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("words", "n_words", 50, None),
    ("repeated words", "100 * n_repeat_words / n_words", None, 50),
    ("mean word length", "word_chars / n_words", 1.5, 20),
    ("symbols a word", "n_symbols / n_words", None, 0.25),
    ("exclamations a word", "n_exclaims / n_words", None, 0.5),
    ("repeated lines", "n_dup_lines / n_lines", None, 0.6),
    ("stop words", "n_stop_words / n_words", 0.01, None),
)


def measured(docs: DataFrame, text: str = "text", keep: Iterable[str] | None = None) -> DataFrame:
    """The documents (or their columns `keep`) in a struct `row`, with the measures beside it."""
    columns = docs.columns if keep is None else list(keep)
    # Names of our own only, so that a column of the documents may have any name.
    staged = docs.select(
        packed(columns).alias("row"), F.coalesce(col(text), F.lit("")).alias("_text")
    )
    words = F.array_remove(F.split("_text", BLANKS), "")
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    staged = staged.withColumns({"_words": words, "_lines": lines})
    size = F.size("_words")
    at = lambda i: F.get("_words", i)
    starts = F.when(size >= 3, F.sequence(F.lit(0), size - 3)).otherwise(F.array().cast("array<int>"))
    staged = staged.withColumn("_keys", F.transform(starts, lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2))))
    # Equal windows have equal keys, so texts without an equal pair of keys (most) need no sorting.
    twice = F.size(F.array_distinct("_keys")) < F.size("_keys")
    keyed = F.transform(starts, lambda i: F.struct(F.get("_keys", i).alias("k"), i.alias("i")))
    staged = staged.withColumn("_sorted", F.when(twice, F.sort_array(keyed)))
    return settled(staged.select(
        "row",
        size.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("!")).cast("long").alias("n_exclaims"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
    ))


def _covered() -> Column:
    """Words in windows that equal a neighbour in the order of their keys; the words themselves are compared too."""
    at = lambda k: F.get("_sorted", k)
    word = lambda k, n: F.get("_words", at(k)["i"] + n)
    last = F.size("_sorted") - 1
    equal = lambda a, b: (at(a)["k"] == at(b)["k"]) & (word(a, 0) == word(b, 0)) & (word(a, 1) == word(b, 1)) & (word(a, 2) == word(b, 2))
    same = lambda k: F.when(k > 0, equal(k, k - 1)).otherwise(False) | F.when(k < last, equal(k, k + 1)).otherwise(False)
    repeated = F.transform(F.filter(F.sequence(F.lit(0), last), same), lambda k: at(k)["i"])
    spread = F.flatten(F.transform(repeated, lambda i: F.array(i, i + 1, i + 2)))
    return F.when(F.col("_sorted").isNotNull(), F.size(F.array_distinct(spread)))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdict(rules: Iterable[tuple[str, str, float | None, float | None]] = RULES) -> Column:
    """True where every measure is within its bounds."""
    passed = F.lit(True)
    for _, measure, least, most in rules:
        value = F.coalesce(F.try_divide(*[F.expr(x) for x in measure.rsplit(" / ", 1)]) if " / " in measure else F.expr(measure), F.lit(0))
        if least is not None:
            passed = passed & (value >= least)
        if most is not None:
            passed = passed & (value <= most)
    return passed


def filter_documents(docs: DataFrame, text: str = "text", rules: Iterable = RULES) -> DataFrame:
    """The documents that pass the base rules and the table, with their own columns."""
    return measured(docs, text).where(~base_failed() & verdict(rules)).select("row.*")
