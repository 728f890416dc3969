"""Secret scan: fixed patterns, and strings whose characters are close to random.

Patterns give spans of kind assign, access and hex. Besides, every candidate string (a run of characters that tokens are made
of) gets the Shannon entropy of each window of `WINDOW` characters: the counts of the characters in the window follow as it slides
by one, and so does the sum of n * log2(n), kept in whole numbers so that nothing drifts. Each character class has its own
threshold. The stretch from the first to the last window above it is a span of kind entropy, unless the candidate is on
the allow list or the stretch touches a pattern's span.

Thresholds are below what nearly all random strings of 20 characters of a class reach. Left out on purpose are strings of lower-case letters alone, with or without a
capital at the front and hyphens, slashes and underscores between: they are identifiers and long words much more often than secrets.

Positions count code points, the end is exclusive. A null text is empty; a text without a match has no spans, a table without rows gives none. Rows are
independent, so repeated rows give repeated results. Texts are searched whole; the time grows with their length, and with the square of the number of matches in one
text only by a copy of numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.errors import settled
from sluiceway.llm.stage import col

# The patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
SCALE = 1 << 20
#: Character classes in the order in which they are tried: pattern of the whole candidate, least entropy of a window in bits.
CLASSES = (
    ("[0-9]+", 2.6),
    ("[0-9a-fA-F]+", 2.9),
    ("(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).*", 3.6),
    ("(?=.*[0-9])(?=.*[A-Za-z]).*", 3.6),
    ("(?=.*[a-z])(?=.*[A-Z]).*", 3.8),
    (".*", 3.5),
)
#: Candidates that are placeholders or plain identifiers.
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]?(key|token|secret)",
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"(?i)0123456789|abcdefghij",
    r"^[A-Z]?[a-z]+([_/-][A-Z]?[a-z]+)*$",
)


def located(matches: str, gaps: str) -> Column:
    """Start, end and text of each match, from the matches and the texts between them."""
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), F.col(matches), lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(lengths, begin, lambda s, x: F.struct(
        (s["at"] + x["g"] + x["m"]).alias("at"), F.concat(s["starts"], F.array(s["at"] + x["g"])).alias("starts")), lambda s: s["starts"])
    places = F.zip_with(starts, F.col(matches), lambda start, m: F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("match")))
    return F.when(F.size(matches) > 0, places).otherwise(F.array().cast("array<struct<start:int,end:int,match:string>>"))


def _runs(frame: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds the places of all matches as array `name`. Texts without a match are told by one search."""
    found = F.col("_text").rlike(pattern)
    none = F.array().cast("array<string>")
    frame = frame.withColumns({
        "_m": F.when(found, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none),
        "_g": F.when(found, F.split("_text", pattern, -1)).otherwise(none),
    })
    return frame.withColumn(name, located("_m", "_g")).drop("_m", "_g")


def _slid(codes: Column, least: Column) -> Column:
    """First start and last end of the windows that reach `least` (scaled), by counts that follow the window."""
    table = F.array(*[F.lit(round(SCALE * n * math.log2(n)) if n else 0).cast("long") for n in range(WINDOW + 2)])
    part = lambda n: F.get(table, n)
    begin = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).cast("long").alias("total"), F.lit(-1).alias("first"), F.lit(-1).alias("last")
    )

    def slide(state: Column, i: Column) -> Column:
        comes, goes = F.get(codes, i), F.get(codes, i - WINDOW)
        n, m = F.get(state["counts"], comes), F.get(state["counts"], goes)
        other = (i < WINDOW) | (comes == goes)
        total = state["total"] + F.when(other & (i >= WINDOW), F.lit(0)).otherwise(part(n + 1) - part(n)) + F.when(other, F.lit(0)).otherwise(part(m - 1) - part(m))
        put = lambda counts, j, v: F.concat(F.slice(counts, F.lit(1), j), F.array(v), F.slice(counts, j + 2, F.lit(128)))
        more = F.when(other & (i >= WINDOW), state["counts"]).otherwise(put(state["counts"], comes, n + 1))
        counts = F.when(other, more).otherwise(put(more, goes, m - 1))
        # Entropy is log2(WINDOW) - total / WINDOW, so a small total is a high entropy.
        high = (i >= WINDOW - 1) & (total <= least)
        first = F.when(high & (state["first"] < 0), i - WINDOW + 1).otherwise(state["first"])
        return F.struct(counts.alias("counts"), total.alias("total"), first.alias("first"), F.when(high, i + 1).otherwise(state["last"]).alias("last"))

    return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), begin, slide, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _most_total(candidate: Column) -> Column:
    """The largest sum of n * log2(n) that a window of the candidate's class may have."""
    choice = F.lit(-1).cast("long")
    for pattern, bits in reversed(CLASSES):
        most = math.floor(SCALE * WINDOW * (math.log2(WINDOW) - bits))
        choice = F.when(candidate.rlike(f"^{pattern}$"), F.lit(most).cast("long")).otherwise(choice)
    return choice


def scan(docs: DataFrame, carry: Column, text: str = "text") -> DataFrame:
    """Rows `row` and `spans`: start, rank of the kind, end, kind and matched text, in order."""
    frame = docs.select(carry.alias("row"), F.coalesce(col(text), F.lit("")).alias("_text"))
    for name, pattern in (("_assign", ASSIGN), ("_access", ACCESS), ("_hex", HEX), ("_candidate", CANDIDATE)):
        frame = _runs(frame, name, pattern)
    frame = frame.withColumn("_assign", F.filter("_assign", lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= 6))
    kind = lambda name, rank: F.transform(name, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(KINDS[rank]).alias("kind"), x["match"].alias("match")))
    frame = frame.withColumn("_base", F.concat(kind("_assign", 0), kind("_access", 1), kind("_hex", 2)))
    allowed = lambda x: F.array_contains(F.array(*[x.rlike(p) for p in ALLOWED]), True)
    wanted = F.filter("_candidate", lambda x: ~allowed(x["match"]))
    coded = F.transform(wanted, lambda x: F.struct(
        x["start"].alias("start"), x["match"].alias("match"), _most_total(x["match"]).alias("most"),
        F.transform(F.split(x["match"], ""), lambda c: F.ascii(c)).alias("codes")))
    frame = frame.withColumn("_coded", coded)
    frame = frame.withColumn("_slid", F.transform("_coded", lambda x: F.struct(x["start"].alias("at"), x["match"].alias("match"), _slid(x["codes"], x["most"]).alias("s"))))
    high = F.transform(F.filter("_slid", lambda x: x["s"]["first"] >= 0), lambda x: F.struct(
        (x["at"] + x["s"]["first"]).alias("start"), F.lit(3).alias("rank"), (x["at"] + x["s"]["last"]).alias("end"), F.lit(KINDS[3]).alias("kind"),
        F.substring(x["match"], x["s"]["first"] + 1, x["s"]["last"] - x["s"]["first"]).alias("match")))
    frame = frame.withColumn("_high", high)
    apart = F.filter("_high", lambda x: ~F.exists("_base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return settled(frame.select("row", F.sort_array(F.concat("_base", apart)).alias("spans")))


def listed(spans: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
