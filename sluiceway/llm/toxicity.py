"""Toxicity: a learned lexicon as a trie, met by Levenshtein automata, and scores from the window around each hit.

Lexicon: words of labelled documents, counted in both classes over the whole sample. A word, or a beginning of at least `STEM` letters that several words
share, enters if at least `SUPPORT` toxic documents have it, it is `ODDS` times as frequent in them as in others, and that many would not have it by chance: the likelihood
ratio against equal shares must pay for as many trials as there are words. So the lexicon is bounded by what the sample proves, not by a number. Copies and near copies
are one class, which counts once, with the label that most of its documents have (toxic if equally many). Near copies are found by `MINIMA` minima over a document's words: those that agree in
a band of them are compared with the first of the band, and are of its class if they agree in `ALIKE` of all minima. A term weighs the logarithm of its odds.

Hits: a document's words are run through the trie with the automaton of the word: a row of edit distances follows each branch and ends it
when all are above the bound (1 for terms of five letters or more, else 0). A stem is met by a word's beginning. Two filters stand before the walk. Tables of codes
of three letters (code points, not bytes) rule out most words: with one edit, the term's first three letters, or the three after them moved by
one place at most, are in the word. Codes are hashed into the tables, so a word may pass for nothing but is never missed. What is left must share a form with a
term, where the forms of a word are itself and what remains without one of its letters: two words within one edit always share one.

Context: a hit counts as quoted if marks of quotation stand on both sides within `REACH` words, or a word of reporting stands before it.
Exact, misspelled and quoted hits, their share of the words and the sum of their weights go into a logistic score that is fitted on the sample.

A text without words, or null, has no hits, and the score of that. Without labels of both classes nothing is learned and every score is 0. Repeated rows score alike, empty tables give no rows, texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import components
from sluiceway.llm.samples import labelled
from sluiceway.llm.stage import col, written
from sluiceway.llm.text import Words, bounded_batches, letter_words, lower_ascii, mixed, slices

SAMPLE = 24_000
SUPPORT = 6
STEM = 4
STEM_WORDS = 4
STEM_LENGTHS = (4, 5, 6, 7, 8)
ODDS = 20.0
MINIMA = 64
BAND = 8
ALIKE = 54
PROOF = 3.0
REACH = 8
FUZZY_LETTERS = 5
_MEMO = 200_000
_SPREAD, _NO_LETTER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0)
# Marks of quotation and words of reporting.
OPENING = ('"', "“", "„", "«", "‘")
CLOSING = ('"', "”", "“", "»", "’")
REPORTING = ("said", "says", "called", "wrote", "quote", "quoted", "word", "term", "sagte", "nannte", "dit", "appelé", "dijo", "llamó")


class Trie:
    """Terms by their letters, with their weights; a term that ends in * is a stem."""

    def __init__(self, terms: dict[str, float]):
        self.root: dict = {}
        for term, weight in terms.items():
            node = self.root
            for letter in term.removesuffix("*"):
                node = node.setdefault(letter, {})
            node["stem" if term.endswith("*") else "word"] = (weight, len(term.removesuffix("*")))

    def met(self, word: str) -> tuple[int, float] | None:
        """Edits (0 or 1) and weight of the heaviest term that the word, or its beginning, is."""
        node, best = self.root, 0.0
        for letter in word:
            node = node.get(letter)
            if node is None:
                break
            best = max(best, node.get("stem", (0.0,))[0])
        else:
            best = max(best, node.get("word", (0.0,))[0])
        if best:
            return 0, best
        best = self._near(self.root, word, list(range(len(word) + 1)))
        return (1, best) if best else None

    def _near(self, node: dict, word: str, row: list[int]) -> float:
        """Weight of a term below with enough letters and within one edit; `row` has the distances to the word's beginnings."""
        best = 0.0
        for letter, child in node.items():
            if len(letter) > 1:
                continue
            new = [row[0] + 1]
            for i in range(1, len(row)):
                new.append(min(new[i - 1] + 1, row[i] + 1, row[i - 1] + (word[i - 1] != letter)))
            if min(new) > 1:
                continue
            weight, letters = child.get("word", (0.0, 0))
            if letters >= FUZZY_LETTERS and new[-1] <= 1:
                best = max(best, weight)
            weight, letters = child.get("stem", (0.0, 0))
            if letters > FUZZY_LETTERS:
                best = max(best, weight)
            best = max(best, self._near(child, word, new))
        return best


def _forms(word: str) -> list[str]:
    return [word, *[word[:i] + word[i + 1 :] for i in range(len(word))]]


def _letters(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters of all texts, each as the number that its bytes make, and where each word starts and ends among them."""
    data = np.concatenate([words.data, np.zeros(4, np.uint8)])
    opens = (data & 0xC0) != 0x80
    first = np.flatnonzero(opens)
    letters = data[first].astype(np.uint64)
    wide = np.flatnonzero(letters >= 0xC0)
    size = np.diff(first, append=len(data))[wide]
    for i in range(1, 4):
        more = wide[size > i]
        letters[more] = letters[more] << np.uint64(8) | data[first[more] + i].astype(np.uint64)
    before = np.concatenate([[0], np.cumsum(opens)])
    return letters, before[words.start], before[words.end]


def _slots(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return mixed((a * _SPREAD + b) * _SPREAD + c, 9) >> np.uint64(40)


class Lexicon:
    """Terms, the tables that rule words out, and the weights of the score."""

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.trie = Trie(self.terms)
        self.head, self.rest = np.zeros(1 << 24, bool), np.zeros(1 << 24, bool)
        self.weights = np.zeros(6)
        self.memo: dict[bytes, tuple[int, float] | None] = {}
        #: Words and stems, and the forms of those that may be misspelled; lengths of the stems among these.
        self.words, self.stems, self.forms, self.stem_forms = set(), set(), set(), set()
        for term in self.terms:
            letters = term.removesuffix("*")
            (self.stems if term.endswith("*") else self.words).add(letters)
            if not term.endswith("*") and len(letters) >= FUZZY_LETTERS:
                self.forms.update(_forms(letters))
            elif term.endswith("*") and len(letters) > FUZZY_LETTERS:
                self.stem_forms.update(_forms(letters))
        self.stem_lengths = sorted({len(x) for x in self.stems})
        self.near_lengths = sorted({n + d for n in self.stem_lengths if n > FUZZY_LETTERS for d in (-1, 0, 1)})
        for term in self.terms:
            letters = term.removesuffix("*")
            if term.endswith("*") and len(letters) < 3:
                self.head[:] = True
            self.head[self._slot(letters[:3])] = True
            if len(letters) >= FUZZY_LETTERS:
                self.rest[self._slot(letters[3:6])] = True
        self.reporting = {w.encode() for w in REPORTING}

    def __getstate__(self) -> dict:
        return {"terms": self.terms, "weights": self.weights}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["terms"])
        self.weights = state["weights"]

    def may_meet(self, word: str) -> bool:
        """Whether the word can be a term, or begin with a stem, with at most one edit. Never False for one that is."""
        if word in self.words or any(word[:n] in self.stems for n in self.stem_lengths):
            return True
        if not self.forms.isdisjoint(_forms(word)):
            return True
        return any(not self.stem_forms.isdisjoint(_forms(word[:n])) for n in self.near_lengths if len(word) >= n)

    @staticmethod
    def _slot(letters: str) -> int:
        """Place of up to three letters in the tables."""
        codes = [int.from_bytes(x.encode(), "big") for x in letters] + [0] * (3 - len(letters))
        return int(_slots(*(np.array([x], np.uint64) for x in codes))[0])

    def _likely(self, words: Words) -> np.ndarray:
        letters, start, end = _letters(words)

        def code(shift: int) -> np.ndarray:
            at = start + shift
            return _slots(*(np.where(at + i < end, letters[np.minimum(at + i, len(letters) - 1)], _NO_LETTER) for i in range(3)))

        return np.flatnonzero(self.head[code(0)] | self.rest[code(2)] | self.rest[code(3)] | self.rest[code(4)])

    def features(self, words: Words) -> np.ndarray:
        """For each text: exact, misspelled and quoted hits, share of hits, weight of hits, and 1."""
        n = len(words.count)
        out = np.zeros((n, 6))
        out[:, 5] = 1
        likely = self._likely(words)
        if len(likely):
            row = np.searchsorted(words.first, likely, "right") - 1
            raw = words.data.tobytes()
            for i, k in zip(likely.tolist(), row.tolist()):
                word = raw[words.start[i] : words.end[i]]
                if word in self.memo:
                    found = self.memo[word]
                else:
                    if len(self.memo) >= _MEMO:
                        self.memo.clear()
                    letters = word.decode(errors="replace")
                    found = self.memo[word] = self.trie.met(letters) if self.may_meet(letters) else None
                if found is not None:
                    edits, weight = found
                    quoted = self._quoted(words, raw, i, k)
                    out[k, 2 if quoted else edits] += 1
                    out[k, 4] += 0 if quoted else weight / (1 + edits)
        hits = out[:, :3].sum(1)
        out[:, 3] = 100 * hits / np.maximum(words.count, 1)
        out[:, :5] = np.log1p(out[:, :5])
        return out

    def _quoted(self, words: Words, raw: bytes, i: int, k: int) -> bool:
        first, last = max(int(words.first[k]), i - REACH), min(int(words.first[k + 1]) - 1, i + REACH)
        before = raw[words.start[first] : words.start[i]].decode(errors="replace")
        after = raw[words.end[i] : words.end[last]].decode(errors="replace") if last > i else raw[words.end[i] : words.end[i] + 4].decode(errors="replace")
        if any(o in before and c in after for o, c in zip(OPENING, CLOSING)):
            return True
        return any(raw[words.start[j] : words.end[j]] in self.reporting for j in range(max(first, i - 3), i))

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.terms:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -50, 50)))


def _features(batches: Iterator[pa.RecordBatch], lexicon: Lexicon) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    chars, fold = letter_words(), lower_ascii()
    for whole in batches:
        for batch in slices(whole, "text"):
            yield batch, lexicon.features(Words(batch.column("text"), chars, fold))


def _minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least hashes of each document's words under `MINIMA` orders; empty without words."""
    chars, fold = letter_words(), lower_ascii()
    masks = mixed(np.arange(MINIMA, dtype=np.uint64), 11)
    factors = mixed(np.arange(MINIMA, dtype=np.uint64), 12) | np.uint64(1)
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"), chars, fold)
            some = np.flatnonzero(words.count)
            found = np.zeros((len(some), MINIMA), np.uint64)
            hashes = words.hashes()
            for m in range(MINIMA if len(some) else 0):
                found[:, m] = np.minimum.reduceat(mixed((hashes ^ masks[m]) * factors[m], m), words.first[some])
            at = np.concatenate([[0], np.cumsum(np.where(words.count > 0, MINIMA, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(pa.array(at), pa.array(found.ravel().view(np.int64)))], names=["key", "minima"])


def _classed(sample: DataFrame) -> DataFrame:
    """`label`, `words`: one row for each class of copies and near copies of the sample. The sample bounds all of it."""
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = sample.select("label", "text", F.sort_array(F.array_distinct(F.regexp_extract_all(folded, F.lit(r"[0-9a-z[^\x00-\x7F]]+"), F.lit(0)))).alias("words"))
    # True copies have the whole set of words in common. The keys are hashes, so their order is the same in every run.
    same = words.groupBy(F.xxhash64("words").alias("key")).agg(
        F.sum("label").alias("toxic"), F.count("*").alias("n"), F.min("words").alias("words"), F.min("text").alias("text"))
    same = written(same)
    signed = written(same.select("key", "text").mapInArrow(_minima, "key long, minima array<long>").where("size(minima) > 0"))
    bands = F.transform(F.sequence(F.lit(0), F.lit(MINIMA // BAND - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(F.slice("minima", b * BAND + 1, F.lit(BAND))).alias("value")))
    posted = signed.select("key", "minima", F.explode(bands).alias("b"))
    first = posted.groupBy("b").agg(F.min_by("key", "key").alias("first"), F.min_by("minima", "key").alias("other"), F.count("*").alias("n")).where("n > 1").drop("n")
    agree = F.size(F.filter(F.zip_with("minima", "other", lambda x, y: x == y), lambda e: e))
    links = posted.join(first, "b").where("key <> first").where(agree >= ALIKE).select(F.col("key").alias("a"), F.col("first").alias("b")).distinct()
    reached = components(links)
    classed = same.join(reached, F.col("key") == F.col("node"), "left").withColumn("class", F.coalesce("least", "key"))
    one = classed.groupBy("class").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"), F.min_by("words", "key").alias("words"))
    return written(one.select((2 * F.col("toxic") >= F.col("n")).cast("int").alias("label"), "words"))


def _proof(toxic: Column, clean: Column, share: float) -> Column:
    """Logarithm of how much likelier the counts are under their own share of toxic documents than under the sample's."""
    n = toxic + clean
    part = lambda x, p: F.when(x > 0, x * F.log(x / (n * p))).otherwise(0.0)
    return part(toxic, F.lit(share)) + part(clean, F.lit(1 - share))


def _terms(sample: DataFrame) -> dict[str, float]:
    """Words and stems that toxic documents have and others do not, with their weights."""
    words = _classed(sample)
    total = {r.label: r["count"] for r in words.groupBy("label").count().collect()}
    if len(total) < 2:
        return {}
    share = total[1] / (total[0] + total[1])
    one = words.select("label", F.explode("words").alias("term")).groupBy("term").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    one = written(one.where("length(term) >= 3"))
    trials = float(np.log(max(1, one.where(F.col("toxic") >= SUPPORT).count()))) + PROOF
    stems = one.select(F.explode(F.array(*[F.when(F.length("term") >= n, F.substring("term", 1, n)) for n in STEM_LENGTHS])).alias("stem"), "toxic", "clean")
    stems = stems.where("stem IS NOT NULL").groupBy("stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum((F.col("toxic") > 0).cast("int")).alias("n"))
    odds = (F.col("toxic") + 0.5) / total[1] / ((F.col("clean") + 0.5) / total[0])
    good = (F.col("toxic") >= SUPPORT) & (odds >= ODDS) & (_proof(F.col("toxic"), F.col("clean"), share) >= trials)
    stems = stems.where(good & (F.col("n") >= STEM_WORDS) & (F.col("toxic") >= 2 * SUPPORT))
    both = stems.select(F.concat("stem", F.lit("*")).alias("term"), odds.alias("odds")).union(one.where(good).select("term", odds.alias("odds")))
    return {r.term: round(float(np.log(r.odds)), 6) for r in both.collect()}


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **columns: str) -> Lexicon:
    """`labels` has only rows to learn from, of which at most `sample` by a hash of the id; rows without text or label are left out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    chosen = written(labelled(docs, labels, sample, 7, **columns))
    lexicon = Lexicon(_terms(chosen))
    if not lexicon.terms:
        return lexicon
    shared = spark.sparkContext.broadcast(lexicon)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _features(batches, shared.value):
            yield pa.RecordBatch.from_arrays([batch.column("label"), *[pa.array(found[:, i]) for i in range(6)]], names=["label", *[f"f{i}" for i in range(6)]])

    got = chosen.mapInArrow(measured, "label int, " + ", ".join(f"f{i} double" for i in range(6))).collect()
    lexicon.weights = _logistic(np.array([list(r)[1:] for r in got]), np.array([r.label for r in got]))
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Newton steps; both classes weigh the same."""
    weights = np.zeros(x.shape[1])
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    weigh = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (weigh * (chance - y)) + penalty * weights
        bend = (x * (weigh * chance * (1 - chance))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        weights = weights - np.linalg.solve(bend, slope)
    return weights


def score(docs: DataFrame, lexicon: Lexicon, carry: Column, text: str = "text") -> DataFrame:
    """Rows `row` and `score`."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(lexicon)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in _features(batches, shared.value):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(shared.value.scores(found))], names=["row", "score"])

    rows = docs.select(carry.alias("row"), col(text).cast("string").alias("text"))
    return rows.mapInArrow(scored, f"row {rows.schema['row'].dataType.simpleString()}, score double")
