"""Substring dedup: every window of `WINDOW` words that also starts elsewhere, by prefix-partitioned suffix trees.

Words are runs of characters other than blanks and the controls 9 to 13, unchanged. Suffixes that can share `WINDOW` words are
grouped by a prefix, and a tree is built for each group; a node at the depth of a window with two suffixes or more below is a repeat.

1. Which suffixes: in each window the 12-word run with the least hash is its anchor (the first of equal ones). Equal windows have their anchors at
   the same place, so suffixes that start at anchors are enough, with the 23 words before an anchor as the way back to the starts of windows.
2. Prefix of all that a window with the anchor may hold (23 words before, 35 from it on): places with the same one share every window. They are
   settled by counting, so exact copies, of which there may be any number, never meet in one group.
3. Prefix of 12 words for what is left: one suffix for each different surrounding. Groups with one suffix have no inner node and are dropped.
   The others become trees, level by level: nodes for the words from the anchor on, and nodes for those before it, backwards. Two places share the
   window that starts `o` words before the anchor if they have the same node at depth `o` backwards and at `WINDOW - o` forwards.
4. A group with more than `GROUP` suffixes does not fit a task's memory by design: its prefix is lengthened to the whole window, for each of the 24
   starts. A group that shares it is one node at full depth, so counting with partial sums settles it.

Steps 2 and 4 compare hashes of 64 bits within equal 12-word hashes, step 3 the words' hashes. Every result is a range of words for a document.
A null text has no words. Texts with fewer than `WINDOW` words have no window. A document is told by a hash (64 bits) of its id, of any type, and its text, so rows
that share an id or have none are told apart, too. Repeated rows repeat each other's windows, so these are removed from both. An empty table gives no rows; a
text of any length is cut into suffixes whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.stage import col, release, written
from sluiceway.llm.text import Words, bounded_batches, minimum_by, mixed, sequence_hashes, slices, space_words

WINDOW = 35
ANCHOR = 12
STARTS = WINDOW - ANCHOR + 1
GROUP = 1 << 16
BATCH = 4096
_RANK_BITS = np.uint64(40)
_BITS = 6


def _surroundings(words: Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word, and number of words, of what windows with the 12 words at `at` may hold."""
    left = words.left()
    place = np.arange(len(words)) - np.repeat(words.first[:-1], words.count)
    first = at - np.minimum(place[at], STARTS - 1)
    return first, at + np.minimum(left[at], WINDOW) - first


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows `key`, `anchor` (hash of 12 words), `around` (hash of the surroundings) and `place`."""
    chars = space_words()
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"), chars)
            left = words.left()
            starts = np.flatnonzero(left >= WINDOW)
            if not len(starts):
                continue
            hashes = words.hashes()
            runs = np.arange(len(words) - ANCHOR + 1)
            grams = sequence_hashes(hashes, runs, np.full(len(runs), ANCHOR))
            ranked = (grams >> _RANK_BITS << _RANK_BITS) | runs.astype(np.uint64)
            least = minimum_by(ranked, STARTS)[starts] & np.uint64((1 << 40) - 1)
            at = np.unique(least).astype(np.int64)
            first, size = _surroundings(words, at)
            around = mixed(sequence_hashes(hashes, first, size, 2) ^ (at - first).astype(np.uint64), 3)
            owner = words.owner()[at]
            place = (((at - words.first[owner]) << _BITS | (at - first)) << _BITS) | size
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(owner)), pa.array(grams[at].view(np.int64)), pa.array(around.view(np.int64)), pa.array(place)],
                names=["key", "anchor", "around", "place"])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words' hashes around each wanted anchor: `back` words, then those from the anchor on."""
    chars = space_words()
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"), chars)
            hashes = words.hashes()
            wanted = batch.column("wanted")
            row = np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
            flat = wanted.flatten()
            place = flat.field("place").to_numpy()
            at = words.first[row] + (place >> 2 * _BITS)
            back, size = (place >> _BITS) & 63, place & 63
            to = np.concatenate([[0], np.cumsum(size)])
            index = np.arange(to[-1]) - np.repeat(to[:-1], size) + np.repeat(at - back, size)
            tokens = pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(hashes[index].view(np.int64)))
            for a in range(0, len(row), 4096):
                part = slice(a, a + 4096)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(row[part])), flat.field("anchor")[part], flat.field("n")[part], flat.field("big")[part],
                     pa.array(place[part]), tokens[part]], names=["key", "anchor", "n", "big", "place", "tokens"])


def _columns(tokens: pa.Array, back: np.ndarray) -> np.ndarray:
    """A row for each suffix with the anchor in column 23; a missing word is like no other."""
    size = np.diff(tokens.offsets.to_numpy())
    flat = tokens.flatten().to_numpy()
    _, flat = np.unique(flat, return_inverse=True)
    n, width = len(size), STARTS - 1 + WINDOW
    out = -1 - np.arange(n * width, dtype=np.int64).reshape(n, width)
    row = np.repeat(np.arange(n), size)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(STARTS - 1 - back, size)
    out[row, column] = flat
    return out


def _below(node: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Nodes of the next level."""
    order = np.lexsort((word, node))
    new = np.ones(len(order), bool)
    new[1:] = (node[order][1:] != node[order][:-1]) | (word[order][1:] != word[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _deep(anchor: np.ndarray, count: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest `o` of the windows, `o` words before the anchor, that a suffix shares with another; -1 without one."""
    _, node = np.unique(anchor, return_inverse=True)
    forwards = {0: node}
    for depth in range(WINDOW):
        node = _below(node, columns[:, STARTS - 1 + depth])
        forwards[depth + 1] = node
    back = np.zeros(len(anchor), np.int64)
    low, high = np.full(len(anchor), -1), np.full(len(anchor), -1)
    for o in range(STARTS):
        if o:
            back = _below(back, columns[:, STARTS - 1 - o])
        shared = _below(back, forwards[WINDOW - o])
        # Surroundings that occur twice are settled by step 2.
        repeated = (np.bincount(shared, weights=count)[shared] >= 2) & (count < 2)
        low[repeated & (low < 0)] = o
        high[repeated] = o
    return low, high


def _ranges(key: pa.Array, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(low >= 0)
    at = place[some] >> 2 * _BITS
    return pa.RecordBatch.from_arrays(
        [key.take(pa.array(some)), pa.array((at - high[some]).astype(np.int64)), pa.array((at - low[some] + WINDOW).astype(np.int64))], names=["key", "start", "end"])


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of the groups, some whole groups at a time. Rows come in order of their anchors."""
    rest: list[pa.RecordBatch] = []
    held = 0

    def done(table: pa.Table) -> Iterator[pa.RecordBatch]:
        batch = table.combine_chunks()
        if batch.num_rows:
            place = batch.column("place").to_numpy()
            tokens = batch.column("tokens").combine_chunks()
            low, high = _deep(batch.column("anchor").to_numpy(), batch.column("n").to_numpy().astype(float), _columns(tokens, (place >> _BITS) & 63))
            yield _ranges(batch.column("key").combine_chunks(), place, low, high)

    for batch in batches:
        rest.append(batch)
        held += batch.num_rows
        if held >= BATCH:
            table = pa.Table.from_batches(rest)
            anchor = table.column("anchor").to_numpy()
            changes = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            cut = int(changes[-1]) if len(changes) else 0
            for a, b in _runs(changes, cut):
                yield from done(table.slice(a, b - a))
            rest = table.slice(cut).combine_chunks().to_batches()
            held = table.num_rows - cut
    if rest:
        yield from done(pa.Table.from_batches(rest))


def _runs(changes: np.ndarray, cut: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups with about BATCH rows."""
    first = 0
    for end in changes.tolist():
        if end <= cut and (end - first >= BATCH or end == cut):
            yield first, end
            first = end


def _whole_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each window around an anchor, with the hash of its words."""
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            place = part.column("place").to_numpy()
            back, size = (place >> _BITS) & 63, place & 63
            tokens = part.column("tokens")
            first = tokens.offsets.to_numpy()[:-1] - tokens.offsets.to_numpy()[0]
            flat = tokens.flatten().to_numpy().view(np.uint64)
            number = np.minimum(back, size - WINDOW) + 1
            number = np.maximum(np.minimum(number, size - WINDOW + 1), 0)
            row = np.repeat(np.arange(part.num_rows), number)
            step = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            # With the anchor's place in it: a window that holds an anchor twice is not its own copy.
            window = mixed(sequence_hashes(flat, first[row] + step, np.full(len(row), WINDOW), 4) ^ (back[row] - step).astype(np.uint64), 4)
            take = pa.array(row)
            start = (place >> 2 * _BITS)[row] - back[row] + step
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(take), part.column("anchor").take(take), pa.array(window.view(np.int64)), part.column("n").take(take), pa.array(start)],
                names=["key", "anchor", "window", "n", "start"])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, and the words outside all ranges with one blank between."""
    chars = space_words()
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"), chars)
            ranges = batch.column("ranges")
            row = np.repeat(np.arange(batch.num_rows), np.diff(ranges.offsets.to_numpy()))
            flat = ranges.flatten()
            marks = np.zeros(len(words) + 1, np.int64)
            for field, step in (("start", 1), ("end", -1)):
                np.add.at(marks, words.first[row] + flat.field(field).to_numpy(), step)
            gone = np.cumsum(marks[:-1]) > 0
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(words.count.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array([x.decode() for x in words.joined_all(~gone)], pa.string())],
                names=["row", "n_words", "n_removed", "kept"])


def repeats(keyed: DataFrame, group: int = GROUP) -> DataFrame:
    """Rows `key`, `start`, `end`: ranges of words that repeated windows cover."""
    spark = keyed.sparkSession
    anchors = written(keyed.mapInArrow(_anchors, "key long, anchor long, around long, place long"))
    classes = anchors.groupBy("anchor", "around").agg(F.count("*").alias("n"), F.min("key").alias("key"), F.min_by("place", "key").alias("place"))
    classes = written(classes)
    release(spark)
    copies = anchors.join(classes.where("n > 1").select("anchor", "around"), ["anchor", "around"])
    at = F.shiftright("place", 2 * _BITS) - F.shiftright("place", _BITS).bitwiseAND(63)
    copies = written(copies.select("key", at.alias("start"), (at + F.col("place").bitwiseAND(63)).alias("end")))
    groups = written(classes.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1"))
    members = classes.join(groups, "anchor").select("key", F.struct("anchor", F.col("n").alias("n"), (F.col("m") > group).alias("big"), "place").alias("w"))
    members = written(members.groupBy("key").agg(F.collect_list("w").alias("wanted")))
    release(spark)
    schema = "key long, anchor long, n long, big boolean, place long, tokens array<long>"
    suffixes = keyed.join(members.withColumnRenamed("key", "_k").hint("shuffle_hash"), F.col("key") == F.col("_k")).select("key", "text", "wanted")
    suffixes = written(suffixes.mapInArrow(_suffixes, schema))
    release(spark)
    trees = suffixes.where("NOT big").repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_trees, "key long, start long, end long")
    windows = suffixes.where("big").mapInArrow(_whole_windows, "key long, anchor long, window long, n long, start long")
    windows = written(windows)
    shared = written(windows.groupBy("anchor", "window").agg(F.sum("n").alias("total")).where("total > 1").select("anchor", "window"))
    long_prefix = windows.join(shared, ["anchor", "window"]).select("key", "start", (F.col("start") + WINDOW).alias("end"))
    return copies.union(trees).union(long_prefix)


def dedup(docs: DataFrame, carry: Column, id_column: str = "doc_id", text: str = "text", group: int = GROUP) -> DataFrame:
    """Rows `row`, `n_words`, `n_removed` and `kept`, the text of the words that stay."""
    spark = docs.sparkSession
    bounded_batches(spark)
    key = F.xxhash64(col(id_column).cast("string"), F.lit(":"), col(text).cast("string")).alias("key")
    keyed = docs.select(key, col(text).cast("string").alias("text"))
    ranges = written(repeats(keyed, group).groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("ranges")))
    release(spark)
    rows = docs.select(carry.alias("row"), key, col(text).cast("string").alias("text"))
    rows = rows.join(ranges.withColumnRenamed("key", "_k").hint("shuffle_hash"), F.col("key") == F.col("_k"), "left")
    rows = rows.select("row", "text", F.coalesce("ranges", F.array().cast("array<struct<start:long,end:long>>")).alias("ranges"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_kept, f"row {kind}, n_words long, n_removed long, kept string")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their text reduced to the words that stay; columns as they were."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    out = dedup(docs, F.struct(*[col(c).alias(n) for c, n in zip(docs.columns, names)]), id_column, text)
    return out.select(*[(F.col("kept") if c == text else F.col("row")[n]).alias(c) for c, n in zip(docs.columns, names)])
