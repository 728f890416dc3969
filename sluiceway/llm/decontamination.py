"""Benchmark decontamination: windows of words of test items, looked up in every window of the documents.

Words are lower-cased (A to Z) runs of digits, a to z and characters beyond ASCII. A window is `n` consecutive words of an item; an
item with fewer words, but not none, is one window. The windows are cut into blocks of bounded size, and one block
at a time is broadcast as a sorted array of hashes with the windows' words. Workers hash every window of a document,
look it up, and compare the words of what they find. With one block, the usual case, that is a single pass without
a shuffle; with more, each pass adds to the hits of the one before, and its rows are written to the shared folder.

A null text and one without words have no hits. An item without words has no windows. Documents are independent rows, so repeated
rows and null ids stay as they are. Without documents or items the result is empty or without hits.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.stage import col, written
from sluiceway.llm.text import Words, bounded_batches, letter_words, lower_ascii, sequence_hashes, slices

N = 10
BLOCK_WINDOWS = 200_000
_WORD = r"[0-9a-z[^\x00-\x7F]]+"
_TABLE_BITS = 20


def item_windows(items: DataFrame, n: int = N, item_column: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct rows `gram` (words with a blank between) and `item` (the id as text)."""
    folded = F.translate(col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select(col(item_column).cast("string").alias("item"), F.regexp_extract_all(folded, F.lit(_WORD), F.lit(0)).alias("w"))
    words = words.where("size(w) > 0 AND item IS NOT NULL")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))).alias("gram")).distinct()


class Block:
    """Windows of one block: hashes by length, and the items of each window's words."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.items: dict[bytes, list[str]] = defaultdict(list)
        for gram, item in rows:
            self.items[gram.encode()].append(item)
        grams = list(self.items)
        words = Words(pa.array([g.decode() for g in grams], pa.large_string()), letter_words())
        hashes = sequence_hashes(words.hashes(), words.first[:-1], words.count)
        self.hashes = {int(k): np.sort(hashes[words.count == k]) for k in np.unique(words.count)}
        self.tables = {}
        for k, values in self.hashes.items():
            self.tables[k] = np.zeros(1 << _TABLE_BITS, bool)
            self.tables[k][values >> np.uint64(64 - _TABLE_BITS)] = True

    def hits(self, words: Words) -> list[tuple[int, int, list[str]]]:
        """First word, length and items of each window of the texts that the block holds."""
        found, hashes, left = [], words.hashes(), words.left()
        for k, values in self.hashes.items():
            at = np.flatnonzero(left >= k)
            mine = sequence_hashes(hashes, at, np.full(len(at), k))
            near = self.tables[k][mine >> np.uint64(64 - _TABLE_BITS)]
            at, mine = at[near], mine[near]
            place = np.minimum(np.searchsorted(values, mine), len(values) - 1)
            for i in at[values[place] == mine].tolist():
                items = self.items.get(words.joined(i, k))
                if items:
                    found.append((i, k, items))
        return found


def _scanned(batches: Iterator[pa.RecordBatch], block: Block, clean: bool) -> Iterator[pa.RecordBatch]:
    """Adds a block's hits to what `hits` and `items` hold already."""
    chars, fold = letter_words(), lower_ascii()
    for whole in batches:
        for batch in slices(whole, "text"):
            words = Words(batch.column("text"), chars, fold)
            marks, items = np.zeros(len(words) + 1, np.int64), defaultdict(set)
            owner = words.owner()
            spans, known = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            for row, (a, b) in enumerate(zip(spans, known)):
                for s, e in zip(a[::2], a[1::2]):
                    marks[words.first[row] + s] += 1
                    marks[words.first[row] + e] -= 1
                if b:
                    items[row].update(b)
            for i, k, names in block.hits(words):
                marks[i] += 1
                marks[i + k] -= 1
                items[int(owner[i])].update(names)
            hit = np.cumsum(marks[:-1]) > 0
            yield _result(batch, words, hit, owner, items, clean)


def _result(batch: pa.RecordBatch, words: Words, hit: np.ndarray, owner: np.ndarray, items: dict, clean: bool) -> pa.RecordBatch:
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    after = np.concatenate([first[1:], [True]]) if len(owner) else first
    starts = np.flatnonzero(hit & (first | ~np.concatenate([[False], hit[:-1]])))
    ends = np.flatnonzero(hit & (after | ~np.concatenate([hit[1:], [False]]))) + 1
    base = words.first[owner[starts]] if len(starts) else starts
    flat = np.stack([starts - base, ends - base], 1).ravel().astype(np.int32)
    per = np.bincount(owner[starts], minlength=batch.num_rows) if len(starts) else np.zeros(batch.num_rows, np.int64)
    hits = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(2 * per)]).astype(np.int32)), pa.array(flat))
    names = pa.array([sorted(items.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string()))
    text = batch.column("text")
    if clean and len(starts):
        text = _cut(text, words, starts, ends, owner)
    sums = np.concatenate([[0], np.cumsum(hit)])[words.first]
    columns = [batch.column("row"), text, pa.array(words.count.astype(np.int64)), pa.array(np.diff(sums).astype(np.int64)), hits, names]
    return pa.RecordBatch.from_arrays(columns, names=["row", "text", "n_words", "n_hit", "hits", "items"])


def _cut(text: pa.Array, words: Words, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> pa.Array:
    """The texts without their spans, from the first byte of a span's first word to the last of its last."""
    out = text.to_pylist()
    gone = defaultdict(list)
    for s, e in zip(starts.tolist(), ends.tolist()):
        gone[int(owner[s])].append((int(words.start[s]), int(words.end[e - 1])))
    for row, ranges in gone.items():
        at, parts = int(words.at[row]), []
        for s, e in ranges:
            parts.append(words.raw[at:s].tobytes())
            at = e
        out[row] = b"".join([*parts, words.raw[at : int(words.at[row + 1])].tobytes()]).decode()
    return pa.array(out, text.type)


def scan(docs: DataFrame, items: DataFrame, carry: Column, text: str = "text", item_column: str = "item_id", item_text: str = "text",
         n: int = N, clean: bool = False, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Rows `row`, `text`, `n_words`, `n_hit`, `hits` (starts and ends of hit words, in turn) and `items` (sorted ids as text).

    With `clean` the text comes back without the hit spans.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    windows = written(item_windows(items, n, item_column, item_text))
    blocks = max(1, math.ceil(windows.count() / block_windows))
    part = F.pmod(F.xxhash64("gram", "item"), F.lit(blocks))
    frame = docs.select(carry.alias("row"), col(text).cast("string").alias("text"), F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"))
    kind = frame.schema
    for b in range(blocks):
        rows = [tuple(r) for r in windows.where(part == b).select("gram", "item").collect()]
        shared = spark.sparkContext.broadcast(Block(rows))
        last = b == blocks - 1
        schema = f"row {kind['row'].dataType.simpleString()}, text string, n_words long, n_hit long, hits array<int>, items array<string>"
        frame = frame.select("row", "text", "hits", "items").mapInArrow(lambda it, s=shared, c=clean and last: _scanned(it, s.value, c), schema)
        if not last:
            frame = written(frame)
    return frame


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", drop_share: float = 0.5, **options) -> DataFrame:
    """The documents without their hit spans; one of which `drop_share` or more of the words are hit goes as a whole."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    carry = F.struct(*[col(c).alias(n) for c, n in zip(docs.columns, names)])
    out = scan(docs, items, carry, text, clean=True, **options)
    out = out.where((F.col("n_hit") == 0) | (F.col("n_hit") < drop_share * F.col("n_words")))
    return out.select(*[(F.col("text") if c == text else F.col("row")[n]).alias(c) for c, n in zip(docs.columns, names)])
