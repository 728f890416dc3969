"""Words of texts as arrays: shared by the operators that work on Arrow batches.

A batch is cut into slices of whole rows of about `SLICE` bytes, so the arrays stay small however many rows
Spark puts into a batch. A single longer text is a slice of its own; a null text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from sluiceway.llm.stage import importable

SLICE = 1 << 20
BATCH_BYTES = 4 << 20
_ONE = np.uint64(1)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes, as thousands of long texts would not fit a Python worker."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def space_words() -> np.ndarray:
    """True for the bytes of words that blanks and the controls 9 to 13 separate."""
    table = np.ones(256, bool)
    table[[9, 10, 11, 12, 13, 32]] = False
    return table


def letter_words() -> np.ndarray:
    """True for digits, a to z and every byte of a character beyond ASCII."""
    table = np.zeros(256, bool)
    table[48:58] = table[97:123] = table[128:] = True
    return table


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (with the end of the last)."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows whose texts have about `size` bytes together."""
    _, at = utf8(batch.column(batch.schema.get_field_index(text)))
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        last = min(last, first + 4096)
        yield batch.slice(first, last - first)
        first = last


class Words:
    """Words of some texts: `start` and `end` in `data`, and the first word of each text in `first`."""

    def __init__(self, column: pa.Array, chars: np.ndarray, fold: np.ndarray | None = None):
        raw, at = utf8(column)
        self.raw, self.at = raw, at
        self.data = raw if fold is None else fold[raw]
        inside = chars[self.data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = at[(at > 0) & (at < len(raw))]
        before[edges] = False
        after[edges - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits for each word."""
        ahead, back = _powers(len(self.data) + 1, 2 * seed)
        sums = _sums((self.data.astype(np.uint64) + _ONE) * ahead[: len(self.data)])
        return mixed((sums[self.end] - sums[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64), seed)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], self.count) - np.arange(len(self))

    def joined(self, i: int, n: int) -> bytes:
        """Words i to i + n with one blank between."""
        raw = self.data[self.start[i] : self.end[i + n - 1]].tobytes()
        base = self.start[i]
        return b" ".join(raw[s - base : e - base] for s, e in zip(self.start[i : i + n].tolist(), self.end[i : i + n].tolist()))

    def joined_all(self, keep: np.ndarray | None = None) -> list[bytes]:
        """Each text as its words with one blank between; only words marked in `keep`."""
        keep = np.ones(len(self), bool) if keep is None else keep
        start, end = self.start[keep], self.end[keep]
        sums = np.concatenate([[0], np.cumsum(keep)])[self.first]
        length = end - start + 1
        to = np.concatenate([[0], np.cumsum(length)])
        out = np.full(int(to[-1]), 32, np.uint8)
        shift = np.repeat(start - to[:-1], length)
        at = np.arange(len(out)) + shift
        inside = np.ones(len(out), bool)
        inside[to[1:] - 1] = False
        out[inside] = self.data[at[inside]]
        whole = out.tobytes()
        bounds = to[sums].tolist()
        return [whole[a : max(a, b - 1)] for a, b in zip(bounds[:-1], bounds[1:])]


def sequence_hashes(words: np.ndarray, first: np.ndarray, length: np.ndarray, seed: int = 1) -> np.ndarray:
    """64 bits for each run of words, from the words' hashes; the same run has the same bits anywhere."""
    ahead, back = _powers(len(words) + 1, 2 * seed + 1)
    sums = _sums(words * ahead[: len(words)])
    return mixed((sums[first + length] - sums[first]) * back[first] + length.astype(np.uint64), seed)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = values ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def minimum_by(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    out, reach = values, 1
    while reach * 2 <= width:
        out = np.minimum(out[: len(out) - reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, n.bit_length())
    ahead, back = _power_table(size, seed)
    return ahead[:n], back[:n]


@lru_cache(maxsize=6)
def _power_table(size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    base = (0x2545F4914F6CDD1D + 0x9E3779B97F4A7C16 * seed) % (1 << 64) | 1
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        table = np.full(size, x, np.uint64)
        table[0] = 1
        out.append(np.cumprod(table))
    return out[0], out[1]
