"""Quality classifier: supervised vectors of hashed words and character n-grams, averaged per document, with a softmax on top.

Features are the hashes of words, of pairs of neighbouring words (a word that equals one of the last `REACH` has a feature of its own for the distance) and of byte
n-grams of 2 to 4 bytes. Each kind has its own part of the table. Learning is plain stochastic gradient descent in numpy over a sample
of at most `SAMPLE` labelled documents, chosen by a hash of the id; vectors of features and the output layer are learned together.
A document's feature vectors enter as an average, so a learned model scores a feature with one number, and a document with
the average of these.

A null or empty text has no features and gets the score of the bias alone. Without labelled rows of both classes every score is the
share of label 1 (0.5 without any). Rows are independent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from sluiceway.llm.samples import labelled
from sluiceway.llm.stage import col
from sluiceway.llm.text import Words, bounded_batches, mixed, slices, space_words

BUCKETS = 4096
KINDS = 5
REACH = 8
DIMENSION = 8
SAMPLE = 6000
EPOCHS = 12
RATE = 2.0
_ROWS = 256


def features(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind: the text of each feature, and its place in the table."""
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    owner, hashes = words.owner(), words.hashes()
    yield owner, (hashes >> shift).astype(np.int64)
    same = np.zeros(len(hashes), np.int64)
    for back in range(min(REACH, max(0, len(hashes) - 1)), 0, -1):
        equal = (hashes[back:] == hashes[:-back]) & (owner[back:] == owner[:-back])
        same[back:][equal] = back
    pair = np.zeros(len(hashes), np.uint64)
    pair[1:] = mixed(hashes[:-1] * np.uint64(3) + hashes[1:], 9)
    places = np.where(same > 0, same, REACH + 1 + (pair >> shift).astype(np.int64) % (BUCKETS - REACH - 1))
    yield owner, BUCKETS + places
    data = words.raw.astype(np.uint32)
    text = np.repeat(np.arange(len(words.count)), np.diff(words.at))
    for kind, n in enumerate((2, 3, 4), 2):
        if len(data) < n:
            yield text[:0], text[:0]
            continue
        gram = np.zeros(len(data) - n + 1, np.uint32)
        for i in range(n):
            gram = gram << np.uint32(8) | data[i : len(data) - n + 1 + i]
        inside = text[n - 1 :] == text[: len(gram)]
        places = (gram * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
        yield text[: len(gram)][inside], (kind * BUCKETS + places[inside]).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from slices(whole, "text")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's share of features by place: within a kind they sum to 1."""
    chars = space_words()
    width = KINDS * BUCKETS
    for batch in _rows(batches):
        for a in range(0, batch.num_rows, _ROWS):
            part = batch.slice(a, _ROWS)
            n = part.num_rows
            out = np.zeros((n, width), np.float32)
            for owner, place in features(Words(part.column("text"), chars)):
                total = np.maximum(np.bincount(owner, minlength=n), 1)
                out += np.bincount(owner * width + place, minlength=n * width).reshape(n, width) / total[:, None]
            places, shares = [], []
            for row in out:
                some = np.flatnonzero(row)
                places.append(some.astype(np.uint16).tobytes())
                shares.append(row[some].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("label"), pa.array(places, pa.binary()), pa.array(shares, pa.binary())], names=["label", "places", "shares"])


class Model:
    """One number for each feature, and the bias."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE):
        width = KINDS * BUCKETS
        labels = np.array([r[0] for r in rows], int)
        share = labels.mean() if len(labels) else 0.5
        self.weights, self.bias = np.zeros(width), 0.0
        if len(set(labels.tolist())) < 2:
            self.bias = float(np.log(np.clip(share, 0.01, 0.99) / (1 - np.clip(share, 0.01, 0.99)))) if len(labels) else 0.0
            return
        random = np.random.default_rng(11)
        vectors = random.normal(0, 0.1, (width, DIMENSION)).astype(np.float32)
        output = random.normal(0, 0.1, (DIMENSION, 2)).astype(np.float32)
        bias = np.log(np.array([1 - share, share], np.float32))
        # Both classes weigh the same share of a step, as one of them is rare.
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        for epoch in range(epochs):
            step = rate * (1 - epoch / epochs)
            order = random.permutation(len(rows))
            for a in range(0, len(order), 32):
                chosen = order[a : a + 32]
                dense = np.zeros((len(chosen), width), np.float32)
                for i, k in enumerate(chosen):
                    dense[i, rows[k][1]] = rows[k][2]
                hidden = dense @ vectors
                logits = hidden @ output + bias
                chance = np.exp(logits - logits.max(1, keepdims=True))
                chance /= chance.sum(1, keepdims=True)
                chance[np.arange(len(chosen)), labels[chosen]] -= 1
                error = chance * (weight[chosen] / len(chosen))[:, None]
                back = error @ output.T
                output -= step * (hidden.T @ error)
                bias -= step * error.sum(0)
                some = np.flatnonzero(dense.any(0))
                vectors[some] -= step * (dense[:, some].T @ back)
        self.weights = (vectors @ (output[:, 1] - output[:, 0])).astype(float)
        self.bias = float(bias[1] - bias[0])

    def scores(self, words: Words) -> np.ndarray:
        n = len(words.count)
        logit = np.full(n, self.bias)
        for owner, place in features(words):
            logit += np.bincount(owner, weights=self.weights[place], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, **columns: str) -> Model:
    """`labels` has only rows to learn from; rows without text or label are left out."""
    bounded_batches(docs.sparkSession)
    chosen = labelled(docs, labels, sample, 5, **columns)
    got = chosen.mapInArrow(_vectors, "label int, places binary, shares binary").collect()
    # In an order that does not depend on how tasks came back, so that a rerun learns the same.
    got.sort(key=lambda r: (r.label, bytes(r.places), bytes(r.shares)))
    return Model([(r.label, np.frombuffer(r.places, np.uint16).astype(int), np.frombuffer(r.shares, np.float16).astype(np.float32)) for r in got])


def score(docs: DataFrame, model: Model, carry: Column, text: str = "text") -> DataFrame:
    """Rows `row` and `score`, the chance of label 1."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars, model = space_words(), shared.value
        for batch in _rows(batches):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(model.scores(Words(batch.column("text"), chars)))], names=["row", "score"])

    rows = docs.select(carry.alias("row"), col(text).cast("string").alias("text"))
    return rows.mapInArrow(scored, f"row {rows.schema['row'].dataType.simpleString()}, score double")
