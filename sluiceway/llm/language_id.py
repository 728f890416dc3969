"""Language identification: nearest of several centroids per language, by the cosine of TF-IDF vectors of hashed byte trigrams.

Texts are lower-cased (A to Z), other ASCII characters than letters count as blanks, and each text stands between two blanks. A trigram's hash is
one of `DIMENSIONS` places. Document frequencies cover every training document. Centroids are fitted on a sample of at most
`SAMPLE` training documents, chosen by a hash of the id, so that each language has a like number: spherical k-means
gives `CLUSTERS` centroids per language. A text goes to the language of its nearest centroid; `rejected` tells that it is further
from it than nearly all of the sample's members were.

A null text, and one without a letter, is `und` with score 0; so is every text if no language can be learned. Rows are independent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.stage import col
from sluiceway.llm.text import bounded_batches, lower_ascii, slices, utf8

DIMENSIONS = 4096
SAMPLE = 6000
CLUSTERS = 4
SHARPNESS = 30.0
REJECTED_SHARE = 0.005
UNKNOWN = "und"
_ROWS = 256


def _letters() -> np.ndarray:
    table = lower_ascii()
    keep = np.zeros(256, bool)
    keep[97:123] = keep[128:] = True
    return np.where(keep[table], table, 32).astype(np.uint8)


def counts(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """Trigram counts: a row for each text."""
    raw, at = utf8(column)
    n = len(column)
    padded = np.full(len(raw) + 2 * n, 32, np.uint8)
    shift = np.repeat(2 * np.arange(n) + 1, np.diff(at))
    padded[np.arange(len(raw)) + shift] = table[raw]
    x = padded.astype(np.uint32)
    place = ((x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
    row = np.repeat(np.arange(n), np.diff(at) + 2)[:-2]
    inside = np.ones(len(place), bool)
    ends = at[1:-1] + 2 * np.arange(1, n)
    inside[ends - 1] = inside[ends - 2] = False
    inside &= (x[:-2] != 32) | (x[1:-1] != 32) | (x[2:] != 32)
    return np.bincount(row[inside] * DIMENSIONS + place[inside], minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for part in slices(whole, "text"):
            for a in range(0, part.num_rows, _ROWS):
                yield part.slice(a, _ROWS)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of this task that hold each trigram; place -1 is the number of texts."""
    table, total, n = _letters(), np.zeros(DIMENSIONS, np.int64), 0
    for batch in _rows(batches):
        total += (counts(batch.column("text"), table) > 0).sum(0)
        n += batch.num_rows
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIMENSIONS)), pa.array(np.concatenate([[n], total]))], names=["place", "texts"])


def _weighed(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = (np.log1p(matrix) * idf).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class Model:
    """Unit centroids, the language of each, and the least cosine that is not rejected."""

    def __init__(self, idf: np.ndarray, vectors: np.ndarray, languages: list[str], clusters: int = CLUSTERS):
        self.idf, self.names = idf, sorted(set(languages))
        given = np.array(languages)
        centroids, owner, least = [], [], []
        for k, name in enumerate(self.names):
            found, near = _clustered(vectors[given == name], clusters)
            centroids.append(found)
            owner += [k] * len(found)
            least += [np.quantile(near, REJECTED_SHARE)] * len(found)
        self.centroids = np.concatenate(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32)
        self.owner, self.least = np.array(owner, int), np.array(least)

    def predict(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the language in `names`, its score and whether it is rejected."""
        cosine = _weighed(matrix, self.idf) @ self.centroids.T
        nearest = cosine.argmax(1)
        best = np.stack([cosine[:, self.owner == k].max(1) for k in range(len(self.names))], 1)
        share = np.exp(SHARPNESS * (best - best.max(1, keepdims=True)))
        language = self.owner[nearest]
        score = share[np.arange(len(share)), language] / share.sum(1)
        return language, score.astype(float), cosine.max(1) < self.least[nearest]


def _clustered(vectors: np.ndarray, clusters: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids by spherical k-means, and each vector's cosine with its nearest."""
    order = np.random.default_rng(17).permutation(len(vectors))
    centroids = vectors[order[:clusters]]
    for _ in range(12):
        member = (vectors @ centroids.T).argmax(1)
        sums = np.stack([vectors[member == k].sum(0) if (member == k).any() else centroids[k] for k in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centroids, (vectors @ centroids.T).max(1)


def fit(training: DataFrame, id_column: str = "doc_id", text: str = "text", language: str = "lang", sample: int = SAMPLE) -> Model:
    """`training` has only rows to learn from; rows without text or language are left out."""
    spark = training.sparkSession
    bounded_batches(spark)
    rows = training.select(col(id_column).cast("string").alias("id"), col(text).cast("string").alias("text"), col(language).cast("string").alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    found = rows.select("text").mapInArrow(_frequencies, "place long, texts long").groupBy("place").agg(F.sum("texts").alias("texts")).collect()
    texts = dict((r.place, r.texts) for r in found)
    total = texts.get(-1, 0)
    idf = np.log((1 + total) / (1 + np.array([texts.get(i, 0) for i in range(DIMENSIONS)]))) + 1
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    each = sample // max(1, len(sizes))
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, each / n))).otherwise(share)
    order = F.xxhash64("id", F.lit(3))
    chosen = rows.where(F.pmod(order, F.lit(1 << 20)) < share * (1 << 20)).orderBy(order, F.xxhash64("text")).limit(sample)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _letters()
        for batch in _rows(batches):
            made = [row.astype(np.float16).tobytes() for row in _weighed(counts(batch.column("text"), table), idf)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(made, pa.binary())], names=["lang", "vector"])

    got = chosen.select("text", "lang").mapInArrow(vectors, "lang string, vector binary").collect()
    matrix = np.array([np.frombuffer(r.vector, np.float16) for r in got], np.float32).reshape(len(got), DIMENSIONS)
    return Model(idf, matrix, [r.lang for r in got])


def identify(docs: DataFrame, model: Model, carry: Column, text: str = "text") -> DataFrame:
    """Rows `row`, `language`, `score` and `rejected`."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, model = _letters(), shared.value
        for batch in _rows(batches):
            language = np.full(batch.num_rows, UNKNOWN, object)
            score, rejected = np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            known = batch.column("letter").to_numpy(zero_copy_only=False)
            if model.names and known.any():
                place, share, far = model.predict(counts(batch.column("text"), table)[known])
                language[known], score[known], rejected[known] = np.array(model.names, object)[place], share, far
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(language, pa.string()), pa.array(score), pa.array(rejected)], names=["row", "language", "score", "rejected"])

    letter = F.coalesce(col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(carry.alias("row"), col(text).cast("string").alias("text"), letter.alias("letter"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"row {kind}, language string, score double, rejected boolean")
