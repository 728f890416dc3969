"""Approximate nearest neighbours by cross-polytope hashing, ranked by exact Euclidean distance.

Hashing: a unit vector, filled up with zeros to a power of two of components, is rotated by three rounds of random signs and a fast Hadamard transform, and goes
to the nearest signed axis. A bucket is one such axis in one of `TABLES` tables, or `rotations` of them at once when the rows are so many that the
buckets would be large. Every vector is in one bucket of each table. A query looks into the bucket of its own axis and into those that are hardly
farther: all whose scores fall behind the best by at most `reach` in sum.

`reach` is fitted: for at most `CALIBRATION` of the queries, drawn by a hash, one pass over all vectors finds their true neighbours, and `reach` is the least that would have
met `TARGET` of them. So it follows the data: vectors with near neighbours need few buckets, isolated ones many. The sample bounds only this number;
every vector is indexed and every query searched.

Equal vectors are one class with its `k + 1` smallest ids, which is all that `k` neighbours can need; the ids are cut where they are read, so any number of copies costs
little. A bucket of many vectors is cut into blocks of about `POINTS`, its queries into blocks of `QUERIES`, and each pair of blocks is one group of work.
No candidate is dropped. A query that finds fewer than `k` is compared with all vectors, in blocks too.

Vectors that are null, zero, empty or hold a null or a component that is not finite take no part, nor do rows without an id. Rows with equal id and vector are one row. Vectors of other lengths than the
query's are no candidates. Ties go to the smaller id. Without queries the result is empty; other columns, of any name, take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.llm.stage import col, written
from sluiceway.llm.text import bounded_batches

TABLES = 8
TARGET = 0.97
CALIBRATION = 128
BUCKET = 1 << 20
POINTS = 2048
QUERIES = 2048
_ROUNDS = 3
_SLACK = 1e-9


class Index(NamedTuple):
    """What is fitted: axes a bucket has, and how far behind the best a bucket may be."""

    rotations: int
    reach: float


# Hashing

def _signs(table: int, rotation: int, size: int) -> np.ndarray:
    return np.random.default_rng([table, rotation, size]).choice([-1.0, 1.0], (_ROUNDS, size))


def _hadamard(rows: np.ndarray) -> np.ndarray:
    """The orthonormal transform of each row, in a number of steps that is the logarithm of its length."""
    n, size = rows.shape
    step = 1
    while step < size:
        pairs = rows.reshape(n, -1, 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, size)
        step *= 2
    return rows / math.sqrt(size)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, filled up to a power of two; scaled first, so that squares neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    size = max(2, 1 << (vectors.shape[1] - 1).bit_length())
    out = np.zeros((len(vectors), size))
    out[:, : vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    return out


def _rotated(units: np.ndarray, table: int, rotation: int) -> np.ndarray:
    for signs in _signs(table, rotation, units.shape[1]):
        units = _hadamard(units * signs)
    return units


def _axes(rotated: np.ndarray) -> np.ndarray:
    """The nearest signed axis of each row: axis i as i, its opposite as i + size."""
    best = np.abs(rotated).argmax(1)
    return best + rotated.shape[1] * (rotated[np.arange(len(rotated)), best] < 0)


def codes(units: np.ndarray, table: int, rotations: int) -> np.ndarray:
    """The bucket of each row in a table."""
    out = np.zeros(len(units), np.int64)
    for r in range(rotations):
        out = out * 2 * units.shape[1] + _axes(_rotated(units, table, r))
    return out


def behind(units: np.ndarray, table: int, rotations: int) -> np.ndarray:
    """How far each signed axis is behind the best one, by row, rotation and axis."""
    parts = []
    for r in range(rotations):
        rotated = _rotated(units, table, r)
        both = np.concatenate([rotated, -rotated], 1)
        parts.append(both.max(1, keepdims=True) - both)
    return np.stack(parts, 1)


def probes(lag: np.ndarray, reach: float) -> np.ndarray:
    """Buckets of a table that are at most `reach` behind, from one row of `behind`."""
    code, sums = np.zeros(1, np.int64), np.zeros(1)
    for axis in lag:
        near = np.flatnonzero(axis <= reach)
        total = sums[:, None] + axis[near][None, :]
        at = np.nonzero(total <= reach)
        code, sums = code[at[0]] * len(axis) + near[at[1]], total[at]
    return code


# Vectors in Arrow batches

def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each length and their vectors as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, values[starts[rows][:, None] + np.arange(n)[None, :]]


def _posted(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Each class in its bucket of every table."""
    for batch in batches:
        for rows, vectors in _by_length(batch.column("v")):
            units = _unit(vectors)
            for table in range(TABLES):
                bucket = codes(units, table, index.rotations) * TABLES + table
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), vectors.shape[1], np.int32)), pa.array(bucket), *[batch.column(c).take(pa.array(rows)) for c in ("class", "first", "v")]],
                    names=["dim", "bucket", "class", "first", "v"])


def _probed(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Each query class in all buckets that it looks into."""
    for batch in batches:
        for rows, vectors in _by_length(batch.column("v")):
            units = _unit(vectors)
            for table in range(TABLES):
                lag = behind(units, table, index.rotations)
                for at in range(0, len(rows), 64):
                    found = [probes(x, index.reach) for x in lag[at : at + 64]]
                    mine = np.repeat(rows[at : at + 64], [len(f) for f in found])
                    bucket = np.concatenate(found) * TABLES + table
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(mine), vectors.shape[1], np.int32)), pa.array(bucket), *[batch.column(c).take(pa.array(mine)) for c in ("class", "first", "v")]],
                        names=["dim", "bucket", "class", "first", "v"])


def _ranked(queries: np.ndarray, points: np.ndarray, first: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the `k` nearest points and their distances, ties by `first`. A fast estimate with slack comes first, then exact differences."""
    square = (points * points).sum(1)
    for at in range(0, len(queries), 128):
        some = queries[at : at + 128]
        own = (some * some).sum(1)
        guess = np.maximum(own[:, None] + square[None, :] - 2 * some @ points.T, 0)
        bound = np.partition(guess, k - 1, 1)[:, k - 1] if len(points) > k else guess.max(1)
        slack = _SLACK * (own + square.max())
        for i in range(len(some)):
            near = np.flatnonzero(guess[i] <= bound[i] + slack[i])
            exact = np.sqrt(((points[near] - some[i]) ** 2).sum(1))
            order = np.lexsort((first[near], exact))[:k]
            yield at + i, near[order], exact[order]


def _met(group: pa.Table, k: int) -> pa.Table:
    """The nearest points of a block's queries; classes `q` and `p`."""
    asks = group.column("asks").to_numpy()
    sides = []
    for mask in (asks, ~asks):
        part = group.filter(pa.array(mask))
        vectors = next((v for _, v in _by_length(part.column("v"))), None)
        sides.append((part.column("class").to_numpy(), part.column("first").combine_chunks(), vectors))
    (q, _, queries), (p, first, points) = sides
    out_q, out_p, out_d = [], [], []
    if queries is not None and points is not None:
        order = pa.compute.rank(first, sort_keys="ascending", tiebreaker="dense").to_numpy()
        for i, at, distance in _ranked(queries, points, order, k):
            out_q.append(np.full(len(at), q[i]))
            out_p.append(at)
            out_d.append(distance)
    rows = np.concatenate(out_p) if out_p else np.zeros(0, np.int64)
    return pa.table({
        "q": pa.array(np.concatenate(out_q) if out_q else np.zeros(0, np.int64)), "p": pa.array(p[rows] if len(p) else np.zeros(0, np.int64)),
        "first": first.take(pa.array(rows)), "distance": pa.array(np.concatenate(out_d) if out_d else np.zeros(0)),
    })


# The steps

def _classes(base: DataFrame, asking: Column, k: int, id_column: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (`class`, `v`, the smallest `ids`, `asked`), and the queries as `id`, `class`."""
    kind = base.select(col(vector)).schema[0].dataType
    exact = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))
    known = base.select(col(id_column).alias("id"), (col(vector) if exact else col(vector).cast("array<double>")).alias("v"), asking.alias("asks"))
    real = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    known = known.where(F.col("id").isNotNull() & F.coalesce(real, F.lit(False)))
    rows = known.groupBy("id", "v").agg(F.bool_or(F.coalesce("asks", F.lit(False))).alias("asks"))
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    least = rows.select("id", "v", place.alias("place")).where(F.col("place") <= k + 1)
    classes = least.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    classes = written(classes.select(F.monotonically_increasing_id().alias("class"), F.col("ids")[0].alias("first"), "ids", "v"))
    queries = written(rows.where("asks").select("id", "v").join(classes.select("class", "v"), "v").select("id", "class"))
    return classes, queries


def fit(classes: DataFrame, asked: DataFrame, k: int, target: float = TARGET, calibration: int = CALIBRATION) -> Index | None:
    """The index for these classes, from the true neighbours of at most `calibration` of the asked ones; None without any."""
    drawn = asked.orderBy(F.xxhash64("class"), "class").limit(calibration).select("class", "v").collect()
    if not drawn:
        return None
    longest = max(len(r.v) for r in drawn)
    axes = 2 * max(2, 1 << (longest - 1).bit_length())
    rotations = 1 + max(0, int(math.log(max(1, classes.count() / BUCKET)) / math.log(axes)))
    vectors = [np.array(r.v, np.float64) for r in drawn]
    shared = classes.sparkSession.sparkContext.broadcast((np.array([r["class"] for r in drawn]), vectors))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = shared.value
        for batch in batches:
            mine = batch.column("class").to_numpy()
            for rows, points in _by_length(batch.column("v")):
                alike = [i for i, w in enumerate(wanted) if len(w) == points.shape[1]]
                if not alike:
                    continue
                number, place, length = [], [], []
                for i, at, distance in _ranked(np.stack([wanted[j] for j in alike]), points, mine[rows], k + 1):
                    other = mine[rows[at]] != names[alike[i]]
                    number.append(np.full(other.sum(), alike[i], np.int32))
                    place.append(rows[at[other]])
                    length.append(distance[other])
                at = np.concatenate(place)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(number)), pa.array(np.concatenate(length)), pa.array(mine[at]), batch.column("v").take(pa.array(at))], names=["q", "distance", "class", "v"])

    kind = classes.schema["v"].dataType.simpleString()
    near = classes.select("class", "v").mapInArrow(compared, f"q int, distance double, class long, v {kind}")
    place = F.row_number().over(Window.partitionBy("q").orderBy("distance", "class"))
    truth = near.withColumn("place", place).where(F.col("place") <= k).select("q", "v").collect()
    if not truth:
        return Index(rotations, 0.0)
    least = []
    for row in truth:
        pair = _unit(np.stack([vectors[row.q], np.array(row.v, np.float64)]))
        size, lags = 2 * pair.shape[1], []
        for table in range(TABLES):
            lag, code = behind(pair[:1], table, rotations)[0], int(codes(pair[1:], table, rotations)[0])
            lags.append(sum(lag[r][code // size ** (rotations - 1 - r) % size] for r in range(rotations)))
        least.append(min(lags))
    least.sort()
    return Index(rotations, least[min(len(least) - 1, math.ceil(target * len(least)) - 1)] + _SLACK)


def _found(points: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The nearest points of each query class over all buckets that both are in; `dim`, `bucket`, `class`, `first`, `v` on both sides."""
    key = ["dim", "bucket"]
    both = points.groupBy(key).agg(F.count("*").alias("n")).join(queries.groupBy(key).agg(F.count("*").alias("m")), key)
    sizes = written(both.select(*key, F.ceil(F.col("n") / POINTS).cast("int").alias("across"), F.ceil(F.col("m") / QUERIES).cast("int").alias("down")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    one = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    rest = ["class", "first", "v"]
    cut_points = points.join(sizes, key).select(*key, one("across").alias("x"), every("down").alias("y"), *rest, F.lit(False).alias("asks"))
    cut_queries = queries.join(sizes, key).select(*key, every("across").alias("x"), one("down").alias("y"), *rest, F.lit(True).alias("asks"))
    kind = points.schema["first"].dataType.simpleString()
    return cut_points.union(cut_queries).groupBy(*key, "x", "y").applyInArrow(lambda group: _met(group, k), f"q long, p long, first {kind}, distance double")


def _nearest(found: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """`class` and `near`: the first k + 1 rows as distance and id, of each query class. `found` may name a pair more than once."""
    once = found.groupBy("q", "p").agg(F.min("first").alias("first"), F.min("distance").alias("distance"))
    place = F.row_number().over(Window.partitionBy("q").orderBy("distance", "first", "p"))
    best = once.withColumn("place", place).where(F.col("place") <= k + 1).select("q", F.col("p").alias("class"), "distance")
    rows = best.join(classes.select("class", "ids"), "class")
    entries = F.transform("ids", lambda x: F.struct(F.col("distance"), x.alias("id")))
    near = F.slice(F.sort_array(F.flatten(F.collect_list(entries))), 1, k + 1)
    return rows.groupBy(F.col("q").alias("class")).agg(near.alias("near"))


def search(base: DataFrame, asking: Column, k: int = 10, id_column: str = "vec_id", vector: str = "embedding", target: float = TARGET) -> DataFrame:
    """For each row that `asking` holds for its `k` nearest other rows: `query_id`, `rank` (from 1), `id`, `distance`."""
    spark = base.sparkSession
    bounded_batches(spark)
    classes, queries = _classes(base, asking, k, id_column, vector)
    asked = written(classes.join(queries.select("class").distinct(), "class", "left_semi").select("class", "first", "v"))
    index = fit(classes, asked, k, target)
    if index is None:
        kind = classes.schema["first"].dataType
        return spark.createDataFrame([], T.StructType([T.StructField("query_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("id", kind), T.StructField("distance", T.DoubleType())]))
    columns = f"dim int, bucket long, class long, first {classes.schema['first'].dataType.simpleString()}, v {classes.schema['v'].dataType.simpleString()}"
    slim = classes.select("class", "first", "v")
    points = slim.mapInArrow(lambda batches: _posted(batches, index), columns)
    wanted = written(asked.mapInArrow(lambda batches: _probed(batches, index), columns))
    near = written(_nearest(_found(points, wanted, k + 1), classes, k))
    # Whoever has too few is compared with all vectors; a vector of a rare length may still have fewer.
    short = asked.join(near.where(F.size("near") <= k).select("class"), "class", "left_semi")
    short = written(short.union(asked.join(near, "class", "left_anti")))
    if not short.isEmpty():
        whole = lambda frame: frame.select(F.size("v").alias("dim"), F.lit(0).cast("long").alias("bucket"), "class", "first", "v")
        rest = _nearest(_found(whole(slim), whole(short), k + 1), classes, k)
        near = written(near.join(short.select("class"), "class", "left_anti").union(rest))
    listed = queries.join(near, "class")
    others = F.slice(F.filter("near", lambda x: ~((x["id"] == F.col("id")) & (x["distance"] == 0))), 1, k)
    ranked = listed.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "x"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("id"), F.col("x.distance").alias("distance"))
