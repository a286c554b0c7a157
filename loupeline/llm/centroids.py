"""Exact integer k-means whose assignments are filtered by n-simplex bounds.

Components become the integers floor(scale * x). The pivots are the first centroids. From its distances to the pivots a vector gets an
apex: its place in the space the pivots span, and its height over that space. The apexes of two points bound their distance: the
distance of the apexes from below, and that with one apex reflected at the base from above. Apexes of the vectors are computed once and
stored with their integers; a round makes only those of its centroids, drops every centroid whose lower bound is over another's upper
bound (with room for rounding), and compares the rest by exact integer distances. Ties go to the smaller number.

Rounds send back one sum per cluster and component; the driver holds nothing but the centroids. Sums are made inside tasks first, so a
cluster with most of the vectors is no larger than another.

Rows whose vector is null, has another number of components, or a null or non-finite one are left out. Repeated rows count each. Fewer
vectors than clusters give that many centroids; a table without any gives no rows. Vectors without an id take part, but start no
centroid unless there are too few others. Other columns are ignored, whatever their names. A component beyond 2**24 after scaling is an
error, since exact distances would no longer fit 64 bits.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loupeline.llm import common
from loupeline.session import written

LARGEST = 1 << 24
LEAST_HEIGHT = 0.05  # of a pivot over the space of the earlier ones, as a share of its distance; flatter ones are left out
ROUNDING = 1e-6


class Simplex:
    """Apexes over pivots, from distances alone."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots[:1].astype(np.float64)
        self.base = np.zeros((0, 0))
        for pivot in pivots[1:].astype(np.float64):
            apex = self.apexes(pivot[None, :])[0]
            if apex[-1] > LEAST_HEIGHT * max(np.linalg.norm(apex), 1e-9):
                n = len(apex)
                grown = np.zeros((n, n))
                grown[:-1, :-1], grown[-1] = self.base, apex
                self.base, self.pivots = grown, np.vstack([self.pivots, pivot])

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """One row per vector: places along the base, then the height."""
        vectors = np.asarray(vectors, dtype=np.float64)
        squares = np.stack([((vectors - pivot) ** 2).sum(axis=1) for pivot in self.pivots], axis=1)  # to every pivot
        along = np.zeros((len(vectors), len(self.base)))
        if len(self.base):
            right = (squares[:, :1] + (self.base ** 2).sum(axis=1) - squares[:, 1:]) / 2
            along = np.linalg.solve(self.base, right.T).T
        height = np.sqrt(np.maximum(squares[:, 0] - (along ** 2).sum(axis=1), 0))
        return np.concatenate([along, height[:, None]], axis=1)


def bounds(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds of the distances of two sets of points, from their apexes."""
    along = ((a[:, None, :-1] - b[None, :, :-1]) ** 2).sum(axis=2)
    return along + (a[:, None, -1] - b[None, :, -1]) ** 2, along + (a[:, None, -1] + b[None, :, -1]) ** 2


def assign(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of every vector, its squared distance, and how many exact distances that took."""
    low, high = bounds(apexes, tops)
    room = ROUNDING * (1 + (apexes ** 2).sum(axis=1) + (tops ** 2).sum(axis=1).max())
    row, at = np.nonzero(low <= (high.min(axis=1) + room)[:, None])
    exact = np.full(low.shape, np.iinfo(np.int64).max)
    for i in range(0, len(row), 1 << 16):
        r, c = row[i:i + (1 << 16)], at[i:i + (1 << 16)]
        exact[r, c] = ((vectors[r] - centroids[c]) ** 2).sum(axis=1)
    nearest = exact.argmin(axis=1)
    return nearest, exact[np.arange(len(nearest)), nearest], len(row)


def integers(vectors: DataFrame, dimensions: int, scale: int, vector: str = "embedding", number: str = "vec_id") -> DataFrame:
    """``number, q`` of the usable vectors."""
    x = F.col(f"`{vector}`").cast("array<double>")
    usable = F.coalesce((F.size(x) == dimensions) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False))

    def whole(v: Column) -> Column:
        scaled = F.floor(v * float(scale))
        return F.when(F.abs(v * float(scale)) <= LARGEST, scaled).otherwise(F.raise_error(F.lit("a vector component is too large for exact distances"))).cast("int")

    return vectors.where(usable).select(F.col(f"`{number}`").alias(number), F.transform(x, whole).alias("q"))


def _lists(column: pa.Array, dimensions: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dimensions)


def cluster(vectors: DataFrame, k: int, rounds: int, dimensions: int, scale: int, seed: int = 1, vector: str = "embedding", number: str = "vec_id") -> tuple[DataFrame, np.ndarray]:
    """``number, cluster, distance`` of every usable vector, and the final centroids (one row each, exact integers)."""
    given = integers(vectors, dimensions, scale, vector, number)
    spark = vectors.sparkSession
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(f"`{number}`").cast("string")), 256)
    first = given.select(hashed.alias("h"), "q").orderBy(F.col("h").asc_nulls_last(), "q").limit(k).collect()
    kind = given.schema[number].dataType.simpleString()
    if not first:
        return spark.createDataFrame([], f"`{number}` {kind}, cluster int, distance bigint"), np.zeros((0, dimensions), dtype=np.int64)
    centroids = np.array([r.q for r in first], dtype=np.int64)
    simplex = Simplex(centroids)
    width = len(simplex.base) + 1

    def with_apexes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = simplex.apexes(_lists(batch.column("q"), dimensions, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(number), batch.column("q"), pa.ListArray.from_arrays(pa.array(np.arange(len(tops) + 1) * width, pa.int32()), pa.array(tops.ravel()))],
                                             names=[number, "q", "apex"])

    held = written(common.bounded(given).mapInArrow(with_apexes, f"`{number}` {kind}, q array<int>, apex array<double>"), "apexes")

    def parts(batch: pa.RecordBatch, size: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            yield part, _lists(part.column("q"), dimensions, np.int64), _lists(part.column("apex"), width, np.float64)

    for _ in range(rounds):
        def summed(batches: Iterator[pa.RecordBatch], centroids=centroids, tops=simplex.apexes(centroids)) -> Iterator[pa.RecordBatch]:
            sums, counts = np.zeros(centroids.shape, dtype=np.int64), np.zeros(len(centroids), dtype=np.int64)
            for batch in batches:
                for _, q, apex in parts(batch):
                    nearest = assign(q, apex, centroids, tops)[0]
                    np.add.at(sums, nearest, q)
                    counts += np.bincount(nearest, minlength=len(counts))
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, dimensions)), pa.array(np.tile(np.arange(dimensions), len(some))), pa.array(sums[some].ravel()), pa.array(np.repeat(counts[some], dimensions))],
                                             names=["cluster", "i", "s", "n"])

        found = held.select("q", "apex").mapInArrow(summed, "cluster bigint, i bigint, s bigint, n bigint").groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
        centroids = centroids.copy()
        for r in found:  # at most k * dimensions sums
            centroids[r.cluster, r.i] = r.s // r.n  # rounds down, also below zero

    def nearest(batches: Iterator[pa.RecordBatch], centroids=centroids, tops=simplex.apexes(centroids)) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, q, apex in parts(batch):
                at, distance, _ = assign(q, apex, centroids, tops)
                yield pa.RecordBatch.from_arrays([part.column(number), pa.array(at.astype(np.int32)), pa.array(distance)], names=[number, "cluster", "distance"])

    return held.mapInArrow(nearest, f"`{number}` {kind}, cluster int, distance bigint"), centroids


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``."""
    stored = written(assigned, "clusters")
    sums = {r.cluster: r.d for r in stored.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # one per centroid

    def at(values: list, kind: str) -> Column:
        return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("cluster") + 1).cast(kind) if values else F.lit(None).cast(kind)

    return stored.withColumns({"cluster_inertia": at([sums.get(c, 0) for c in range(len(centroids))], "bigint"), "inertia": F.lit(sum(sums.values())).cast("bigint"),
                               "centroid_sha256": at([digest(c) for c in centroids], "string")})
