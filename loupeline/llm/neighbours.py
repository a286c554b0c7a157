"""Approximate nearest neighbours by cross-polytope hashing.

Every unit vector is turned by pseudo-random rotations (three rounds of random signs and a fast Hadamard transform) and
falls to the nearest of the signed axes, once per table. A query is probed in the buckets of its ``probes`` nearest signed axes
of each table. Buckets are cut into chunks by counted size, so a bucket that holds a third of all vectors, or is probed by
a third of all queries, becomes many blocks; a block multiplies its queries with its vectors and only its best pairs leave the
task, with their exact scores. The best of all blocks are kept per query.

Equal vectors are indexed once: of each class the rows of smallest ids are enough for any answer, ``k`` of them besides those of any one id. Queries
that are equal are searched once. A query that finds fewer than ``k`` others although there are more (tiny or odd tables) is searched again in blocks against all vectors, so
every query has its full number of answers. All vectors are indexed; nothing is sampled.

``hashes`` rotations per table make longer keys for larger tables: a table has (2 d) ** hashes buckets.

Vectors that are null, zero, or hold null or non-finite components take no part, as rows or as queries. Only vectors of one dimension are
compared. Scores are inner products of the original vectors, added up in component order in double precision; equal scores go to the smaller id. Rows
that repeat an id are told apart by nothing: each is a candidate, none of them for a query of that id. A null id takes no part.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from loupeline.session import written

DATA_CHUNK, QUERY_CHUNK = 512, 1024
SPARE = 4  # more classes than asked for leave a block, so that rounding in the product cannot cost an answer


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(rows, -1, 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(rows, width)
        half *= 2
    return x / np.sqrt(width)


@cache
def _signs(seed: int, table: int, turn: int, width: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([seed, table, turn, width])).choice([-1.0, 1.0], (3, width))


def axes(unit: np.ndarray, seed: int, table: int, turn: int) -> np.ndarray:
    """Inner products with the signed axes after one pseudo-random rotation."""
    width = 1 << max(0, int(unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), width))
    x[:, : unit.shape[1]] = unit
    for signs in _signs(seed, table, turn, width):
        x = hadamard(x * signs)
    return np.concatenate([x, -x], axis=1)


def buckets(unit: np.ndarray, seed: int, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` most promising buckets of each vector, its own first."""
    best, score = np.zeros((len(unit), 1), dtype=np.int64), np.zeros((len(unit), 1))
    for turn in range(hashes):
        near = axes(unit, seed, table, turn)
        take = min(probes, near.shape[1])
        top = np.argsort(-near, axis=1, kind="stable")[:, :take]
        both = (score[:, :, None] + np.take_along_axis(near, top, 1)[:, None, :]).reshape(len(unit), -1)
        keys = (best[:, :, None] * near.shape[1] + top[:, None, :]).reshape(len(unit), -1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :probes]
        best, score = np.take_along_axis(keys, order, 1), np.take_along_axis(both, order, 1)
    return best


def _matrix(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<f8").reshape(len(column), -1)


def vectors(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id, vec``: the vectors that take part, as bytes of doubles."""
    values = F.col(embedding).cast("array<double>")
    fine = F.coalesce(F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))) & F.exists(values, lambda v: v != 0), F.lit(False))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("values")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8"), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            flat = flat + 0.0  # one zero only
            yield pa.RecordBatch.from_arrays([ids, pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())], names=["vec_id", "vec"])

    rows = table.where(F.col(vec_id).isNotNull() & fine).select(F.col(vec_id).cast("bigint").alias("vec_id"), values.alias("values"))
    return rows.mapInArrow(pack, "vec_id bigint, vec binary")


def _keyed(rows: DataFrame, seed: int, tables: int, hashes: int, probes: int, with_vector: bool) -> DataFrame:
    """A row per table and probed bucket: ``key`` (dimension, table, bucket), id and, if asked for, the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, raw = part.column("id").to_numpy(), part.column("vec").to_pylist()
                sizes = np.array([len(v) for v in raw])
                for size in np.unique(sizes):
                    own = np.flatnonzero(sizes == size)
                    x = _matrix([raw[i] for i in own])
                    scale = np.abs(x).max(1, keepdims=True)
                    unit = x / scale
                    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                    for t in range(tables):
                        found = buckets(unit, seed, t, hashes, probes)
                        which = np.repeat(own, found.shape[1])
                        columns = [pa.array([f"{size // 8}/{t}/{b}" for b in found.ravel()], pa.string()), pa.array(ids[which])]
                        if with_vector:
                            columns.append(part.column("vec").take(pa.array(which)))
                        yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "vec"][: len(columns)])

    return rows.mapInArrow(run, "key string, id bigint" + ", vec binary" * with_vector)


def _best_pairs(queries: pd.DataFrame, data: pd.DataFrame, keep: int) -> pd.DataFrame:
    a, b = _matrix(queries["vec"].tolist()), _matrix(data["vec"].tolist())
    product = a @ b.T
    take = min(keep, len(b))
    last = -np.partition(-product, take - 1, axis=1)[:, take - 1]
    # the product rounds: all that come near the last one kept are scored exactly, so that ties go by id
    room = 1e-12 * (1 + np.abs(a).max(1) * np.abs(b).max() * a.shape[1])
    rows, columns = np.nonzero(product >= (last - room)[:, None])
    score = np.zeros(len(rows))
    for d in range(a.shape[1]):  # component order, so that equal vectors get equal scores
        score += a[rows, d] * b[columns, d]
    ids = data["id"].to_numpy()[columns]
    order = np.lexsort((ids, -score, rows))
    first = np.searchsorted(rows[order], np.arange(len(a)))
    order = order[np.arange(len(order)) - first[rows[order]] < take]
    return pd.DataFrame({"query": queries["id"].to_numpy()[rows[order]], "vec_id": ids[order], "score": score[order]})


def _in_blocks(queries: DataFrame, data: DataFrame, counts: DataFrame, keep: int) -> DataFrame:
    """Best pairs of every block of equal key; ``counts`` has ``key, n_data, n_queries``."""
    sized = written(counts.select("key", F.ceil(F.col("n_data") / DATA_CHUNK).cast("int").alias("_d"), F.ceil(F.col("n_queries") / QUERY_CHUNK).cast("int").alias("_q"))
                    .where("_d > 0 and _q > 0"), "blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = queries.join(sized, "key").select("key", "id", "vec", every("_d").alias("d"), mine("_q").alias("q"))
    right = data.join(sized, "key").select("key", "id", "vec", mine("_d").alias("d"), every("_q").alias("q"))
    return (left.groupBy("key", "d", "q").cogroup(right.groupBy("key", "d", "q"))
            .applyInPandas(lambda a, b: _best_pairs(a, b, keep) if len(a) and len(b) else pd.DataFrame({"query": [], "vec_id": [], "score": []}),
                           "query bigint, vec_id bigint, score double"))


def _top(rows: DataFrame, by: str, n: int) -> DataFrame:
    order = W.partitionBy(by).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _besides_any(rows: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """The first rows of each group that are enough to hold the first ``k`` of other ids, whichever one id is left out.

    No answer needs more than ``k`` rows of one id; of the first ``2 k`` rows so limited, at least ``k`` stay without any one id.
    """
    own = rows.withColumn("_own", F.row_number().over(W.partitionBy(by, "vec_id").orderBy(*order))).where(F.col("_own") <= k)
    return own.withColumn("_at", F.row_number().over(W.partitionBy(by).orderBy(*order))).where(F.col("_at") <= 2 * k)


def probes_for(rows: int, dimensions: int, k: int, tables: int, recall: float) -> int:
    """Probes per table so that a share ``recall`` of the ``k`` nearest of so many unrelated vectors is found.

    Unrelated vectors are the hardest case: the k-th nearest of n has a cosine of about c, the normal quantile of 1 - k / n over the root of the
    dimension. Its bucket is the axis of its largest coordinate, about m deviations; there the query has c m deviations on average, and every axis
    that has more than t is probed. A table may miss it, all tables together only in a share 1 - recall.
    """
    normal, width = NormalDist(), 1 << max(0, int(dimensions - 1).bit_length())
    share = min(0.5, k / max(rows, 1))
    c = min(0.99, normal.inv_cdf(1 - share) / dimensions ** 0.5)
    m = normal.inv_cdf(1 - 0.5 / (2 * width))
    t = c * m - normal.inv_cdf(1 - (1 - recall) ** (1 / tables)) * (1 - c * c) ** 0.5
    return max(1, min(2 * width, round((1 - normal.cdf(t)) * 2 * width)))


def nearest(table: DataFrame, is_query: Column, k: int = 20, tables: int = 6, probes: int | None = None, recall: float = 0.95, hashes: int = 1, seed: int = 20, vec_id: str = "vec_id",
            embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for every row of ``table`` for which ``is_query`` (a condition on vec_id) holds.

    Without ``probes`` their number follows from the counted rows and ``recall`` (see ``probes_for``).
    """
    rows = written(vectors(table, vec_id, embedding), "vectors")
    members = written(_besides_any(rows, "vec", [F.col("vec_id")], k).withColumnsRenamed({"_own": "copy", "_at": "n"}), "vector-classes")
    # numbered in the order of their smallest ids, which several classes share if an id has several vectors
    classes = written(members.where("n = 1").orderBy("vec_id", "vec").select(F.monotonically_increasing_id().alias("id"), "vec"), "class-numbers")
    if probes is None:
        counted, size = classes.agg(F.count("*"), F.max(F.length("vec") / 8)).first()
        probes = probes_for(counted, int(size or 1), k, tables, recall)
    asked = written(rows.where(is_query).distinct().join(classes.withColumnRenamed("id", "class"), "vec").select(F.col("vec_id").alias("query_id"), "class"), "queries")
    wanted = asked.select(F.col("class").alias("id")).distinct()
    queries = written(classes.join(wanted, "id").select("id", "vec"), "query-vectors")

    keep = k + 1 + SPARE
    parts = [_keyed(frame, seed, tables, hashes, n, False).groupBy("key").agg(F.count("*").alias(name)) for frame, n, name in ((classes, 1, "n_data"), (queries, probes, "n_queries"))]
    pairs = _in_blocks(_keyed(queries, seed, tables, hashes, probes, True), _keyed(classes, seed, tables, hashes, 1, True), parts[0].join(parts[1], "key"), keep)
    # a class comes from every table at most once, so so many rows hold at least ``keep`` different classes
    found = written(_top(_top(pairs, "query", keep * tables).drop("rank").groupBy("query", "vec_id").agg(F.max("score").alias("score")), "query", keep).drop("rank"), "found")

    size = F.length("vec").cast("string")
    members_of = members.join(classes.select(F.col("id").alias("class"), "vec"), "vec").select("class", "vec_id", "copy")
    answer = _expand(found, members_of, k)
    total = members.groupBy(size.alias("key")).agg(F.count("*").alias("there"))
    own = members.where(is_query).groupBy(size.alias("key"), F.col("vec_id").alias("query_id")).agg(F.count("*").alias("own"), F.count_if(F.col("copy") == 1).alias("own_classes"))
    here = _others(asked, answer).groupBy("query_id", "class").agg(F.count("*").alias("here"))
    lacking = (asked.join(queries.select(F.col("id").alias("class"), "vec", size.alias("key")), "class").join(total, "key").join(own, ["key", "query_id"], "left").join(here, ["query_id", "class"], "left")
               .where(F.coalesce("here", F.lit(0)) < F.least(F.lit(k), F.col("there") - F.coalesce("own", F.lit(0)))))
    short = written(lacking.groupBy(F.col("class").alias("id"), "vec", "key").agg(F.max(F.coalesce("own_classes", F.lit(1))).alias("own_classes")), "short")
    most = short.agg(F.max("own_classes")).first()[0]
    if most is not None:
        short = short.select("key", "id", "vec")
        keep = k + most + SPARE  # the classes of a query's own id may all come first
        data = classes.withColumn("key", size)
        counts = data.groupBy("key").agg(F.count("*").alias("n_data")).join(short.groupBy("key").agg(F.count("*").alias("n_queries")), "key")
        again = written(_top(_in_blocks(short, data.select("key", "id", "vec"), counts, keep), "query", keep).drop("rank"), "found")
        found = found.join(short.select(F.col("id").alias("query")), "query", "left_anti").unionByName(again)
        answer = _expand(found, members_of, k)
    each = _others(asked, answer).groupBy("query_id", "of", "vec_id", "copy").agg(F.max("score").alias("score"))  # a row once, if a query id has several vectors
    return _top(each.select("query_id", "vec_id", "score"), "query_id", k).select("query_id", "rank", "vec_id", "score")


def _others(asked: DataFrame, answer: DataFrame) -> DataFrame:
    """Answers to the class of every query, without rows of its own id."""
    return asked.join(answer.withColumnRenamed("query", "class"), "class").where("vec_id <> query_id")


def _expand(found: DataFrame, members_of: DataFrame, k: int) -> DataFrame:
    """Enough of the nearest rows of each query class, from its nearest classes ``of``, for ``k`` besides any one id."""
    rows = found.select("query", F.col("vec_id").alias("class"), "score").join(members_of, "class").select("query", F.col("class").alias("of"), "vec_id", "copy", "score")
    return _besides_any(rows, "query", [F.desc("score"), F.col("vec_id")], k).drop("_own", "_at")
