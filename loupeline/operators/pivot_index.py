"""Exact nearest bank vectors through a pivot index: cells around pivots, visited only if the triangle inequality allows a better hit.

The bank of a category is partitioned around pivots, which are bank vectors themselves (those of the smallest hashes of their
numbers): every vector belongs to the cell of its nearest pivot, and a cell knows its radius, the largest distance from its pivot. A query
first visits the cell of its nearest pivot. The distance found there bounds the answer, so a second visit is due only to cells whose pivot is
no farther than that bound and the radius together. Both visits are joins on (category, cell), cut into blocks of bounded
size on both sides, so a crowded cell is spread over tasks; only the best hit of a query in a block leaves its task.

The pivots (at most ``pivots`` per category) are shipped to tasks when their bytes are under the limit that the caller checks.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loupeline.session import sized, written

ROUNDING = 1e-7  # room for rounding, as a share of the norms involved


def choose_pivots(bank: DataFrame, category: str, pivots: int) -> DataFrame:
    """``category, vec_id, embedding`` of the pivots. Hash order makes the choice the same on every run."""
    order = F.struct(F.xxhash64("vec_id").alias("h"), "vec_id")
    cells = bank.withColumn("_part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(64)))  # a crowded category is ranked in 64 places first
    first = cells.withColumn("_n", F.row_number().over(Window.partitionBy(category, "_part").orderBy(order))).where(F.col("_n") <= pivots)
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(category).orderBy(order))).where(F.col("_n") <= pivots).select(category, "vec_id", "embedding")


def _lengths(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances, wrong by no more than ``ROUNDING`` of the norms."""
    squares = (vectors ** 2).sum(1)[:, None] - 2 * vectors @ points.T + (points ** 2).sum(1)[None, :]
    return np.sqrt(np.maximum(squares, 0))


def placed(rows: DataFrame, category: str, shared, matrix, unit: bool) -> DataFrame:
    """Bank vectors with ``_cell`` and ``_far``, the distance from its pivot."""
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for value, part in frame.groupby(category):
                far = _lengths(matrix(part["embedding"], unit), shared.value[value])
                cell = far.argmin(1)
                yield part.assign(_cell=cell.astype(np.int64), _far=far[np.arange(len(cell)), cell])

    return rows.mapInPandas(place, f"{', '.join(f'{n} {k}' for n, k in rows.dtypes)}, _cell bigint, _far double")


def visits(queries: DataFrame, category: str, shared, radii, matrix, unit: bool, bounded: bool) -> DataFrame:
    """Queries with ``_cell``: the nearest pivot's, or (``bounded``, by column ``distance``) all other cells that may hold a better hit."""
    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for value, part in frame.groupby(category):
                if value not in shared.value:
                    continue
                points = matrix(part["embedding"], unit)
                far = _lengths(points, shared.value[value])
                home = far.argmin(1)
                if not bounded:
                    yield part.assign(_cell=home.astype(np.int64))
                    continue
                room = ROUNDING * (1 + np.linalg.norm(points, axis=1)[:, None] + np.linalg.norm(shared.value[value], axis=1)[None, :])
                due = far - radii.value[value][None, :] <= part["distance"].to_numpy()[:, None] + room
                due[np.arange(len(home)), home] = False
                row, cell = np.nonzero(due)
                yield part.drop(columns=["distance"]).iloc[row].assign(_cell=cell.astype(np.int64))

    kept = [(n, k) for n, k in queries.dtypes if n != "distance"]
    return queries.mapInPandas(plan, f"{', '.join(f'{n} {k}' for n, k in kept)}, _cell bigint")


def search(queries: DataFrame, bank: DataFrame, category: str, schema: str, match, matrix, unit: bool, pivots: int, block_rows: int, broadcast_bytes: int,
           count: list | None = None) -> DataFrame | None:
    """Best hits ``(vec_id, category, bank_id, distance)`` by ``match(queries, bank)`` inside blocks; None if the pivots are over the limit.

    ``distance`` of ``match`` is Euclidean (of unit vectors if ``unit``). ``count`` receives the visits' frames with the distances they take.
    """
    spark = queries.sparkSession
    chosen = written(choose_pivots(bank, category, pivots), "pivots")
    rows, width = chosen.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    if rows * width * 8 > broadcast_bytes:
        return None
    table = {value: matrix(part.sort_values("vec_id")["embedding"], unit) for value, part in chosen.toPandas().groupby(category)}
    shared = spark.sparkContext.broadcast(table)
    held = written(placed(bank, category, shared, matrix, unit), "bank-cells")
    radii = {value: np.full(len(points), -np.inf) for value, points in table.items()}
    for r in held.groupBy(category, "_cell").agg(F.max("_far").alias("far")).collect():  # at most one row per pivot
        radii[r[category]][r["_cell"]] = r["far"]
    far = spark.sparkContext.broadcast(radii)

    def joined(visiting: DataFrame, name: str) -> DataFrame:
        def cut(frame, part):
            return frame.groupBy(category, "_cell").agg(F.count(F.lit(1)).alias(f"{part}_n"), F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias(part))

        sizes = sized(cut(visiting, "_chunks").join(cut(held, "_blocks"), [category, "_cell"]), "cell-blocks")
        if count is not None:
            count.append(sizes.select((F.col("_chunks_n") * F.col("_blocks_n")).alias("distances")))
        on = [category, "_cell"]
        mine = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = visiting.join(sizes, on).withColumns({"_q": mine("_chunks"), "_b": every("_blocks")}).select(*on, "_q", "_b", "vec_id", "embedding")
        right = held.join(sizes, on).withColumns({"_b": mine("_blocks"), "_q": every("_chunks")}).select(*on, "_q", "_b", "vec_id", "embedding")
        keys = (*on, "_q", "_b")
        partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(match, schema)
        return written(partial.groupBy("vec_id", category).agg(F.min(F.struct("distance", "bank_id")).alias("best")).select("vec_id", category, "best.bank_id", "best.distance"), name)

    first = joined(written(visits(queries, category, shared, far, matrix, unit, False), "first-visits"), "first-hits")
    again = queries.join(first.select("vec_id", category, "distance"), ["vec_id", category])
    second = joined(written(visits(again.select(*queries.columns, "distance"), category, shared, far, matrix, unit, True), "second-visits"), "second-hits")
    best = first.unionByName(second).groupBy("vec_id", category).agg(F.min(F.struct("distance", "bank_id")).alias("best"))
    return best.select("vec_id", category, "best.bank_id", "best.distance")
