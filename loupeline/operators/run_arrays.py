"""Run tables as numpy arrays: what a task does with the whole images (or bands of image rows) that Spark dealt to it.

Runs travel as stacks ``(keys..., y, y1, x0, x1)``, equal runs on the rows y..y1, and are laid out row by row only here, a bounded number
at a time. So neither a shuffle nor a sort of Spark's ever holds a row per run.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BAND = 256  # image rows that are worked on together: images of any height are cut into such bands
CHUNK = 1 << 18  # runs laid out at once, or those of one larger band


def dealt(runs: DataFrame, keys: Sequence[str], values: Sequence[str] = (), band: int | None = BAND, reach: tuple | None = None,
          together: bool = False) -> DataFrame:
    """Stacks ``(keys, _band, y, y1, x0, x1, values)`` with all of a band in one partition, side by side.

    Stacks are cut at bands; with ``reach`` (first and last row) they are sent whole to every band that these rows meet. Without ``band`` an
    image is one unit; ``together`` brings the bands of an image to one partition as well, one after the other. The shuffle key is a hash, so
    that no earlier partitioning is taken for it.
    """
    kind = dict(runs.dtypes)["y"]
    last = F.col("y1") if "y1" in runs.columns else F.col("y")
    rows = runs.select(*keys, "y", last.cast(kind).alias("y1"), "x0", "x1", *values)
    if band is None:
        cut = rows.withColumn("_band", F.lit(0).cast("bigint"))
    else:
        low, high = reach or (F.col("y"), F.col("y1"))
        cut = rows.withColumn("_band", F.explode(F.sequence(F.floor(low / band), F.floor(high / band))))
        if reach is None:
            first = F.col("_band") * band
            cut = cut.withColumns({"y": F.greatest(F.col("y"), first).cast(kind), "y1": F.least(F.col("y1"), first + (band - 1)).cast(kind)})
    unit = [*keys] if band is None else [*keys, "_band"]
    return cut.select(*keys, "_band", "y", "y1", "x0", "x1", *values).repartition(F.xxhash64(*(keys if together else unit))).sortWithinPartitions(*unit)


def codes(rows: pa.Table, name: str) -> np.ndarray:
    """A number from 0 for every distinct value of a column, null among them."""
    return rows.column(name).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)


def _starts(rows: pa.Table, unit: Sequence[str]) -> np.ndarray:
    """Whether a row begins a new unit."""
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for name in unit:
        own = codes(rows, name)
        new[1:] |= own[1:] != own[:-1]
    return new


def whole(batches: Iterator[pa.RecordBatch], unit: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of complete units that have about ``CHUNK`` runs (or rows, where they are no stacks), and the first row of each unit. A unit that a
    batch cuts waits for its other rows."""
    def parts(rows: pa.Table) -> Iterator[tuple[pa.Table, np.ndarray]]:
        first = np.flatnonzero(_starts(rows, unit))
        stop = np.append(first[1:], len(rows))
        runs = np.cumsum(rows.column("y1").to_numpy() - rows.column("y").to_numpy() + 1)[stop - 1] if "y1" in rows.column_names else stop  # up to the end of each unit
        at = 0
        while at < len(first):
            end = max(at + 1, int(np.searchsorted(runs, (runs[at - 1] if at else 0) + CHUNK, side="right")))
            yield rows.slice(first[at], stop[end - 1] - first[at]), first[at:end] - first[at]
            at = end

    held: list[pa.RecordBatch] = []  # rows of one unit
    for batch in batches:
        if not batch.num_rows:
            continue
        joint = pa.Table.from_batches([*(b.slice(b.num_rows - 1) for b in held[-1:]), batch])
        new = np.flatnonzero(_starts(joint, unit)[1 if held else 0:])
        if not len(new):  # more of the same unit
            held.append(batch)
            continue
        done = pa.Table.from_batches([*held, batch.slice(0, new[-1])])
        if len(done):
            yield from parts(done)
        held = [batch.slice(new[-1])]
    if held:
        yield from parts(pa.Table.from_batches(held))


def numbers(rows: pa.Table, *names: str) -> list[np.ndarray]:
    return [rows.column(n).to_numpy().astype(np.int64) for n in names]


def units(rows: pa.Table, first: np.ndarray) -> np.ndarray:
    """Number of every row's unit."""
    return np.repeat(np.arange(len(first)), np.diff(np.append(first, len(rows))))


def laid_out(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stack and the image row of every run of stacks that go from ``low`` to ``high``; none where ``high`` is less."""
    n = np.maximum(high - low + 1, 0)
    which = np.repeat(np.arange(len(n)), n)
    return which, low[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


class Rows:
    """Numbers for (unit, image row) and for places on them, so that one sort orders the runs of many images."""

    def __init__(self, unit: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray):
        self.y, self.x = int(y.min()), int(x0.min())
        self.height, self.span = int(y.max()) - self.y + 1, int(x1.max()) - self.x + 4

    def number(self, unit: np.ndarray, y: np.ndarray) -> np.ndarray:
        return unit * self.height + (y - self.y)

    def place(self, unit: np.ndarray, y: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self.number(unit, y) * self.span + (x - self.x)

    def back(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """unit, y, x"""
        row, x = np.divmod(place, self.span)
        unit, y = np.divmod(row, self.height)
        return unit, y + self.y, x + self.x


def merged(unit: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Disjoint runs that do not touch, in the order of (unit, y, x0)."""
    rows = Rows(unit, y, x0, x1)
    start, end = rows.place(unit, y, x0), rows.place(unit, y, x1)
    order = np.argsort(start)
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1] + 1)))
    unit, y, low = rows.back(start[first])
    return unit, y, low, low + end[np.append(first[1:] - 1, len(end) - 1)] - start[first]


def painted(unit: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray, rank: np.ndarray) -> tuple[Rows, np.ndarray, np.ndarray]:
    """Stretches between neighbouring ends of runs: their places (one more than stretches) and the highest ``rank`` (from 0) on each, -1 for none."""
    rows = Rows(unit, y, x0, x1)
    start, end = rows.place(unit, y, x0), rows.place(unit, y, x1) + 1
    places = np.sort(np.concatenate((start, end)))
    places = places[np.append(True, places[1:] != places[:-1])]
    order = np.argsort(rank.astype(np.min_scalar_type(rank.max())), kind="stable")  # small ranks are sorted digit by digit
    low, high, rank = np.searchsorted(places, start)[order], np.searchsorted(places, end)[order] - 1, rank[order]
    top, at, covered = np.full(len(places), -1, dtype=np.int64), 0, np.cumsum(high - low + 1)
    while at < len(rank):  # written in the order of ranks, so that the last one stays, and a bounded number at a time
        stop = max(at + 1, int(np.searchsorted(covered, (covered[at - 1] if at else 0) + 4 * CHUNK, side="right")))
        which, place = laid_out(low[at:stop], high[at:stop])
        top[place] = rank[at:stop][which]
        at = stop
    return rows, places, top


def per_image(placed: DataFrame, keys: Sequence[str], work: Callable, made: str, then: tuple[Callable, str] | None = None) -> DataFrame:
    """``keys`` and the ``made`` columns: ``work`` gets the rows of complete units and each unit's first row and returns, for every row it makes, its
    unit and its columns as arrays. ``then`` is a second such pair that gets what the first made of complete images, in the same task; their
    bands have to be dealt ``together``."""
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
    keys = list(keys)
    steps = [([*keys, "_band"], work, made), *([(keys, *then)] if then else [])]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema if f.name in keys), steps[-1][2]])

    def step(batches: Iterator[pa.RecordBatch], unit_keys: list[str], work: Callable, made: str) -> Iterator[pa.RecordBatch]:
        names, types = zip(*(part.strip().split(" ") for part in made.split(",")))
        types = [kinds[t] for t in types]
        for rows, first in whole(batches, unit_keys):
            unit, columns = work(rows, first)
            for at in range(0, len(unit), 1 << 17):  # what goes back is bounded as well
                part = slice(at, at + (1 << 17))
                own = rows.select(keys).take(pa.array(first[unit[part]])).combine_chunks()
                arrays = [own.column(k).combine_chunks() for k in keys] + [pa.array(c[part]).cast(t) for c, t in zip(columns, types)]
                yield pa.RecordBatch.from_arrays([a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays], names=[*keys, *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps:
            batches = step(batches, *part)
        return batches

    return placed.mapInArrow(run, schema)
