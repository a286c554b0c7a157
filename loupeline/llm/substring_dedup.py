"""Substring deduplication by seeds and extension: words inside a repeated run of at least ``LENGTH`` words are removed.

Seeds are winnowed: of the ``GRAM``-word hashes in every window of ``LENGTH`` words the smallest is the window's anchor, so
equal windows have equal anchors at equal places, and an anchor stands for the stretch of windows that choose it.

1. Anchors that occur once anywhere are dropped: nothing around them repeats.
2. The others are joined on the anchor. Occurrences whose whole stretch is equal (extended both ways as far as the anchor's
   windows go) form a class; all but its earliest are repeats as a whole.
3. Only where one anchor has several classes are the earliest of them compared window by window, which finds how far each
   extends. Repeats of one document that touch or overlap join to maximal ones, and their words are cut.

An anchor shared by thousands of documents costs one row per occurrence, never one per pair; classes are counted with
partial aggregates and occurrences meet their class's single row in joins whose hot keys Spark can split.

Order is (doc_id, first word); a null doc_id comes last. Rows of equal doc_id are one document in that order, so equal rows
do not remove each other. Words are runs without ASCII white space, unchanged; null and empty texts have none. Windows are
compared by 128-bit hashes. Result names replace clashing input columns.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loupeline.llm import common
from loupeline.session import written

LENGTH, GRAM = 20, 8
LAST = (1 << 63) - 1
SPANS = "array<struct<a:int,b:int>>"


def stretches(group: common.Group, hashes: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of every anchor's stretch (as word places in the group), anchor hash and hash of the stretch."""
    n, width = len(hashes), length - gram + 1
    last = np.repeat(group.first[1:], np.diff(group.first))  # end of each word's document
    at = np.arange(n)
    key = common.Grams(hashes, 0)(at, np.minimum(at + gram, n))
    best, span = at, 1
    while span < width:  # leftmost smallest of twice as many, or of the rest
        step = min(span, width - span)
        right = best[np.minimum(at + step, n - 1)] if n else best
        best = np.where(key[right] < key[best], right, best)
        span += step
    start = np.flatnonzero(at + length <= last)
    chosen = best[start]
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)
    a = start[fresh]
    b = start[np.append(np.flatnonzero(fresh)[1:] - 1, len(start) - 1)] if len(start) else a
    anchor = chosen[fresh]
    whole = common.Grams(hashes, 1)(a, b + length)
    return a, b, key[anchor], common.mixed(whole + ((anchor - a) * 1024 + (b - a)).astype(np.uint64))


def _marked(docs: DataFrame, text: str) -> DataFrame:
    """Order and content key of every document; equal rows have equal keys."""
    body = F.col(f"`{text}`").cast("string")
    return docs.select("*", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("_ord"), F.xxhash64(body).alias("_key"), body.alias("_text"))


def _anchors(docs: DataFrame, length: int, gram: int, whole: bool) -> DataFrame:
    """Anchor hashes of all documents; ``whole`` adds the stretch and its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "_text"):
                group = common.Group(common.raw(part.column("_text")), common.NOT_SPACE, lower=False)
                a, b, h, c = stretches(group, group.hashes(), length, gram)
                if not whole:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])
                    continue
                doc = np.searchsorted(group.first, a, side="right") - 1
                base = group.first[doc]
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), part.column("_ord").take(rows), part.column("_key").take(rows),
                                                  pa.array((a - base).astype(np.int32)), pa.array((b - base).astype(np.int32))], names=["h", "c", "_ord", "_key", "a", "b"])

    given = docs.select(*["_ord", "_key"] * whole, "_text")
    return common.bounded(given).mapInArrow(run, "h bigint, c bigint, _ord bigint, _key bigint, a int, b int" if whole else "h bigint")


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """Hash and place of every window of the stretches in ``spans``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "_text"):
                group = common.Group(common.raw(part.column("_text")), common.NOT_SPACE, lower=False)
                hashes = group.hashes()
                one, two = common.Grams(hashes, 2), common.Grams(hashes, 3)
                lists = part.column("spans")
                flat = lists.flatten()
                a, b = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
                doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                count = b - a + 1
                doc, within = np.repeat(doc, count), np.repeat(a, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                place = group.first[doc] + within
                rows = pa.array(doc)
                yield pa.RecordBatch.from_arrays([pa.array(one(place, place + length).view(np.int64)), pa.array(two(place, place + length).view(np.int64)),
                                                  part.column("_ord").take(rows), part.column("_key").take(rows), pa.array(within.astype(np.int32))],
                                                 names=["x", "y", "_ord", "_key", "a"])

    return common.bounded(docs.select("_ord", "_key", "_text", "spans")).mapInArrow(run, "x bigint, y bigint, _ord bigint, _key bigint, a int")


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``_ord, _key, spans``: the repeated word ranges [a, b) of every marked document that has some."""
    # counted sides are stored before they are joined: then both sides of a join are plain exchanges, whose hot keys Spark splits
    often = written(_anchors(docs, length, gram, False).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-anchors")
    seeds = written(_anchors(docs, length, gram, True).join(often, "h"), "seeds")
    classes = written(seeds.groupBy("h", "c").agg(F.min(F.struct("_ord", "a")).alias("first"), F.count("*").alias("n")), "seed-classes")
    several = written(classes.groupBy("h").agg(F.count("*").alias("classes")), "anchor-classes")
    # a class of one row with an anchor of one class cannot be: such anchors were dropped
    told = classes.join(several, "h").select("h", "c", "first", "classes").where("n > 1 or classes > 1")
    met = written(seeds.join(told, ["h", "c"]).select("_ord", "_key", "a", "b", "classes", (F.struct("_ord", "a") == F.col("first")).alias("earliest")), "seed-places")
    surely = met.where("not earliest").select("_ord", "_key", "a", (F.col("b") + length).alias("b"))

    open_ = met.where("earliest and classes > 1").groupBy("_ord", "_key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    windows = written(_windows(docs.select("_ord", "_key", "_text").join(open_, ["_ord", "_key"]), length), "windows")
    first = written(windows.groupBy("x", "y").agg(F.min(F.struct("_ord", "a")).alias("first"), F.count("*").alias("n")).where("n > 1"), "repeated-windows")
    partly = windows.join(first, ["x", "y"]).where(F.struct("_ord", "a") != F.col("first")).select("_ord", "_key", "a", (F.col("a") + length).alias("b"))
    return surely.unionByName(partly).groupBy("_ord", "_key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or the columns in ``keep``) with ``n_words``, ``n_removed`` and ``kept_text``, the text without its repeated words.

    A removed word goes with the white space after it; the rest of the text is unchanged. A null text stays null.
    """
    added = ("n_words", "n_removed", "kept_text")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    marked = _marked(docs, text)
    spans = repeats(marked.select("_ord", "_key", "_text"), length, gram)
    rows = marked.select(*(F.col(f"`{c}`") for c in kept), "_ord", "_key", "_text").join(spans, ["_ord", "_key"], "left")
    rows = rows.select(*(F.col(f"`{c}`") for c in kept), "_text", F.coalesce("spans", F.array().cast(SPANS)).alias("_spans"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in kept), "n_words bigint, n_removed bigint, kept_text string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "_text"):
                texts = common.raw(part.column("_text"))
                group = common.Group(texts, common.NOT_SPACE, lower=False)
                lists = part.column("_spans")
                flat = lists.flatten()
                doc = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
                a, b = (group.first[doc] + flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                cover = np.zeros(len(group.start) + 1, dtype=np.int64)
                np.add.at(cover, a, 1)
                np.add.at(cover, b, -1)
                gone = np.cumsum(cover)[:-1] > 0
                total = np.concatenate([[0], np.cumsum(gone)])
                removed = total[group.first[1:]] - total[group.first[:-1]]
                bodies = [t if not removed[i] else _without(t, group, gone, i) for i, t in enumerate(texts)]
                columns = [part.column(c) for c in kept] + [pa.array(np.diff(group.first), pa.int64()), pa.array(removed, pa.int64()),
                                                            pa.array([None if t is None else t.decode() for t in bodies], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return common.bounded(rows).mapInArrow(run, schema)


def _without(text: bytes, group: common.Group, gone: np.ndarray, i: int) -> bytes:
    """Text of document i without the marked words."""
    first, last = group.first[i], group.first[i + 1]
    start = group.start[first:last] - group.offsets[i]
    flags = np.diff(np.concatenate([[0], gone[first:last].astype(np.int8), [0]]))
    edges = np.append(start, len(text))
    parts, at = [], 0
    for a, b in zip(edges[np.flatnonzero(flags == 1)].tolist(), edges[np.flatnonzero(flags == -1)].tolist()):
        parts.append(text[at:a])
        at = b
    return b"".join([*parts, text[at:]])
