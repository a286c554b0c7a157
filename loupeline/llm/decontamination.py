"""Benchmark decontamination with one FM-index per shard of training text.

A shard is a run of documents inside a partition, so nothing is shuffled. Its words become symbols: the words of the test
phrases have numbers, all others end a stretch. The stretches long enough to hold a phrase are indexed; all phrases are
searched backwards at once through wavelet ranks, found ranges are located by walking to sampled positions, and the
occurrences are merged into removal spans. A phrase is ``window`` consecutive words of a test item, or a whole shorter item.

The test set is read in blocks of ``BLOCK_BYTES`` of text; each block is broadcast (its size is bounded by that) and searched in all
documents, and spans and items of the blocks are united, so a larger test set means more passes and no larger broadcast.
Words are compared by 64-bit hashes.

Texts are lower-cased in A-Z; words are runs of digits, letters and all characters beyond ASCII. Null or empty texts have no words; items
without words are ignored; items that share an id count once. Items without an id hit words as all others; together they count as one item,
which is null in ``items``. Repeated documents are treated each. Result names replace clashing input columns.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loupeline.llm import common
from loupeline.llm.fm_index import FMIndex

BLOCK_BYTES = 4 << 20
SHARD_BYTES = 4 << 20
SPANS = "array<struct<first:int,last:int>>"


def by_name(names: set[str | None]) -> list[str | None]:
    """Item names in order, items without one last."""
    return sorted(names, key=lambda name: (name is None, name or ""))


@dataclass(frozen=True)
class Phrases:
    """Distinct phrases of a block of test items."""

    vocabulary: np.ndarray  # sorted word hashes; word k has symbol k + 1
    symbols: np.ndarray  # one row per phrase, padded with zeros
    length: np.ndarray
    first: np.ndarray  # items of phrase p are items[first[p]:first[p + 1]]
    items: np.ndarray
    names: list[str | None]

    @staticmethod
    def of(items: list[tuple[str | None, str]], window: int) -> Phrases:
        group = common.Group([text.encode() for _, text in items], common.WORD_BYTE, lower=True)
        vocabulary, symbol = np.unique(group.hashes(), return_inverse=True)
        names = by_name({name for name, _ in items})
        number = {name: i for i, name in enumerate(names)}
        rows, owners = [], []
        for i, (name, _) in enumerate(items):
            own = symbol[group.first[i]:group.first[i + 1]] + 1
            if 0 < len(own) < window:
                rows.append(np.pad(own, (0, window - len(own)))[None])
            elif len(own):
                rows.append(np.lib.stride_tricks.sliding_window_view(own, window))
            owners += [number[name]] * (len(rows[-1]) if len(own) else 0)
        table = np.concatenate([np.zeros((0, window), dtype=np.int64), *rows])
        distinct, which = np.unique(table, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([which.reshape(-1), np.array(owners, dtype=np.int64)], axis=1), axis=0)
        return Phrases(vocabulary, distinct, (distinct > 0).sum(1), np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1], names)


def search(group: common.Group, phrases: Phrases) -> tuple[np.ndarray, list[list[int]]]:
    """Whether each word of the shard is hit, and the numbers of the items found in each document."""
    n, texts = len(group.start), len(group.first) - 1
    hit, items = np.zeros(n, dtype=bool), [[] for _ in range(texts)]
    if not n or not len(phrases.length):
        return hit, items
    hashes = group.hashes()
    at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    known = phrases.vocabulary[at] == hashes
    # stretches of known words inside one document
    flags = np.zeros(n + 2, dtype=np.int8)
    flags[1:-1] = known
    edges = np.diff(flags)
    inner = group.first[1:-1]
    opens, closes = edges == 1, edges == -1
    split = inner[(inner > 0) & (inner < n)]
    split = split[known[split] & known[split - 1]]
    opens[split] = closes[split] = True
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    long = end - start >= phrases.length.min()
    start, end = start[long], end[long]
    if not len(start):
        return hit, items
    size = end - start + 1  # and a separator
    place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
    text = np.zeros(len(place), dtype=np.int64)
    ends = np.cumsum(size) - 1
    inside = np.ones(len(place), dtype=bool)
    inside[ends] = False
    text[inside] = at[place[inside]] + 1
    index = FMIndex(text, len(phrases.vocabulary))
    which, found = index.locate(*index.find(phrases.symbols, phrases.length))
    word = place[found]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + phrases.length[which], -1)
    hit = np.cumsum(cover)[:-1] > 0
    doc = np.searchsorted(group.first, word, side="right") - 1
    count = np.diff(phrases.first)[which]
    owners = phrases.items[np.repeat(phrases.first[which], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
    for d, i in np.unique(np.stack([np.repeat(doc, count), owners], axis=1), axis=0).tolist():
        items[d].append(i)
    return hit, items


def _spans(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged spans of hit words inside documents: first word and end, counted in the shard, and the number of spans per document."""
    flags = np.zeros(len(hit) + 2, dtype=np.int8)
    flags[1:-1] = hit
    edges = np.diff(flags)
    opens, closes = edges == 1, edges == -1
    inner = first[1:-1]
    split = inner[(inner > 0) & (inner < len(hit))]
    split = split[hit[split] & hit[split - 1]]
    opens[split] = closes[split] = True
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    return start, end, np.diff(np.searchsorted(start, first))


def cut(data: bytes, spans: list[tuple[int, int]]) -> str:
    """Text without the byte ranges, which are in order."""
    parts, at = [], 0
    for a, b in spans:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]]).decode()


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str | None, str]]]:
    """Test items in blocks of bounded size."""
    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).cast("string").alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item"), F.lit(n)) == k)
        yield [(r["item"], r["text"]) for r in part.collect()]


def _pass(docs: DataFrame, phrases: Phrases, text: str, clean: bool) -> DataFrame:
    """Adds the findings of one block to ``n_words``, ``spans`` and ``items`` (and makes ``clean_text`` if asked for)."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", clean_text string" * clean
    pair = pa.struct([("first", pa.int32()), ("last", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            for part in common.slices(batch, text, SHARD_BYTES):
                texts = common.raw(part.column(text))
                group = common.Group(texts, common.WORD_BYTE, lower=True)
                hit, found = search(group, block)
                for d, spans in enumerate(part.column("spans").to_pylist()):
                    for span in spans:
                        hit[group.first[d] + span["first"]:group.first[d] + span["last"]] = True
                start, end, count = _spans(hit, group.first)
                doc = np.repeat(np.arange(len(texts)), count)
                offsets = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
                base = group.first[doc]
                made = {"n_words": pa.array(np.diff(group.first), pa.int64()),
                        "spans": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(start - base, pa.int32()), pa.array(end - base, pa.int32())], fields=list(pair))),
                        "items": pa.array([by_name({*before, *(block.names[i] for i in own)}) for before, own in zip(part.column("items").to_pylist(), found)], pa.list_(pa.string()))}
                columns = [made[c] if c in made else part.column(c) for c in names]
                if clean:
                    a, b = group.start[start] - group.offsets[doc], group.end[end - 1] - group.offsets[doc]
                    cuts = np.concatenate([[0], np.cumsum(count)])
                    columns.append(pa.array([None if t is None else cut(t, list(zip(a[x:y].tolist(), b[x:y].tolist()))) for t, x, y in zip(texts, cuts[:-1], cuts[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *["clean_text"] * clean])

    return common.bounded(docs).mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text",
                  keep: list[str] | None = None, clean: bool = True) -> DataFrame:
    """``docs`` (or the columns in ``keep``) with ``n_words``, ``spans`` of hit words, ``items`` whose phrases occur (sorted as strings), ``n_hit``
    and, if asked for, ``clean_text``: the text without the spans."""
    added = ("n_words", "spans", "items", "n_hit", "clean_text")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("_text"), F.lit(0).cast("bigint").alias("n_words"),
                       F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    pending = None
    for block in _blocks(benchmark, item, item_text):
        if pending is not None:
            rows = _pass(rows, pending, "_text", False)
        pending = Phrases.of(block, window)
    rows = _pass(rows, pending, "_text", clean)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["last"] - s["first"])
    return rows.select(*(F.col(f"`{c}`") for c in kept), "n_words", "spans", "items", n_hit.alias("n_hit"), *["clean_text"] * clean)
