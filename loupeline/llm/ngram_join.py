"""Jaccard join of documents on their sets of word n-grams, by signature trees under exact segment keys.

The top level is distributed. Sizes fall into classes, whose upper bounds grow by ``GROWTH``; two linked sets are compared in the class of the
larger. If sets of a class link, they differ in at most d hashes (which follows from the class's upper bound), so of d + 1 segments into which
their hashes are dealt at least one is equal on both sides. A set therefore goes under one key for each segment of its own class, and of the
next one if a linked set may be so large. Members of a key are compared by signature trees (``signature_tree``) and what is left by whole sets
(``set_links``); no link is lost, and only a forest of the links is made.

Words are split at ASCII white space, A-Z lower-cased. Fewer words than an n-gram are one n-gram of all; null texts and texts without
words have empty sets and link with nothing, not even each other. Equal sets are one node. Documents without an id take part, but are nobody's
smallest. Repeated rows are separate documents with one id. Other columns are ignored, whatever their names.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from loupeline.llm import common, set_links
from loupeline.llm.components import components
from loupeline.llm.signature_tree import Share
from loupeline.session import written

GROWTH = 1.5


def _bounds() -> np.ndarray:
    """Upper bounds of the size classes."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * GROWTH)))
    return np.array(out, dtype=np.int64)


BOUNDS = _bounds()


def segments(upper: np.ndarray, share: Share) -> np.ndarray:
    """One more than the most hashes in which two linked sets of at most these sizes differ."""
    p, q = share
    return (q - p) * 2 * upper // (p + q) + 1


def segment_keys(hashes: np.ndarray, first: np.ndarray, share: Share) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets, one set after the other, and how many each has."""
    sizes = np.diff(first)
    some = np.flatnonzero(sizes)
    lowest = np.searchsorted(BOUNDS, sizes[some])
    highest = np.searchsorted(BOUNDS, sizes[some] * share[1] // share[0])
    reach = highest - lowest + 1
    owner, kind = np.repeat(some, reach), np.repeat(lowest, reach) + np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach)
    parts = segments(BOUNDS[kind], share)
    base = np.cumsum(parts) - parts
    # every hash of a set, once for every class the set belongs to
    copies = sizes[owner]
    slot = np.repeat(np.arange(len(owner)), copies)
    item = hashes[first[owner][slot] + np.arange(len(slot)) - (np.cumsum(copies) - copies)[slot]]
    spread = common.mixed(item ^ np.uint64(0x9FB21C651E98DF25))
    at = base[slot] + (spread % parts[slot].astype(np.uint64)).astype(np.int64)
    sums = np.zeros(int(parts.sum()), dtype=np.uint64)
    np.add.at(sums, at, common.mixed(spread ^ np.uint64(0xD1B54A32D192ED03)))
    part = np.arange(len(sums)) - np.repeat(base, parts)
    salt = (np.repeat(kind, parts).astype(np.uint64) << np.uint64(40)) + part.astype(np.uint64)
    per_set = np.zeros(len(sizes), dtype=np.int64)
    np.add.at(per_set, owner, parts)
    return common.mixed(sums ^ common.mixed(salt)), per_set


def near_duplicates(docs: DataFrame, share: Share, text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, n_shingles`` (size of the set) and ``component_id`` (smallest doc_id reachable over links) of every document."""
    marked = written(set_links.signatures(docs, text, shingle), "signatures")
    row = F.min(F.struct(set_links.position().alias("ord"), "body")).alias("row")
    one = marked.where("size > 0").groupBy("node").agg(row, F.min("doc_id").alias("head"))
    nodes = written(one.select("node", F.col("node").alias("label"), "head", "row.ord", "row.body"), "shingle-nodes")
    keys = set_links.keyed(docs, text, shingle, lambda hashes, first: segment_keys(hashes, first, share))
    parts = components(set_links.links(docs, text, marked, nodes, keys, share, shingle))
    rooted = nodes.select("node", "head").join(parts, "node", "left").select("node", "head", F.coalesce("root", "node").alias("root"))
    rooted = written(rooted, "node-roots")
    least = rooted.groupBy("root").agg(F.min("head").alias("component_id"))
    classes = written(rooted.join(least, "root").select("node", "component_id"), "node-classes")
    empty = F.col("size") == 0
    told = marked.select("doc_id", "size", F.when(empty, F.xxhash64("doc_id", "body")).otherwise(F.col("node")).alias("node"))  # empty ones meet nobody, and not in one place
    return told.join(classes, "node", "left").select("doc_id", F.col("size").alias("n_shingles"), F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
