"""SimHash near-duplicates over a Gray-order hierarchical index.

A fingerprint bit is set if it is set in over half of the XXH64 hashes (seed 42) of a text's word shingles, repeats counted.
Two fingerprints link at ``RADIUS`` or fewer differing bits.

The index works on distinct fingerprints. Its top level is distributed: two fingerprints that differ in two bits agree in
two of their four 16-bit blocks, so each fingerprint goes under the six masked patterns of two blocks, and only members
of one pattern can be compared there. A pattern with more than ``GROUP`` members is divided again by three masked patterns
of its other 32 bits, one of which two near fingerprints also share; what is left then has at most 22 free bits. Inside a
group the fingerprints are sorted by Gray rank, which puts those with equal leading and few changing bits side by side;
runs of ``FAN`` neighbours form a node that holds the bits all its members share, the nodes of a level form nodes again,
and a node stores only the bits its parent does not. A search adds up the differences from the top and drops a whole node once
they exceed the radius. A group returns a spanning forest of its links, never its pairs.

Words are split at ASCII white space and A-Z lower-cased. A text of fewer words than a shingle gives one shingle of all; null texts and
texts without words have fingerprint zero and link like any other. Null ``doc_id`` take part, but are nobody's
smallest. Equal rows are one node. Clashing column names of the input are replaced by the result's.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from loupeline.llm import common, shingles
from loupeline.llm.components import components
from loupeline.llm.signature_tree import Share
from loupeline.session import written

SHINGLE, SEED, RADIUS = 3, 42, 2
GROUP, FAN = 512, 8
PAIRS = ((3, 2), (3, 1), (3, 0), (2, 1), (2, 0), (1, 0))


def fingerprints_of(texts: list[bytes | None], shingle: int = SHINGLE) -> np.ndarray:
    group = common.Group(texts, common.NOT_SPACE, lower=True)
    inside = common.NOT_SPACE[group.data]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    data = group.data[keep]
    data[~inside[keep]] = 0x20  # words are now one space apart
    start, end = common.words(data, common.NOT_SPACE)
    words = np.diff(group.first)
    shingles = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    before = np.cumsum(shingles) - shingles
    owner = np.repeat(np.arange(len(texts)), shingles)
    first = group.first[:-1][owner] + np.arange(len(owner)) - before[owner]
    last = first + np.minimum(shingle, words[owner]) - 1
    joined = data.tobytes()
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(start[first].tolist(), end[last].tolist())), np.uint64, len(first))
    out = np.zeros(len(texts), dtype=np.uint64)
    some = shingles > 0
    if some.any():
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, before[some], axis=0, dtype=np.int64)
        out[some] = np.packbits(2 * ones > shingles[some][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` (or the columns in ``keep``) with ``fp``, the fingerprint as a signed 64-bit number."""
    return common.with_columns(docs, text, docs.columns if keep is None else keep, "fp bigint",
                               lambda texts: [fingerprints_of(texts, shingle).view(np.int64)], 1 << 20)


def gray_rank(value: Column) -> Column:
    """Place of a 64-bit value in the Gray sequence, shifted so that signed order is that of the places."""
    for step in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, step))
    return value.bitwiseXOR(F.lit(-(1 << 63)))


class GrayTree:
    """Hierarchical index of fingerprints that are sorted by Gray rank."""

    def __init__(self, fps: np.ndarray, fan: int = FAN):
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        shared, pattern = np.full(len(fps), full), fps
        self.fan, levels = fan, [(shared, pattern)]
        while len(pattern) > 1:
            cuts = np.arange(0, len(pattern), fan)
            ones, zeros = np.bitwise_and.reduceat(pattern & shared, cuts), np.bitwise_and.reduceat(~pattern & shared, cuts)
            shared, pattern = ones | zeros, ones
            levels.append((shared, pattern))
        self.levels = []  # from the top: bits a node adds to its parent's, and their values
        for depth, (shared, pattern) in enumerate(reversed(levels)):
            above = levels[len(levels) - depth][0][np.arange(len(shared)) // fan] if depth else np.zeros(len(shared), dtype=np.uint64)
            self.levels.append((shared & ~above, pattern))

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Query and member numbers of all pairs within the radius."""
        query, node = np.repeat(np.arange(len(queries)), len(self.levels[0][0])), np.tile(np.arange(len(self.levels[0][0])), len(queries))
        spent = np.zeros(len(query), dtype=np.uint8)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                size = len(mask)
                children = (node[:, None] * self.fan + np.arange(self.fan)).ravel()
                query, spent = np.repeat(query, self.fan), np.repeat(spent, self.fan)
                there = children < size
                query, spent, node = query[there], spent[there], children[there]
            spent = spent + np.bitwise_count((queries[query] ^ pattern[node]) & mask[node])
            near = spent <= radius
            query, node, spent = query[near], node[near], spent[near]
        return query, node


def forest(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, root of its part) that connect exactly the members within chains of near pairs."""
    label, tree = np.arange(len(fps)), GrayTree(fps)
    for at in range(0, len(fps), 128):
        a, b = tree.search(fps[at:at + 128], radius)
        a = a + at
        a, b = a[a < b], b[a < b]
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return fps[moved], fps[label[moved]]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Fingerprints of each group; groups follow each other in a partition."""
    held, key = [], None
    for batch in batches:
        gid, fp = batch.column("gid").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(gid)) + 1, [len(gid)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and gid[a] != key:
                yield np.concatenate(held)
                held = []
            held.append(fp[a:b])
            key = gid[a]
    if held:
        yield np.concatenate(held)


def links(distinct: DataFrame) -> DataFrame:
    """Edges ``u, v`` whose chains join exactly the fingerprints of ``distinct`` (column fp) within chains of links."""
    fp = F.col("fp")
    block = [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]

    def under(t: int, pair: tuple[int, int]) -> Column:
        left = [i for i in range(4) if i not in pair]
        gid = F.lit((t * 4 + 3) << 48) + F.shiftleft(block[pair[0]], 32) + F.shiftleft(block[pair[1]], 16)
        return F.struct(gid.alias("gid"), (F.shiftleft(block[left[0]], 16) + block[left[1]]).alias("rest"))

    keyed = distinct.select("fp", F.explode(F.array(*(under(t, pair) for t, pair in enumerate(PAIRS)))).alias("k")).select("fp", "k.gid", "k.rest")
    crowded = keyed.groupBy("gid").agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(crowded, "gid")
    rest, base = F.col("rest"), F.col("gid") - F.lit(3 << 48)
    parts = F.array(base + F.shiftright(rest, 22), base + F.lit(1 << 48) + F.shiftright(rest, 11).bitwiseAND(F.lit(2047)), base + F.lit(2 << 48) + rest.bitwiseAND(F.lit(2047)))
    spread = members.select("fp", F.explode(F.when(F.col("n") <= GROUP, F.array("gid")).otherwise(parts)).alias("gid"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, n = [], [], 0
        for fps in _runs(batches):
            if len(fps) > 1:
                u, v = forest(fps)
                us.append(u.view(np.int64))
                vs.append(v.view(np.int64))
                n += len(u)
            if n > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])
                us, vs, n = [], [], 0
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    ordered = spread.repartition("gid").sortWithinPartitions("gid", gray_rank(fp)).select("gid", "fp")
    return ordered.mapInArrow(search, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, similarity: Share | None = None) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest doc_id reachable over links, for every document.

    With a ``similarity`` (p, q), texts whose sets of five-word shingles have a Jaccard similarity of at least p / q link too, however far their
    fingerprints are.
    """
    prints = fingerprints(docs, text, ["doc_id"], shingle) if similarity is None else shingles.signatures(docs, text, lambda texts: fingerprints_of(texts, shingle))
    marked = written(prints, "fingerprints")
    heads = written(marked.groupBy("fp").agg(F.min("doc_id").alias("head")), "fingerprint-heads")
    parts = components(links(heads.select("fp")))
    least = (heads.join(parts, heads["fp"] == parts["node"], "left").select("fp", "head", F.coalesce("root", "fp").alias("root")))
    if similarity is not None:
        least = written(least, "fingerprint-roots")
        wider = components(shingles.links(docs, text, marked, least.select("fp", "root"), similarity))
        least = least.join(wider.withColumnRenamed("root", "wider"), least["root"] == wider["node"], "left").select("fp", "head", F.coalesce("wider", "root").alias("root"))
    smallest = least.groupBy("root").agg(F.min("head").alias("component_id"))
    classes = written(least.join(smallest, "root").select("fp", "component_id"), "fingerprint-classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, similarity: Share | None = None) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: that of the smallest doc_id.

    Repeated rows leave one; documents without a doc_id stay unless their rows are equal in text.
    """
    copies = near_duplicates(docs, text, shingle, similarity).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").dropDuplicates(["doc_id", text]).select(*(f"`{c}`" for c in docs.columns))
