"""Links between sets of word shingles that meet under common keys, as a forest of verified links.

Whatever makes the keys (segments of the sets, MinHash bands), two sets of a key whose similarity reaches the share end up connected:

1. Keys whose members are one already are left out, and of keys with the same members one is kept.
2. The members of a key are dealt to blocks of at most ``BLOCK``, each with the key's first member besides. A block finds its candidate
   pairs with a signature tree over bitmaps and sends on a spanning forest of them, at most one pair per member.
3. One such pair of every node is compared by whole sets, and pairs that link join their classes (star contraction); then the other pairs
   whose ends are still in two classes. A node without a candidate has no link: no whole set is made for it.
4. What this leaves open is settled exactly: keys of several blocks whose members are still in several classes, and keys with a pair that
   looked similar but was not. Their members with candidates are dealt to blocks again, a class of many members to blocks of its own, and every two
   blocks meet unless both hold one and the same class. Such a task holds about ``2 * MEETING * ROOM`` hashes, compares members of
   different classes until they are joined, and sends on a forest.

Joins whose small side grows with the corpus are asked to sort and merge, so that nothing is broadcast on its size of the day.

No task ever holds a whole key, and no step emits all pairs of one. Work beyond step 2 grows with the members outside a key's largest
class: a key whose members stay in many large classes costs as many block meetings as it has pairs of blocks.

Sets are compared by 64-bit hashes of their shingles, and equal sets are one node with a 64-bit number.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loupeline.llm import common, signature_tree
from loupeline.llm.components import components
from loupeline.session import written

BLOCK = 256
MEETING, ROOM = 256, 1024  # sets of up to so many hashes in a block of a meeting; a larger set counts as several
SEEN = 1 << 20
LAST = (1 << 63) - 1


def sets(texts: list[bytes | None], shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Different shingle hashes of every text in ascending order, one text after the other, and where each text's begin.

    Words are split at ASCII white space, A-Z lower-cased. Fewer words than a shingle are one shingle of all; no words give none.
    """
    group = common.Group(texts, common.NOT_SPACE, lower=True)
    words = np.diff(group.first)
    count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    owner = np.repeat(np.arange(len(texts)), count)
    start = group.first[:-1][owner] + np.arange(len(owner)) - (np.cumsum(count) - count)[owner]
    hashes = common.Grams(group.hashes(), 4)(start, start + np.minimum(shingle, words[owner]))
    order = np.lexsort((hashes, owner))
    hashes = hashes[order]  # owners are in order already
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.searchsorted(owner[fresh], np.arange(len(texts) + 1))


def numbers(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number of every set; equal sets have equal ones."""
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(common.mixed(hashes ^ np.uint64(0x2545F4914F6CDD1D)))])
    return common.mixed(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


class _Seen:
    """Nodes that a task has had lately, so that copies in one task are worked on once."""

    def __init__(self):
        self.nodes: set[int] = set()

    def fresh(self, nodes: np.ndarray) -> np.ndarray:
        """Flags of the first of each node."""
        out = np.zeros(len(nodes), dtype=bool)
        if len(self.nodes) > SEEN:
            self.nodes.clear()
        for i, node in enumerate(nodes.tolist()):
            if node not in self.nodes:
                self.nodes.add(node)
                out[i] = True
        return out


def signatures(docs: DataFrame, text: str, shingle: int, more: dict[str, tuple[str, Callable]] | None = None) -> DataFrame:
    """``doc_id, body`` (hash of the text), ``node`` (number of its set), ``size``, ``low`` (its least hash) and ``bits`` (bitmap; null for a
    copy in the same task). ``more`` adds columns that are made from the texts."""
    more = more or {}
    given = docs.select("doc_id", F.xxhash64(F.col(f"`{text}`").cast("string")).alias("body"), F.col(f"`{text}`").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            for part in common.slices(batch, "_text"):
                texts = common.raw(part.column("_text"))
                hashes, first = sets(texts, shingle)
                node = numbers(hashes, first).view(np.int64)
                low = np.append(hashes, np.uint64(0))[first[:-1]].view(np.int64)
                bits = [b if new else None for b, new in zip(signature_tree.bitmaps(hashes, first), seen.fresh(node))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("body"), *(pa.array(make(texts)) for _, make in more.values()),
                                                  pa.array(node), pa.array(np.diff(first)), pa.array(low), pa.array(bits, pa.binary())], names=["doc_id", "body", *more, "node", "size", "low", "bits"])

    added = "".join(f"{name} {kind}, " for name, (kind, _) in more.items())
    return common.bounded(given).mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, body bigint, {added}node bigint, size bigint, low bigint, bits binary")


def keyed(docs: DataFrame, text: str, shingle: int, keys_of: Callable) -> DataFrame:
    """``key, node`` of every set that holds something; copies in one task are one. ``keys_of`` takes all hashes and where each set begins, and returns
    the keys, one set after the other, and how many each set has. Keys are made again whenever they are read; that is cheaper than to store them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            for part in common.slices(batch, "_text"):
                hashes, first = sets(common.raw(part.column("_text")), shingle)
                node = numbers(hashes, first).view(np.int64)
                new = seen.fresh(node)
                size = np.diff(first)
                first = np.concatenate([[0], np.cumsum(size[new])])
                keys, count = keys_of(hashes[np.repeat(new, size)], first)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.repeat(node[new], count))], names=["key", "node"])

    return common.bounded(docs.select(F.col(f"`{text}`").cast("string").alias("_text"))).mapInArrow(run, "key bigint, node bigint")


def position():
    """Order of a document: its number, those without one last."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST))


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of every group; groups follow each other in a partition."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(c).to_numpy() for c in by]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for column in names:
            change |= column[1:] != column[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]])
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            key = tuple(column[x] for column in names)
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(x, y - x))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _whole_sets(docs: DataFrame, text: str, chosen: DataFrame, shingle: int, name: str) -> DataFrame:
    """``node, hashes`` of the ``chosen`` nodes (node, ord, body), from their first documents."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "_text"):
                hashes, first = sets(common.raw(part.column("_text")), shingle)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([hashes[x:y].tobytes() for x, y in zip(first[:-1], first[1:])], pa.binary())], names=["node", "hashes"])

    body = F.col(f"`{text}`").cast("string")
    texts = docs.select(position().alias("ord"), F.xxhash64(body).alias("body"), body.alias("_text")).join(chosen.hint("merge"), ["ord", "body"]).select("node", "_text")
    return written(common.bounded(texts).mapInArrow(whole, "node bigint, hashes binary").dropDuplicates(["node"]), name)


def _common(x: bytes, y: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))


def _in_block(share: signature_tree.Share):
    """Forests of the candidate pairs of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for block in runs(batches, ["key", "chunk"]):
            node, low, size, label = (block.column(c).to_numpy() for c in ("node", "low", "size", "label"))
            if len(node) > 1:
                a, b = signature_tree.candidates(block.column("bits").to_pylist(), size, np.argsort(low.view(np.uint64), kind="stable"), share)
                u, v = signature_tree.forest(a, b, np.unique(label, return_inverse=True)[1])
                us.append(node[u])
                vs.append(node[v])
            if sum(map(len, us)) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["a", "b"])
                us, vs = [], []
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["a", "b"])

    return run


def _in_meeting(share: signature_tree.Share):
    """Forests of the links of every two blocks that meet, by whole sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(batches, ["task"]):
            node, label = block.column("node").to_numpy(), block.column("label").to_numpy()
            held = [np.frombuffer(h, dtype=np.uint64) for h in block.column("hashes").to_pylist()]
            size = np.array([len(h) for h in held])
            first = np.concatenate([[0], np.cumsum(size)])
            bits = signature_tree.bitmaps(np.concatenate(held), first)
            a, b = signature_tree.candidates(bits, size, np.argsort(np.array([h[0] for h in held]), kind="stable"), share)
            u, v = signature_tree.forest(a, b, np.unique(label, return_inverse=True)[1], lambda x, y: bool(signature_tree.enough(_common(held[x], held[y]), size[x], size[y], share)))
            yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v])], names=["u", "v"])

    return run


def links(docs: DataFrame, text: str, marked: DataFrame, nodes: DataFrame, keys: DataFrame, share: signature_tree.Share, shingle: int) -> DataFrame:
    """Verified links ``u, v`` between nodes that connect all pairs of a common key whose similarity reaches the share.

    ``marked`` (signatures) and ``nodes`` are stored; ``nodes`` has ``node, label`` (nodes of one label count as connected) and ``ord, body`` of
    the node's first document; ``keys`` is as from ``keyed``.
    """
    shared = written(keys.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x <> y").select("key"), "shared-keys")
    met = written(keys.join(shared.hint("merge"), "key").groupBy("key", "node").agg(F.lit(0).alias("_")).select("key", "node"), "keyed-nodes")
    alike = met.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("rep"), F.expr("bit_xor(xxhash64(node))").alias("x"), F.expr("bit_xor(xxhash64(node, 1))").alias("y"))
    kept = written(alike.groupBy("n", "rep", "x", "y").agg(F.min("key").alias("key")).select("key", "n", "rep"), "kept-keys")
    members = written(met.join(kept, "key").join(nodes.select("node", "label"), "node").select("key", "n", "rep", "node", "label"), "key-members")
    open_keys = written(members.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key"), "open-keys")
    members = members.join(open_keys, "key", "left_semi")

    some = members.select("node").distinct()
    drawn = written(marked.where("bits is not null").select("node", "size", "low", "bits").join(some, "node").dropDuplicates(["node"]), "bitmaps")
    chunks = F.ceil(F.col("n") / BLOCK)
    chunk = F.when(F.col("n") <= BLOCK, F.array(F.lit(0).cast("bigint"))).when(F.col("node") == F.col("rep"), F.sequence(F.lit(0).cast("bigint"), chunks - 1)).otherwise(F.array(F.pmod(F.xxhash64("node", "key"), chunks)))
    dealt = members.select("key", "node", "label", F.explode(chunk).alias("chunk")).join(drawn, "node")
    blocks = dealt.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "node")
    pairs = written(common.bounded(blocks).mapInArrow(_in_block(share), "a bigint, b bigint").distinct(), "candidate-pairs")

    # whole sets of all that have a candidate, and of the members of keys too large for one block
    crowded = members.where(F.col("n") > BLOCK)
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).union(crowded.select("node")).distinct()
    held = _whole_sets(docs, text, written(nodes.join(wanted, "node").select("node", "ord", "body"), "compared-texts"), shingle, "compared-sets")
    known = members.where("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v")).distinct()

    # first one pair of every node, then the pairs that are still between two classes
    lead = written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first-pairs")
    judged = _judged(lead, held, share)
    roots = components(judged.where("near").select(F.col("a").alias("u"), F.col("b").alias("v")).union(known))
    rest = written(_apart(pairs.join(lead, ["a", "b"], "left_anti"), roots), "other-pairs")
    if not rest.isEmpty():
        judged = judged.unionByName(_judged(rest, held, share))
        roots = components(judged.where("near").select(F.col("a").alias("u"), F.col("b").alias("v")).union(known))
    found = judged.where("near").select(F.col("a").alias("u"), F.col("b").alias("v"))

    refuted = _apart(judged.where("not near").select("a", "b"), roots).select(F.col("a").alias("node")).distinct()
    doubtful = members.join(refuted, "node", "left_semi").select("key").union(crowded.select("key")).distinct()
    left = members.join(doubtful, "key").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("label"))
    left = written(left.join(held.select("node", F.floor(F.length("hashes") / 8).alias("size")), "node").select("key", "node", "label", "size"), "open-members")
    several = written(left.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key"), "open-keys")
    if several.isEmpty():
        return found
    return found.union(_meetings(written(left.join(several, "key").select("key", "node", "label", "size"), "open-members"), held, share))


def _judged(pairs: DataFrame, held: DataFrame, share: signature_tree.Share) -> DataFrame:
    """``a, b, near``: pairs compared by their whole sets."""
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [bool(signature_tree.enough(_common(x, y), len(x) // 8, len(y) // 8, share)) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(near, pa.bool_())], names=["a", "b", "near"])

    sides = pairs.join(held.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(held.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b").select("a", "b", "x", "y")
    return written(common.bounded(sides).mapInArrow(compared, "a bigint, b bigint, near boolean"), "judged-pairs")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) whose ends have different roots."""
    ends = pairs.join(roots.select(F.col("node").alias("a"), F.col("root").alias("x")), "a", "left").join(roots.select(F.col("node").alias("b"), F.col("root").alias("y")), "b", "left")
    return ends.where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")


def _meetings(members: DataFrame, held: DataFrame, share: signature_tree.Share) -> DataFrame:
    """Links between members (key, node, label, size) of different labels, blocks of a key meeting two by two; ``held`` has their whole sets."""
    # Copies share many keys. Keys with the same members of small classes and the same large classes are one from here on.
    weight = F.sum(F.ceil(F.greatest("size", F.lit(1)) / ROOM)).alias("n")
    sizes = members.groupBy("key", "label").agg(weight, F.expr("bit_xor(xxhash64(node))").alias("nodes"))
    large = F.col("n") >= MEETING
    marks = sizes.groupBy("key").agg(F.bit_xor(F.when(~large, F.col("nodes"))).alias("x"), F.bit_xor(F.when(large, F.xxhash64("label"))).alias("y"))
    one = marks.select("key", F.xxhash64(F.coalesce("x", F.lit(0)), F.coalesce("y", F.lit(0))).alias("one"))
    members = written(members.join(one, "key").select(F.col("one").alias("key"), "node", "label", "size").distinct(), "open-members")
    classes = members.groupBy("key", "label").agg(weight)
    rest = classes.where(F.col("n") < MEETING).groupBy("key").agg(F.sum("n").alias("small"))
    places = written(classes.join(rest, "key", "left").select("key", "label", "n", F.coalesce("small", F.lit(0)).alias("small")), "open-classes")
    own = F.col("n") >= MEETING  # a class of many members has blocks of its own
    block = F.when(own, F.xxhash64(F.lit(1), "label", F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / MEETING)))).otherwise(F.xxhash64(F.lit(0), F.pmod(F.xxhash64("label"), F.ceil(F.col("small") / MEETING))))
    dealt = written(members.join(places, ["key", "label"]).select("key", "node", "label", "size", block.alias("block"), F.when(own, F.col("label")).alias("pure")), "open-blocks")
    blocks = written(dealt.groupBy("key", "block").agg(F.max("pure").alias("pure"), F.min("size").alias("low"), F.max("size").alias("high")), "open-blocks")
    other = blocks.select("key", *(F.col(c).alias(f"{c}_2") for c in ("block", "pure", "low", "high")))
    one_class = F.coalesce(F.col("pure") == F.col("pure_2"), F.lit(False))
    fits = signature_tree.enough(F.least("high", "high_2"), F.col("low"), F.col("low_2"), share)
    meets = blocks.join(other, "key").where((F.col("block") <= F.col("block_2")) & ~one_class & fits)
    tasks = meets.select("key", F.xxhash64("key", "block", "block_2").alias("task"), F.explode(F.array_distinct(F.array("block", "block_2"))).alias("block"))
    seats = written(tasks.join(dealt, ["key", "block"]).select("task", "node", "label"), "open-seats")
    seated = seats.join(held, "node").repartition("task").sortWithinPartitions("task", "node").select("task", "node", "label", "hashes")
    return common.bounded(seated).mapInArrow(_in_meeting(share), "u bigint, v bigint").distinct()
