"""Spelling variants: words of a corpus that differ by one code point, found through Bloom filters of the vocabulary.

Words are maximal runs of ``LETTERS``, A-Z lower-cased; the vocabulary holds the words of enough code points and occurrences. Two words are near
if one inserted, deleted or replaced code point makes one of the other. Of each such pair, one side reaches the other by a deletion or
by a replacement with a later letter, so only these edits are generated, from the letters that occur in the vocabulary.

The vocabulary is held in blocked Bloom filters, one for every word length, cut by hash into shards of at most ``SHARD_BYTES``: a word sets
``PROBES`` bits of one 64-bit block. Shards are broadcast in loads of at most ``LOAD_BYTES``, and every load is one pass over the
vocabulary, so what is broadcast is bounded however many words there are. An edit is hashed from its word's hash without being
spelled out; only edits that hit their filter become strings and are joined with the vocabulary, which removes the false ones.

Every letter fits one byte of Latin-1, so words of a length are a byte matrix. A word of any length is handled; its edits are made in
bounded parts. Null or empty texts have no words. Documents without an id count, but lose no letters (see ``thinned``). Repeated rows count each.
Other columns are ignored, whatever their names. A frequent word is one row of pre-aggregated counts.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loupeline.llm import common, url_filter
from loupeline.session import written

LETTERS = "[A-Za-zÀ-ÿ]+"
BITS, PROBES, SHARD_BYTES, LOAD_BYTES = 16, 6, 1 << 16, 32 << 20
TASK_WORDS = 1 << 14  # words whose edits one task probes
PART = 1 << 20  # edits that are made at once
_VALUES = np.random.Generator(np.random.PCG64(20250117)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = common.Powers(common.MULTIPLIER)


def runs(docs: DataFrame, text: str = "text", number: str = "doc_id") -> DataFrame:
    """``doc_id, run``: every run of letters of every text."""
    lowered = F.translate(F.col(f"`{text}`").cast("string"), url_filter.UPPER, url_filter.LOWER)
    return docs.select(F.col(f"`{number}`").cast("string").alias("doc_id"), F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"))


def thinned(found: DataFrame, every: int) -> DataFrame:
    """``word``: the runs, of which one in ``every`` loses a letter; which run and letter follows from the hash of document and run."""
    h, run = F.crc32(F.concat_ws(":", "doc_id", "run")), F.col("run")
    place = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return found.select(F.when(F.col("doc_id").isNotNull() & (h % every == 0), cut).otherwise(run).alias("word"))


def vocabulary(words: DataFrame, letters: int, occurrences: int) -> DataFrame:
    """``word, n`` of the words with at least so many letters and occurrences."""
    return words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= occurrences)


def matrix(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(-1, length)


class Hashes:
    """Hashes of the words of a length and of their edits: a sum over the places of letter value times place power."""

    def __init__(self, letters: np.ndarray):
        self.letters, length = letters, letters.shape[1]
        _powers.reach(length + 1)
        self.terms = _VALUES[letters] * _powers.up[:length]
        self.whole = self.terms.sum(axis=1, dtype=np.uint64)

    def replaced(self, place: int, letter: int) -> np.ndarray:
        return common.mixed(self.whole - self.terms[:, place] + _VALUES[letter] * _powers.up[place:place + 1])

    def deleted(self) -> np.ndarray:
        """A column for every place."""
        after = self.whole[:, None] - np.cumsum(self.terms, axis=1, dtype=np.uint64)
        return common.mixed(self.whole[:, None] - after - self.terms + after * _powers.down[1:2])


def address(hashes: np.ndarray, shards: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard, block inside it, and the bits of the block that a hash sets."""
    second = common.mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    bits = np.zeros(len(hashes), dtype=np.uint64)
    for i in range(PROBES):
        bits |= np.uint64(1) << (second >> np.uint64(6 * i) & np.uint64(63))
    return (hashes % np.uint64(shards)).astype(np.int64), (hashes // np.uint64(shards) % np.uint64(blocks)).astype(np.int64), bits


def layout(counts: dict[int, int]) -> dict[int, tuple[int, int]]:
    """Shards and blocks per shard of every word length."""
    out = {}
    for length, n in counts.items():
        blocks = -(-n * BITS // 64)
        shards = -(-blocks * 8 // SHARD_BYTES)
        out[length] = shards, -(-blocks // shards)
    return out


def filters(words: DataFrame, shape: dict[int, tuple[int, int]]) -> DataFrame:
    """``length, shard, bits``: the filters of the vocabulary."""
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, found in by_length(batch.column("word").to_pylist()):
                shard, block, bits = address(common.mixed(Hashes(matrix(found, length)).whole), *shape[length])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), length)), pa.array(shard), pa.array(block), pa.array(bits.view(np.int64))], names=["length", "shard", "block", "bits"])

    blocks = words.select("word").mapInArrow(placed, "length bigint, shard bigint, block bigint, bits bigint").groupBy("length", "shard", "block").agg(F.bit_or("bits").alias("bits"))

    def joined(key, batch):
        length, shard = (k.as_py() for k in key)
        out = np.zeros(shape[length][1], dtype=np.int64)
        out[batch.column("block").to_numpy()] = batch.column("bits").to_numpy()
        return pa.table({"length": [length], "shard": [shard], "bits": pa.array([out.tobytes()], pa.binary())})

    return blocks.groupBy("length", "shard").applyInArrow(joined, "length bigint, shard bigint, bits binary")


def by_length(words: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    held: dict[int, list[bytes]] = {}
    for word in words:
        if word:
            held.setdefault(len(word), []).append(word.encode("latin-1"))
    for length, found in held.items():
        for at in range(0, len(found), max(1, PART // (8 * length))):
            yield length, found[at:at + max(1, PART // (8 * length))]


def tables(shape: dict[int, tuple[int, int]], load: dict[tuple[int, int], np.ndarray]) -> dict[int, np.ndarray]:
    """Filters of a load by word length, a row per shard; shards of other loads are empty."""
    out = {}
    for (length, shard), bits in load.items():
        out.setdefault(length, np.zeros(shape[length], dtype=np.uint64))[shard] = bits
    return out


def probe(words: list[bytes], length: int, letters: np.ndarray, held: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Places of words, and edits of them that a filter of ``held`` (see ``tables``) has."""
    code = matrix(words, length)
    hashes = Hashes(code)

    def hits(hashed: np.ndarray, size: int) -> np.ndarray:
        shard, block, bits = address(hashed, *held[size].shape)
        return np.flatnonzero(held[size][shard, block] & bits == bits)

    if length - 1 in held:
        deleted = hashes.deleted()
        fresh = np.ones(code.shape, dtype=bool)
        fresh[:, 1:] = code[:, 1:] != code[:, :-1]  # deleting either of two equal letters gives one word
        row, place = np.nonzero(fresh)
        at = hits(deleted[row, place], length - 1)
        yield row[at], [words[r][:p] + words[r][p + 1:] for r, p in zip(row[at].tolist(), place[at].tolist())]
    if length in held:
        for place in range(length):
            for letter in letters:
                row = np.flatnonzero(code[:, place] < letter)
                at = row[hits(hashes.replaced(place, letter)[row], length)]
                if len(at):
                    yield at, [words[r][:place] + bytes([letter]) + words[r][place + 1:] for r in at.tolist()]


def _loads(spark: SparkSession, stored: DataFrame) -> Iterator[dict[tuple[int, int], np.ndarray]]:
    """Filters in groups of at most ``LOAD_BYTES``, and the two lengths that a word may reach kept as near as may be."""
    sizes = stored.select("length", "shard", F.length("bits").alias("bytes")).orderBy("length", "shard").toLocalIterator()
    load, total = [], 0
    for r in sizes:
        if load and total + r.bytes > LOAD_BYTES:
            yield _fetched(stored, load)
            load, total = [], 0
        load.append((r.length, r.shard))
        total += r.bytes
    if load:
        yield _fetched(stored, load)


def _fetched(stored: DataFrame, load: list[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
    (low, first), (high, last) = load[0], load[-1]  # loads are ranges in order
    after = (F.col("length") > low) | (F.col("length") == low) & (F.col("shard") >= first)
    before = (F.col("length") < high) | (F.col("length") == high) & (F.col("shard") <= last)
    return {(r.length, r.shard): np.frombuffer(r.bits, dtype=np.uint64) for r in stored.where(after & before).collect()}


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n`` for every pair of near words, in both directions; ``words`` (word, n) is stored."""
    spark = words.sparkSession
    counts = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()}
    found = None
    if counts:
        shape = layout(counts)
        letters = words.select(F.explode(F.split("word", "")).alias("c")).where("c <> ''").distinct().collect()  # at most the letters of LETTERS
        letters = np.array(sorted(ord(r.c) for r in letters), dtype=np.uint8)
        stored = written(filters(words, shape), "word-filters")
        spread = words.repartition(-(-sum(counts.values()) // TASK_WORDS), "word")  # few bytes, but much work
        for load in _loads(spark, stored):
            held = spark.sparkContext.broadcast(tables(shape, load))

            def probed(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    n = dict(zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()))
                    for length, mine in by_length(list(n)):
                        for at, edits in probe(mine, length, letters, held.value):
                            names = [mine[i].decode("latin-1") for i in at.tolist()]
                            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([n[w] for w in names], pa.int64()), pa.array([e.decode("latin-1") for e in edits], pa.string())], names=["word", "n", "other"])

            hits = written(spread.mapInArrow(probed, "word string, n bigint, other string"), "probed-edits")
            found = hits if found is None else found.unionByName(hits)
            held.unpersist()
    if found is None:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).where("false")
    pairs = written(found.join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other").select("word", "n", "other", "other_n"), "near-words")
    return pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``forms`` (word, form): the end of the chain of forms, by doubling; forms rise, so chains end."""
    now = written(forms.select("word", F.col("form").alias("root")), "word-roots")
    while True:
        over = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(now.join(over, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        if not now.where("moved").limit(1).collect():
            return now.select("word", "root")
        now = now.select("word", "root")


def group(words: DataFrame, rise: int = 2) -> DataFrame:
    """Every word of ``words`` (word, n) with its form, root and counts.

    ``form`` is the near word of the largest n (ties: first in code-point order) if that is at least ``rise`` times the word's own.
    """
    stored = written(words, "vocabulary")
    rank = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("w")))
    best = near_words(stored).groupBy("word").agg(F.count("*").alias("n_near"), rank.alias("best"))
    joined = stored.join(best, "word", "left")
    rises: Column = -F.col("best.m") >= rise * F.col("n")
    told = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(rises, F.col("best.w")).alias("form"), F.when(rises, -F.col("best.m")).alias("form_n")), "word-forms")
    ends = roots(told.where("form is not null"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
