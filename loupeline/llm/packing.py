"""Best-fit packing of tokenised documents into training sequences by exact complements.

Documents become token ids and an end id; longer ones are cut into pieces of the sequence length. Packing is planned on the
histogram of piece lengths, which has at most ``size`` entries however large the corpus is: from the longest length
down, the gap a piece leaves is looked up among the sums of one, two and three available lengths; a combination that
fills it exactly is used as often as the counts allow. Only when there is none does the longest fitting length go in
(best fit), and the rest of the gap is looked up again. The plan is a short list of patterns with repetitions.

Every piece then finds its own place without meeting the others: its rank among the pieces of its length selects the
pattern, the repetition and the offset. Ranks are counted inside hash cells whose offsets are added up, so a length that
a third of all pieces share is spread over all tasks. Full pieces need no rank.

Null and empty texts are the end id alone. Repeated rows are packed each. Extra columns are not carried; ``doc_id`` may be null.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from loupeline.llm import common
from loupeline.session import written

PLAIN = "\t-\r -~À-ÖØ-öø-ÿ"  # characters that normalisation leaves alone but for case
_OTHER = re.compile(f"[^{PLAIN}]|<\\|")
_UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")  # the vocabulary's own pre-token rule on PLAIN

SLICE_BYTES = 1 << 19  # text that is encoded at once
LEARN_WORDS = 1 << 13  # new words that the tokenizer gets at once


class WordTokens:
    """Token ids of whole texts for a vocabulary whose tokens never cross white space, with a memory of words.

    A word is what stands between ASCII white space; it is remembered by a 64-bit hash. New words of plain characters are
    encoded together and told apart by their word-end tokens, all others are given to the tokenizer as they stand.
    ``keep`` bounds the memory: beyond so many words it starts anew.
    """

    def __init__(self, path: str, keep: int = 1_500_000):
        from tokenizers import Tokenizer
        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(names.values()) + 1, dtype=bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.hashes, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted by hash
        self.start, self.length, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Remember words whose hashes, in rising order, are new. A part at a time: an encoding holds its tokens and their places as objects."""
        for at in range(0, len(words), LEARN_WORDS):
            self._learn(hashes[at:at + LEARN_WORDS], words[at:at + LEARN_WORDS])

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain = np.array([_OTHER.search(word) is None for word in words])
        easy = [word for word, is_plain in zip(words, plain) if is_plain]
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(easy)], add_special_tokens=False)[0].ids, dtype=np.uint32)
        units = np.cumsum([0] + [len(_UNITS.findall(word.lower())) for word in easy])
        cuts = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])
        if len(cuts) != units[-1] + 1:
            raise ValueError("the vocabulary has no word ends for its pre-tokens")
        hard = [self.tokenizer.encode(word, add_special_tokens=False).ids for word, is_plain in zip(words, plain) if not is_plain]
        length = np.empty(len(words), dtype=np.int64)
        length[plain], length[~plain] = np.diff(cuts[units]), [len(x) for x in hard]
        start = np.empty(len(words), dtype=np.int64)
        start[plain], start[~plain] = cuts[units[:-1]], len(ids) + np.cumsum(length[~plain]) - length[~plain]
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.row = np.insert(self.hashes, at, hashes), np.insert(self.row, at, len(self.start) + np.arange(len(words)))
        self.start, self.length = np.concatenate([self.start, len(self.flat) + start]), np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, ids, *(np.array(x, dtype=np.uint32) for x in hard)])

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids begin (one entry more than texts)."""
        group = common.Group(texts, common.NOT_SPACE, lower=False)
        distinct, first, which = np.unique(group.hashes(), return_index=True, return_inverse=True)
        if len(self.hashes) > self.keep:
            self.forget()
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        new = first[~known]
        if len(new):
            data = group.data.tobytes()
            self.learn(distinct[~known], [data[a:b].decode() for a, b in zip(group.start[new].tolist(), group.end[new].tolist())])
            at = np.searchsorted(self.hashes, distinct)
        at = self.row[at][which] if len(which) else np.zeros(0, np.int64)
        length = self.length[at]
        ends = np.concatenate([[0], np.cumsum(length)])
        ids = self.flat[np.repeat(self.start[at] - ends[:-1], length) + np.arange(ends[-1])]
        return ids, ends[group.first]


_known: dict[str, WordTokens] = {}


def tokens(path: str) -> WordTokens:
    """One memory per Python worker."""
    if path not in _known:
        _known[path] = WordTokens(path)
    return _known[path]


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, keep_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in common.slices(batch, "text", SLICE_BYTES):
                ids, first = tokens(tokenizer).encode(common.raw(part.column("text")))
                rows, bodies = [], []
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), first[:-1], first[1:]):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    for k in range(0, len(own), size):
                        body = own[k:k + size]
                        rows.append((doc_id, k // size, k, len(body), zlib.crc32(body.tobytes())))
                        if keep_ids:
                            bodies.append(body.astype(np.int32))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    columns.append(pa.array(bodies, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.bounded(rows).mapInArrow(run, schema)


class Plan:
    """Patterns of lengths that share a sequence, found on a histogram of lengths."""

    def __init__(self, counts: dict[int, int], size: int):
        self.size = size
        self.left = [0] * (size + 1)
        for length, n in counts.items():
            self.left[length] = n
        self.patterns: list[tuple[list[int], int]] = []  # lengths, longest first, and repetitions
        self._index()
        for longest in range(size, 0, -1):
            while self.left[longest]:
                self._place(longest)

    def _index(self) -> None:
        """Sums of one, two and three available lengths as bit sets; bit s is set if some combination sums to s."""
        full = (1 << (self.size + 1)) - 1
        self.known = [n for n in range(1, self.size + 1) if self.left[n]]
        one = sum(1 << n for n in self.known)
        two = three = 0
        for n in self.known:
            two |= one << n & full
        for n in self.known:
            three |= two << n & full
        self.sums = (one, two, three)

    def _enough(self, lengths: list[int]) -> bool:
        return all(self.left[n] >= lengths.count(n) for n in set(lengths))

    def _exact(self, held: list[int], gap: int) -> list[int] | None:
        """One, two or three available lengths that fill the gap exactly, the longest possible first."""
        one, two, three = self.sums
        if one >> gap & 1 and self._enough([*held, gap]):
            return [gap]
        if two >> gap & 1:
            for b in reversed(self.known):
                if b < gap and b * 2 >= gap and one >> (gap - b) & 1 and self._enough([*held, b, gap - b]):
                    return [b, gap - b]
        if three >> gap & 1:
            for b in reversed(self.known):
                if b < gap and b * 3 >= gap and two >> (gap - b) & 1:
                    for c in reversed(self.known):
                        d = gap - b - c
                        if c <= b and 0 < d <= c and self.left[d] and self._enough([*held, b, c, d]):
                            return [b, c, d]
        return None

    def _place(self, longest: int) -> None:
        lengths, gap = [longest], self.size - longest
        while gap:
            found = self._exact(lengths, gap)
            if found is None:
                fit = next((n for n in reversed(self.known) if n <= gap and self._enough([*lengths, n])), None)
                if fit is None:
                    break
                found = [fit]
            lengths += found
            gap -= sum(found)
        times = min(self.left[n] // lengths.count(n) for n in set(lengths))
        self.patterns.append((lengths, times))
        for n in lengths:
            self.left[n] -= times
        if not all(self.left[n] for n in lengths):
            self._index()

    def slots(self) -> dict[str, np.ndarray]:
        """For ranges of ranks within a length: the pattern's first sequence, uses per sequence and first offset there."""
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        for lengths, times in self.patterns:
            offset = 0
            for n in dict.fromkeys(lengths):
                uses = lengths.count(n)
                rows.append((n, taken.get(n, 0), sequence, uses, offset))
                taken[n] = taken.get(n, 0) + uses * times
                offset += uses * n
            sequence += times
        rows.sort()
        return dict(zip(("length", "rank", "sequence", "uses", "offset"), np.array(rows, dtype=np.int64).reshape(-1, 5).T))


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: sequences hold at most ``size`` ids and are filled from 0 without gaps."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, size, end_id, keep_ids).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    short, full = cut.where(F.col("length") < size), cut.where(F.col("length") == size)
    total = short.count()
    cells = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total >> 15)
    ranked = short.withColumn("_cell", F.pmod(F.xxhash64("_row"), F.lit(cells)).cast("int"))
    counts = written(ranked.groupBy("length", "_cell").agg(F.count("*").alias("_n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most size - 1 rows
    slots = Plan(histogram, size).slots()
    sequences = 1 << 40  # numbers of full pieces follow those of the plan

    before = F.sum("_n").over(W.partitionBy("length").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("length", "_cell", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("length", "_cell").orderBy("_row")) - 1
    ranked = ranked.withColumn("_in_cell", place).join(offsets, ["length", "_cell"]).withColumn("_rank", F.col("_before") + F.col("_in_cell"))
    names = [c for c in cut.columns if c != "_row"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema if f.name != "_row") + ", sequence_id bigint, offset bigint"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = slots["length"] * (1 << 48) + slots["rank"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(starts, length * (1 << 48) + rank, side="right") - 1
            again, use = np.divmod(rank - slots["rank"][at], slots["uses"][at])
            columns = [batch.column(c) for c in names] + [pa.array(slots["sequence"][at] + again), pa.array(slots["offset"][at] + use * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    placed = ranked.select(*names, "_rank").mapInArrow(assign, schema)
    return placed.unionByName(full.select(*names, (F.col("_row") + sequences).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")))
