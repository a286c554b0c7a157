"""Shared helpers of the text operators: byte-bounded groups of documents, vectorised words and rolling hashes."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

GROUP_BYTES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C1B  # odd and 3 modulo 8, so that its powers differ in low bits
_MASK = (1 << 64) - 1
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20241130)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
UPPER_TO_LOWER[65:91] += 32
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
WORD_BYTE = np.zeros(256, dtype=bool)  # digits, letters a-z and every byte of a character beyond ASCII
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])


_byte_powers = Powers(MULTIPLIER)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def groups(texts: list[bytes | None], limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that hold ``limit`` bytes, or one longer text."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        size = len(text or b"")
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(texts):
        yield first, len(texts)


def raw(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()


def words(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of bytes of a class."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    step = np.diff(flags)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _byte_powers.reach(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _byte_powers.up[: len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * _byte_powers.down[start])


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, limit: int = GROUP_BYTES) -> np.ndarray:
    """64-bit hash of every word; memory stays bounded by cutting long data between words."""
    if len(data) <= limit:
        return _hashed(data, start, end)
    out, first = np.empty(len(start), dtype=np.uint64), 0
    while first < len(start):
        base = int(start[first])
        last = max(first + 1, int(np.searchsorted(end, base + limit, side="right")))
        out[first:last] = _hashed(data[base:int(end[last - 1])], start[first:last] - base, end[first:last] - base)
        first = last
    return out


class Grams:
    """Hashes of word sequences of any length from prefix sums; ``salt`` gives independent families."""

    def __init__(self, hashes: np.ndarray, salt: int = 0):
        self.powers = _gram_powers.setdefault(salt, Powers((MULTIPLIER * (8 * salt + 1) + 16 * salt) & _MASK | 1))
        self.powers.reach(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * self.powers.up[: len(hashes)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.powers.down[start])


_gram_powers: dict[int, Powers] = {}


class Group:
    """The words of several documents laid out in one buffer, a space after each document.

    ``start`` and ``end`` are byte places in ``data``; ``first[i]:first[i + 1]`` are the words of document i.
    """

    def __init__(self, texts: list[bytes | None], inside: np.ndarray, lower: bool):
        joined = b"".join(part for text in texts for part in (text or b"", b" "))
        self.data = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            self.data = UPPER_TO_LOWER[self.data]
        self.offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t or b"") + 1 for t in texts], out=self.offsets[1:])
        self.start, self.end = words(self.data, inside)
        self.first = np.searchsorted(self.start, self.offsets)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.start, self.end)

    def owner(self) -> np.ndarray:
        """Document of every word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def table(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type)
                                       for n, c in columns.items()], schema=pa.schema([schema.field(n) for n in columns]))


def slices(batch: pa.RecordBatch, column: str, limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch whose texts hold about ``limit`` bytes, or one longer text."""
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield batch.slice(first, i - first)
            first, total = i, 0
        total += int(size)
    if first < len(sizes):
        yield batch.slice(first)


BATCH_BYTES = 8 << 20


def bounded(df: DataFrame) -> DataFrame:
    """``df``, whose session from now on hands Python at most ``BATCH_BYTES`` (or one row) at a time.

    Spark's own bounds, 10,000 rows and 64 MiB, are too much for several copies of a batch of long texts in one executor.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def with_columns(df: DataFrame, text: str, keep: list[str], added: str, compute, limit: int = GROUP_BYTES) -> DataFrame:
    """``keep`` columns of ``df`` and the ``added`` ones that ``compute`` makes from lists of UTF-8 texts.

    Added names replace kept ones. Texts reach ``compute`` in parts of about ``limit`` bytes.
    """
    fields = [part.strip().rsplit(" ", 1) for part in added.split(",")]
    new = [name for name, _ in fields]
    kept = [c for c in keep if c not in new]
    given = df.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").cast("string").alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema if f.name != "_text"), added])
    kinds = {"string": pa.string(), "double": pa.float64(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", limit):
                made = compute(raw(part.column("_text")))
                columns = [pa.array(values, kinds.get(kind)) for values, (_, kind) in zip(made, fields)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *columns], names=[*kept, *new])

    return bounded(given).mapInArrow(run, schema)
