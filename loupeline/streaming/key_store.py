"""A store of accepted content whose keys lie in hash buckets with Bloom filters, so that a micro-batch reads only buckets it may repeat.

Every micro-batch is a part of the store: its accepted rows, its keys by bucket, and one Bloom array per bucket. A key sets ``PROBES`` bits of one
64-bit word of its bucket's array. The next micro-batch looks its keys up in the arrays of all parts, which are a few bytes per key, and reads the
keys of just those buckets of those parts where all bits are set; there the keys themselves decide, so a wrong guess of a filter costs a read and
never a row. What a micro-batch reads of the keys does not grow with the buckets it leaves alone.

``compact`` merges the keys of older parts into one. A part is rewritten only by a replay of its own micro-batch, and a stream may only replay its last one,
so the last part of every stream is never merged. A merge is published by its own rows in ``merged``; readers leave the merged parts out.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loupeline.session import scratch
from loupeline.streaming.ingest import run_available, stream_id

BUCKETS, WORDS, PROBES = 64, 4096, 4
PART = ("stream_id", "batch_id")


def bucket_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def word_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(1)), F.lit(WORDS)).cast("int")


def mask_of(keys: Sequence[str]) -> Column:
    h = F.xxhash64(*keys, F.lit(2))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(PROBES)]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def bloom_arrays(rows: DataFrame) -> DataFrame:
    """``bucket, bits`` from rows with bucket, word and mask: one array of ``WORDS`` words per bucket."""
    words = rows.groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits"))
    held = F.map_from_entries(F.collect_list(F.struct("word", "bits")))  # at most WORDS entries
    return words.groupBy("bucket").agg(held.alias("_held")).select("bucket", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.coalesce(F.element_at("_held", i), F.lit(0).cast("bigint"))).alias("bits"))


class KeyStore:
    """Folder with ``rows``, ``keys``, ``filters`` and ``merged``; ``on`` are the key columns, ``first`` decides between equal keys of a micro-batch."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, on: Sequence[str] = ("category", "sha256"), first: str = "sample_id"):
        self.spark, self.folder, self.on, self.first, self.schema = spark, folder.rstrip("/"), list(on), first, schema
        self.key_schema = ", ".join(f"{n} {k}" for n, k in spark.createDataFrame([], schema).select(*on).dtypes)
        self.reads: list[list[tuple]] = []  # the (stream_id, batch_id, bucket) that each micro-batch read, for those who watch it

    def _read(self, what: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{what}"
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        return self.spark.createDataFrame([], schema)

    def rows(self) -> DataFrame:
        """All accepted rows."""
        return self._read("rows", f"{self.schema}, stream_id string, batch_id bigint").drop(*PART)

    def _keys(self, parts: Iterable[str]) -> DataFrame:
        """Keys of some parts or of buckets of them."""
        base = f"{self.folder}/keys"
        given = self.spark.read.option("basePath", base).schema(f"{self.key_schema}, stream_id string, batch_id bigint, bucket int")
        return given.parquet(*(f"{base}/{part}" for part in parts)).select(*self.on)

    def _live(self, parts: DataFrame) -> DataFrame:
        merged = self._read("merged", "stream_id string, batch_id bigint, into string")
        return parts.join(merged.select(*PART).distinct(), list(PART), "left_anti")

    def filters(self) -> DataFrame:
        """``stream_id, batch_id, bucket, bits`` of all live parts."""
        return self._live(self._read("filters", "bucket int, bits array<bigint>, stream_id string, batch_id bigint"))

    def accept(self, batch: DataFrame, own: str, batch_id: int) -> None:
        """Stores the rows of a micro-batch whose keys no other part has."""
        keys, rest = self.on, [c for c in batch.columns if c not in (*self.on, self.first)]
        path = scratch(self.spark, "incoming")
        least = batch.groupBy(*keys).agg(F.min(F.struct(self.first, *rest)).alias("_row")).select(*keys, "_row.*")
        least.withColumns({"bucket": bucket_of(keys), "word": word_of(keys), "mask": mask_of(keys)}).write.parquet(path)
        new = self.spark.read.parquet(path)
        others = self.filters().filter(~((F.col("stream_id") == own) & (F.col("batch_id") == batch_id)))
        probed = others.select(*PART, "bucket", F.posexplode("bits").alias("word", "bits")).filter("bits <> 0").join(new.select("bucket", "word", "mask"), ["bucket", "word"])
        # parts and buckets, not keys: what a compacted store has few of
        hits = sorted(tuple(r) for r in probed.filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select(*PART, "bucket").distinct().collect())
        self.reads.append(hits)
        fresh = new
        if hits:
            held = self._keys(f"stream_id={s}/batch_id={b}/bucket={k}" for s, b, k in hits)
            fresh = new.join(held, keys, "left_anti")
        self._store(fresh, batch.columns, own, batch_id)

    def _store(self, fresh: DataFrame, columns: Sequence[str] | None, own: str, batch_id: int) -> None:
        part = f"stream_id={own}/batch_id={batch_id}"
        if columns is not None:
            path = f"{self.folder}/rows/{part}"
            fresh.select(*columns).write.mode("overwrite").parquet(path)
            stored = self.spark.read.schema(self.schema).parquet(path).select(*self.on)
        else:
            stored = fresh.select(*self.on)
        placed = stored.withColumns({"bucket": bucket_of(self.on), "word": word_of(self.on), "mask": mask_of(self.on)})
        placed.select(*self.on, "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/keys/{part}")
        bloom_arrays(placed).write.mode("overwrite").parquet(f"{self.folder}/filters/{part}")

    def compact(self) -> int:
        """Merges the keys of all live parts but the last of each stream into one part; returns how many parts were merged."""
        live = self.filters().select(*PART).distinct()
        last = live.filter("batch_id >= 0").groupBy("stream_id").agg(F.max("batch_id").alias("last"))
        old = [tuple(r) for r in live.join(last, "stream_id", "left").filter("last is null or batch_id < last").select(*PART).collect()]
        if len(old) < 2:
            return 0
        into = f"merged-{uuid.uuid4().hex}"
        self._store(self._keys(f"stream_id={s}/batch_id={b}" for s, b in old), None, into, -1)  # negative: not a micro-batch, nobody replays it
        rows = self.spark.createDataFrame([(s, b, into) for s, b in old], "stream_id string, batch_id bigint, into string")
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/merged")
        return len(old)


def ingest_bucketed(source: DataFrame, store: KeyStore, checkpoint: str, watch: Callable[[int], None] | None = None) -> StreamingQuery:
    """Every content of a stream once, across restarts and streams of the same store."""
    def accept(batch: DataFrame, batch_id: int) -> None:
        store.accept(batch, stream_id(batch.sparkSession, checkpoint), batch_id)
        if watch is not None:
            watch(batch_id)

    return run_available(source.writeStream.foreachBatch(accept), checkpoint)
