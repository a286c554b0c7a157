"""Count-driven micro-batch ingestion: every content is accepted once per category, across restarts."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loupeline.functions.decisions import utc_text


def stream_files(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int) -> DataFrame:
    """Parquet files of a folder as a stream; ``files_per_trigger`` sets the size of a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Processes everything that is there now and stops; the checkpoint makes the next run continue after it."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_dedup(source: DataFrame, output: str, checkpoint: str, on=("category", "sha256")) -> StreamingQuery:
    """Stateful form: keys live in the state store. Content may return at any time, so there is no watermark and the
    state grows with the distinct content; ``ingest_against_store`` keeps it in a table."""
    return run_available(source.dropDuplicates(list(on)).writeStream.format("parquet").option("path", output), checkpoint)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity that Spark keeps in a checkpoint: the same after a restart, another for a new checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def ingest_against_store(source: DataFrame, store: str, checkpoint: str, on=("category", "sha256"), first: str = "sample_id") -> StreamingQuery:
    """Table form: each micro-batch keeps what no other micro-batch of any stream has stored.

    A micro-batch owns the folder of its stream and number, so a replay rewrites its own rows only, and a stream with a
    new checkpoint adds to the store instead of replacing it. Of equal contents the smallest ``first`` is accepted, whatever
    the order of arrival inside the micro-batch. Only the key columns of the store are read.
    """
    keys = list(on)
    rest = [c for c in source.columns if c not in (*keys, first)]
    # an empty part gives the store its schema before anything is accepted
    source.sparkSession.createDataFrame([], source.schema).write.mode("overwrite").parquet(f"{store}/stream_id=none/batch_id=-1")

    def accept(batch: DataFrame, batch_id: int) -> None:
        own = stream_id(batch.sparkSession, checkpoint)
        least = F.min(F.struct(first, *rest)).alias("_row")
        others = batch.sparkSession.read.schema(f"{batch.schema.simpleString()[7:-1].replace(':', ' ')}, stream_id string, batch_id bigint").parquet(store).filter(
            ~((F.col("stream_id") == own) & (F.col("batch_id") == batch_id)))
        fresh = batch.groupBy(*keys).agg(least).select(*keys, "_row.*").join(others.select(*keys), keys, "left_anti")
        fresh.select(*batch.columns).write.mode("overwrite").parquet(f"{store}/stream_id={own}/batch_id={batch_id}")

    return run_available(source.writeStream.foreachBatch(accept), checkpoint)


def event_log(source: DataFrame, log: str, checkpoint: str, event: str, columns: list[str], at: str | None = None) -> StreamingQuery:
    """Append-only event log, one folder per stream and micro-batch so that a replay replaces its own events only. ``at`` names the column
    with the time of an event; it is logged as UTC text."""
    stamp = [utc_text(at).alias("at")] if at else []

    def append(batch: DataFrame, batch_id: int) -> None:
        own = stream_id(batch.sparkSession, checkpoint)
        batch.select(F.lit(event).alias("event"), *stamp, *columns).write.mode("overwrite").parquet(f"{log}/stream_id={own}/event_batch={batch_id}")

    return run_available(source.writeStream.foreachBatch(append), checkpoint)
