"""Files as DataFrames: listings, digests, rasters, JSON reports, CSV tables, case folders, manifests."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loupeline.operators.lookups import MASK_DIRECTORIES

# Image suffixes that are listed
IMAGE_SUFFIXES = (".bmp", ".jpeg", ".jpg", ".png", ".tif", ".tiff")


def scan_files(spark: SparkSession, root: str, suffixes: Sequence[str] = IMAGE_SUFFIXES, skip_masks: bool = True) -> DataFrame:
    """Recursive listing ``(path, length, content)``; the bytes are read only where a later column needs them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    kept = files.filter(suffix.isin(*[s.lower() for s in suffixes]))
    if skip_masks:
        kept = kept.filter(~F.arrays_overlap(F.split(F.lower("path"), "/"), F.array(*[F.lit(m) for m in MASK_DIRECTORIES])))
    return kept.select("path", "length", "content")


def content_digest(files: DataFrame) -> DataFrame:
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def scan_raster(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images; unreadable files stay as rows with ``readable = false``."""
    images = spark.read.format("image").option("dropInvalid", "false").option("recursiveFileLookup", "true").load(root)
    return images.select(F.col("image.origin").alias("path"), F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                         F.col("image.nChannels").alias("n_channels"), F.col("image.data").alias("data"), (F.col("image.height") > 0).alias("readable"))


def pixel_digest(rasters: DataFrame) -> DataFrame:
    """Digest of dimensions and decoded pixels: equal for one picture saved under two encodings."""
    size = F.concat_ws("x", "height", "width", "n_channels").cast("binary")
    return rasters.filter("readable").select("path", F.sha2(F.concat(size, "data"), 256).alias("pixel_sha256"))


def raster_runs(rasters: DataFrame, external: bool = True) -> DataFrame:
    """Foreground runs of mask rasters ``(path, y, x0, x1)``, taken from the first channel.

    External masks mark defects dark (< 128), internal masks bright (>= 128). One mask is one bounded image: its edges are found in
    one scan, inside Arrow batches of a few images.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                pixels = np.frombuffer(row["data"], dtype=np.uint8)[:: row["n_channels"]].reshape(row["height"], row["width"])
                framed = np.zeros((row["height"], row["width"] + 2), dtype=np.int8)
                framed[:, 1:-1] = (pixels < 128) if external else (pixels >= 128)
                step = np.diff(framed, axis=1)
                y, first = np.nonzero(step == 1)
                last = np.nonzero(step == -1)[1] - 1
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(y), pa.string()), pa.array(y, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                                                 names=["path", "y", "x0", "x1"])

    return rasters.filter("readable").select("path", "height", "width", "n_channels", "data").mapInArrow(run, "path string, y bigint, x0 bigint, x1 bigint")


REPORT_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()), T.StructField("batch_no", T.LongType()), T.StructField("official_model", T.StringType()),
    T.StructField("rows", T.ArrayType(T.StructType([
        T.StructField("sample_id", T.LongType()), T.StructField("official", T.StringType()), T.StructField("truth", T.StringType()),
        T.StructField("review", T.StringType()), T.StructField("label_source", T.StringType())])))])


def scan_json_reports(spark: SparkSession, path: str, schema: T.StructType = REPORT_SCHEMA, rows: str = "rows", multi_line: bool = False) -> DataFrame:
    """Batch reports by explicit schema, one output row per nested row."""
    reports = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    outer = [c for c in reports.columns if c != rows]
    return reports.select(*outer, F.inline(rows))


def sink_report_json(reports: DataFrame, path: str) -> str:
    """JSON through the commit protocol: readers see a finished report or none."""
    reports.write.mode("overwrite").json(path)
    return path


def sink_table_csv(table: DataFrame, path: str) -> str:
    table.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def sink_cases_partitioned(cases: DataFrame, path: str) -> str:
    """Case rows in one folder per confusion case."""
    cases.write.mode("overwrite").partitionBy("case").parquet(path)
    return path


def append_events(events: DataFrame, path: str) -> str:
    events.write.mode("append").parquet(path)
    return path


def scan_state_table(spark: SparkSession, path: str, category: str | None = None) -> DataFrame:
    """Feedback tables stored by category; a category filter prunes partitions."""
    table = spark.read.parquet(path)
    return table if category is None else table.filter(F.col("category") == category)
