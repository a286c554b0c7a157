"""Frames kept by the identity of what they were made from: read if they are there, computed if not.

A frame is written under a fresh name first and then published by one row in the manifest, which is one small file and so appears as a whole or
not at all. A run that is lost between the two leaves an unnamed frame that nobody reads. Two runs that publish the same identity hold equal
frames; readers take the first by name. Nothing is ever changed in place.

``get`` keeps one frame per identity. ``get_groups`` keeps a frame's groups by identities of their own, so that a changed group is computed
alone. Identities are texts: a fingerprint of the members and of the settings that shaped the frame.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "name string, identity string, grp string, path string"


def table_identity(table: DataFrame) -> str:
    """Identity of the files a table is read from: names, sizes and times of change, summed so that no list of them is gathered."""
    files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    n, a, b = files.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(*))"), F.expr("sum(cast(xxhash64(*, 1) as decimal(38, 0)))")).first()
    return f"{n}:{a}:{b}"


class FrameStore:
    """Store in a folder that every executor reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.computed: list[tuple[str, str]] = []  # what this object had to compute: (name, group or identity)

    def manifest(self) -> DataFrame:
        path = f"{self.folder}/manifest"
        try:
            return self.spark.read.schema(MANIFEST).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        self.spark.createDataFrame([], MANIFEST).write.mode("append").parquet(path)
        return self.spark.read.schema(MANIFEST).parquet(path)

    def _publish(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")

    def get(self, name: str, identity: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The frame ``name`` of ``identity``."""
        known = self.manifest().filter((F.col("name") == name) & (F.col("identity") == identity)).agg(F.min("path")).first()[0]
        if known is None:
            made, known = build(), f"{self.folder}/{name}/{uuid.uuid4().hex}"
            made.write.parquet(known)
            self._publish([(name, identity, None, known)])
            self.computed.append((name, identity))
        return self.spark.read.parquet(known)

    def get_groups(self, name: str, identities: DataFrame, group: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rows of all groups of ``identities`` (group, identity). ``build`` gets the groups (column ``group``) whose identity is not in the store.

        There are few groups, such as categories; their names and identities are read by the driver, their rows are not.
        """
        kept = self.manifest().filter(F.col("name") == name).groupBy(F.col("grp").alias(group), "identity").agg(F.min("path").alias("path"))
        wanted = identities.select(F.col(group).cast("string").alias(group), "identity").join(kept, [group, "identity"], "left").collect()
        kind = dict(identities.dtypes)[group]
        missing = [r for r in wanted if r["path"] is None]
        paths = [(r[group], r["path"]) for r in wanted if r["path"] is not None]
        if missing:
            groups = self.spark.createDataFrame([(r[group],) for r in missing], f"{group} string").select(F.col(group).cast(kind).alias(group))
            path = f"{self.folder}/{name}/{uuid.uuid4().hex}"
            build(groups).write.parquet(path)
            self._publish([(name, r["identity"], r[group], path) for r in missing])
            self.computed += [(name, r[group]) for r in missing]
            paths += [(r[group], path) for r in missing]
        out = None
        for path in sorted({p for _, p in paths}):
            own = self.spark.read.parquet(path).filter(F.col(group).cast("string").isin(*[g for g, p in paths if p == path]))
            out = own if out is None else out.unionByName(own)
        return out if out is not None else build(self.spark.createDataFrame([], f"{group} {kind}"))
