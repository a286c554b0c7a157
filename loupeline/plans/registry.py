"""Registry of named queries and their independent SQL statements."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """Lazy access to one folder of Parquet tables: ``t.orders``, ``t.lineitem``..."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


PLANS: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is the statement checked against it on the same tables."""
    def wrap(build: Callable[[Tables], DataFrame]):
        if name in PLANS:
            raise ValueError(f"duplicate query name: {name}")
        PLANS[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return wrap


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, folder, build=build: build(Tables(spark, folder))) for name, build in PLANS.items()}
