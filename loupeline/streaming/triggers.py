"""Count-driven triggers on Spark's arbitrary state: what has fired, and at which count, is part of the state.

Every category has a value state with its running count and a map state with its firings. A level fires once, whatever the size of the
micro-batches: a micro-batch that passes several levels fires the highest, and a replayed one finds the state as it was. Rows are counted
inside tasks first, so a category with most of the stream sends a few small rows to its state.

These processors need a state store with several states per key; ``state_store`` switches the session to RocksDB for the queries started in it.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loupeline.streaming.counters import partial_counts, reached_milestone

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


class LevelTrigger(StatefulProcessor):
    """Fires ``(key, total, level, firing)`` when ``level_of(total)`` passes the highest level fired so far; ``firing`` numbers them."""

    def __init__(self, key: str, level_of: Callable[[int], int], start: int):
        self.key, self.level_of, self.start = key, level_of, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "total bigint, last bigint")
        self.fired = handle.getMapState("fired", "level bigint", "total bigint, firing bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        total, last = self.count.get() if self.count.exists() else (0, self.start)
        total += int(sum(frame["n"].sum() for frame in rows))
        level = self.level_of(total)
        if level > last and not self.fired.containsKey((level,)):
            firing = 1 + sum(1 for _ in self.fired.keys())
            self.fired.updateValue((level,), (total, firing))
            yield pd.DataFrame({self.key: [key[0]], "total": [total], "level": [level], "firing": [firing]})
        self.count.update((total, max(level, last)))

    def close(self) -> None:
        pass


class ShadowTrigger(StatefulProcessor):
    """Fires ``(key, shadow_ng, shadow_batches)`` once per model, with the first micro-batch that brings enough evidence.

    The evidence of every micro-batch stays in the map state until the verdict is due.
    """

    def __init__(self, key: str, min_ng: int, max_batches: int):
        self.key, self.min_ng, self.max_batches = key, min_ng, max_batches

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.done = handle.getValueState("done", "done boolean")
        self.evidence = handle.getMapState("evidence", "batch bigint", "ng bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = int(sum(frame["n"].sum() for frame in rows))
        if self.done.exists():
            return
        held = [row[0] for row in self.evidence.values()]
        ng, batches = sum(held) + new, len(held) + 1
        if ng >= self.min_ng or batches >= self.max_batches:
            self.done.update((True,))
            self.evidence.clear()
            yield pd.DataFrame({self.key: [key[0]], "shadow_ng": [ng], "shadow_batches": [batches]})
        else:
            self.evidence.updateValue((batches,), (new,))

    def close(self) -> None:
        pass


def level_firings(source: DataFrame, key: str, flag: str, level_of: Callable[[int], int], start: int) -> DataFrame:
    """Every firing of a level: ``(key, total, level, firing)``."""
    kind = dict(source.dtypes)[key]
    counted = partial_counts(source, key, flag)
    return counted.groupBy(key).transformWithStateInPandas(LevelTrigger(key, level_of, start), f"{key} {kind}, total bigint, level bigint, firing bigint", "Append", "None")


def milestone_firings(source: DataFrame, key: str = "category", flag: str = "labeled_ng") -> DataFrame:
    return level_firings(source, key, flag, reached_milestone, 0)


def recalibration_firings(source: DataFrame, key: str = "category", flag: str = "labeled_ng", every: int = 5) -> DataFrame:
    return level_firings(source, key, flag, lambda total: total // every, -1)


def shadow_firings(source: DataFrame, key: str = "model", flag: str = "valid_ng", min_ng: int = 10, max_batches: int = 5) -> DataFrame:
    kind = dict(source.dtypes)[key]
    counted = partial_counts(source, key, flag)
    return counted.groupBy(key).transformWithStateInPandas(ShadowTrigger(key, min_ng, max_batches), f"{key} {kind}, shadow_ng bigint, shadow_batches bigint", "Append", "None")
