"""Running counts per category with triggers: milestones, recalibrations, shadow verdicts.

Each micro-batch is counted inside its tasks first; only one small row per (category, task) reaches the state, so a
category that holds most of the stream is no hot key.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def reached_milestone(labeled: int, first: int = 40, step: int = 20, knee: int = 100, late: int = 40) -> int:
    """Highest milestone at or below ``labeled``, 0 before the first one."""
    if labeled < first:
        return 0
    turn = first + max(0, -(-(knee - first) // step)) * step
    return first + (labeled - first) // step * step if labeled < turn else turn + (labeled - turn) // late * late


def partial_counts(source: DataFrame, key: str, flag: str) -> DataFrame:
    """Rows per key with ``flag`` set, counted per Arrow batch without a shuffle."""
    kind = dict(source.dtypes)[key]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            sums = frame.groupby(key, as_index=False)[flag].sum().rename(columns={flag: "n"})
            yield sums.astype({"n": "int64"})

    return source.select(key, flag).mapInPandas(count, f"{key} {kind}, n bigint")


def counted_triggers(source: DataFrame, key: str, flag: str, level: Callable[[int], int], start: int, name: str) -> DataFrame:
    """Emits ``(key, total, name)`` whenever ``level(total)`` passes the level of the last emission."""
    kind = dict(source.dtypes)[key]

    def update(group, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total, last = state.get if state.exists else (0, start)
        total += int(sum(frame["n"].sum() for frame in frames))
        now = level(total)
        fired = now > last
        state.update((total, max(now, last)))
        yield pd.DataFrame({key: [group[0]], "total": [total], name: [now]} if fired else {key: [], "total": [], name: []}).astype(
            {"total": "int64", name: "int64"})

    return partial_counts(source, key, flag).groupBy(key).applyInPandasWithState(
        update, f"{key} {kind}, total bigint, {name} bigint", "total bigint, last bigint", "append", GroupStateTimeout.NoTimeout)


def milestone_stream(source: DataFrame, key: str = "category", flag: str = "labeled_ng") -> DataFrame:
    """Training milestones as the labelled NG count of a category crosses them."""
    return counted_triggers(source, key, flag, reached_milestone, 0, "milestone")


def recalibration_stream(source: DataFrame, key: str = "category", flag: str = "labeled_ng", every: int = 5) -> DataFrame:
    """A recalibration at the first sight of a category and whenever its NG count enters a new multiple of ``every``."""
    return counted_triggers(source, key, flag, lambda total: total // every, -1, "multiple")


def shadow_stream(source: DataFrame, key: str = "model", flag: str = "valid_ng", min_ng: int = 10, max_batches: int = 5) -> DataFrame:
    """One row per model when its shadow evidence suffices: enough valid reviewed NG or enough micro-batches."""
    kind = dict(source.dtypes)[key]

    def update(group, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ng, batches, done = state.get if state.exists else (0, 0, False)
        ng, batches = ng + int(sum(frame["n"].sum() for frame in frames)), batches + 1
        due = not done and (ng >= min_ng or batches >= max_batches)
        state.update((ng, batches, done or due))
        rows = [(group[0], ng, batches)] if due else []
        yield pd.DataFrame(rows, columns=[key, "shadow_ng", "shadow_batches"]).astype({"shadow_ng": "int64", "shadow_batches": "int64"})

    return partial_counts(source, key, flag).groupBy(key).applyInPandasWithState(
        update, f"{key} {kind}, shadow_ng bigint, shadow_batches bigint", "ng bigint, batches bigint, done boolean", "append",
        GroupStateTimeout.NoTimeout)
