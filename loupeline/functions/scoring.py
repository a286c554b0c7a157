"""Pluggable scorers: a model is loaded once per task and fed Arrow batches."""
from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loupeline.operators.vectors import Bank, nearest_bank


class Scorer(Protocol):
    """What a plugin offers inside a task."""

    def predict(self, frame: pd.DataFrame) -> pd.DataFrame: ...

    def healthcheck(self) -> dict[str, Any]: ...

    def close(self) -> None: ...


def score_with(rows: DataFrame, factory: Callable[[], Scorer], schema: str) -> DataFrame:
    """Scores every row with a scorer built once per task; an unhealthy scorer fails the task, not single rows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = factory()
        try:
            state = scorer.healthcheck()
            if state.get("ok") is not True:
                raise RuntimeError("this task's scorer is not fit to score: " + ", ".join(f"{k}={v}" for k, v in sorted(state.items())))
            for frame in batches:
                yield scorer.predict(frame)
        finally:
            scorer.close()

    return rows.mapInPandas(run, schema)


class PluginError(RuntimeError):
    """A plugin that cannot be loaded, lacks a method, is not fit to score, or returns other columns than it promised."""


def load_plugin(spec: str, config: dict[str, Any]) -> Scorer:
    """The scorer that ``module:function`` makes from ``config``, checked for what a scorer has to offer."""
    module, mark, name = spec.partition(":")
    if not mark or not module or not name:
        raise PluginError(f"a plugin is named module:function, not {spec!r}")
    try:
        factory = getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError) as error:
        raise PluginError(f"plugin {spec} is not there: {error}") from error
    try:
        scorer = factory(config)
    except Exception as error:
        raise PluginError(f"plugin {spec} cannot be made: {type(error).__name__}: {error}") from error
    missing = [m for m in ("predict", "healthcheck", "close") if not callable(getattr(scorer, m, None))]
    if missing:
        raise PluginError(f"plugin {spec} lacks {', '.join(missing)}")
    return scorer


class CheckedScorer:
    """A plugin whose results are compared with the promised columns, from the first batch on."""

    def __init__(self, spec: str, config: dict[str, Any], columns: Sequence[str]):
        self.spec, self.columns, self.inner = spec, list(columns), load_plugin(spec, config)

    def healthcheck(self) -> dict[str, Any]:
        state = self.inner.healthcheck()
        if not isinstance(state, dict):
            raise PluginError(f"the healthcheck of plugin {self.spec} returns {type(state).__name__}, not a dict")
        return state

    def predict(self, frame: pd.DataFrame) -> pd.DataFrame:
        out = self.inner.predict(frame)
        found = sorted(out.columns) if isinstance(out, pd.DataFrame) else None
        if found != sorted(self.columns):
            raise PluginError(f"plugin {self.spec} returns {found or type(out).__name__}, promised are {sorted(self.columns)}")
        if len(out) != len(frame):
            raise PluginError(f"plugin {self.spec} returns {len(out)} rows for {len(frame)}")
        return out[self.columns]

    def close(self) -> None:
        self.inner.close()


def score_with_plugin(rows: DataFrame, spec: str, schema: str, config: dict[str, Any] | None = None) -> DataFrame:
    """Scores ``rows`` with the plugin ``module:function``, which every task resolves for itself; ``schema`` names the columns it returns."""
    columns = rows.sparkSession.createDataFrame([], schema).columns
    settings = dict(config or {})
    return score_with(rows, lambda: CheckedScorer(spec, settings, columns), schema)


class BankScorer:
    """Distance to the nearest bank vector by the same comparison as ``nearest_bank``; the bank arrives as a broadcast of checked size."""

    def __init__(self, shared):
        ids, vectors = shared.value
        self.bank = Bank(np.asarray(vectors, dtype=np.float64), np.asarray(ids)) if len(ids) else None

    def healthcheck(self) -> dict[str, Any]:
        return {"ok": self.bank is not None, "bank": 0 if self.bank is None else len(self.bank.ids)}

    def predict(self, frame: pd.DataFrame) -> pd.DataFrame:
        _, distance = self.bank.best(np.stack(frame["embedding"].to_numpy()).astype(np.float64)) if len(frame) else ([], [])
        return pd.DataFrame({"vec_id": frame["vec_id"], "score": distance})

    def close(self) -> None:
        self.bank = None


def score_against_bank(rows: DataFrame, bank: DataFrame, limit_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """``vec_id, score``: distance to the nearest vector of a bank of any size.

    A bank of a checked size is shipped to the tasks and used by a scorer there; a larger one goes through the blocked join.
    """
    count, width = bank.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    if count * width * 8 > limit_bytes:
        one = F.lit(0).alias("_all")
        hits = nearest_bank(rows.select("vec_id", "embedding", one), bank.select("vec_id", "embedding", one), "_all", broadcast_bytes=limit_bytes)
        return hits.select("vec_id", F.col("distance").alias("score"))
    held = bank.select("vec_id", "embedding").collect()
    shared = bank.sparkSession.sparkContext.broadcast(([r[0] for r in held], [list(r[1]) for r in held]))
    return score_with(rows, lambda: BankScorer(shared), "vec_id bigint, score double")


PREDICT_SCHEMA = "score double, runs array<struct<y:int,x0:int,x1:int>>"


def predict_items(rows: DataFrame, key: str, item: str, predict: Callable[[pd.Series], pd.DataFrame]) -> DataFrame:
    """Calls ``predict`` once per Arrow batch: a series of items gives a frame with ``score`` and ``mask`` (a list of (y, x0, x1)), in the same order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            found = predict(frame[item])
            if len(found) != len(frame):
                raise ValueError(f"the predictor returns {len(found)} results for {len(frame)} items")
            yield pd.DataFrame({key: frame[key].to_numpy(), "score": found["score"].to_numpy(dtype=float),
                                "runs": [[{"y": y, "x0": a, "x1": b} for y, a, b in mask] for mask in found["mask"]]})

    return rows.select(key, item).mapInPandas(run, f"{key} {dict(rows.dtypes)[key]}, {PREDICT_SCHEMA}")
