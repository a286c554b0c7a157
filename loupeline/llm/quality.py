"""Quality classifier: a byte-level convolutional network in numpy.

A text becomes channels per byte: which of a few byte classes it has, and whether the last ``REPEAT`` bytes also stood a short
way back. Channels are summed over cells of ``CELL`` bytes; a chunk is ``WIDTH`` cells, chunks overlap by half and cover the
whole text. Learned filters look at every chunk, the largest response of each filter over all chunks is kept (max
pooling), and one logistic unit combines them into the probability of label 1. Long texts are read in parts with the maximum
carried on, so memory does not grow with a text.

Training reads a bounded sample: at most ``SAMPLE`` texts per label, the first by a hash of the document number among the labelled
texts of at most ``SAMPLE_BYTES`` bytes. The network is a few thousand numbers and is broadcast.

Null and empty texts are one empty chunk and get its score. Labels other than 0 and 1 and labels of unknown documents
teach nothing; several labels of a document count as the largest. With a single label in the sample every score is the share of ones.
Repeated rows are scored each; input columns with the names of results are replaced.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from loupeline.llm import common

CELL, WIDTH, STRIDE = 4, 16, 8
REPEAT, REACH = 5, 32
FILTERS, EPOCHS, BATCH = 24, 20, 64
SAMPLE, SAMPLE_BYTES = 1000, 16_000
PART_BYTES = 1 << 17  # of text at a time, a multiple of a stride


def _classes() -> np.ndarray:
    """Channel of every byte: lower case, upper case, digit, blank, line end, ending marks, other marks by kind, beyond ASCII."""
    kind = np.full(256, 9, dtype=np.uint8)
    kind[97:123], kind[65:91], kind[48:58] = 0, 1, 2
    kind[[32, 9]], kind[[10, 11, 12, 13]] = 3, 4
    for channel, marks in ((5, b".,;:'\"()-"), (6, b"!?"), (7, b"|/\\<>=_{}[]"), (8, b"*#$%&@^~+`")):
        kind[list(marks)] = channel
    kind[128:] = 10
    return kind


CLASSES, CHANNELS = _classes(), 12


def cells(data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Channel sums of each cell of ``data``; ``before`` are the bytes that precede it."""
    size = -(-max(len(data), 1) // CELL)
    out = np.zeros((size, CHANNELS), dtype=np.float32)
    if not len(data):
        return out
    cell = np.arange(len(data)) // CELL
    out += np.bincount(cell * CHANNELS + CLASSES[data], minlength=size * CHANNELS).reshape(size, CHANNELS)
    context = np.concatenate([before[-(REACH + REPEAT):], data])
    key = np.zeros(max(len(context) - REPEAT + 1, 0), dtype=np.uint64)  # the REPEAT bytes that begin here
    for i in range(REPEAT):
        key = (key << np.uint64(8)) | context[i:i + len(key)].astype(np.uint64)
    again = np.zeros(len(key), dtype=bool)
    for back in range(2, REACH + 1):
        again[back:] |= key[back:] == key[:-back]
    ends = np.flatnonzero(again) + REPEAT - 1 - (len(context) - len(data))
    ends = ends[ends >= 0]
    out[:, CHANNELS - 1] = np.bincount(ends // CELL, minlength=size)
    return out


def chunks(grid: np.ndarray) -> np.ndarray:
    """Overlapping chunks of the cells, one row each; the last is filled up with empty cells."""
    n = max(1, -(-(len(grid) - WIDTH) // STRIDE) + 1)
    padded = np.zeros(((n - 1) * STRIDE + WIDTH, CHANNELS), dtype=np.float32)
    padded[: len(grid)] = grid
    view = np.lib.stride_tricks.sliding_window_view(padded, WIDTH, axis=0)[::STRIDE]
    return view.transpose(0, 2, 1).reshape(n, WIDTH * CHANNELS)


def parts(text: bytes) -> list[np.ndarray]:
    """Cells of consecutive parts of a text; each part begins with the cells its first chunk shares with the one before."""
    data = np.frombuffer(text, dtype=np.uint8)
    shared = (WIDTH - STRIDE) * CELL
    out = []
    for at in range(0, max(len(data), 1), PART_BYTES):
        first = max(0, at - shared)
        out.append(cells(data[first:at + PART_BYTES], data[max(0, first - REACH - REPEAT):first]))
    return out


@dataclass(frozen=True)
class Network:
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def pooled(self, text: bytes) -> np.ndarray:
        best = np.zeros(len(self.bias), dtype=np.float32)
        for grid in parts(text):
            best = np.maximum(best, (chunks(grid) @ self.filters + self.bias).max(0))
        return best

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        pooled = np.stack([self.pooled(t or b"") for t in texts]) if texts else np.zeros((0, len(self.bias)))
        return 1.0 / (1.0 + np.exp(-np.clip(pooled.astype(np.float64) @ self.weights + self.offset, -60, 60)))


def fit(texts: list[bytes], labels: np.ndarray, share: float | None = None, seed: int = 7) -> Network:
    """Adam on the logistic loss with both labels weighted alike; ``share`` of label 1 then sets the offset."""
    labels = np.asarray(labels, dtype=np.float64)
    share = min(max(float(labels.mean()) if share is None and len(labels) else share or 0.5, 1e-4), 1 - 1e-4)
    rng = np.random.Generator(np.random.PCG64(seed))
    size = WIDTH * CHANNELS
    state = {"f": rng.normal(0, 0.3 / np.sqrt(size), (size, FILTERS)), "b": np.full(FILTERS, 0.05), "w": rng.normal(0, 0.3, FILTERS), "o": np.zeros(1)}
    prior = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return Network(state["f"].astype(np.float32), state["b"].astype(np.float32), np.zeros(FILTERS), float(prior))
    stacks = [np.concatenate([chunks(grid) for grid in parts(t)]).astype(np.uint8) for t in texts]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in state.items()}
    weight = np.where(labels == 1, 0.5 / max((labels == 1).mean(), 1e-9), 0.5 / max((labels == 0).mean(), 1e-9))
    step = 0
    for epoch in range(EPOCHS):
        rate = 0.01 if epoch < EPOCHS * 2 // 3 else 0.002
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            chosen = order[at:at + BATCH]
            x = np.concatenate([stacks[i] for i in chosen]).astype(np.float32)
            cuts = np.cumsum([0, *(len(stacks[i]) for i in chosen)])
            h = x @ state["f"].astype(np.float32) + state["b"].astype(np.float32)
            top = np.stack([h[a:b].argmax(0) + a for a, b in zip(cuts[:-1], cuts[1:])])
            best = np.take_along_axis(h, top, 0)
            pooled = np.maximum(best, 0)
            z = pooled @ state["w"] + state["o"]
            error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[chosen]) * weight[chosen] / len(chosen)
            inner = error[:, None] * state["w"][None, :] * (best > 0)
            gradient = {"w": pooled.T @ error + 1e-4 * state["w"], "o": np.array([error.sum()]), "b": inner.sum(0),
                        "f": np.einsum("dks,dk->sk", x[top], inner, optimize=True) + 1e-4 * state["f"]}
            step += 1
            for k, g in gradient.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                state[k] = state[k] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Network(state["f"].astype(np.float32), state["b"].astype(np.float32), state["w"], float(state["o"][0] + prior))


def learn(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, text: str = "text", sample: int = SAMPLE) -> Network:
    """Network for ``label`` from the labelled documents for which ``allowed`` (a condition on doc_id) holds."""
    known = labels.where(allowed).groupBy("doc_id").agg(F.max(label).alias("label")).where("label in (0, 1)")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    texts = docs.where(allowed & (F.octet_length(F.col(text)) <= SAMPLE_BYTES)).select("doc_id", F.col(text).alias("text"))
    rows = []
    for value in (0, 1):
        # candidates are bounded, so they may be broadcast to the scan of the texts; a few spare ones replace long or unknown documents
        ids = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample).select("doc_id")
        found = texts.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        rows += [(r["text"].encode(), value) for r in found.collect()]
    total = sum(counts.values())
    return fit([t for t, _ in rows], np.array([y for _, y in rows]), counts.get(1, 0) / total if total else 0.5)


def classify(docs: DataFrame, network: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or the columns in ``keep``) with ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    return common.with_columns(docs, text, docs.columns if keep is None else keep, "score double", lambda texts: [shared.value.score(texts)], 1 << 20)
