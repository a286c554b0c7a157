"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters becomes a single blank; the n-grams of one to three characters are hashed
into ``BUCKETS`` counts. Training adds up the counts of all labelled documents, inside each task first and then by
(language, bucket), so only one row per language and bucket reaches the driver: a matrix of at most ``MAX_LANGUAGES`` rows.
Its log-probabilities are broadcast and every text is scored in batches with numpy.

Null texts and texts without a letter are ``und`` with score 0. Documents without a language, or with a null or empty text,
teach nothing. If nothing can be learned every text is ``und``. Repeated rows are judged (and counted) each; input columns
with the names of results are replaced.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loupeline.llm import common

BUCKETS = 1 << 15
MAX_LANGUAGES = 1000
PART_BYTES = 1 << 18


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all n-grams, the text each belongs to, and how many letters each text has."""
    chars = [np.frombuffer((" " + t.decode().lower() + " ").encode("utf-32-le"), dtype=np.uint32) if t else np.zeros(0, np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in chars])
    code = np.concatenate([np.zeros(0, np.uint32), *chars])
    letter = _letters()[code]
    letters = np.bincount(owner[letter], minlength=len(texts))
    code = np.where(letter, code, 32).astype(np.uint64)
    blank = ~letter
    keep = np.ones(len(code), dtype=bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (owner[1:] == owner[:-1]))
    code, owner = code[keep], owner[keep]
    buckets, owners = [], []
    for n in (1, 2, 3):
        if len(code) < n:
            break
        last = len(code) - n + 1
        h = np.zeros(last, dtype=np.uint64)
        for i in range(n):
            h = (h + code[i:i + last] + np.uint64(n)) * np.uint64(common.MULTIPLIER)
            h ^= h >> np.uint64(29)
        whole = owner[:last] == owner[n - 1:]
        if n == 1:
            whole &= code != 32
        buckets.append((h[whole] >> np.uint64(64 - 15)).astype(np.int64))
        owners.append(owner[:last][whole])
    return np.concatenate([np.zeros(0, np.int64), *buckets]), np.concatenate([np.zeros(0, np.int64), *owners]), letters


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # log-probability of every bucket, one column per language
    prior: np.ndarray

    def judge(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Most likely language, its probability (of equally likely ones the first in name order), and how well it fits.

        The probability says how far the language is ahead of the others, which is far for any text of some length. The fit says whether the text is
        in the language at all: the mean log-likelihood of its n-grams, less that of n-grams drawn evenly from all buckets.
        """
        bucket, owner, letters = grams(texts)
        known, count = letters > 0, np.bincount(owner, minlength=len(texts))
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), -np.inf)
        total = np.stack([np.bincount(owner, self.weights[bucket, k], minlength=len(texts)) for k in range(len(self.languages))], axis=1)
        mean = total / np.maximum(count, 1)[:, None] + np.log(BUCKETS)
        total = total + self.prior
        best = total.argmax(1)
        score = 1.0 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        fit = np.take_along_axis(mean, best[:, None], 1)[:, 0]
        return [self.languages[b] if k else "und" for b, k in zip(best, known)], np.where(known, score, 0.0), np.where(known, fit, -np.inf)

    def score(self, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
        return self.judge(texts)[:2]


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", alpha: float = 0.1) -> Model:
    """Model of all rows with a language and a text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in common.slices(batch, "text", PART_BYTES):
                bucket, owner, letters = grams(common.raw(part.column("text")))
                names = part.column("lang").to_pylist()
                distinct = {name: i for i, name in enumerate(dict.fromkeys(names))}
                which = np.array([distinct[name] for name in names])
                flat = np.bincount(which[owner] * BUCKETS + bucket, minlength=len(distinct) * BUCKETS).reshape(len(distinct), BUCKETS)
                texts = np.bincount(which[letters > 0], minlength=len(distinct))
                for name, i in distinct.items():
                    row = np.append(flat[i], texts[i])
                    sums[name] = sums[name] + row if name in sums else row
        for name, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())], names=["lang", "bucket", "n"])

    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = common.bounded(rows).mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))

    def packed(key, rows):
        row = np.zeros(BUCKETS + 1, dtype="<i8")
        row[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
        return pa.table({"lang": [key[0].as_py()], "row": pa.array([row.tobytes()], pa.binary())})

    # one array per language reaches the driver; a group has at most BUCKETS + 1 rows
    found = {r["lang"]: r["row"] for r in counts.groupBy("lang").applyInArrow(packed, "lang string, row binary").limit(MAX_LANGUAGES + 1).collect()}
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = tuple(sorted(found))
    table = np.stack([np.frombuffer(found[name], dtype="<i8") for name in languages], axis=1).astype(float) if languages else np.zeros((BUCKETS + 1, 0))
    texts = table[-1] + 1.0
    table = table[:-1] + alpha
    return Model(languages, np.log(table / table.sum(0)), np.log(texts / texts.sum()) if len(languages) else np.zeros(0))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, fit: str | None = None) -> DataFrame:
    """``docs`` (or the columns of it in ``keep``) with ``lang_pred`` and ``score``, and the fit under the name ``fit`` if one is given."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = "lang_pred string, score double" + (f", {fit} double" if fit else "")
    return common.with_columns(docs, text, docs.columns if keep is None else keep, added, lambda texts: shared.value.judge(texts)[: 3 if fit else 2], PART_BYTES)
