"""Near copies by the Jaccard similarity of their sets of word shingles: MinHash bands make the keys, the whole sets decide.

A set has ``BANDS`` keys of ``ROWS`` minima each; sets that share a key are compared as in ``set_links``, which connects all similar pairs of a key,
however many sets it has, by a forest of links verified on whole sets. No pair below the similarity links. A pair at similarity s shares a key with
probability 1 - (1 - s ** ROWS) ** BANDS, 0.99995 at 0.8.

Words are as in ``simhash``; a text of fewer words than a shingle gives one shingle of all; null texts and texts without words have no keys and link
with nothing here. Texts of equal sets are one node; repeated rows and rows without a ``doc_id`` are part of theirs. An empty table gives no links.
Other columns are ignored, whatever their names.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from loupeline.llm import common, set_links
from loupeline.llm.signature_tree import Share
from loupeline.session import written

SHINGLE, ROWS, BANDS = 5, 5, 25
_RANDOM = np.random.Generator(np.random.PCG64(20241207))
_FACTORS = _RANDOM.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 64, (BANDS, ROWS), dtype=np.uint64)


def band_keys(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of all sets that hold something, and how many each set has."""
    some = np.diff(first) > 0
    out = np.zeros((int(some.sum()), BANDS), dtype=np.uint64)
    if some.any():
        for band in range(BANDS):
            for factor, shift in zip(_FACTORS[band], _SHIFTS[band]):
                out[:, band] = common.mixed(out[:, band] + np.minimum.reduceat(hashes * factor + shift, first[:-1][some]))
            out[:, band] = common.mixed(out[:, band] ^ np.uint64(band + 1))
    return out.ravel(), np.where(some, BANDS, 0)


def signatures(docs: DataFrame, text: str, fingerprints_of) -> DataFrame:
    """Signatures as in ``set_links``, with ``fp``, the ``fingerprints_of`` texts."""
    return set_links.signatures(docs, text, SHINGLE, {"fp": ("bigint", lambda texts: fingerprints_of(texts).view(np.int64))})


def links(docs: DataFrame, text: str, marked: DataFrame, roots: DataFrame, share: Share) -> DataFrame:
    """Edges ``u, v`` between roots of ``roots`` (``fp, root``) that hold texts of at least the similarity.

    ``marked`` are the stored signatures of ``docs``.
    """
    row = F.min(F.struct(set_links.position().alias("ord"), "body")).alias("row")
    equal = written(marked.where("size > 0").join(roots, "fp").groupBy("node", "root").agg(row), "shingle-sets")
    nodes = written(equal.groupBy("node").agg(F.min("root").alias("label"), F.min("row").alias("row")).select("node", "label", "row.ord", "row.body"), "shingle-nodes")
    same = equal.join(nodes, "node").where("root <> label").select(F.col("root").alias("u"), F.col("label").alias("v"))
    found = written(set_links.links(docs, text, marked, nodes, set_links.keyed(docs, text, SHINGLE, band_keys), share, SHINGLE), "shingle-links")
    label = nodes.select("node", "label")
    ends = found.join(label.select(F.col("node").alias("u"), F.col("label").alias("a")), "u").join(label.select(F.col("node").alias("v"), F.col("label").alias("b")), "v")
    return ends.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(same)
