"""Embedding operators: exact nearest neighbours, residuals, k-center selection, memory banks.

Distances are numpy products inside tasks; pairs are never rows. Small banks travel to the tasks after their size is
checked; larger ones are searched through a pivot index, whose cells meet the queries in blocks, and only each query's best hit
per block leaves the task.
"""
from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loupeline.operators import pivot_index
from loupeline.operators.frame_store import FrameStore
from loupeline.operators.metrics import cohort_fingerprint
from loupeline.operators.review import top_fraction_mean
from loupeline.session import sized

BROADCAST_BYTES = 64 * 1024 * 1024
PIVOT_BYTES = 16 * 1024 * 1024
BLOCK_ROWS = 65536  # vectors per block: large blocks keep the replication of a blocked join low
SLAB_CELLS = 1 << 20  # distances held at once inside a task, in several arrays of 8 MiB


def _matrix(column: pd.Series, unit: bool = False) -> np.ndarray:
    out = np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300) if unit else out


class Bank:
    """Vectors to search. Equal ones are one entry, with the lowest id."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        vectors, ids = np.ascontiguousarray(vectors[order]), ids[order]
        _, first = np.unique(vectors.view(np.dtype((np.void, vectors.itemsize * vectors.shape[1])))[:, 0], return_index=True)
        first.sort()
        self.vectors, self.ids = vectors[first], ids[first]
        self.size = (self.vectors ** 2).sum(1)[None, :]

    def best(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row-wise nearest id (lowest on ties) and its Euclidean distance, recomputed from the difference."""
        slab = max(1, SLAB_CELLS // len(self.vectors))
        hit, distance = np.empty(len(query), dtype=np.int64), np.empty(len(query))
        for at in range(0, len(query), slab):
            part = query[at:at + slab]
            gap = self.size - 2 * part @ self.vectors.T
            least = gap.min(1, keepdims=True)
            # the product rounds, so all that come near the least are compared by their true difference, in bounded parts
            row, near = np.nonzero(gap <= least + 1e-9 * (1 + np.abs(least) + (part ** 2).sum(1, keepdims=True)))
            true, step = np.empty(len(row)), max(1, SLAB_CELLS // (8 * part.shape[1]))
            for i in range(0, len(row), step):
                true[i:i + step] = np.linalg.norm(part[row[i:i + step]] - self.vectors[near[i:i + step]], axis=1)
            order = np.lexsort((near, true, row))
            first = order[np.searchsorted(row[order], np.arange(len(part)))]
            hit[at:at + slab], distance[at:at + slab] = near[first], true[first]
        return self.ids[hit], distance


def nearest_bank(queries: DataFrame, bank: DataFrame, category: str = "category", metric: str = "l2", broadcast_bytes: int = BROADCAST_BYTES,
                 block_rows: int = BLOCK_ROWS, pivots: int = 256, count: list | None = None) -> DataFrame:
    """Exact nearest bank vector of the same category: ``(vec_id, category, bank_id, distance)``.

    Both frames have vec_id, category, embedding. Queries whose category has no bank give no row. A bank of at most ``broadcast_bytes``
    travels to the tasks; a larger one is searched through a pivot index of up to ``pivots`` cells per category (``pivot_index``).
    """
    rows, width = bank.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    schema = f"vec_id bigint, {category} {dict(queries.dtypes)[category]}, bank_id bigint, distance double"
    queries = queries.select("vec_id", category, "embedding")
    bank = bank.select(*(F.col(c).alias(c) for c in ("vec_id", category, "embedding")))  # its own columns, also when both come from one frame
    unit = metric == "cosine"
    told = (F.col("distance") * F.col("distance") / 2 if unit else F.col("distance")).alias("distance")

    def stacked(entries: pd.DataFrame) -> dict:
        return {value: Bank(_matrix(part["embedding"], unit), part["vec_id"].to_numpy()) for value, part in entries.groupby(category)}

    def match(frame: pd.DataFrame, banks: dict) -> pd.DataFrame:
        out = [pd.DataFrame({"vec_id": [], category: [], "bank_id": [], "distance": []})]
        for value, part in frame.groupby(category):
            if value in banks:
                ids, distance = banks[value].best(_matrix(part["embedding"], unit))
                out.append(pd.DataFrame({"vec_id": part["vec_id"].to_numpy(), category: value, "bank_id": ids, "distance": distance}))
        return pd.concat(out[1:] or out, ignore_index=True)

    if rows * width * 8 <= broadcast_bytes:
        # plain matrices travel, ready to search: every worker of an executor holds its own copy, and rows as objects would take several times as much
        shared = queries.sparkSession.sparkContext.broadcast(stacked(bank.toPandas()))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in batches:
                yield match(frame, shared.value)

        return queries.mapInPandas(scan, schema).select("vec_id", category, "bank_id", told)

    found = pivot_index.search(queries, bank, category, schema, lambda a, b: match(a, stacked(b)), _matrix, unit, pivots, block_rows, max(broadcast_bytes, PIVOT_BYTES), count)
    if found is not None:
        return found.select("vec_id", category, "bank_id", told)

    # so many categories that even their pivots are too large: every category is cut on its own, and a query meets the blocks of its category
    def cut(frame, name):
        return frame.groupBy(category).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias(name))

    sizes = sized(cut(queries, "_chunks").join(cut(bank, "_blocks"), category), "blocks")
    mine = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = queries.join(sizes, category).withColumns({"_q": mine("_chunks"), "_b": every("_blocks")}).drop("_chunks", "_blocks")
    right = bank.join(sizes, category).withColumns({"_b": mine("_blocks"), "_q": every("_chunks")}).drop("_chunks", "_blocks")
    keys = (category, "_q", "_b")
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda a, b: match(a, stacked(b)), schema)
    best = partial.groupBy("vec_id", category).agg(F.min(F.struct("distance", "bank_id")).alias("best"))
    return best.select("vec_id", category, "best.bank_id", F.col("best.distance").alias("distance")).select("vec_id", category, "bank_id", told)


def residual_features(queries: DataFrame, references: DataFrame, category: str = "category", **options) -> DataFrame:
    """Each vector minus its nearest reference by cosine: ``(vec_id, category, ref_id, residual)``."""
    hits = nearest_bank(queries, references, category, "cosine", **options).select("vec_id", F.col("bank_id").alias("ref_id"))
    refs = references.select(F.col("vec_id").alias("ref_id"), F.col("embedding").alias("_ref"))
    return queries.join(hits, "vec_id").join(refs, "ref_id").select(
        "vec_id", category, "ref_id", F.zip_with("embedding", "_ref", lambda q, r: q.cast("double") - r.cast("double")).alias("residual"))


def mean_vector(rows: DataFrame, keys: Sequence[str], dim: int, vector: str = "embedding") -> DataFrame:
    """Per-key mean; one running sum per dimension, combined map-side."""
    means = F.array(*[F.avg(F.col(vector)[i].cast("double")) for i in range(dim)])
    return rows.groupBy(*keys).agg(means.alias("mean"))


def normalized(vector):
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(vector, lambda x: x / norm)


def global_descriptor(patches: DataFrame, keys: Sequence[str], dim: int) -> DataFrame:
    """Mean of an image's patch vectors, scaled to unit length."""
    return mean_vector(patches, keys, dim).select(*keys, normalized(F.col("mean")).alias("descriptor"))


def kcenter_select(vectors: DataFrame, k: int, dim: int, category: str = "category", pool: int = 256) -> DataFrame:
    """Greedy k-center per category by cosine distance: ``(category, rank, vec_id, distance)``.

    The first center is the vector nearest the category's centroid. One pass over the data keeps, per category, the
    ``pool`` vectors farthest from the chosen centers. Distances only shrink, so while the best of the pool stays
    strictly above the pool's lowest distance, no vector outside can win and further centers come from the pool.
    The driver holds k centers and one pool per category; a pass emits nothing else.
    """
    rows = vectors.select("vec_id", category, "embedding")
    centroid = mean_vector(rows, [category], dim).toPandas()
    spark, types = vectors.sparkSession, dict(rows.dtypes)
    centers = {c: [] for c in centroid[category]}
    steps: list[tuple] = []
    starts = {c: np.asarray(m) / np.linalg.norm(m) for c, m in zip(centroid[category], centroid["mean"])}

    def farthest(state, first):
        """Top of the pool per category: similarity to the centroid first, then distance to the centers."""
        shared = spark.sparkContext.broadcast(state)

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in batches:
                for value, part in frame.groupby(category):
                    similarity = _matrix(part["embedding"]) @ np.stack(shared.value[value]).T
                    gain = similarity[:, 0] if first else 1.0 - similarity.max(1)
                    keep = np.lexsort((part["vec_id"].to_numpy(), -gain))[:pool]
                    yield part.iloc[keep].assign(gain=gain[keep])

        scored = rows.mapInPandas(score, f"vec_id bigint, {category} {types[category]}, embedding {types['embedding']}, gain double")
        order = Window.partitionBy(category).orderBy(F.col("gain").desc(), "vec_id")
        top = scored.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= (1 if first else pool))
        return top.toPandas()

    for row in farthest({c: [v] for c, v in starts.items()}, True).itertuples():
        centers[getattr(row, category)].append(np.asarray(row.embedding, dtype=np.float64))
        steps.append((getattr(row, category), 1, int(row.vec_id), 0.0))
    chosen = {(c, v) for c, _, v, _ in steps}
    unfinished = set(centers) if k > 1 else set()
    while unfinished:
        top = farthest({c: list(v) for c, v in centers.items()}, False)
        for value in sorted(unfinished):
            part = top[top[category] == value].sort_values("vec_id")
            ids, matrix, gain = part["vec_id"].to_numpy(), _matrix(part["embedding"]), part["gain"].to_numpy().copy()
            limit = gain.min() if len(part) == pool else -np.inf
            free = np.array([(value, int(i)) not in chosen for i in ids])
            moved = False
            while len(centers[value]) < k and free.any():
                best = int(np.where(free, gain, -np.inf).argmax())
                if moved and gain[best] <= limit:
                    break
                steps.append((value, len(centers[value]) + 1, int(ids[best]), float(gain[best])))
                chosen.add((value, int(ids[best])))
                centers[value].append(matrix[best])
                free[best], moved = False, True
                gain = np.minimum(gain, 1.0 - matrix @ matrix[best])
            if len(centers[value]) >= k or not moved:
                unfinished.discard(value)
    return spark.createDataFrame(steps, f"{category} {types[category]}, rank bigint, vec_id bigint, distance double")


SHARD_ROWS = 4096  # vectors that a shard of a coreset holds on average


def _sharded(vectors: DataFrame, category: str, shard_rows: int) -> DataFrame:
    """Vectors with ``_n`` of their category and ``_shard``, of as many as keep a shard at ``shard_rows`` on average."""
    rows = vectors.select("vec_id", category, "embedding")
    sizes = sized(rows.groupBy(category).agg(F.count(F.lit(1)).alias("_n")), "coreset-sizes")
    place = F.conv(F.substring(F.sha2(F.col("vec_id").cast("string"), 256), 1, 15), 16, 10).cast("bigint")
    return rows.join(sizes, category).withColumn("_shard", F.pmod(place, F.ceil(F.col("_n") / F.lit(shard_rows))).cast("int"))


def coreset_fraction(vectors: DataFrame, fraction: float, category: str = "category", shard_rows: int = SHARD_ROWS, spare: int = 2, with_radius: bool = False) -> DataFrame:
    """Coreset of exactly ``ceil(fraction * n)`` vectors of each category: ``(category, vec_id)``.

    Composable summaries in two levels. Shards are dealt by the SHA-256 of the id, so many that one holds ``shard_rows`` vectors on average however
    large its category is. A shard sums itself up by ``spare`` times its share of picks, chosen greedily: first the vector nearest the mean, then
    always the one farthest from all before it. As many summaries as make up ``shard_rows`` vectors again are merged, and the same greedy
    rule chooses the final picks of each merged group from their union; shares are rounded up so far along the groups, so sizes are exact.

    ``with_radius`` adds ``_group`` and ``radius``: every vector of the group is at most that far (1 - cosine of unit vectors turned into an angle) from
    a pick of its group. It is the sum of the largest angle of a member to its shard's summary and the largest angle of a summary to the picks.
    """
    sharded = _sharded(vectors, category, shard_rows)
    kind = dict(vectors.dtypes)[category]
    per = max(1, int(1 / max(fraction * spare, 1e-9)))  # shards whose summaries are merged
    grouped = sharded.withColumn("_group", F.floor(F.col("_shard") / F.lit(per)).cast("int"))
    counts = grouped.groupBy(category, "_group").agg(F.count(F.lit(1)).alias("_m"))
    order = Window.partitionBy(category).orderBy("_group")  # a row per shard_rows * per vectors
    upto = F.sum("_m").over(order)
    due = lambda n: F.ceil(n * F.lit(float(fraction))).cast("int")
    picks = sized(counts.select(category, "_group", (due(upto) - due(upto - F.col("_m"))).alias("_picks")), "picks")

    def greedy(frame: pd.DataFrame, k: int) -> pd.DataFrame:
        """The first k picks in order, each with ``_left``, the largest angle that is left after it."""
        left = frame.sort_values("vec_id").reset_index(drop=True)
        unit, chosen, angle = _matrix(left["embedding"], True), [], []
        open_ = np.ones(len(left), dtype=bool)
        likeness = -(unit @ unit.mean(0))  # the first pick is the most central, the later ones the least covered
        for step in range(min(k, len(left))):
            best = np.flatnonzero(open_)[likeness[open_].argmin()]
            open_[best] = False
            chosen.append(best)
            covered = unit @ unit[best]
            likeness = covered if step == 0 else np.maximum(likeness, covered)
            angle.append(float(np.arccos(np.clip(likeness[open_].min(), -1, 1))) if open_.any() else 0.0)
        return left.loc[chosen].assign(_left=angle)

    def summary(frame: pd.DataFrame) -> pd.DataFrame:
        chosen = greedy(frame, max(1, math.ceil(spare * fraction * len(frame))))
        return chosen.assign(_at=range(len(chosen)))[[category, "_group", "_shard", "vec_id", "embedding", "_at", "_left"]]

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        k = int(frame["_picks"].iloc[0])
        if frame["_shard"].nunique() == 1:  # the picks of one shard are the first of its summary
            chosen, before = frame.sort_values("_at").head(k), 0.0
        else:
            chosen, before = greedy(frame.drop(columns="_left"), k), frame.sort_values("_at").groupby("_shard")["_left"].last().max()
        return chosen.assign(radius=(chosen["_left"].iloc[-1] if k else 0.0) + before)[[category, "vec_id", "_group", "radius"]]

    embedding = dict(vectors.dtypes)["embedding"]
    summaries = grouped.groupBy(category, "_group", "_shard").applyInPandas(summary, f"{category} {kind}, _group int, _shard int, vec_id bigint, embedding {embedding}, _at int, _left double")
    out = summaries.join(picks, [category, "_group"]).groupBy(category, "_group").applyInPandas(merged, f"{category} {kind}, vec_id bigint, _group int, radius double")
    return out if with_radius else out.select(category, "vec_id")


def coreset_cover(vectors: DataFrame, picked: DataFrame, category: str = "category", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per category: members, picks, and whether every member is within the stated radius of a pick (of any group: checked through ``nearest_bank``)."""
    picks = vectors.select("vec_id", category, "embedding").join(picked.select(category, "vec_id", "radius"), [category, "vec_id"])
    bound = picks.groupBy(category).agg(F.max("radius").alias("_radius"), F.count(F.lit(1)).alias("picks"))
    near = nearest_bank(vectors, picks.select("vec_id", category, "embedding"), category, "cosine").groupBy(category).agg(F.max("distance").alias("_far"), F.count(F.lit(1)).alias("members"))
    return near.join(bound, category).withColumn("covered", F.acos(F.greatest(1 - F.col("_far"), F.lit(-1.0))) <= F.col("_radius") + 1e-6)


def content_key(vector: str = "embedding"):
    """Content hash of a vector from its millionths."""
    return F.sha2(F.array_join(F.transform(vector, lambda x: F.round(x.cast("double") * 1e6).cast("bigint").cast("string")), ","), 256)


def bank_build(vectors: DataFrame, n_references: int, dim: int, category: str = "category", order: str = "vec_id") -> dict[str, DataFrame]:
    """Deduplicated content (last one wins), k-center references, the remaining bank and its identity per category."""
    last = vectors.withColumn("sha256", content_key()).groupBy(category, "sha256").agg(
        F.max(F.struct(order, "embedding")).alias("_last")).select(
        category, "sha256", F.col(f"_last.{order}").alias(order), F.col("_last.embedding").alias("embedding"))
    references = kcenter_select(last.withColumnRenamed(order, "vec_id"), n_references, dim, category)
    chosen = references.select(category, F.col("vec_id").alias(order))
    return {"content": last, "references": references, "bank": last.join(chosen, [category, order], "left_anti"),
            "identity": cohort_fingerprint(last, [category], "sha256", 16)}


def stored_banks(store: FrameStore, vectors: DataFrame, n_references: int, dim: int, category: str = "category", order: str = "vec_id") -> DataFrame:
    """``category, part, order, embedding``: references and bank of every category, computed only where the category's content or the settings changed."""
    given = vectors.select(category, F.col(order), "embedding").withColumn("sha256", content_key())
    identities = cohort_fingerprint(given, [category], "sha256", 64, f"references={n_references};order={order}")

    def build(groups: DataFrame) -> DataFrame:
        parts = bank_build(given.drop("sha256").join(groups, category), n_references, dim, category, order)
        chosen = parts["references"].select(category, F.col("vec_id").alias(order), F.lit("reference").alias("part"))
        named = parts["content"].join(chosen, [category, order], "left")
        return named.select(category, F.coalesce("part", F.lit("bank")).alias("part"), order, "embedding")

    return store.get_groups("banks", identities.select(category, F.col("fingerprint").alias("identity")), category, build)


def stored_scores(store: FrameStore, queries: DataFrame, bank: DataFrame, category: str = "category") -> DataFrame:
    """``vec_id, category, distance`` to the nearest bank vector, computed only for categories whose queries or bank changed."""
    both = queries.select(category, "vec_id", "embedding", F.lit("q").alias("side")).unionByName(bank.select(category, "vec_id", "embedding", F.lit("b").alias("side")))
    named = both.withColumn("sha256", F.sha2(F.concat_ws(":", "side", F.col("vec_id").cast("string"), content_key()), 256))
    identities = cohort_fingerprint(named, [category], "sha256", 64)

    def build(groups: DataFrame) -> DataFrame:
        return nearest_bank(queries.join(groups, category), bank.join(groups, category), category).select("vec_id", category, "distance")

    return store.get_groups("scores", identities.select(category, F.col("fingerprint").alias("identity")), category, build)


def bank_score(queries: DataFrame, bank: DataFrame, references: DataFrame, image: str, category: str = "category",
               fraction: float = 0.005, **options) -> DataFrame:
    """Image anomaly score: residual patches against the residual bank, mean of the top distances."""
    def residuals(rows):
        return residual_features(rows, references, category, **options).withColumnRenamed("residual", "embedding")

    hits = nearest_bank(residuals(queries), residuals(bank), category, "l2", **options)
    scored = hits.join(queries.select("vec_id", image), "vec_id")
    return top_fraction_mean(scored, image, "distance", fraction)
