"""Deterministic splits, role reservation, quotas and set differences on content hashes."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loupeline.functions.decisions import unit_hash
from loupeline.operators.ordering import hash_rank, rank_within, running_totals, seeded
from loupeline.operators.review import half_even, top_ranked
from loupeline.session import sized


def hash_split(rows: DataFrame, fraction: float = 0.25, seed: object = 42, category: str = "category",
               sha: str = "sha256") -> DataFrame:
    """calibration or train from SHA-256 of ``seed:category:sha``."""
    share = unit_hash(seeded(seed, F.col(category), F.col(sha)))
    return rows.withColumn("split", F.when(share < F.lit(fraction), "calibration").otherwise("train"))


def sticky_split(rows: DataFrame, existing: DataFrame, fraction: float = 0.25, seed: object = 42,
                 sample: str = "sample_id") -> DataFrame:
    """Stored assignments win over any new seed or fraction; ``is_new`` marks rows to append."""
    stored = existing.select(sample, F.col("split").alias("_stored"))
    out = hash_split(rows, fraction, seed).join(stored, sample, "left")
    return out.withColumns({"split": F.coalesce("_stored", "split"), "is_new": F.col("_stored").isNull()}).drop("_stored")


def dedup_content(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in ``order``: a minimum per key, so hot copies collapse map-side."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in [*order, *rest]])


def bank_shrink(counts: DataFrame, n_ref: int, n_cal: int, n_bank: int, min_stream: int) -> DataFrame:
    """Bank size that leaves ``min_stream`` OK for the stream, and whether the reserve is possible at all."""
    free = F.greatest(F.lit(0).cast("bigint"), F.col("ok") - n_ref - n_cal - min_stream)
    bank = F.least(F.lit(n_bank).cast("bigint"), free)
    return counts.withColumn("bank_count", bank).withColumn(
        "enough", F.col("ok") >= n_ref + n_cal + F.col("bank_count") + min_stream)


def reserve_roles(ok_rows: DataFrame, category: str, token: Column, n_ref: int, n_cal: int, n_bank: int,
                  min_stream: int) -> DataFrame:
    """Seeded disjoint reference, calibration and bank; everything else streams."""
    ranked = hash_rank(ok_rows, [category], token, "_rank", size="ok")
    sized = bank_shrink(ranked, n_ref, n_cal, n_bank, min_stream)
    r = F.col("_rank")
    role = (F.when(~F.col("enough"), "insufficient_ok").when(r <= n_ref, "reference").when(r <= n_ref + n_cal, "calibration")
             .when(r <= n_ref + n_cal + F.col("bank_count"), "bank").otherwise("stream"))
    return sized.withColumn("role", role).drop("_rank", "ok", "bank_count", "enough")


def ratio_downsample(rows: DataFrame, category: str, label: str, token: Column, ratio: float) -> DataFrame:
    """All OK and the seeded NG subset that makes NG ``ratio`` of the stream."""
    totals = sized(rows.groupBy(category).agg(F.count_if(F.col(label) == "OK").alias("_ok")), "totals")
    ng = hash_rank(rows.filter(F.col(label) == "NG"), [category], token, "_rank", size="_ng").join(totals, category)
    wanted = F.least(half_even(F.col("_ok") * F.lit(ratio) / F.lit(1.0 - ratio)), F.col("_ng"))
    kept = ng.filter(F.col("_rank") <= wanted).drop("_rank", "_ng", "_ok")
    return rows.filter(F.col(label) == "OK").unionByName(kept)


def capped_split(rows: DataFrame, category: str, label: str, token: Column, max_ok: int, max_ng: int = 0) -> DataFrame:
    """Seeded first ``max_ok`` OK and ``max_ng`` NG per category; 0 keeps all NG."""
    ranked = hash_rank(rows, [category, label], token, "_rank")
    limit = F.when(F.col(label) == "OK", F.lit(max_ok)).otherwise(F.lit(max_ng))
    keep = (F.col("_rank") <= limit) | ((F.col(label) == "NG") & F.lit(max_ng == 0))
    return ranked.filter(keep).drop("_rank")


def nested_prefix_cohorts(ng_rows: DataFrame, category: str, token: Column, counts: Sequence[int]) -> DataFrame:
    """Membership of growing NG prefixes plus the full pool; counts above the pool are dropped."""
    ranked = hash_rank(ng_rows, [category], token, "rank", size="_pool")
    sizes = F.array_distinct(F.concat(F.filter(F.array(*[F.lit(c).cast("bigint") for c in sorted(counts)]),
                                               lambda n: n <= F.col("_pool")), F.array("_pool")))
    return ranked.withColumn("ng_count", F.explode(sizes)).filter(F.col("rank") <= F.col("ng_count")).drop("_pool")


def stream_shuffle(rows: DataFrame, category: str, token: Column) -> DataFrame:
    return hash_rank(rows, [category], token, "position")


def stratified_batches(rows: DataFrame, category: str, label: str, token: Column, size: int) -> DataFrame:
    """Batches of ``size`` with an even NG rate: NG dealt round-robin, OK filling the free places in order.

    The first ``ng % batches`` batches hold one NG more, so an OK's batch follows from its rank in closed form.
    """
    totals = sized(rows.groupBy(category).agg(F.count_if(F.col(label) == "NG").alias("_ng"), F.count(F.lit(1)).alias("_all")), "totals")
    ranked = hash_rank(rows, [category, label], token, "_rank").join(totals, category)
    i, batches = F.col("_rank") - 1, F.ceil(F.col("_all") / F.lit(size))
    each, extra = F.floor(F.col("_ng") / batches), F.col("_ng") % batches
    tight, loose = F.lit(size) - each - 1, F.lit(size) - each
    head = extra * tight
    ok_batch = F.when(i < head, F.floor(i / F.greatest(tight, F.lit(1)))).otherwise(
        extra + F.floor((i - head) / F.greatest(loose, F.lit(1))))
    batch = F.when(F.col(label) == "NG", i % batches).otherwise(ok_batch)
    return ranked.withColumn("batch_no", (batch + 1).cast("bigint")).drop("_rank", "_ng", "_all")


def round_robin_ok(rows: DataFrame, category: str, batch: str, token: Column, limit: int) -> DataFrame:
    """Seeded turns over the batches: first pick of every batch, then second picks, up to ``limit`` per category."""
    ranked = hash_rank(rows, [category, batch], token, "_turn", digits=2)
    return top_ranked(ranked, [category], [F.col("_turn"), F.col(batch)], limit, "pick").drop("_turn")


def linspace_support(rows: DataFrame, category: str, order: Sequence[str], cap: int) -> DataFrame:
    """Evenly spaced members of the sorted list, first and last included."""
    ranked = rank_within(rows, [category], [F.col(c) for c in order], "_rank", size="_n")
    counts = rows.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    k = F.least(F.col("_n"), F.lit(cap).cast("bigint"))
    spots = counts.select(category, F.col("_n"), k.alias("_k"), F.explode(F.sequence(F.lit(0).cast("bigint"), k - 1)).alias("_i"))
    index = F.when(F.col("_k") == 1, F.lit(0)).when(F.col("_i") == F.col("_k") - 1, F.col("_n") - 1).otherwise(
        F.floor(F.col("_i") * ((F.col("_n") - 1) / F.greatest(F.col("_k") - 1, F.lit(1)))))
    wanted = spots.select(category, (index.cast("bigint") + 1).alias("_rank")).distinct()
    return ranked.join(wanted, [category, "_rank"], "left_semi").drop("_rank", "_n")


def synthetic_quota(counts: DataFrame, cap: int = 20, per_real: float = 0.10, fraction: float = 0.03,
                    increase: float = 0.02, real: str = "real_ng", ok: str = "train_ok") -> DataFrame:
    """Largest synthetic count within all four bounds; the last bound exists only while NG share + increase < 1."""
    r, total = F.col(real), F.col(real) + F.col(ok)
    room = F.lit(1.0) - r / total - F.lit(increase)
    share = F.when(room > 0, F.lit(increase) * total / room)
    bound = F.least(F.lit(float(cap)), F.lit(per_real) * r, F.lit(fraction) * total / F.lit(1.0 - fraction), share)
    budget = F.greatest(F.lit(0).cast("bigint"), F.floor(bound + F.lit(1e-10)))
    return counts.withColumn("budget", F.when((r > 0) & (total > 0), budget).otherwise(F.lit(0).cast("bigint")))


def area_targets(areas: DataFrame, category: str, area: str, budgets: DataFrame) -> DataFrame:
    """Quantiles of the real areas at (i + 0.5) / budget, linearly interpolated.

    Distinct areas get running counts from one range sort. A distinct area covers the ranks from its predecessor's
    count to its own, so it is compared only with the targets that fall there: budgets are few and joined by size, and a row
    gives as many rows as it has targets.
    """
    sizes = areas.groupBy(category, area).agg(F.count(F.lit(1)).alias("_c"))
    runs = running_totals(sizes, [category], [F.col(area)], {"_upto": "_c"}, {"_n": "_c"})
    budget, n = F.col("budget"), F.col("_n")
    joined = runs.join(sized(budgets.filter(budget > 0).select(category, "budget"), "budgets"), category)

    def place(i):
        return (n - 1) * ((i + F.lit(0.5)) / budget)

    # targets whose lower or upper neighbour rank is inside (_upto - _c, _upto]; one spare target on each side covers rounding
    per_rank = budget / F.greatest(n - 1, F.lit(1))
    first = F.greatest(F.floor((F.col("_upto") - F.col("_c") - 1) * per_rank - 0.5) - 1, F.lit(0).cast("bigint"))
    last = F.least(F.ceil(F.col("_upto") * per_rank - 0.5) + 1, budget - 1)
    near = joined.withColumn("target_id", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    at = place(F.col("target_id"))

    def holds(rank):
        return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank)

    picked = near.groupBy(category, "target_id").agg(
        F.min(F.when(holds(F.floor(at)), F.col(area))).alias("_lo"), F.min(F.when(holds(F.ceil(at)), F.col(area))).alias("_hi"),
        F.max(at - F.floor(at)).alias("_w")).filter("_lo IS NOT NULL")
    return picked.select(category, "target_id", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias("target"))


def area_band_join(targets: DataFrame, items: DataFrame, category: str, factor: float) -> DataFrame:
    """Items whose area lies in [target / factor, target * factor], with their log distance.

    A log bucket of width ``factor`` (at least one per mille) makes it an equi join: a match is in the target's bucket or a neighbour.
    Targets are few: they are stored, so that a join by their known size leaves the items where they are.
    """
    def bucket(value):
        return F.floor(F.ln(value) / F.ln(F.lit(max(factor, 1.001))))

    left = sized(targets.withColumn("_bucket", F.explode(F.array(*[bucket(F.col("target")) + d for d in (-1, 0, 1)]))), "targets")
    right = items.withColumn("_bucket", bucket(F.col("area")))
    inside = (F.col("area") >= F.col("target") / F.lit(factor)) & (F.col("area") <= F.col("target") * F.lit(factor))
    return left.join(right, [category, "_bucket"]).filter(inside).withColumn(
        "log_distance", F.abs(F.ln(F.col("area") / F.col("target")))).drop("_bucket")


def area_match_select(targets: DataFrame, items: DataFrame, category: str, factor: float, tie: str = "item_id") -> DataFrame:
    """Targets in order each take the nearest unused item of their band, ties by ``tie`` and then ``item_id``.

    Only items with an area strictly between 0 and 1 are taken. Earlier targets use up at most one item each, so a target's
    choice is always among its nearest as many as its category has targets; that exact shortlist is settled per category.
    """
    counts = targets.groupBy(category).agg(F.count(F.lit(1)).alias("_targets"))
    pairs = area_band_join(targets.join(counts, category), items.filter((F.col("area") > 0) & (F.col("area") < 1)), category, factor)
    nearest = Window.partitionBy(category, "target_id").orderBy(*dict.fromkeys(["log_distance", tie, "item_id"]))
    short = pairs.withColumn("_near", F.row_number().over(nearest)).filter(F.col("_near") <= F.col("_targets")).drop("_targets")

    def settle(frame):
        used, keep = set(), []
        for _, group in frame.sort_values(["target_id", "_near"]).groupby("target_id", sort=True):
            free = group[~group["item_id"].isin(used)].head(1)
            used.update(free["item_id"])
            keep.extend(free.index)
        return frame.loc[keep, [category, "target_id", "item_id", "area", "target"]]

    types = dict(short.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in (category, "target_id", "item_id", "area", "target"))
    return short.groupBy(category).applyInPandas(settle, schema)
