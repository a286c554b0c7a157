"""Sampled review of model-OK samples: score segments, spot checks, escalation, pseudo-OK."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loupeline.operators.ordering import hash_rank, rank_within, seeded
from loupeline.session import sized

# Default policy
POLICY = {"high_fraction": 0.20, "middle_fraction": 0.40, "middle_rate": 0.10, "middle_min": 5,
          "low_rate": 0.02, "low_min": 2}


def half_even(value: Column) -> Column:
    return F.bround(value, 0).cast("bigint")


def review_segments(predictions: DataFrame, keys: Sequence[str], policy: dict | None = None, score: str = "score",
                    sample: str = "sample_id", decision: str = "official") -> DataFrame:
    """Model-OK samples ranked by score in each batch and cut into high, middle and low segments."""
    policy = {**POLICY, **(policy or {})}
    ok = predictions.filter(F.col(decision) == "OK")
    ranked = rank_within(ok, keys, [F.col(score).desc(), F.col(sample)], "rank", size="_n")
    high = half_even(F.col("_n") * F.lit(policy["high_fraction"]))
    middle = half_even(F.col("_n") * F.lit(policy["middle_fraction"]))
    segment = F.when(F.col("rank") <= high, "high").when(F.col("rank") <= high + middle, "middle").otherwise("low")
    return ranked.withColumn("segment", segment).drop("_n")


def spot_check_plan(segments: DataFrame, keys: Sequence[str], seed: object = 42, policy: dict | None = None,
                    sample: str = "sample_id") -> DataFrame:
    """High segment in full; middle and low by a seeded pick of ``min(m, max(minimum, round(m * rate)))`` members."""
    policy = {**POLICY, **(policy or {})}
    token = seeded(seed, *[F.col(k) for k in keys], F.col(sample))
    ranked = hash_rank(segments, [*keys, "segment"], token, "_pick", size="_m", digits=2)
    m = F.col("_m")

    def quota(name):
        rate, least = policy[f"{name}_rate"], policy[f"{name}_min"]
        return F.least(m, F.greatest(F.lit(least).cast("bigint"), half_even(m * F.lit(rate))))

    wanted = F.when(F.col("segment") == "high", m).when(F.col("segment") == "middle", quota("middle")).otherwise(quota("low"))
    return ranked.withColumn("sampled", F.col("_pick") <= wanted).drop("_pick", "_m")


def review_stats(plan: DataFrame, keys: Sequence[str], truth: str = "truth") -> DataFrame:
    """Per segment: members, sampled, NG in the sample, escalation, reviewed and NG found."""
    ng = F.col(truth) == "NG"
    stats = plan.groupBy(*keys, "segment").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(F.col("sampled")).alias("sampled"),
        F.count_if(F.col("sampled") & ng).alias("ng_in_sample"), F.count_if(ng).alias("_all_ng"))
    escalated = (F.col("ng_in_sample") > 0) & (F.col("sampled") < F.col("members"))
    return stats.withColumn("escalated", escalated).withColumns({
        "reviewed": F.when(F.col("escalated"), F.col("members")).otherwise(F.col("sampled")),
        "ng_found": F.when(F.col("escalated"), F.col("_all_ng")).otherwise(F.col("ng_in_sample"))}).drop("_all_ng")


def segment_escalation(plan: DataFrame, keys: Sequence[str], truth: str = "truth") -> DataFrame:
    """Adds ``escalated`` and ``reviewed``: an NG in a partial sample sends the whole segment to review.

    Segments are aggregated first; only their small statistics table is joined back.
    """
    stats = sized(review_stats(plan, keys, truth).select(*keys, "segment", "escalated"), "segments")
    return plan.join(stats, [*keys, "segment"]).withColumn("reviewed", F.col("sampled") | F.col("escalated"))


def reviewed_batch(predictions: DataFrame, keys: Sequence[str], seed: object = 42, policy: dict | None = None) -> DataFrame:
    """Every sample with its review outcome: model-NG always reviewed, model-OK by plan, the rest pseudo-OK."""
    plan = spot_check_plan(review_segments(predictions, keys, policy), keys, seed, policy)
    ok = segment_escalation(plan, keys).drop("rank")
    ng = predictions.filter(F.col("official") == "NG").withColumns({
        "segment": F.lit(None).cast("string"), "sampled": F.lit(False), "escalated": F.lit(False), "reviewed": F.lit(True)})
    return ok.unionByName(ng).withColumn("review", F.when(F.col("reviewed"), "reviewed").otherwise("pseudo_ok"))


def top_fraction_mean(values: DataFrame, sample: str, value: str, fraction: float) -> DataFrame:
    """Mean of the top ``max(1, ceil(n * fraction))`` values per sample; one sample is one bounded image."""
    per = Window.partitionBy(sample)
    ranked = values.withColumn("_rn", F.row_number().over(per.orderBy(F.col(value).desc()))).withColumn(
        "_n", F.count(F.lit(1)).over(per))
    keep = F.col("_rn") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(fraction)))
    return ranked.filter(keep).groupBy(sample).agg(F.avg(F.col(value).cast("double")).alias("image_score"))


def top_ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rank") -> DataFrame:
    """First ``k`` rows per group. Spark limits each task to k rows per group before the shuffle."""
    ranked = rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(name) <= k)


def region_topk(regions: DataFrame, sample: str, min_area: int = 128, max_regions: int = 3) -> DataFrame:
    """Regions of at least ``min_area`` by (peak, area) descending; ``max_regions <= 0`` keeps all."""
    order = Window.partitionBy(sample).orderBy(F.col("peak").desc(), F.col("area").desc(), F.col("label"))
    ranked = regions.filter(F.col("area") >= min_area).withColumn("rank", F.row_number().over(order))
    return ranked if max_regions <= 0 else ranked.filter(F.col("rank") <= max_regions)
