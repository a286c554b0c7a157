"""Paired shadow comparison and the exact-integer promotion gate."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loupeline.functions.decisions import ratio
from loupeline.operators.metrics import legacy_counts
from loupeline.operators.ordering import running_totals

# Fixed value: percentage points of tolerant agreement that promote on their own
TOLERANCE_GAIN_POINTS = 20
SIDES = ("official", "candidate")
FIELDS = ("label", "gt_status", "predicted_ng", "intersection", "union", "gt_pixels", "predicted_pixels", "iou",
          "tolerant_matched_pixels", "tolerant_total_pixels", "tolerance_pixels", "metric_version")


def paired_cohort(official: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both models' rows side by side with ``pair_status``.

    Duplicates are counted per sample before the join, so a repeated sample never multiplies rows.
    """
    def side(rows, name):
        packed = F.struct(*[c for c in FIELDS])
        return rows.groupBy(*keys, "sample_id").agg(F.max(packed).alias(name), F.count(F.lit(1)).alias(f"_{name}_rows"))

    both = side(official, "official").join(side(candidate, "candidate"), [*keys, "sample_id"], "full_outer")
    status = (F.when(F.col("official").isNull(), "missing_official").when(F.col("candidate").isNull(), "missing_candidate")
               .when((F.col("_official_rows") > 1) | (F.col("_candidate_rows") > 1), "duplicate")
               .when(~F.col("official.label").eqNullSafe(F.col("candidate.label")), "label_mismatch").otherwise("paired"))
    return both.withColumn("pair_status", status).drop("_official_rows", "_candidate_rows")


def _side_sums(side: str) -> list[Column]:
    label, status = F.col(f"{side}.label"), F.col(f"{side}.gt_status")
    hit, valid = F.col(f"{side}.predicted_ng"), F.col(f"{side}.gt_status") == "valid"
    zero = F.lit(0).cast("bigint")

    def pixels(column, missed):
        shown = F.when(hit, F.col(f"{side}.{column}")).otherwise(missed)
        return F.coalesce(F.sum(F.when(valid, shown)), zero)

    gt = F.col(f"{side}.gt_pixels")
    return [F.count_if((label == "NG") & hit).alias(f"{side}_tp"), F.count_if((label == "OK") & hit).alias(f"{side}_fp"),
            F.count_if((label == "NG") & ~hit).alias(f"{side}_fn"), F.count_if((label == "OK") & ~hit).alias(f"{side}_tn"),
            F.count_if(valid).alias(f"{side}_valid_ng"), F.count_if(label == "INVALID_GT").alias(f"{side}_excluded_invalid_gt"),
            F.count_if(~status.isin("valid", "outside_roi", "not_required")).alias(f"{side}_invalid_ng"),
            pixels("intersection", zero).alias(f"{side}_intersection"), pixels("union", gt).alias(f"{side}_union"),
            pixels("tolerant_matched_pixels", zero).alias(f"{side}_matched"), pixels("tolerant_total_pixels", gt).alias(f"{side}_total"),
            F.count_if(F.col(side).isNotNull() & (label.isNull() | status.isNull() | hit.isNull())).alias(f"{side}_incomplete"),
            F.count_if(legacy_counts(F.col(side))).alias(f"{side}_legacy")]


def promotion_gate(official: DataFrame, candidate: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One verdict per key from paired rows.

    Lower cost (2 FN + FP) wins, equal cost needs a better tolerant agreement, and a gain of 20 points wins alone.
    Agreements are compared as cross products of 18-digit decimals, never as rounded ratios.
    """
    pairs = paired_cohort(official, candidate, keys)
    sums = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("reviewed"),
                                    F.count_if(F.col("pair_status") != "paired").alias("_unpaired"),
                                    *[c for side in SIDES for c in _side_sums(side)])
    for side in SIDES:
        p = f"{side}_"
        complete = ((F.col(p + "tp") + F.col(p + "fn") > 0) & (F.col(p + "fp") + F.col(p + "tn") > 0) & (F.col(p + "valid_ng") > 0)
                    & (F.col(p + "invalid_ng") == 0) & (F.col(p + "excluded_invalid_gt") == 0))
        pooled = (F.col(p + "valid_ng") > 0) & (F.col(p + "invalid_ng") == 0)
        sums = sums.withColumns({f"_{side}_ok": complete, f"{side}_error_cost": 2 * F.col(p + "fn") + F.col(p + "fp"),
                                 f"{side}_iou_micro": F.when(pooled, ratio(p + "intersection", p + "union")),
                                 f"{side}_tolerant_agreement_micro": F.when(pooled, ratio(p + "matched", p + "total"))})

    def exact(name):
        return F.col(name).cast("decimal(18,0)")

    gain = exact("candidate_matched") * exact("official_total") - exact("official_matched") * exact("candidate_total")
    base = exact("official_total") * exact("candidate_total")
    checks = {"lower_error_cost": F.col("candidate_error_cost") < F.col("official_error_cost"),
              "equal_error_cost": F.col("candidate_error_cost") == F.col("official_error_cost"), "tolerance_improved": gain > 0,
              "tolerance_gain_at_least_20_points": 100 * gain >= TOLERANCE_GAIN_POINTS * base}
    refusal = (F.when(F.col("official_incomplete") + F.col("candidate_incomplete") > 0, "missing_or_legacy_metric_rows")
                .when(F.col("_unpaired") > 0, "unpaired_samples")
                .when(F.col("official_legacy") + F.col("candidate_legacy") > 0, "missing_or_legacy_tolerance_counts")
                .when(~(F.col("_official_ok") & F.col("_candidate_ok")), "insufficient_or_invalid_metrics"))
    judged = sums.withColumn("_refusal", refusal).withColumns(
        {name: F.when(F.col("_refusal").isNull(), check) for name, check in checks.items()})
    lower, equal, better, large = [F.col(c) for c in checks]
    reason = (F.when(lower, "lower_error_cost").when(equal & better, "equal_cost_better_tolerance")
               .when(large, "tolerance_gain_at_least_20_points").when(~equal, "higher_error_cost").otherwise("equal_cost_no_tolerance_gain"))
    promote = lower | (equal & better) | large
    shown = [f"{side}_{c}" for side in SIDES for c in ("fn", "fp", "error_cost", "intersection", "union", "matched", "total", "iou_micro",
                                                       "tolerant_agreement_micro")]
    return judged.select(*keys, "reviewed", F.when(F.coalesce(promote, F.lit(False)), "promote").otherwise("reject").alias("decision"),
                         F.coalesce("_refusal", reason).alias("reason"), *checks, *shown)


def shadow_window(batches: DataFrame, keys: Sequence[str], order: str = "batch_no", ng: str = "valid_ng", min_ng: int = 10,
                  max_batches: int = 5) -> DataFrame:
    """Running shadow evidence per model and the first batch at which a verdict is due."""
    run = running_totals(batches.withColumn("_one", F.lit(1).cast("bigint")), keys, [F.col(order)],
                         {"shadow_ng": ng, "shadow_batches": "_one"})
    reached = (F.col("shadow_ng") >= min_ng) | (F.col("shadow_batches") >= max_batches)
    before = (F.col("shadow_ng") - F.col(ng) >= min_ng) | (F.col("shadow_batches") - 1 >= max_batches)
    return run.withColumn("due", reached & ~before).select(*keys, order, "shadow_ng", "shadow_batches", "due")


# Refusals that come before any metric is computed
UNMEASURED = ("missing_or_legacy_metric_rows", "unpaired_samples", "missing_or_legacy_tolerance_counts")


def gate_pairs(verdicts: DataFrame, rule: str) -> DataFrame:
    """"old → new" texts of a verdict; NULL under another rule id, without metrics, or where either side is NULL."""
    shown = (F.col("rule") == rule) & ~F.col("reason").isin(*UNMEASURED)

    def text(name, metric, percent=False):
        old, new = F.col(f"official_{metric}"), F.col(f"candidate_{metric}")
        show = (lambda v: F.format_string("%.4f%%", v * 100)) if percent else (lambda v: v.cast("string"))
        return F.when(shown & old.isNotNull() & new.isNotNull(), F.concat(show(old), F.lit(" → "), show(new))).alias(name)

    return verdicts.select("*", text("fn_pair", "fn"), text("fp_pair", "fp"), text("iou_pair", "iou_micro", True),
                           text("cost_pair", "error_cost"), text("t5_pair", "tolerant_agreement_micro", True))
