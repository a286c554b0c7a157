"""Confusion, ranking and segmentation aggregates. Counts are summed first, ratios are taken last."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loupeline.functions.decisions import METRIC_VERSION, TOLERANCE_PIXELS, col, ratio
from loupeline.operators.ordering import running_totals

CONFUSION = ("tp", "fp", "fn", "tn")


def confusion_counts(label_ng, predicted_ng) -> list[Column]:
    y, p = col(label_ng), col(predicted_ng)
    return [F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
            F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn")]


def with_rates(counts: DataFrame) -> DataFrame:
    """Derived classification columns from tp, fp, fn, tn."""
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.withColumns({
        "error_cost": F.when(total > 0, 2 * F.col("fn") + F.col("fp")),
        "recall": ratio("tp", F.col("tp") + F.col("fn")),
        "ok_false_positive_rate": ratio("fp", F.col("fp") + F.col("tn")),
        "precision": ratio("tp", F.col("tp") + F.col("fp")),
        "accuracy": ratio(F.col("tp") + F.col("tn"), total)})


def classification_metrics(rows: DataFrame, keys: Sequence[str], label_ng, predicted_ng) -> DataFrame:
    return with_rates(rows.groupBy(*keys).agg(*confusion_counts(label_ng, predicted_ng)))


def metrics_rollup(rows: DataFrame, keys: Sequence[str], label_ng, predicted_ng) -> DataFrame:
    """Confusion at every level of ``keys`` down to the grand total, always from raw counts."""
    counts = rows.rollup(*keys).agg(*confusion_counts(label_ng, predicted_ng), F.grouping_id().alias("gid"))
    depth = {(1 << (len(keys) - n)) - 1: n for n in range(len(keys) + 1)}
    level = F.lit(None).cast("bigint")
    for gid, n in depth.items():
        level = F.when(F.col("gid") == gid, F.lit(n).cast("bigint")).otherwise(level)
    return with_rates(counts.withColumn("level", level).drop("gid"))


def score_counts(rows: DataFrame, keys: Sequence[str], score, label_ng) -> DataFrame:
    """Positives and negatives per distinct score: the only frame order statistics ever sort."""
    return rows.groupBy(*keys, col(score).alias("score")).agg(
        F.count_if(col(label_ng)).alias("pos"), F.count_if(~col(label_ng)).alias("neg"))


def wins_at_score(rows: DataFrame, keys: Sequence[str], score, label_ng) -> DataFrame:
    """For every distinct score: ``n`` negatives of the group, and twice the share of them that a positive with this score beats (``wins``).

    Any subset of positives gets its AUROC against all negatives as sum(wins) / (2 * positives * n), without copying negatives.
    """
    run = running_totals(score_counts(rows, keys, score, label_ng), keys, [F.col("score")], {"neg_upto": "neg"}, {"n": "neg"})
    return run.select(*keys, "score", "n", (2 * F.col("neg_upto") - F.col("neg")).cast("decimal(19,0)").alias("wins"))


def auroc(rows: DataFrame, keys: Sequence[str], score, label_ng) -> DataFrame:
    """P(pos > neg) + P(pos = neg) / 2, NULL when one class is absent.

    Doubled wins are whole numbers; they are summed as decimals so the pair count cannot overflow.
    """
    run = running_totals(score_counts(rows, keys, score, label_ng), keys, [F.col("score")], {"neg_upto": "neg"})
    wins = F.col("pos").cast("decimal(19,0)") * (2 * F.col("neg_upto") - F.col("neg")).cast("decimal(19,0)")
    sums = run.groupBy(*keys).agg(F.sum(wins).alias("wins"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    pairs = 2 * F.col("p").cast("decimal(18,0)") * F.col("n").cast("decimal(18,0)")
    return sums.select(*keys, F.when((F.col("p") > 0) & (F.col("n") > 0),
                                     F.col("wins").cast("double") / pairs.cast("double")).alias("auroc"))


def legacy_counts(row: Column | None = None) -> Column:
    """Valid rows counted under another metric version or tolerance."""
    get = (lambda c: row[c]) if row is not None else F.col
    other = ~get("metric_version").eqNullSafe(F.lit(METRIC_VERSION)) | ~get("tolerance_pixels").eqNullSafe(F.lit(TOLERANCE_PIXELS))
    return (get("gt_status") == "valid") & other


def counted_rows() -> Column:
    """Whether a row's pixels count. A valid row of another metric version or tolerance fails the job: its counts mean something else."""
    told = F.concat(F.lit("pixel counts of metric version "), F.coalesce("metric_version", F.lit("none")), F.lit(" and tolerance "),
                    F.coalesce(F.col("tolerance_pixels").cast("string"), F.lit("none")), F.lit(" have to be counted again from the masks"))
    return F.when(legacy_counts(), F.raise_error(told).cast("boolean")).otherwise(F.col("gt_status") == "valid")


def gate_counts(rows: DataFrame, predicted_ng="predicted_ng") -> DataFrame:
    """End-to-end counts of valid rows: an image called OK contributes its whole ground truth as a miss. Rows of another metric version fail."""
    hit = col(predicted_ng)
    zero = F.lit(0).cast("bigint")
    return rows.filter(F.coalesce(counted_rows(), F.lit(False))).withColumns({
        "intersection": F.when(hit, F.col("intersection")).otherwise(zero),
        "union": F.when(hit, F.col("union")).otherwise(F.col("gt_pixels")),
        "predicted_pixels": F.when(hit, F.col("predicted_pixels")).otherwise(zero),
        "iou": F.when(hit, F.col("iou")).otherwise(F.lit(0.0)),
        "tolerant_matched_pixels": F.when(hit, F.col("tolerant_matched_pixels")).otherwise(zero),
        "tolerant_total_pixels": F.when(hit, F.col("tolerant_total_pixels")).otherwise(F.col("gt_pixels")),
        "tolerant_agreement": F.when(hit, F.col("tolerant_agreement")).otherwise(F.lit(0.0))})


def segmentation_aggregates(predicted_ng="predicted_ng") -> list[Column]:
    """Raw segmentation sums of metric rows; rows that are not valid add nothing, valid ones of another metric version fail."""
    valid, hit = counted_rows(), col(predicted_ng)
    zero = F.lit(0).cast("bigint")

    def total(when_hit, when_missed):
        return F.coalesce(F.sum(F.when(valid, F.when(hit, when_hit).otherwise(when_missed))), zero)

    gt, pred = F.col("gt_pixels"), F.col("predicted_pixels")
    return [
        F.count_if(valid).alias("segmentation_valid_ng"),
        F.count_if(~F.coalesce(F.col("gt_status").isin("valid", "outside_roi", "not_required"), F.lit(False))).alias("segmentation_invalid_ng"),
        total(F.col("intersection"), zero).alias("intersection"),
        total(F.col("union"), gt).alias("union"),
        total(gt + pred, gt).alias("pixels"),
        total(F.col("tolerant_matched_pixels"), zero).alias("tolerant_matched_pixels"),
        total(F.col("tolerant_total_pixels"), gt).alias("tolerant_total_pixels"),
        F.sum(F.when(valid, F.when(hit, F.col("iou")).otherwise(F.lit(0.0)))).alias("iou_sum")]


def with_segmentation_rates(sums: DataFrame) -> DataFrame:
    """Pooled ratios; any invalid ground truth makes all of them NULL while the raw sums stay."""
    complete = (F.col("segmentation_invalid_ng") == 0) & (F.col("segmentation_valid_ng") > 0)
    return sums.withColumns({
        "iou_micro": F.when(complete, ratio("intersection", "union")),
        "dice_micro": F.when(complete, ratio(2 * F.col("intersection"), "pixels")),
        "mean_iou_all_ng": F.when(complete, F.col("iou_sum") / F.col("segmentation_valid_ng")),
        "tolerant_agreement_micro": F.when(complete, ratio("tolerant_matched_pixels", "tolerant_total_pixels")),
        "segmentation_status": F.when(F.col("segmentation_invalid_ng") > 0, "incomplete_gt_or_prediction")
                                .when(F.col("segmentation_valid_ng") > 0, "valid").otherwise("no_valid_ng"),
    }).drop("pixels", "iou_sum")


def segmentation_micro(rows: DataFrame, keys: Sequence[str], predicted_ng="predicted_ng") -> DataFrame:
    return with_segmentation_rates(rows.groupBy(*keys).agg(*segmentation_aggregates(predicted_ng)))


def reviewed_metrics(rows: DataFrame, keys: Sequence[str], predicted_ng="predicted_ng",
                     scope: str = "reviewed_online_subset", extra: Sequence[Column] = ()) -> DataFrame:
    """Classification and segmentation of verified metric rows in one aggregation pass."""
    label, hit = F.col("label"), col(predicted_ng)
    used = label.isin("OK", "NG")
    counts = [F.count_if(used & (label == "NG") & hit).alias("tp"), F.count_if(used & (label == "OK") & hit).alias("fp"),
              F.count_if(used & (label == "NG") & ~hit).alias("fn"), F.count_if(used & (label == "OK") & ~hit).alias("tn"),
              F.count_if(used).alias("count"), F.count(F.lit(1)).alias("verified_count"),
              F.count_if(label == "EXCLUDED").alias("excluded_outside_roi"),
              F.count_if(label == "INVALID_GT").alias("excluded_invalid_gt")]
    sums = rows.groupBy(*keys).agg(*counts, *segmentation_aggregates(predicted_ng), *extra)
    return with_segmentation_rates(with_rates(sums)).withColumn("scope", F.lit(scope))


def case_counts(cases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per confusion case, zero-filled."""
    wide = cases.groupBy(*keys).pivot("case", list(CONFUSION)).count()
    return wide.na.fill(0, list(CONFUSION))


def latency_stats(rows: DataFrame, keys: Sequence[str], latency: str) -> DataFrame:
    """Mean and linearly interpolated 95th percentile; a group without latencies has NULLs.

    The percentile is read off running counts of distinct latencies, so no task holds the latencies of a group.
    """
    counts = rows.groupBy(*keys, F.col(latency).alias("_v")).agg(F.count(F.col(latency)).alias("_c"))
    run = running_totals(counts, keys, [F.col("_v")], {"_upto": "_c"}, {"_n": "_c"})
    at = (F.col("_n") - 1) * F.lit(0.95)
    low, high = F.min(F.when(F.col("_upto") > F.floor(at), F.col("_v"))), F.min(F.when(F.col("_upto") > F.ceil(at), F.col("_v")))
    share = F.max(at - F.floor(at))
    mean = F.sum(F.col("_v") * F.col("_c")) / F.max("_n")
    return run.groupBy(*keys).agg(mean.alias("mean_ms"), (low + (high - low) * share).alias("p95_ms"))


def zero_filled_counts(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Count per key of a closed domain; keys without rows give 0."""
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(counts, list(on), "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


FINGERPRINT_LEVELS = (4, 2, 0)  # hex digits of the cells of each level


def cohort_fingerprint(rows: DataFrame, keys: Sequence[str], sha: str, digits: int = 12, settings: str | None = None) -> DataFrame:
    """Order-free identity of a multiset of content hashes: a hash tree over cells of equal prefixes.

    Equal hashes are counted first. The hashes of a cell and their counts are digested in order, then the digests of the cells with
    a shorter prefix, up to one digest per cohort. A cell holds a 65536th of the distinct hashes and a node above it at most 256 cells, so no task
    gathers a cohort. ``settings``, if given, are part of the identity. ``rows`` are members; a member without a hash is one of an empty hash.
    """
    keys = list(keys)
    entries = rows.groupBy(*keys, F.coalesce(F.col(sha), F.lit("")).alias("_name")).agg(F.count(F.lit(1)).alias("_n"))
    nodes = entries.select(*keys, "_name", "_n", F.concat_ws("=", "_name", F.col("_n").cast("string")).alias("_line"))
    for size in FINGERPRINT_LEVELS:
        lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_name", "_line"))), lambda x: x["_line"]), ",")
        cells = nodes.groupBy(*keys, F.substring("_name", 1, size).alias("_name")).agg(F.sum("_n").alias("_n"), F.sha2(lines, 256).alias("_digest"))
        nodes = cells.withColumn("_line", F.concat_ws("=", "_name", "_digest"))
    token = F.concat_ws(":", F.col("_n").cast("string"), F.col("_digest"), *([F.lit(settings)] if settings else []))
    return nodes.select(*keys, F.col("_n").alias("members"), F.substring(F.sha2(token, 256), 1, digits).alias("fingerprint"))
