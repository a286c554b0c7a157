"""Threshold calibration on exact order statistics.

Every rule reads one frame: distinct scores with running positives and negatives. The frame is built by a single
partial aggregation and one range sort; rules are then conditional minima over it, which combine map-side.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loupeline.functions.decisions import LADDER_QUANTILES, RECALL_LEVELS, col, next_up, ratio
from loupeline.operators.metrics import score_counts
from loupeline.operators.ordering import running_totals, with_previous
from loupeline.session import sized


def running_scores(rows: DataFrame, keys: Sequence[str], score, label_ng) -> DataFrame:
    """Distinct scores with ``pos_upto``/``neg_upto`` (inclusive) and the group's ``p``/``n``."""
    return running_totals(score_counts(rows, keys, score, label_ng), keys, [F.col("score")],
                          {"pos_upto": "pos", "neg_upto": "neg"}, {"p": "pos", "n": "neg"})


def higher_index(n: Column, q: Column) -> Column:
    """0-based index of the "higher" quantile."""
    return F.ceil((n - 1) * q)


def quantile_higher(rows: DataFrame, keys: Sequence[str], value, quantiles: Sequence[float]) -> DataFrame:
    """Order statistic at index ceil((n-1)q) for each q, one row per (group, q)."""
    counts = rows.groupBy(*keys, col(value).alias("value")).agg(F.count(F.lit(1)).alias("c"))
    run = running_totals(counts, keys, [F.col("value")], {"upto": "c"}, {"n": "c"})
    picks = [F.struct(F.lit(float(q)).alias("q"), F.min(F.when(
        F.col("upto") > higher_index(F.col("n"), F.lit(float(q))), F.col("value"))).alias("value")) for q in quantiles]
    return run.groupBy(*keys).agg(F.array(*picks).alias("picks")).select(*keys, F.inline("picks"))


def ok_quantile_threshold(rows: DataFrame, keys: Sequence[str], score, quantile: float) -> DataFrame:
    return quantile_higher(rows, keys, score, [quantile]).select(
        *keys, F.col("value").alias("threshold"), F.col("q").alias("quantile"))


def ladder_from(run: DataFrame, keys: Sequence[str], quantiles: Sequence[float] = LADDER_QUANTILES) -> DataFrame:
    """Highest OK quantile that still catches every NG, else the lowest rung. Without NG or OK there is no threshold to choose and all
    but the counts is NULL."""
    def rung(q):
        reached = F.col("neg_upto") > higher_index(F.col("n"), F.lit(float(q)))
        best = F.min(F.when(reached, F.struct("score", (F.col("pos_upto") - F.col("pos")).alias("missed"))))
        return F.struct(F.lit(float(q)).alias("q"), best["score"].alias("t"), best["missed"].alias("missed"))

    rungs = run.groupBy(*keys).agg(F.array(*[rung(q) for q in sorted(quantiles)]).alias("rungs"),
                                   F.max("n").alias("calibration_ok"), F.max("p").alias("calibration_ng"))
    fitting = F.filter("rungs", lambda r: r["missed"] == 0)
    chosen = F.when(F.size(fitting) > 0, F.element_at(fitting, -1)).otherwise(F.element_at("rungs", 1))
    both = (F.col("calibration_ok") > 0) & (F.col("calibration_ng") > 0)
    return rungs.withColumn("chosen", F.when(both, chosen)).select(
        *keys, F.col("chosen.t").alias("threshold"), F.col("chosen.q").alias("quantile"),
        F.when(both, F.size(fitting) > 0).alias("all_ng_caught"), F.col("chosen.missed").alias("ng_missed_at_fallback"),
        "calibration_ok", "calibration_ng")


def ladder_threshold(rows: DataFrame, keys: Sequence[str], score, label_ng,
                     quantiles: Sequence[float] = LADDER_QUANTILES) -> DataFrame:
    return ladder_from(running_scores(rows, keys, score, label_ng), keys, quantiles)


def sweep_from(run: DataFrame, keys: Sequence[str], min_threshold: float | None = None) -> DataFrame:
    """Confusion at every distinct score above ``min_threshold`` and at one sentinel above the maximum."""
    at_score = run.select(*keys, F.col("score").alias("threshold"), "p", "n",
                          (F.col("p") - F.col("pos_upto") + F.col("pos")).alias("tp"),
                          (F.col("n") - F.col("neg_upto") + F.col("neg")).alias("fp"))
    if min_threshold is not None:
        at_score = at_score.filter(F.col("threshold") > F.lit(float(min_threshold)))
    none = F.lit(0).cast("bigint")
    sentinel = run.groupBy(*keys).agg(next_up(F.max("score")).alias("threshold"), F.max("p").alias("p"),
                                      F.max("n").alias("n")).withColumns({"tp": none, "fp": none})
    both = at_score.unionByName(sentinel)
    return both.select(*keys, "threshold", "tp", "fp", (F.col("p") - F.col("tp")).alias("fn"),
                       (F.col("n") - F.col("fp")).alias("tn"), ratio("tp", "p").alias("recall"),
                       ratio("fp", "n").alias("ok_false_positive_rate"))


def threshold_sweep(rows: DataFrame, keys: Sequence[str], score, label_ng,
                    min_threshold: float | None = None) -> DataFrame:
    return sweep_from(running_scores(rows, keys, score, label_ng), keys, min_threshold)


def _low_fpr(condition: Column) -> Column:
    """Among rows meeting ``condition``: lowest FPR, then highest recall, then highest threshold."""
    fpr, recall, t = F.col("ok_false_positive_rate"), F.col("recall"), F.col("threshold")
    return F.min(F.when(condition, F.struct(fpr.alias("fpr"), (-recall).alias("loss"), (-t).alias("negative"),
                                            F.col("fn").alias("fn"))))


def _pick(best: Column) -> dict[str, Column]:
    return {"threshold": -best["negative"], "recall": -best["loss"], "ok_false_positive_rate": best["fpr"],
            "ng_below_threshold": best["fn"]}


def recall_first(sweep: DataFrame, keys: Sequence[str], target: float | Column = 0.95,
                 max_fpr: float | Column = 0.2) -> DataFrame:
    """Recall-first choice with Youden fallback, both under the FPR cap. A group without NG or without OK is refused: it has
    a status and no threshold."""
    target = target if isinstance(target, Column) else F.lit(float(target))
    cap = max_fpr if isinstance(max_fpr, Column) else F.lit(float(max_fpr))
    fpr, recall, t = F.col("ok_false_positive_rate"), F.col("recall"), F.col("threshold")
    youden = F.max(F.when(fpr <= cap, F.struct((recall - fpr).alias("gain"), recall.alias("recall"), t.alias("t"),
                                               fpr.alias("fpr"), F.col("fn").alias("fn"))))
    best = sweep.groupBy(*keys).agg(_low_fpr((fpr <= cap) & (recall >= target)).alias("e"), youden.alias("y"),
                                    F.min(F.when(recall >= target, fpr)).alias("uncapped_fpr"), F.max(cap).alias("cap"),
                                    ((F.max(F.col("tp") + F.col("fn")) == 0) | (F.max(F.col("fp") + F.col("tn")) == 0)).alias("one_class"))
    reached = F.col("e").isNotNull() & ~F.col("one_class")
    eligible = _pick(F.col("e"))
    fallback = {"threshold": F.col("y.t"), "recall": F.col("y.recall"), "ok_false_positive_rate": F.col("y.fpr"),
                "ng_below_threshold": F.col("y.fn")}
    return best.select(
        *keys, *[F.when(reached, eligible[c]).when(~F.col("one_class"), fallback[c]).alias(c) for c in fallback],
        F.when(F.col("one_class"), "refused_one_class").when(reached, "target_recall_achieved")
         .otherwise("target_recall_unreachable_under_cap_youden_fallback").alias("status"),
        reached.alias("reachable_under_cap"),
        F.coalesce(F.col("uncapped_fpr") > F.col("cap"), F.lit(False)).alias("fpr_cap_binding"))


def youden_fallback(sweep: DataFrame, keys: Sequence[str], max_fpr: float = 0.2) -> DataFrame:
    """Best recall - FPR under the cap, ties to higher recall and then to the higher threshold."""
    fpr, recall, t = F.col("ok_false_positive_rate"), F.col("recall"), F.col("threshold")
    best = sweep.filter(fpr <= F.lit(max_fpr)).groupBy(*keys).agg(
        F.max(F.struct((recall - fpr).alias("gain"), recall.alias("recall"), t.alias("t"), fpr.alias("fpr"))).alias("y"))
    return best.select(*keys, F.col("y.t").alias("threshold"), F.col("y.recall").alias("recall"),
                       F.col("y.fpr").alias("ok_false_positive_rate"))


def max_recall_fallback(sweep: DataFrame, keys: Sequence[str], target: float = 0.95, max_fpr: float = 0.2) -> DataFrame:
    """Recall-first choice whose fallback is the highest recall under the cap."""
    fpr, recall, t = F.col("ok_false_positive_rate"), F.col("recall"), F.col("threshold")
    best = sweep.filter(fpr <= F.lit(max_fpr)).groupBy(*keys).agg(
        F.min(F.when(recall >= F.lit(target), F.struct(fpr.alias("f"), (-recall).alias("r"), (-t).alias("t")))).alias("e"),
        F.min(F.struct((-recall).alias("r"), fpr.alias("f"), (-t).alias("t"))).alias("m"))

    def either(field):
        return F.coalesce(F.col(f"e.{field}"), F.col(f"m.{field}"))

    return best.select(*keys, (-either("t")).alias("threshold"), (-either("r")).alias("recall"),
                       either("f").alias("ok_false_positive_rate"),
                       F.when(F.col("e").isNotNull(), "target_recall_achieved").otherwise("max_recall_fallback").alias("status"))


def recall_ladder(sweep: DataFrame, keys: Sequence[str], levels: Sequence[float] = RECALL_LEVELS) -> DataFrame:
    """Cheapest threshold for each recall level, NULL where the level is out of reach."""
    fpr, t = F.col("ok_false_positive_rate"), F.col("threshold")
    rows = []
    for level in levels:
        best = F.min(F.when(F.col("recall") >= F.lit(level), F.struct(fpr.alias("f"), (-t).alias("t"))))
        rows.append(F.struct(F.lit(float(level)).alias("recall_level"), (-best["t"]).alias("threshold"),
                             best["f"].alias("ok_false_positive_rate")))
    return sweep.groupBy(*keys).agg(F.array(*rows).alias("ladder")).select(*keys, F.inline("ladder"))


def zero_score_ng(rows: DataFrame, keys: Sequence[str], score, label_ng, min_threshold: float = 0.0) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count_if(col(label_ng) & (col(score) <= F.lit(min_threshold))).alias("zero_score_ng"))


def choose_threshold_rule(rows: DataFrame, keys: Sequence[str], score, label_ng, settings: DataFrame,
                          quantiles: Sequence[float] = LADDER_QUANTILES, min_threshold: float = 0.0) -> DataFrame:
    """Rule by NG count: none -> OK quantile, few -> ladder, else recall-first; too few OK is a status.

    ``settings`` has one row per key: zero_ng_quantile, target_recall, max_fpr, min_calibration_ok, full_rule_min_ng.
    All three rules are aggregates of the same running frame.
    """
    settings = sized(settings, "settings")
    run = running_scores(rows, keys, score, label_ng).join(settings, list(keys))
    zero = run.groupBy(*keys).agg(F.min(F.when(
        F.col("neg_upto") > higher_index(F.col("n"), F.col("zero_ng_quantile")), F.col("score"))).alias("zero_threshold"),
        F.max("n").alias("calibration_ok"), F.max("p").alias("calibration_ng"))
    ladder = ladder_from(run, keys, quantiles).select(*keys, F.col("threshold").alias("ladder_threshold"))
    sweep = sweep_from(run, keys, min_threshold).join(settings, list(keys))
    full = recall_first(sweep, keys, F.col("target_recall"), F.col("max_fpr")).select(
        *keys, F.col("threshold").alias("recall_threshold"))
    ok, ng = F.col("calibration_ok"), F.col("calibration_ng")
    rule = (F.when(ok < F.col("min_calibration_ok"), "insufficient_calibration_ok").when(ng == 0, "ok_quantile")
             .when(ng < F.col("full_rule_min_ng"), "ladder").otherwise("recall_first"))
    joined = zero.join(ladder, list(keys)).join(full, list(keys)).join(settings, list(keys)).withColumn("rule", rule)
    return joined.select(*keys, "rule", F.when(F.col("rule") == "ok_quantile", F.col("zero_threshold"))
                         .when(F.col("rule") == "ladder", F.col("ladder_threshold"))
                         .when(F.col("rule") == "recall_first", F.col("recall_threshold")).alias("threshold"),
                         "calibration_ok", "calibration_ng")


def mask_conf_threshold(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Confidence with the best mean IoU, ties to the higher confidence."""
    best = curve.groupBy(*keys).agg(F.max(F.struct("mean_iou", "conf")).alias("best"))
    return best.select(*keys, F.col("best.conf").alias("mask_conf_threshold"), F.col("best.mean_iou").alias("mean_iou"))


def recalibration_due(batches: DataFrame, key: str, order: str, ng: str, every: int = 5) -> DataFrame:
    """Batches after which the threshold is chosen again: each that crosses a multiple of ``every`` labelled NG.

    The first threshold is chosen before the first batch, at a count of zero. The last calibrated count always shares its
    multiple with the previous running count, so no state is needed.
    """
    run = running_totals(batches, [key], [F.col(order)], {"n_ng": ng})
    before = F.col("n_ng") - F.col(ng)
    return run.select(key, order, "n_ng", (F.floor(F.col("n_ng") / every) > F.floor(before / every)).alias("due"))


def threshold_history(calibrations: DataFrame, key: str, order: str) -> DataFrame:
    """Each calibration with the threshold it replaced."""
    return with_previous(calibrations, [key], [F.col(order)],
                         {"previous_threshold": "threshold", "previous_" + order: order})


def pixel_threshold(pixels: DataFrame, keys: Sequence[str], image: str, value: str, token: Column | None = None,
                    per_image: int | None = None, quantile: float = 0.997) -> DataFrame:
    """Quantile of all OK pixels. Only on request (``per_image`` and a ``token`` to order by) does an image contribute a seeded
    sample of so many pixels."""
    if per_image is not None:
        order = Window.partitionBy(image).orderBy(F.sha2(token, 256))
        pixels = pixels.withColumn("_pick", F.row_number().over(order)).filter(F.col("_pick") <= per_image)
    return quantile_higher(pixels, keys, value, [quantile]).select(
        *keys, F.col("q").alias("quantile"), F.col("value").alias("pixel_threshold"))
