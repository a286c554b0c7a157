"""Scalar rules on scores, labels and counts."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
VERIFIED_SOURCES = ("human_review", "folder_ground_truth")
INITIAL_SOURCE = "initial_calibration_yolo_train_ok"
PSEUDO_SOURCE = "sampling_pseudo_ok"
TRUSTED_SOURCES = ("folder_ground_truth", "human_review", "initial_calibration_yolo_train_ok")
REVIEW_SOURCES = ("model_assumed_review", "human_review", "folder_ground_truth", "sampling_pseudo_ok")
TOLERANCE_PIXELS = 5
METRIC_VERSION = "tolerant_agreement_r5_chebyshev_capped_v2"
PROMOTION_RULE = "shadow_cost_t5_capped_gain20_v3"
RECALL_LEVELS = (1.0, 0.95, 0.9, 0.85, 0.8)
LADDER_QUANTILES = (0.80, 0.90, 0.95, 0.97, 0.99, 0.995, 0.999)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decide(score, threshold) -> Column:
    """Inclusive threshold: NG when the score reaches it."""
    return F.when(col(score) >= col(threshold), "NG").otherwise("OK")


def boundary_flag(score, threshold, ratio: float = 0.05, signed: bool = False) -> Column:
    """Within ``ratio`` of the threshold; ``signed`` keeps the sign of the threshold in the band width."""
    width = col(threshold) if signed else F.abs(col(threshold))
    return F.abs(col(score) - col(threshold)) <= width * F.lit(ratio)


def confusion_case(label, predicted_ng) -> Column:
    """tp, fn, fp or tn; NULL when the label is neither OK nor NG."""
    return (F.when(col(label) == "NG", F.when(col(predicted_ng), "tp").otherwise("fn"))
             .when(col(label) == "OK", F.when(col(predicted_ng), "fp").otherwise("tn")))


def ratio(numerator, denominator) -> Column:
    """Double division that is NULL, not zero, on an empty denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def is_verified(truth, source, decision) -> Column:
    return (col(truth).isin("OK", "NG") & col(source).isin(*VERIFIED_SOURCES) & col(decision).isin("OK", "NG"))


def unit_hash(token: Column) -> Column:
    """First 16 hex digits of SHA-256 as a fraction of 16**16: the persistent split coordinate."""
    return F.conv(F.substring(F.sha2(token, 256), 1, 16), 16, 10).cast("double") / F.lit(float(16 ** 16))


def next_up(value: Column) -> Column:
    """Smallest double above ``value``."""
    return F.call_function("java_method", F.lit("java.lang.Math"), F.lit("nextUp"), value).cast("double")


def utc_text(at) -> Column:
    """Time as ISO 8601 text in UTC with microseconds and offset; the session's time zone does not matter."""
    return F.concat(_utc(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def utc_stamp(at) -> Column:
    """The same time without separators, for names of folders: 20240131T235959123456+0000."""
    return F.regexp_replace(utc_text(at), "[:.-]", "")


def _utc(at, pattern: str) -> Column:
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), col(at).cast("timestamp").cast("timestamp_ntz")), pattern)


def milestone_due(labeled: Column, last: Column, first=40, step=20, knee=100, late=40) -> Column:
    """Highest training milestone reached by ``labeled`` and not yet trained, NULL when none is due.

    Milestones run ``first, first+step, ...`` until one is at or above ``knee`` and in steps of ``late`` after it.
    """
    first, step, knee, late = [c if isinstance(c, Column) else F.lit(c) for c in (first, step, knee, late)]
    early_steps = F.greatest(F.ceil((knee - first) / step), F.lit(0))
    turn = first + early_steps * step
    reached = (F.when(labeled < turn, first + F.floor((labeled - first) / step) * step)
                .otherwise(turn + F.floor((labeled - turn) / late) * late)).cast("bigint")
    return F.when((labeled >= first) & (reached > last), reached)


def reasons(**rules: Column) -> Column:
    """Names of the rules that hold, comma separated in the given order; an empty string when none does."""
    return F.array_join(F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])), ",")
