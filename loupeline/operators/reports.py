"""Audits, cache reuse and the per-batch simulation table."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loupeline.functions.decisions import METRIC_VERSION, reasons, utc_text
from loupeline.operators.lookups import model_display_name
from loupeline.operators.metrics import cohort_fingerprint

# Column headers of the exported table, in order
HEADERS = ("批次", "输入数", "实际的输入OK/NG数", "模型推理的OK/NG数", "需要人工打标的数量", "可用于模型训练OK/NG数", "正式模型", "在线Recall",
           "在线OK误报率", "在线micro IoU", "最新YOLO（状态）", "该YOLO实际训练OK/NG数", "YOLO独立评测Recall", "YOLO独立评测OK误报率",
           "YOLO独立评测micro IoU", "类别", "实验方案", "在线漏检数", "在线误报数", "独立评测漏检数", "独立评测误报数", "该YOLO实际训练真实NG数",
           "该YOLO实际加入伪缺陷数", "伪缺陷占训练集比例", "累计生成轮数", "影子阶段状态", "增强选择说明", "影子漏检（正式→候选）",
           "影子误报（正式→候选）", "影子micro IoU（正式→候选）", "影子错误成本（正式→候选）", "影子容差吻合率5px（正式→候选）", "在线错误成本",
           "在线容差吻合率5px", "独立评测错误成本", "独立评测容差吻合率5px")
# Column names behind the headers, same order
COLUMNS = ("batch_no", "inputs", "input_ok_ng", "predicted_ok_ng", "reviewed", "trainable_ok_ng", "official_model", "recall",
           "ok_false_positive_rate", "iou_micro", "latest_model", "trained_ok_ng", "test_recall", "test_fpr", "test_iou", "category",
           "scheme", "fn", "fp", "test_fn", "test_fp", "trained_real_ng", "trained_synthetic", "synthetic_share", "generation_events",
           "shadow_status", "augmentation_note", "fn_pair", "fp_pair", "iou_pair", "cost_pair", "t5_pair", "error_cost",
           "tolerant_agreement", "test_error_cost", "test_tolerant_agreement")
# Model status texts
STATUS_TEXT = {"shadow_candidate": "影子中", "promoted": "已晋升", "production": "正式模型", "rejected_shadow": "影子拒绝",
               "superseded": "被新版本替代"}
DECIDED = ("promoted", "production", "rejected_shadow")


def status_text(status: Column) -> Column:
    out = status
    for name, text in STATUS_TEXT.items():
        out = F.when(status == name, F.lit(text)).otherwise(out)
    return out


def pair_text(a: Column, b: Column) -> Column:
    return F.concat_ws("/", a.cast("string"), b.cast("string"))


def visible_verdict(rows: DataFrame, columns: Sequence[str], status: str = "latest_status") -> DataFrame:
    """Hides verdict columns wherever the batch's own snapshot does not show the model as decided yet."""
    decided = F.coalesce(F.col(status).isin(*DECIDED), F.lit(False))
    return rows.withColumns({c: F.when(decided, F.col(c)) for c in columns})


def simulation_table(batches: DataFrame, scheme: str = "未加伪缺陷") -> DataFrame:
    """The 36-column row of every completed batch from one joined frame (see ``COLUMNS``)."""
    latest = F.col("latest_version").isNotNull()
    pairs = ("fn_pair", "fp_pair", "iou_pair", "cost_pair", "t5_pair")
    shown = visible_verdict(batches, pairs)
    t5 = F.when(F.col("test_metric_version") == METRIC_VERSION, F.col("test_tolerant_agreement"))
    status = status_text(F.col("latest_status"))
    return shown.withColumns({
        "input_ok_ng": pair_text(F.col("input_ok"), F.col("input_ng")),
        "predicted_ok_ng": pair_text(F.col("predicted_ok"), F.col("predicted_ng")),
        "trainable_ok_ng": pair_text(F.col("eligible_training_ok"), F.col("eligible_training_ng")),
        "official_model": model_display_name("used_model"),
        "latest_model": F.when(latest, F.concat(model_display_name("latest_version"), F.lit("（"), status, F.lit("）"))).otherwise("—"),
        "trained_ok_ng": F.when(latest, pair_text(F.col("trained_images") - F.col("trained_ng"), F.col("trained_ng"))),
        "scheme": F.lit(scheme), "trained_real_ng": F.when(latest, F.col("trained_ng") - F.col("selected_synthetic")),
        "trained_synthetic": F.when(latest, F.col("selected_synthetic")),
        "synthetic_share": F.when(latest, F.try_divide(F.col("selected_synthetic").cast("double"), F.col("trained_images").cast("double"))),
        "generation_events": F.when(latest, F.col("generation_events")),
        "shadow_status": F.when(latest, status).otherwise("无候选模型"),
        "augmentation_note": F.when(latest, F.coalesce("augmentation_reason", F.lit("未启用"))).otherwise("尚未训练"),
        "test_tolerant_agreement": t5}).select(*COLUMNS)


def with_headers(table: DataFrame) -> DataFrame:
    return table.select(*[F.col(c).alias(h) for c, h in zip(COLUMNS, HEADERS)])


def pending_batches(reports: DataFrame, snapshots: DataFrame, keys: Sequence[str] = ("category", "batch_no")) -> DataFrame:
    """Batches without a completed snapshot: listed, never reported."""
    return reports.select(*keys).distinct().join(snapshots.select(*keys), list(keys), "left_anti")


def completeness_check(samples: DataFrame, expected: DataFrame, table_rows: DataFrame, size: int, key: str = "category") -> DataFrame:
    """Processed equals expected, nothing pending, one report row per started batch."""
    done = samples.groupBy(key).agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("reviewed_decision").isNull()).alias("pending"))
    zero = F.lit(0).cast("bigint")
    joined = expected.join(done, key, "left").join(table_rows, key, "left").withColumns({
        c: F.coalesce(c, zero) for c in ("processed", "pending", "batch_rows")})
    wanted = F.ceil(F.col("expected") / F.lit(size))
    return joined.withColumns({"expected_batches": wanted, "violations": reasons(
        processed=F.col("processed") != F.col("expected"), pending=F.col("pending") > 0, batches=F.col("batch_rows") != wanted)})


def audit_integrity(production: DataFrame, files: DataFrame, key: str = "category") -> DataFrame:
    """Production checkpoints that are missing or no longer match their recorded hash."""
    stored = files.select("checkpoint", F.col("sha256").alias("_actual"))
    joined = production.join(stored, "checkpoint", "left")
    return joined.select(key, "version", F.when(F.col("_actual").isNull(), "checkpoint_missing")
                         .when(F.col("_actual") != F.col("sha256"), "checkpoint_changed").otherwise("").alias("error"))


def audit_report(audited: DataFrame, pool_counts: DataFrame, states: DataFrame, at: Column, key: str = "category") -> DataFrame:
    """One row per category: errors of its production checkpoints, members of every pool, its state, and the time of the report.

    ``audited`` is the result of ``audit_integrity``, ``pool_counts`` has one row per pool, ``states`` one row per category.
    """
    wrong = audited.groupBy(key).agg(F.count_if(F.col("error") != "").alias("errors"), F.count(F.lit(1)).alias("production_models"))
    pools = pool_counts.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("pool", "n")))).alias("counts"))  # the closed set of pools
    joined = states.join(pools, key, "left").join(wrong, key, "left").fillna(0, ["errors", "production_models"])
    return joined.withColumns({"status": F.when(F.col("errors") == 0, "ok").otherwise("error"), "created_at": utc_text(at)})


def model_artifact_check(trained: DataFrame, files: DataFrame, tests: DataFrame) -> DataFrame:
    """Trained versions without a test result or with a checkpoint hash that does not match."""
    stored = files.select("version", F.col("sha256").alias("_actual"))
    tested = tests.select("version").distinct().withColumn("_tested", F.lit(True))
    joined = trained.join(stored, "version", "left").join(tested, "version", "left")
    return joined.select("category", "version", reasons(no_test_result=F.col("_tested").isNull(), checkpoint=~F.col("sha256").eqNullSafe(
        F.col("_actual"))).alias("violations")).filter(F.col("violations") != "")


def row_identity(parts: Sequence[Column]) -> Column:
    """Digest of named values in canonical JSON: fixed order, explicit nulls."""
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def cache_identity(*parts: Column) -> Column:
    """Identity of a cached score: everything the score depends on, so a change of any part misses.

    The parts are hashed as JSON, which keeps them apart and tells a NULL from any text.
    """
    return row_identity([p.cast("string").alias(f"p{i}") for i, p in enumerate(parts)])


def score_cache_reuse(requests: DataFrame, cache: DataFrame, key: str = "identity") -> DataFrame:
    """Cached scores by identity; misses keep a NULL score and are the only rows left to infer."""
    stored = cache.select(key, F.col("score")).dropDuplicates([key]).withColumn("hit", F.lit(True))
    return requests.join(stored, key, "left").withColumn("hit", F.coalesce("hit", F.lit(False)))


def threshold_cache_valid(current: DataFrame, cached: DataFrame, parts: Sequence[str], keys: Sequence[str] = ("category",)) -> DataFrame:
    """Thresholds may be reused when bank, calibration OK, rules and NG identities are all unchanged."""
    old = cached.select(*keys, *[F.col(p).alias(f"_{p}") for p in parts], F.lit(True).alias("_found"))
    joined = current.join(old, list(keys), "left")
    changed = reasons(no_cache=F.col("_found").isNull(), **{p: F.col("_found").isNotNull() & ~F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts})
    return joined.select(*keys, changed.alias("changed")).withColumn("valid", F.col("changed") == "")


def feedback_unchanged(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Same rows before and after, by order-free fingerprints of every row."""
    def identity(rows, name):
        row = row_identity([F.col(c).cast("string").alias(c) for c in columns])
        return cohort_fingerprint(rows.withColumn("_row", row), keys, "_row").select(*keys, F.col("fingerprint").alias(name))

    both = identity(before, "before").join(identity(after, "after"), list(keys), "full_outer")
    return both.withColumn("unchanged", F.col("before").eqNullSafe(F.col("after")))


def protocol_mask_audit(images: DataFrame, masks: DataFrame, size: int, key: str = "category") -> DataFrame:
    """NG images per category whose mask is missing, of another size or empty, and the batches to expect.

    ``images``: image, category, label, height, width. ``masks``: image, mask_height, mask_width, defect_pixels.
    """
    joined = images.join(masks, "image", "left")
    ng = F.col("label") == "NG"
    missing = F.col("mask_height").isNull()
    other = (F.col("mask_height") != F.col("height")) | (F.col("mask_width") != F.col("width"))
    return joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("expected_stream"), F.count_if(ng).alias("stream_ng"), F.count_if(ng & missing).alias("missing_mask"),
        F.count_if(ng & ~missing & other).alias("wrong_size"), F.count_if(ng & ~missing & (F.col("defect_pixels") == 0)).alias("empty_mask"),
        F.ceil(F.count(F.lit(1)) / F.lit(size)).alias("expected_batches"))


MANIFEST = ("sample_id", "category", "sha256", "mask_sha256", "excluded_outside_roi")


def training_manifest(columns: Sequence[str] = MANIFEST, **roles: DataFrame) -> DataFrame:
    """One row per training or validation sample with its split, its role (real_ng, synthetic_ng, real_ok, pseudo_ok) and ``columns``."""
    out = None
    for role, rows in roles.items():
        part = rows.select("split", F.lit(role).alias("role"), *columns)
        out = part if out is None else out.unionByName(part)
    return out
