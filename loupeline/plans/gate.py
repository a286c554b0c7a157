"""Segmentation metrics, paired cohorts and promotion verdicts on per-image metric rows."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.functions.decisions import METRIC_VERSION, confusion_case, is_verified
from loupeline.operators import gate as g
from loupeline.operators import metrics as m
from loupeline.operators import runs as u
from loupeline.plans.masks import H, W
from loupeline.plans.metrics import RATES
from loupeline.plans.registry import query
from loupeline.session import written
from loupeline.sources import bindings as b

LAYERS = {"official": 0.5, "shadow": 0.3}


def samples(t):
    """Decisions with the state of their masks; broken masks occur in every third batch only."""
    bad, k = F.col("batch_no") % 3 == 0, F.col("sample_id")
    return b.decisions(t).withColumns({
        "mask_found": ~(bad & (k % 23 == 0)), "mask_readable": ~(bad & (k % 29 == 0)), "mask_valid": ~(bad & (k % 31 == 0)),
        "prediction_found": ~(bad & (k % 37 == 0)), "has_roi": F.col("category") != "2-HIGH"})


def counts(t, layers=tuple(LAYERS)):
    """Pixel counts of the layers; an instance that several layers keep is one row."""
    inst = b.instance_stacks(t, only_ng=True).filter(F.col("conf") >= min(LAYERS[n] for n in layers))
    bits = sum((F.when(F.col("conf") >= LAYERS[n], 2 << i).otherwise(0) for i, n in enumerate(layers)), F.lit(0))
    ends = ["sample_id", "category", "y", "y1", "x0", "x1"]
    marked = b.gt_stacks(t).select(*ends, F.lit(1).alias("layers")).unionByName(inst.select(*ends, bits.alias("layers")))
    return u.layer_counts(u.roi_clip(marked, b.roi_runs(t)), layers, ["sample_id"], H, W)


ROW_COLUMNS = ("sample_id", "category", "batch_no", "label", "gt_status", "predicted_ng", "intersection", "union", "gt_pixels",
               "predicted_pixels", "iou", "tolerant_matched_pixels", "tolerant_total_pixels", "tolerance_pixels", "metric_version")


def rows(t, layer="official", verified=False, pixel_counts=None, keep=()):
    base = samples(t)
    if verified:
        base = base.filter(is_verified("truth", "label_source", layer))
    base = base.withColumn("predicted_ng", F.col(layer) == "NG")
    return u.metric_rows(base, counts(t, (layer,)) if pixel_counts is None else pixel_counts, layer).select(*ROW_COLUMNS, *keep)


def pairs(t, verified=True, pixel_counts=None):
    """Official and shadow rows; one sweep counts both predictions and its small result is stored for the two readers."""
    both = written(counts(t), "pixel-counts") if pixel_counts is None else pixel_counts
    return rows(t, "official", verified, both), rows(t, "shadow", verified, both)


def layer_sql(name):
    return f"""k_{name} AS (SELECT ci.* FROM ci SEMI JOIN gtr USING (sample_id) WHERE conf >= {LAYERS[name]}::DOUBLE), {b.pixels_sql('k_' + name, 'p_' + name)},
i_{name} AS (SELECT sample_id, count(*) AS n FROM gp JOIN p_{name} USING (sample_id, y, x) GROUP BY 1),
s_{name} AS (SELECT sample_id, count(*) AS n FROM p_{name} GROUP BY 1),
m_{name} AS (SELECT sample_id, count(*) AS n FROM gp WHERE EXISTS (SELECT 1 FROM k_{name} r WHERE r.sample_id = gp.sample_id
  AND gp.x BETWEEN r.x0 - 5 AND r.x1 + 5 AND gp.y BETWEEN r.y0 - 5 AND r.y1 + 5) GROUP BY 1),
e_{name} AS (SELECT sample_id, count(*) AS n FROM p_{name} p WHERE NOT EXISTS (SELECT 1 FROM cg r WHERE r.sample_id = p.sample_id
  AND p.x BETWEEN r.x0 - 5 AND r.x1 + 5 AND p.y BETWEEN r.y0 - 5 AND r.y1 + 5) GROUP BY 1),
r0_{name} AS (SELECT s.*, s.{name} = 'NG' AS predicted_ng, coalesce(a.n, 0) AS a, s.{name} = 'NG' AND prediction_found AS shown, coalesce(i.n, 0) AS i,
  coalesce(p.n, 0) AS p, coalesce(mm.n, 0) AS mm, coalesce(e.n, 0) AS e,
  CASE WHEN truth <> 'NG' THEN 'not_required' WHEN NOT mask_found THEN 'missing_gt' WHEN NOT mask_readable THEN 'unreadable_gt'
    WHEN NOT mask_valid THEN 'invalid_gt' WHEN coalesce(a.n, 0) = 0 THEN 'outside_roi' ELSE 'valid' END AS st
  FROM smp s LEFT JOIN ar a USING (sample_id) LEFT JOIN i_{name} i USING (sample_id) LEFT JOIN s_{name} p USING (sample_id)
  LEFT JOIN m_{name} mm USING (sample_id) LEFT JOIN e_{name} e USING (sample_id)),
rows_{name} AS (SELECT sample_id, category, batch_no, label_source, truth, score, threshold, predicted_ng,
  CASE WHEN st = 'outside_roi' THEN 'EXCLUDED' WHEN st IN ('missing_gt', 'unreadable_gt', 'invalid_gt') AND has_roi THEN 'INVALID_GT' ELSE truth END AS label,
  CASE WHEN st = 'valid' AND predicted_ng AND NOT prediction_found THEN 'missing_prediction' ELSE st END AS gt_status,
  CASE WHEN st = 'valid' THEN CASE WHEN shown THEN i ELSE 0 END END AS intersection, CASE WHEN st = 'valid' THEN CASE WHEN shown THEN a + p - i ELSE a END END AS "union",
  CASE WHEN st = 'valid' THEN a END AS gt_pixels, CASE WHEN st = 'valid' THEN CASE WHEN shown THEN p ELSE 0 END END AS predicted_pixels,
  CASE WHEN st = 'valid' THEN CASE WHEN shown THEN i::DOUBLE / (a + p - i) ELSE 0 END END AS iou,
  CASE WHEN st = 'valid' THEN CASE WHEN shown THEN mm ELSE 0 END END AS tolerant_matched_pixels,
  CASE WHEN st = 'valid' THEN CASE WHEN shown THEN a + least(e, a) ELSE a END END AS tolerant_total_pixels FROM r0_{name})"""


BASE = f"""{b.DECISIONS}, {b.GT_RECTS}, {b.INSTANCES}, {b.ROI}, {b.clipped_sql('gtr', 'cg')}, {b.clipped_sql('ins', 'ci')}, {b.pixels_sql('cg', 'gp')},
ar AS (SELECT sample_id, count(*) AS n FROM gp GROUP BY 1),
smp AS (SELECT *, NOT (batch_no % 3 = 0 AND sample_id % 23 = 0) AS mask_found, NOT (batch_no % 3 = 0 AND sample_id % 29 = 0) AS mask_readable,
  NOT (batch_no % 3 = 0 AND sample_id % 31 = 0) AS mask_valid, NOT (batch_no % 3 = 0 AND sample_id % 37 = 0) AS prediction_found, category <> '2-HIGH' AS has_roi FROM dec)"""
ROWS = f"{BASE}, {layer_sql('official')}"
PAIRS = f"{ROWS}, {layer_sql('shadow')}"
VERIFIED = "label_source IN ('human_review', 'folder_ground_truth')"
SEG_SUMS = """count(*) FILTER (gt_status = 'valid') AS segmentation_valid_ng,
  count(*) FILTER (gt_status NOT IN ('valid', 'outside_roi', 'not_required')) AS segmentation_invalid_ng,
  CAST(coalesce(sum(intersection) FILTER (gt_status = 'valid' AND predicted_ng), 0) AS BIGINT) AS intersection,
  CAST(coalesce(sum(CASE WHEN predicted_ng THEN "union" ELSE gt_pixels END) FILTER (gt_status = 'valid'), 0) AS BIGINT) AS "union",
  coalesce(sum(gt_pixels + CASE WHEN predicted_ng THEN predicted_pixels ELSE 0 END) FILTER (gt_status = 'valid'), 0) AS px,
  CAST(coalesce(sum(tolerant_matched_pixels) FILTER (gt_status = 'valid' AND predicted_ng), 0) AS BIGINT) AS tolerant_matched_pixels,
  CAST(coalesce(sum(CASE WHEN predicted_ng THEN tolerant_total_pixels ELSE gt_pixels END) FILTER (gt_status = 'valid'), 0) AS BIGINT) AS tolerant_total_pixels,
  avg(CASE WHEN predicted_ng THEN iou ELSE 0 END) FILTER (gt_status = 'valid') AS miou"""
SEG_RATES = """CASE WHEN segmentation_invalid_ng = 0 AND segmentation_valid_ng > 0 THEN intersection::DOUBLE / "union" END AS iou_micro,
  CASE WHEN segmentation_invalid_ng = 0 AND segmentation_valid_ng > 0 THEN 2 * intersection::DOUBLE / px END AS dice_micro,
  CASE WHEN segmentation_invalid_ng = 0 AND segmentation_valid_ng > 0 THEN round(miou, 9) END AS mean_iou_all_ng,
  CASE WHEN segmentation_invalid_ng = 0 AND segmentation_valid_ng > 0 THEN tolerant_matched_pixels::DOUBLE / tolerant_total_pixels END AS tolerant_agreement_micro,
  CASE WHEN segmentation_invalid_ng > 0 THEN 'incomplete_gt_or_prediction' WHEN segmentation_valid_ng > 0 THEN 'valid' ELSE 'no_valid_ng' END AS segmentation_status"""
CLASS_SUMS = """count(*) FILTER (label = 'NG' AND predicted_ng) AS tp, count(*) FILTER (label = 'OK' AND predicted_ng) AS fp,
  count(*) FILTER (label = 'NG' AND NOT predicted_ng) AS fn, count(*) FILTER (label = 'OK' AND NOT predicted_ng) AS tn"""


def rounded(df):
    return df.withColumn("mean_iou_all_ng", F.round("mean_iou_all_ng", 9))


@query("gt_status", f"WITH {ROWS} SELECT sample_id, category, label, gt_status, intersection, gt_pixels FROM rows_official")
def _(t):
    return rows(t).select("sample_id", "category", "label", "gt_status", "intersection", "gt_pixels")


@query("missing_prediction_override", f"WITH {ROWS} SELECT sample_id, category, batch_no, label FROM rows_official WHERE gt_status = 'missing_prediction'")
def _(t):
    return rows(t).filter("gt_status = 'missing_prediction'").select("sample_id", "category", "batch_no", "label")


@query("gate_counts", f"""WITH {ROWS} SELECT sample_id, CASE WHEN predicted_ng THEN intersection ELSE 0 END AS intersection,
  CASE WHEN predicted_ng THEN "union" ELSE gt_pixels END AS "union", gt_pixels, CASE WHEN predicted_ng THEN predicted_pixels ELSE 0 END AS predicted_pixels,
  CASE WHEN predicted_ng THEN iou ELSE 0 END AS iou, CASE WHEN predicted_ng THEN tolerant_matched_pixels ELSE 0 END AS tolerant_matched_pixels,
  CASE WHEN predicted_ng THEN tolerant_total_pixels ELSE gt_pixels END AS tolerant_total_pixels,
  CASE WHEN predicted_ng THEN tolerant_matched_pixels::DOUBLE / tolerant_total_pixels ELSE 0 END AS tolerant_agreement
FROM rows_official WHERE gt_status = 'valid'""")
def _(t):
    valid = rows(t, keep=("tolerant_agreement",))
    return m.gate_counts(valid).select("sample_id", "intersection", "union", "gt_pixels", "predicted_pixels", "iou",
                                       "tolerant_matched_pixels", "tolerant_total_pixels", "tolerant_agreement")


@query("segmentation_micro", f"WITH {ROWS}, c AS (SELECT category, batch_no, {SEG_SUMS} FROM rows_official GROUP BY 1, 2) SELECT * EXCLUDE (px, miou), {SEG_RATES} FROM c")
def _(t):
    return rounded(m.segmentation_micro(rows(t), ["category", "batch_no"]))


@query("sample_weighted_check", f"""WITH {ROWS} SELECT category, sum(CASE WHEN predicted_ng THEN intersection ELSE 0 END)::DOUBLE
    / sum(CASE WHEN predicted_ng THEN "union" ELSE gt_pixels END) AS iou_micro,
  round(avg(CASE WHEN predicted_ng THEN iou ELSE 0 END), 9) AS iou_macro FROM rows_official WHERE gt_status = 'valid' GROUP BY 1""")
def _(t):
    """Pooled against per-image IoU over the valid rows: large defects weigh more in the pooled one."""
    counted = m.gate_counts(rows(t, keep=("tolerant_agreement",)))
    return counted.groupBy("category").agg((F.sum("intersection").cast("double") / F.sum("union")).alias("iou_micro"),
                                           F.round(F.avg("iou"), 9).alias("iou_macro"))


@query("reviewed_metrics", f"""WITH {ROWS}, c AS (SELECT category, batch_no, {CLASS_SUMS}, count(*) FILTER (label IN ('OK', 'NG')) AS "count", count(*) AS verified_count,
  count(*) FILTER (label = 'EXCLUDED') AS excluded_outside_roi, count(*) FILTER (label = 'INVALID_GT') AS excluded_invalid_gt, {SEG_SUMS}
  FROM rows_official WHERE {VERIFIED} GROUP BY 1, 2)
SELECT * EXCLUDE (px, miou), {RATES}, {SEG_RATES}, 'reviewed_online_subset' AS scope FROM c""")
def _(t):
    return rounded(m.reviewed_metrics(rows(t, verified=True), ["category", "batch_no"]))


@query("complete_vs_reviewed", f"""WITH {ROWS}, c AS (
  SELECT category, 'reviewed_online_subset' AS scope, {CLASS_SUMS}, {SEG_SUMS} FROM rows_official WHERE {VERIFIED} GROUP BY 1 UNION ALL
  SELECT category, 'complete_simulated_batch', {CLASS_SUMS}, {SEG_SUMS} FROM rows_official GROUP BY 1)
SELECT category, scope, tp, fp, fn, tn, intersection, "union", tolerant_matched_pixels, tolerant_total_pixels, segmentation_status FROM
  (SELECT *, {SEG_RATES} FROM c)""")
def _(t):
    shared = written(counts(t, ("official",)), "pixel-counts")
    seen = m.reviewed_metrics(rows(t, verified=True, pixel_counts=shared), ["category"])
    full = m.reviewed_metrics(rows(t, pixel_counts=shared), ["category"], scope="complete_simulated_batch")
    return seen.unionByName(full).select("category", "scope", "tp", "fp", "fn", "tn", "intersection", "union",
                                         "tolerant_matched_pixels", "tolerant_total_pixels", "segmentation_status")


def fixed_test(t):
    """Every order as a fixed test item scored by its price; the threshold can move without touching masks."""
    return rows(t, keep=("score", "tolerant_agreement")).withColumn("predicted_ng", F.col("score") >= 260000.0)


@query("fixed_test_metrics", f"""WITH {ROWS}, tst AS (SELECT * REPLACE (score >= 260000 AS predicted_ng) FROM rows_official),
c AS (SELECT category, {CLASS_SUMS}, count(*) FILTER (label = 'OK') AS test_ok, count(*) FILTER (label = 'NG') AS test_ng,
  count(*) FILTER (label = 'EXCLUDED') AS excluded_outside_roi, count(*) FILTER (label = 'INVALID_GT') AS excluded_invalid_gt, {SEG_SUMS} FROM tst GROUP BY 1),
rk AS (SELECT category, label, rank() OVER w + (count(*) OVER (PARTITION BY category, score) - 1) / 2.0::DOUBLE AS r FROM tst WHERE label IN ('OK', 'NG')
  WINDOW w AS (PARTITION BY category ORDER BY score)),
au AS (SELECT category, (sum(r) FILTER (label = 'NG') - count(*) FILTER (label = 'NG') * (count(*) FILTER (label = 'NG') + 1) / 2.0::DOUBLE)
  / (count(*) FILTER (label = 'NG') * count(*) FILTER (label = 'OK')) AS test_auroc FROM rk GROUP BY 1)
SELECT c.* EXCLUDE (px, miou), {RATES}, {SEG_RATES}, test_auroc FROM c JOIN au USING (category)""")
def _(t):
    test = written(fixed_test(t), "test-rows")
    extra = [F.count_if(F.col("label") == "OK").alias("test_ok"), F.count_if(F.col("label") == "NG").alias("test_ng")]
    result = m.reviewed_metrics(test, ["category"], extra=extra).drop("scope", "count", "verified_count")
    ranked = m.auroc(test.filter("label IN ('OK', 'NG')").withColumn("is_ng", F.col("label") == "NG"), ["category"], "score", "is_ng")
    return rounded(result.join(ranked.withColumnRenamed("auroc", "test_auroc"), "category"))


@query("test_report_cases", f"""WITH {ROWS} SELECT sample_id, category, score, label, gt_status,
  CASE WHEN label = 'NG' THEN CASE WHEN score >= 260000 THEN 'tp' ELSE 'fn' END ELSE CASE WHEN score >= 260000 THEN 'fp' ELSE 'tn' END END AS "case",
  iou AS raw_localization_iou, CASE WHEN gt_status = 'valid' THEN CASE WHEN score >= 260000 THEN iou ELSE 0 END END AS end_to_end_iou,
  CASE WHEN gt_status = 'valid' THEN CASE WHEN score >= 260000 THEN intersection ELSE 0 END END AS intersection,
  CASE WHEN gt_status = 'valid' THEN CASE WHEN score >= 260000 THEN "union" ELSE gt_pixels END END AS "union"
FROM rows_official WHERE label IN ('OK', 'NG')""")
def _(t):
    return report_cases(fixed_test(t))


def report_cases(test):
    """Per-image case rows: raw localization IoU next to the end-to-end counts."""
    valid, hit = F.col("gt_status") == "valid", F.col("predicted_ng")
    return test.filter("label IN ('OK', 'NG')").select(
        "sample_id", "category", "score", "label", "gt_status", confusion_case("label", hit).alias("case"),
        F.col("iou").alias("raw_localization_iou"), F.when(valid, F.when(hit, F.col("iou")).otherwise(F.lit(0.0))).alias("end_to_end_iou"),
        F.when(valid, F.when(hit, F.col("intersection")).otherwise(F.lit(0).cast("bigint"))).alias("intersection"),
        F.when(valid, F.when(hit, F.col("union")).otherwise(F.col("gt_pixels"))).alias("union"))


@query("gt_issues", f"WITH {ROWS} SELECT sample_id, category, gt_status AS status FROM rows_official WHERE gt_status NOT IN ('valid', 'not_required')")
def _(t):
    return rows(t).filter("gt_status NOT IN ('valid', 'not_required')").select("sample_id", "category", F.col("gt_status").alias("status"))


@query("metric_version_check", f"""WITH {ROWS} SELECT category, count(*) AS valid_rows, count(*) FILTER (sample_id % 7 = 0) AS legacy_rows,
  count(*) FILTER (sample_id % 7 = 0) > 0 AS refused FROM rows_official WHERE gt_status = 'valid' GROUP BY 1""")
def _(t):
    """Rows whose counts came from an older metric version must be recomputed before they are compared."""
    mixed = rows(t).withColumn("metric_version", F.when(F.col("sample_id") % 7 == 0, "tolerant_agreement_r5_chebyshev_v1").otherwise(F.lit(METRIC_VERSION)))
    valid = mixed.filter("gt_status = 'valid'")
    return valid.groupBy("category").agg(F.count(F.lit(1)).alias("valid_rows"), F.count_if(m.legacy_counts()).alias("legacy_rows")).withColumn(
        "refused", F.col("legacy_rows") > 0)


@query("paired_cohort", f"""WITH {PAIRS}, o AS (SELECT * FROM rows_official WHERE {VERIFIED}), s AS (SELECT * FROM rows_shadow WHERE {VERIFIED} AND sample_id % 97 <> 0)
SELECT category, sample_id, CASE WHEN o.label IS NULL THEN 'missing_official' WHEN s.label IS NULL THEN 'missing_candidate'
  WHEN o.label <> s.label THEN 'label_mismatch' ELSE 'paired' END AS pair_status, o.intersection AS official_intersection, s.intersection AS candidate_intersection
FROM o FULL JOIN s USING (category, sample_id)""")
def _(t):
    old, new = pairs(t)
    cohort = g.paired_cohort(old, new.filter("sample_id % 97 <> 0"), ["category"])
    return cohort.select("category", "sample_id", "pair_status", F.col("official.intersection").alias("official_intersection"),
                         F.col("candidate.intersection").alias("candidate_intersection"))


def side_sql(source, alias, key):
    return f"""{alias} AS (SELECT category, {key}, {CLASS_SUMS}, {SEG_SUMS}, count(*) FILTER (label = 'INVALID_GT') AS inv, count(*) AS n FROM {source}
  WHERE {VERIFIED} GROUP BY 1, 2)"""


def verdict_sql(key, official, shadow):
    """One verdict per (category, key) over two sources of metric rows."""
    return f"""{side_sql(official, 'o', key)}, {side_sql(shadow, 'c', key)},
j AS (SELECT o.category, o.{key}, o.n AS reviewed, 2 * o.fn + o.fp AS official_error_cost, 2 * c.fn + c.fp AS candidate_error_cost,
  {", ".join(f"{a}.{col} AS {side}_{out}" for a, side in (("o", "official"), ("c", "candidate")) for col, out in (("fn", "fn"), ("fp", "fp"), ("intersection", "intersection"), ('"union"', "union"), ("tolerant_matched_pixels", "matched"), ("tolerant_total_pixels", "total")))},
  CASE WHEN o.segmentation_valid_ng > 0 AND o.segmentation_invalid_ng = 0 THEN o.intersection::DOUBLE / o."union" END AS official_iou_micro,
  CASE WHEN c.segmentation_valid_ng > 0 AND c.segmentation_invalid_ng = 0 THEN c.intersection::DOUBLE / c."union" END AS candidate_iou_micro,
  CASE WHEN o.segmentation_valid_ng > 0 AND o.segmentation_invalid_ng = 0 THEN o.tolerant_matched_pixels::DOUBLE / o.tolerant_total_pixels END AS official_tolerant_agreement_micro,
  CASE WHEN c.segmentation_valid_ng > 0 AND c.segmentation_invalid_ng = 0 THEN c.tolerant_matched_pixels::DOUBLE / c.tolerant_total_pixels END AS candidate_tolerant_agreement_micro,
  o.tp + o.fn > 0 AND o.fp + o.tn > 0 AND o.segmentation_valid_ng > 0 AND o.segmentation_invalid_ng = 0 AND o.inv = 0 AND
  c.tp + c.fn > 0 AND c.fp + c.tn > 0 AND c.segmentation_valid_ng > 0 AND c.segmentation_invalid_ng = 0 AND c.inv = 0 AS complete
  FROM o JOIN c USING (category, {key})),
k AS (SELECT *, candidate_error_cost < official_error_cost AS lo, candidate_error_cost = official_error_cost AS eq,
  candidate_matched::HUGEINT * official_total > official_matched::HUGEINT * candidate_total AS be,
  100 * (candidate_matched::HUGEINT * official_total - official_matched::HUGEINT * candidate_total) >= 20 * official_total::HUGEINT * candidate_total AS la FROM j),
verdict AS (SELECT * EXCLUDE (complete, lo, eq, be, la), CASE WHEN complete AND (lo OR (eq AND be) OR la) THEN 'promote' ELSE 'reject' END AS decision,
  CASE WHEN NOT complete THEN 'insufficient_or_invalid_metrics' WHEN lo THEN 'lower_error_cost' WHEN eq AND be THEN 'equal_cost_better_tolerance'
    WHEN la THEN 'tolerance_gain_at_least_20_points' WHEN NOT eq THEN 'higher_error_cost' ELSE 'equal_cost_no_tolerance_gain' END AS reason,
  CASE WHEN complete THEN lo END AS lower_error_cost, CASE WHEN complete THEN eq END AS equal_error_cost, CASE WHEN complete THEN be END AS tolerance_improved,
  CASE WHEN complete THEN la END AS tolerance_gain_at_least_20_points FROM k)"""


def verdicts(t, pixel_counts=None):
    return g.promotion_gate(*pairs(t, pixel_counts=pixel_counts), ["category", "batch_no"])


VERDICT = f"{PAIRS}, {verdict_sql('batch_no', 'rows_official', 'rows_shadow')}"


@query("promotion_gate_per_batch", f"WITH {VERDICT} SELECT * FROM verdict")
def _(t):
    """Every batch judged on its own; ``promotion_gate`` judges the whole shadow window of a model."""
    return verdicts(t)


PAIR = "CASE WHEN {ok} THEN concat({a}, ' → ', {c}) END AS {name}"
PERCENT = "printf('%.4f%%', {0} * 100)"


def pair_sql(metric, name, percent=False):
    old, new = f"official_{metric}", f"candidate_{metric}"
    a, c = [PERCENT.format(v) if percent else v for v in (old, new)]
    return PAIR.format(ok=f"ok AND {old} IS NOT NULL AND {new} IS NOT NULL", a=a, c=c, name=name)


@query("shadow_window", f"""WITH {ROWS}, bt AS (SELECT category, batch_no // 7 AS model, batch_no, count(*) FILTER (label = 'NG' AND gt_status = 'valid') AS ng
  FROM rows_official WHERE {VERIFIED} GROUP BY 1, 2, 3),
r AS (SELECT *, CAST(sum(ng) OVER w AS BIGINT) AS shadow_ng, row_number() OVER w AS shadow_batches FROM bt WINDOW w AS (PARTITION BY category, model ORDER BY batch_no)),
d AS (SELECT *, shadow_ng >= 60 OR shadow_batches >= 5 AS hit FROM r)
SELECT category, model, batch_no, shadow_ng, shadow_batches, hit AND NOT coalesce(lag(hit) OVER (PARTITION BY category, model ORDER BY batch_no), false) AS due FROM d""")
def _(t):
    batches = rows(t, verified=True).withColumn("model", F.floor(F.col("batch_no") / 7)).groupBy("category", "model", "batch_no").agg(
        F.count_if((F.col("label") == "NG") & (F.col("gt_status") == "valid")).alias("valid_ng"))
    return g.shadow_window(batches, ["category", "model"], min_ng=60)


@query("disagreements", f"WITH {b.DECISIONS} SELECT sample_id, category, batch_no, official, shadow FROM dec WHERE {VERIFIED} AND official <> shadow")
def _(t):
    return b.decisions(t).filter(is_verified("truth", "label_source", "official") & (F.col("official") != F.col("shadow"))).select(
        "sample_id", "category", "batch_no", "official", "shadow")
