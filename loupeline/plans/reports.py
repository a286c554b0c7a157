"""Reports, audits, caches and file round trips."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.functions.decisions import METRIC_VERSION, PROMOTION_RULE, confusion_case, ratio
from loupeline.functions.review import assumed_review, export_review_batch, folder_truth_review, import_review_batch
from loupeline.operators import calibration as c
from loupeline.operators import gate as g
from loupeline.operators import lifecycle as l
from loupeline.operators import metrics as m
from loupeline.operators import reports as rp
from loupeline.operators import regions as rg
from loupeline.operators import review as r
from loupeline.operators import runs as u
from loupeline.operators import splits as s
from loupeline.operators.ordering import fill_forward, seeded
from loupeline.plans import gate as pg
from loupeline.plans import lifecycle as pl
from loupeline.plans import masks as pm
from loupeline.plans import splits as ps
from loupeline.plans import validation as pv
from loupeline.plans.calibration import FIRST_SQL
from loupeline.plans.metrics import RATES
from loupeline.plans.registry import SQL, query
from loupeline.plans.review import ESCALATED, KEYS, batch_report
from loupeline.session import scratch, written
from loupeline.sources import bindings as b
from loupeline.sources import files as fs


@query("category_summary", f"""WITH {pg.ROWS}, x AS (SELECT *, CASE WHEN label_source = 'initial_calibration_yolo_train_ok' THEN 'i'
    WHEN label_source IS NULL OR label_source NOT IN ('human_review', 'folder_ground_truth') THEN 'u' WHEN sample_id % 53 = 0 THEN 'm' ELSE 'k' END AS why FROM rows_official),
e AS (SELECT category, count(*) FILTER (why = 'i') AS excluded_initialization, count(*) FILTER (why = 'u') AS excluded_unverified, count(*) FILTER (why = 'm') AS missing_prediction_records FROM x GROUP BY 1),
cl AS (SELECT category, {pg.CLASS_SUMS}, {pg.SEG_SUMS} FROM x WHERE why = 'k' GROUP BY 1),
la AS (SELECT category, round(avg(latency_ms), 9) AS latency_ms_mean FROM dec WHERE label_source IN ('human_review', 'folder_ground_truth') AND sample_id % 53 <> 0 GROUP BY 1)
SELECT cl.* EXCLUDE (px, miou), {RATES}, {pg.SEG_RATES}, tn::DOUBLE / nullif(tn + fp, 0) AS specificity, latency_ms_mean, excluded_initialization, excluded_unverified, missing_prediction_records
FROM cl JOIN e USING (category) JOIN la USING (category)""")
def _(t):
    found = F.col("sample_id") % 53 != 0
    excluded = l.exclusion_accounting(b.decisions(t), ["category"], found)
    kept = pg.rows(t, verified=True, keep=("latency_ms",)).filter(found)
    result = m.reviewed_metrics(kept, ["category"], extra=[F.round(F.avg("latency_ms"), 9).alias("latency_ms_mean")])
    summary = result.drop("scope", "count", "verified_count", "excluded_outside_roi", "excluded_invalid_gt")
    return pg.rounded(summary.withColumn("specificity", ratio("tn", F.col("tn") + F.col("fp"))).join(excluded, "category"))


LATEST = f"""WITH {pl.MODELS}, bt AS (SELECT DISTINCT category, batch_no FROM dec)
SELECT bt.category, bt.batch_no, arg_max(version, start_batch) AS latest_version, max(start_batch) AS start_batch, arg_max(milestone, start_batch) AS milestone,
  arg_max(coalesce(verdict_batch, 9999), start_batch) AS vb, arg_max(coalesce(decision, ''), start_batch) AS decision FROM bt LEFT JOIN models m ON m.category = bt.category AND m.start_batch <= bt.batch_no GROUP BY 1, 2"""
STATUS_SQL = "CASE WHEN latest_version IS NULL THEN NULL WHEN vb > batch_no THEN 'shadow_candidate' WHEN decision = 'promote' THEN 'promoted' ELSE 'rejected_shadow' END"
TEXT_SQL = "CASE {0} WHEN 'shadow_candidate' THEN '影子中' WHEN 'promoted' THEN '已晋升' WHEN 'rejected_shadow' THEN '影子拒绝' END"
NAME_SQL = "CASE WHEN {0} = 'pretrained' THEN '预训练模型' ELSE concat('YOLO-v', string_split(string_split({0}, '-seg-v')[2], '-')[1]) END"


def latest_models(t, known=None):
    """Newest candidate known at the end of each batch, with the status its snapshot shows then."""
    trained = (pl.models(t) if known is None else known).select("category", F.col("start_batch").alias("batch_no"), F.struct(
        "version", "milestone", "verdict_batch", "decision").alias("model"))
    events = b.decisions(t).select(*KEYS).distinct().join(trained, KEYS, "left")
    known = fill_forward(events, ["category"], [F.col("batch_no")], {"latest": "model"})
    open_verdict = F.coalesce(F.col("latest.verdict_batch") > F.col("batch_no"), F.lit(True))
    status = F.when(F.col("latest").isNotNull(), F.when(open_verdict, "shadow_candidate").when(F.col("latest.decision") == "promote", "promoted").otherwise("rejected_shadow"))
    return known.select(*KEYS, F.col("latest.version").alias("latest_version"), F.col("latest.milestone").alias("milestone"),
                        F.col("latest.verdict_batch").alias("verdict_batch"), status.alias("latest_status"))


def verdict_texts(verdicts):
    ruled = verdicts.filter("decision IS NOT NULL").withColumn("rule", F.lit(PROMOTION_RULE))
    return g.gate_pairs(ruled, PROMOTION_RULE).select("category", F.col("version").alias("latest_version"), "fn_pair", "fp_pair", "iou_pair", "cost_pair", "t5_pair")


@query("snapshot_shadow_leak_guard", f"""SELECT category, batch_no, latest_version, {STATUS_SQL} AS latest_status, CASE WHEN {STATUS_SQL} IN ('promoted', 'rejected_shadow') THEN decision END AS verdict
FROM ({LATEST})""")
def _(t):
    known = pl.models(t)
    decided = known.select("category", F.col("version").alias("latest_version"), F.col("decision").alias("verdict"))
    joined = latest_models(t, known).join(decided, ["category", "latest_version"], "left")
    return rp.visible_verdict(joined, ["verdict"]).select(*KEYS, "latest_version", "latest_status", "verdict")


SIMULATION = f"""WITH full_m AS (WITH {pg.ROWS}, c AS (SELECT category, batch_no, {pg.CLASS_SUMS}, {pg.SEG_SUMS} FROM rows_official GROUP BY 1, 2) SELECT * EXCLUDE (px, miou), {RATES}, {pg.SEG_RATES} FROM c),
test_m AS (WITH {pg.ROWS}, tst AS (SELECT * REPLACE (score >= 260000 AS predicted_ng) FROM rows_official), c AS (SELECT category, {pg.CLASS_SUMS}, {pg.SEG_SUMS} FROM tst GROUP BY 1) SELECT * EXCLUDE (px, miou), {RATES}, {pg.SEG_RATES} FROM c),
rep AS ({SQL['batch_report']}), snp AS ({SQL['batch_snapshot']}), frc AS ({SQL['model_in_force']}), lat AS (SELECT *, {STATUS_SQL} AS status FROM ({LATEST})),
prs AS ({SQL['gate_pairs'].replace('verdict_batch % 5 <> 0 AS ok', 'true AS ok')}),
j AS (SELECT rep.category, rep.batch_no, rep."count" AS inputs, concat(rep.input_ok, '/', rep.input_ng) AS input_ok_ng, concat(rep.predicted_ok, '/', rep.predicted_ng) AS predicted_ok_ng, rep.reviewed,
  concat(eligible_training_ok, '/', eligible_training_ng) AS trainable_ok_ng, {NAME_SQL.format('used_model')} AS official_model, f.recall, f.ok_false_positive_rate, f.iou_micro,
  CASE WHEN latest_version IS NULL THEN '—' ELSE concat({NAME_SQL.format('latest_version')}, '（', {TEXT_SQL.format('status')}, '）') END AS latest_model,
  CASE WHEN latest_version IS NOT NULL THEN concat(milestone * 4 - milestone, '/', milestone) END AS trained_ok_ng,
  CASE WHEN latest_version IS NOT NULL THEN x.recall END AS test_recall, CASE WHEN latest_version IS NOT NULL THEN x.ok_false_positive_rate END AS test_fpr,
  CASE WHEN latest_version IS NOT NULL THEN x.iou_micro END AS test_iou, '未加伪缺陷' AS scheme, f.fn, f.fp, CASE WHEN latest_version IS NOT NULL THEN x.fn END AS test_fn,
  CASE WHEN latest_version IS NOT NULL THEN x.fp END AS test_fp, CASE WHEN latest_version IS NOT NULL THEN milestone - milestone // 20 END AS trained_real_ng,
  CASE WHEN latest_version IS NOT NULL THEN milestone // 20 END AS trained_synthetic, CASE WHEN latest_version IS NOT NULL THEN (milestone // 20)::DOUBLE / (milestone * 4) END AS synthetic_share,
  CASE WHEN latest_version IS NOT NULL THEN milestone // 40 END AS generation_events, coalesce({TEXT_SQL.format('status')}, '无候选模型') AS shadow_status,
  CASE WHEN latest_version IS NOT NULL THEN '未启用' ELSE '尚未训练' END AS augmentation_note,
  {", ".join(f"CASE WHEN status IN ('promoted', 'rejected_shadow') THEN prs.{p} END AS {p}" for p in ("fn_pair", "fp_pair", "iou_pair", "cost_pair", "t5_pair"))},
  f.error_cost, f.tolerant_agreement_micro AS tolerant_agreement, CASE WHEN latest_version IS NOT NULL THEN x.error_cost END AS test_error_cost,
  CASE WHEN latest_version IS NOT NULL THEN x.tolerant_agreement_micro END AS test_tolerant_agreement
  FROM rep JOIN full_m f USING (category, batch_no) JOIN test_m x USING (category) JOIN snp USING (category, batch_no) JOIN frc USING (category, batch_no)
  JOIN lat USING (category, batch_no) LEFT JOIN prs ON prs.category = rep.category AND prs.version = lat.latest_version)
SELECT * FROM j"""


@query("simulation_table", SIMULATION)
def _(t):
    return simulation(t)


def simulation(t):
    shared = written(pg.counts(t), "pixel-counts")  # one sweep serves the online, test and shadow metrics
    full = m.reviewed_metrics(pg.rows(t, pixel_counts=shared), KEYS, scope="complete_simulated_batch").select(
        *KEYS, "recall", "ok_false_positive_rate", "iou_micro", "fn", "fp", "error_cost", F.col("tolerant_agreement_micro").alias("tolerant_agreement"))
    scored = pg.rows(t, pixel_counts=shared, keep=("score",)).withColumn("predicted_ng", F.col("score") >= 260000.0)
    known = lambda name: F.when(F.col("latest_version").isNotNull(), F.col(name))
    test = m.reviewed_metrics(scored, ["category"]).select(
        "category", F.col("recall").alias("_recall"), F.col("ok_false_positive_rate").alias("_fpr"), F.col("iou_micro").alias("_iou"), F.col("fn").alias("_fn"),
        F.col("fp").alias("_fp"), F.col("error_cost").alias("_cost"), F.col("tolerant_agreement_micro").alias("_t5"))
    report = batch_report(r.reviewed_batch(b.decisions(t), KEYS)).select(*KEYS, F.col("count").alias("inputs"), "reviewed", "input_ok", "input_ng", "predicted_ok", "predicted_ng")
    milestone = F.col("milestone")
    candidates, verdicts = pl.judged(t, shared)  # one gate for the model in force, the status shown and the numbers beside it
    joined = (report.join(full, KEYS).join(pl.snapshots(t), KEYS).join(pl.in_force(t, candidates), KEYS).join(latest_models(t, candidates), KEYS).join(test, "category")
              .join(verdict_texts(verdicts), ["category", "latest_version"], "left"))
    ready = joined.withColumns({
        "trained_images": milestone * 4, "trained_ng": milestone, "selected_synthetic": F.floor(milestone / 20), "generation_events": F.floor(milestone / 40),
        "augmentation_reason": F.lit(None).cast("string"), "test_metric_version": F.lit(METRIC_VERSION), "test_recall": known("_recall"), "test_fpr": known("_fpr"),
        "test_iou": known("_iou"), "test_fn": known("_fn"), "test_fp": known("_fp"), "test_error_cost": known("_cost"), "test_tolerant_agreement": known("_t5")})
    return rp.simulation_table(ready)


@query("pending_batches", f"""WITH {pl.SNAP} SELECT DISTINCT d.category, d.batch_no FROM dec d WHERE NOT EXISTS (SELECT 1 FROM snap WHERE snap.category = d.category AND snap.batch_no = d.batch_no
  AND eligible_training_ok > 300)""")
def _(t):
    return rp.pending_batches(b.decisions(t), pl.snapshots(t).filter("eligible_training_ok > 300"))


@query("completeness_check", f"""WITH {b.DECISIONS}, ex AS (SELECT category, count(*) AS expected FROM dec GROUP BY 1), d AS (SELECT category, count(*) AS processed,
    count(*) FILTER (label_source IS NULL) AS pending FROM dec WHERE category <> '5-LOW' OR sample_id % 2 = 0 GROUP BY 1),
tb AS (SELECT category, count(DISTINCT batch_no) AS batch_rows FROM dec GROUP BY 1)
SELECT category, expected, processed, pending, batch_rows, CAST(ceil(expected / 200.0::DOUBLE) AS BIGINT) AS expected_batches,
  concat_ws(',', CASE WHEN processed <> expected THEN 'processed' END, CASE WHEN pending > 0 THEN 'pending' END, CASE WHEN batch_rows <> CAST(ceil(expected / 200.0::DOUBLE) AS BIGINT) THEN 'batches' END) AS violations
FROM ex JOIN d USING (category) JOIN tb USING (category)""")
def _(t):
    rows = b.decisions(t)
    expected = rows.groupBy("category").agg(F.count(F.lit(1)).alias("expected"))
    done = rows.filter("category <> '5-LOW' OR sample_id % 2 = 0").withColumn("reviewed_decision", F.when(F.col("label_source").isNotNull(), F.col("truth")))
    table = rows.groupBy("category").agg(F.countDistinct("batch_no").alias("batch_rows"))
    return rp.completeness_check(done, expected, table, 200)


FILES_SQL = "SELECT p_partkey AS k, concat('ckpt/', p_partkey) AS checkpoint, sha256(CAST(p_partkey + CASE WHEN p_size % 9 = 0 THEN 1 ELSE 0 END AS VARCHAR)) AS sha256 FROM part WHERE p_size % 7 <> 0"


def checkpoints(t):
    """Stored checkpoint files: some missing, some changed since registration."""
    k = F.col("p_partkey")
    return t.part.filter("p_size % 7 <> 0").select(k.alias("k"), F.concat(F.lit("ckpt/"), k.cast("string")).alias("checkpoint"),
                                                   F.sha2((k + F.when(F.col("p_size") % 9 == 0, 1).otherwise(0)).cast("string"), 256).alias("sha256"))


@query("audit_integrity", f"""WITH pr AS (SELECT p_brand AS category, p_type AS version, concat('ckpt/', p_partkey) AS checkpoint, sha256(CAST(p_partkey AS VARCHAR)) AS sha256, p_partkey FROM part), f AS ({FILES_SQL})
SELECT category, version, CASE WHEN f.k IS NULL THEN 'checkpoint_missing' WHEN f.sha256 <> pr.sha256 THEN 'checkpoint_changed' ELSE '' END AS error FROM pr LEFT JOIN f ON f.checkpoint = pr.checkpoint""")
def _(t):
    k = F.col("p_partkey").cast("string")
    production = t.part.select(F.col("p_brand").alias("category"), F.col("p_type").alias("version"), F.concat(F.lit("ckpt/"), k).alias("checkpoint"), F.sha2(k, 256).alias("sha256"))
    return rp.audit_integrity(production, checkpoints(t))


AUDIT_AT = "2024-02-29 23:59:58.125"


@query("audit_report", f"""WITH pr AS (SELECT p_brand AS category, p_size, p_partkey, CASE WHEN p_size % 7 = 0 OR p_size % 9 = 0 THEN 1 ELSE 0 END AS bad FROM part),
n AS (SELECT category, p_size % 12 AS i, count(*) AS n FROM pr GROUP BY 1, 2), p(i, pool) AS (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(l.POOLS))}),
c AS (SELECT c.category, string_agg(concat(p.pool, '=', coalesce(n.n, 0)), ',' ORDER BY p.pool) AS counts FROM (SELECT DISTINCT category FROM pr) c CROSS JOIN p LEFT JOIN n ON n.category = c.category AND n.i = p.i GROUP BY 1)
SELECT pr.category, max(p_size) AS last_milestone, any_value(c.counts) AS counts, CAST(sum(bad) AS BIGINT) AS errors, count(*) AS production_models, CASE WHEN sum(bad) = 0 THEN 'ok' ELSE 'error' END AS status,
  '2024-02-29T23:59:58.125000+00:00' AS created_at FROM pr JOIN c USING (category) GROUP BY 1""")
def _(t):
    k = F.col("p_partkey").cast("string")
    rows = t.part.withColumn("category", F.col("p_brand"))
    production = rows.select("category", F.col("p_type").alias("version"), F.concat(F.lit("ckpt/"), k).alias("checkpoint"), F.sha2(k, 256).alias("sha256"))
    pool = F.element_at(F.array(*[F.lit(p) for p in l.POOLS]), (F.col("p_size") % 12 + 1).cast("int"))
    counts = l.pool_counts(rows.select(F.col("p_partkey").alias("sample_id"), "category", pool.alias("pool")), rows.select("category").distinct())
    states = rows.groupBy("category").agg(F.max("p_size").alias("last_milestone"))
    report = rp.audit_report(rp.audit_integrity(production, checkpoints(t)), counts, states, F.lit(AUDIT_AT).cast("timestamp"))
    flat = F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return report.withColumn("counts", flat).select("category", "last_milestone", "counts", "errors", "production_models", "status", "created_at")


@query("model_artifact_check", f"""WITH f AS ({FILES_SQL}) SELECT p_brand AS category, CAST(p_partkey AS VARCHAR) AS version, concat_ws(',', CASE WHEN p_size % 6 = 0 THEN 'no_test_result' END,
  CASE WHEN f.sha256 IS NULL OR f.sha256 <> sha256(CAST(p_partkey AS VARCHAR)) THEN 'checkpoint' END) AS violations FROM part LEFT JOIN f ON f.k = p_partkey
WHERE p_size % 6 = 0 OR f.sha256 IS NULL OR f.sha256 <> sha256(CAST(p_partkey AS VARCHAR))""")
def _(t):
    k = F.col("p_partkey").cast("string")
    trained = t.part.select(F.col("p_brand").alias("category"), k.alias("version"), F.sha2(k, 256).alias("sha256"))
    stored = checkpoints(t).select(F.col("k").cast("string").alias("version"), "sha256")
    return rp.model_artifact_check(trained, stored, t.part.filter("p_size % 6 <> 0").select(k.alias("version")))


@query("score_cache_reuse", """WITH x AS (SELECT doc_id, source, lang, sha256(text) AS sha FROM documents),
c AS (SELECT sha, lang, min(n_chars) / 100.0::DOUBLE AS score FROM (SELECT sha256(text) AS sha, lang, n_chars FROM documents WHERE doc_id % 3 <> 0) GROUP BY 1, 2)
SELECT doc_id, c.score IS NOT NULL AS hit, c.score FROM x LEFT JOIN c ON c.sha = x.sha AND c.lang = x.lang""")
def _(t):
    """Scores depend on content, model (here the language) and metric version; a copy of scored content is a hit."""
    rows = t.documents.select("doc_id", (F.col("n_chars") / F.lit(100.0)).alias("score"), rp.cache_identity(
        F.sha2("text", 256), F.col("lang"), F.lit(METRIC_VERSION)).alias("identity"))
    cache = rows.filter("doc_id % 3 <> 0").groupBy("identity").agg(F.min("score").alias("score"))
    return rp.score_cache_reuse(rows.select("doc_id", "identity"), cache).select("doc_id", "hit", "score")


@query("threshold_cache_valid", f"""WITH {b.DECISIONS}, a AS (SELECT category, batch_no, CAST(sum(camera_id) AS BIGINT) AS bank, CAST(sum(sample_id) FILTER (truth = 'OK') AS BIGINT) AS ok, count(*) FILTER (truth = 'NG') AS ng FROM dec GROUP BY 1, 2),
n AS (SELECT * FROM a), o AS (SELECT * REPLACE (batch_no + 1 AS batch_no) FROM a)
SELECT n.category, n.batch_no, concat_ws(',', CASE WHEN o.category IS NULL THEN 'no_cache' END, CASE WHEN o.bank <> n.bank THEN 'bank' END, CASE WHEN o.ok IS DISTINCT FROM n.ok AND o.category IS NOT NULL THEN 'ok' END, CASE WHEN o.ng <> n.ng THEN 'ng' END) AS changed,
  o.category IS NOT NULL AND o.bank = n.bank AND o.ok IS NOT DISTINCT FROM n.ok AND o.ng = n.ng AS valid FROM n LEFT JOIN o ON o.category = n.category AND o.batch_no = n.batch_no""")
def _(t):
    """Every batch against the one before it."""
    parts = b.decisions(t).groupBy(*KEYS).agg(F.sum("camera_id").alias("bank"), F.sum(F.when(F.col("truth") == "OK", F.col("sample_id"))).alias("ok"),
                                              F.count_if(F.col("truth") == "NG").alias("ng"))
    return rp.threshold_cache_valid(parts, parts.withColumn("batch_no", F.col("batch_no") + 1), ("bank", "ok", "ng"), KEYS)


@query("feedback_unchanged", f"""WITH {b.DECISIONS} SELECT category, NOT bool_or(sample_id % 5000 = 77 AND category = '1-URGENT') AS unchanged FROM dec GROUP BY 1""")
def _(t):
    before = b.decisions(t)
    touched = (F.col("sample_id") % 5000 == 77) & (F.col("category") == "1-URGENT")
    after = before.withColumn("truth", F.when(touched, "CHANGED").otherwise(F.col("truth")))
    return rp.feedback_unchanged(before, after, ["category"], ["sample_id", "truth", "label_source"]).select("category", "unchanged")


@query("protocol_mask_audit", f"""WITH {b.GT_RECTS}, a AS (SELECT sample_id, count(*) AS n FROM gtr GROUP BY 1),
im AS (SELECT o_orderkey AS k, o_orderpriority AS category, CASE WHEN o_orderstatus = 'F' THEN 'NG' ELSE 'OK' END AS label FROM orders)
SELECT category, count(*) AS expected_stream, count(*) FILTER (label = 'NG') AS stream_ng, count(*) FILTER (label = 'NG' AND k % 23 = 0) AS missing_mask,
  count(*) FILTER (label = 'NG' AND k % 23 <> 0 AND k % 31 = 0) AS wrong_size, count(*) FILTER (label = 'NG' AND k % 23 <> 0 AND k % 37 = 0) AS empty_mask,
  CAST(ceil(count(*) / 200.0::DOUBLE) AS BIGINT) AS expected_batches FROM im GROUP BY 1""")
def _(t):
    k, height, width = F.col("o_orderkey"), F.lit(b.IMAGE_HEIGHT), F.lit(b.IMAGE_WIDTH)
    images = t.orders.select(k.alias("image"), F.col("o_orderpriority").alias("category"), F.when(F.col("o_orderstatus") == "F", "NG").otherwise("OK").alias("label"),
                             height.alias("height"), width.alias("width"))
    area = u.mask_area(u.merge_runs(b.gt_runs(t).select("sample_id", *u.RUN), ["sample_id"]), ["sample_id"])
    key = F.col("sample_id")
    masks = area.filter(key % 23 != 0).select(key.alias("image"), F.when(key % 31 == 0, height + 1).otherwise(height).alias("mask_height"), width.alias("mask_width"),
                                              F.when(key % 37 == 0, 0).otherwise(F.col("area")).alias("defect_pixels"))
    return rp.protocol_mask_audit(images, masks, 200)


@query("review_join", f"""WITH {b.DECISIONS} SELECT d.sample_id, d.category, d.official AS model_decision, d.truth AS reviewed_decision, CASE WHEN truth = 'NG' THEN concat('mask/', sample_id, '.png') END AS mask_path,
  'automatic_folder_ground_truth' AS reviewer FROM dec d""")
def _(t):
    rows = b.decisions(t)
    key = F.col("sample_id").cast("string")
    truth = rows.select("sample_id", F.concat_ws("/", F.lit("lot"), "truth", F.concat(key, F.lit(".png"))).alias("path"),
                        F.when(F.col("truth") == "NG", F.concat(F.lit("mask/"), key, F.lit(".png"))).alias("mask"))
    return folder_truth_review(rows.select("sample_id", "category", F.col("official").alias("decision")), truth).select(
        "sample_id", "category", "model_decision", "reviewed_decision", "mask_path", "reviewer")


@query("folder_review", f"""WITH {pv.IMAGES}, {pv.FILES}, f AS (SELECT k, o_orderpriority, CASE WHEN k % 19 = 0 THEN replace(image, '/NG/', '/OK/') WHEN k % 41 = 0 THEN replace(image, '/NG/', '/new/') ELSE image END AS image
    FROM img JOIN orders ON o_orderkey = k WHERE k % 43 <> 0),
d AS (SELECT k, depth, count(DISTINCT mask) AS n, min(mask) AS mask FROM mk GROUP BY 1, 2), nr AS (SELECT k, min(depth) AS depth FROM mk GROUP BY 1), hit AS (SELECT d.* FROM d JOIN nr USING (k, depth)),
x AS (SELECT o_orderkey AS sample_id, CASE WHEN o_orderkey % 17 = 0 THEN '5-LOW' ELSE o.o_orderpriority END AS category, f.k IS NOT NULL AS there, contains(image, '/OK/') AS ok, contains(image, '/NG/') AS ng, o.o_orderpriority AS folder, n, mask
  FROM orders o LEFT JOIN f ON f.k = o_orderkey LEFT JOIN hit ON hit.k = o_orderkey),
y AS (SELECT *, CASE WHEN NOT there THEN 'no_file' WHEN NOT ok AND NOT ng THEN 'no_label' WHEN folder <> category THEN 'category_mismatch' WHEN ng AND n > 1 THEN 'ambiguous_masks' END AS error FROM x)
SELECT sample_id, category, CASE WHEN error IS NULL THEN CASE WHEN ng THEN 'NG' ELSE 'OK' END END AS reviewed_decision, CASE WHEN error IS NULL AND ng THEN mask END AS mask_path, error FROM y""")
def _(t):
    """Truth, category and mask of every sample from one folder tree, some files missing, misplaced or with two masks."""
    n, paths = F.col("k"), pv.image_paths(t)
    moved = F.when(n % 19 == 0, F.replace("image", F.lit("/NG/"), F.lit("/OK/"))).when(n % 41 == 0, F.replace("image", F.lit("/NG/"), F.lit("/new/"))).otherwise(F.col("image"))
    files = paths.filter(n % 43 != 0).select(n.alias("sample_id"), moved.alias("path"))
    samples = t.orders.select(F.col("o_orderkey").alias("sample_id"), F.when(F.col("o_orderkey") % 17 == 0, "5-LOW").otherwise(F.col("o_orderpriority")).alias("category"), F.lit("OK").alias("decision"))
    aliases = t.orders.select(F.col("o_orderpriority").alias("category"), F.col("o_orderpriority").alias("alias")).distinct()
    return folder_truth_review(samples, files, pv.mask_paths(t).select(F.replace("mask", F.lit(".BMP"), F.lit(".bmp")).alias("mask")), aliases).select(
        "sample_id", "category", "reviewed_decision", F.replace("mask_path", F.lit(".bmp"), F.lit(".BMP")).alias("mask_path"), "error")


@query("export_training_manifest", f"""WITH {ps.ROLE_PLAN}, st AS (SELECT sample_id, category, sha256, truth FROM con)
SELECT 'train' AS split, 'real_ng' AS role, sample_id, category, sha256, sha256(concat('mask', sample_id)) AS mask_sha256, sample_id % 17 = 0 AS excluded_outside_roi FROM st WHERE truth = 'NG' UNION ALL
SELECT 'train', 'real_ok', sample_id, category, sha256, NULL, false FROM reserved WHERE role = 'bank' UNION ALL SELECT 'val', 'real_ok', sample_id, category, sha256, NULL, false FROM reserved WHERE role = 'calibration' UNION ALL
SELECT 'train', 'pseudo_ok', sample_id, category, sha256, NULL, false FROM reserved WHERE role = 'stream'""")
def _(t):
    held = ps.reserved(t)
    none = {"mask_sha256": F.lit(None).cast("string"), "excluded_outside_roi": F.lit(False)}
    ok = lambda split, role: held.filter(F.col("role") == role).withColumn("split", F.lit(split)).withColumns(none)
    ng = b.contents(t).filter("truth = 'NG'").withColumns({
        "split": F.lit("train"), "mask_sha256": F.sha2(F.concat(F.lit("mask"), F.col("sample_id").cast("string")), 256), "excluded_outside_roi": F.col("sample_id") % 17 == 0})
    manifest = rp.training_manifest(real_ng=ng, real_ok=ok("train", "bank").unionByName(ok("val", "calibration")), pseudo_ok=ok("train", "stream"))
    path = scratch(t.spark, "training-manifest")
    manifest.write.parquet(path)
    return t.spark.read.schema(manifest.schema).parquet(path)


CORNERS = " ".join(f"%.6f" for _ in range(8))


@query("training_labels", f"""WITH RECURSIVE {b.GT_RECTS}, {b.INSTANCES}, {b.ROI}, {b.clipped_sql('gtr', 'cg')},
gen AS (SELECT ins.* FROM ins JOIN orders ON o_orderkey = sample_id WHERE o_orderstatus <> 'F' AND conf >= 0.9::DOUBLE),
every AS (SELECT sample_id, x0, y0, x1, y1 FROM cg UNION ALL SELECT sample_id, x0, y0, x1, y1 FROM gen), {pm.COMPONENTS.format(source="every")},
ed AS (SELECT sample_id, label, least(bx0 / {pm.W - 1}.0::DOUBLE, 1) AS l, least(by0 / {pm.H - 1}.0::DOUBLE, 1) AS t, least(bx1 / {pm.W - 1}.0::DOUBLE, 1) AS r, least(by1 / {pm.H - 1}.0::DOUBLE, 1) AS bt FROM lab),
lt AS (SELECT sample_id, string_agg(concat('0 ', printf('{CORNERS}', l, t, r, t, r, bt, l, bt)), chr(10) ORDER BY label) AS labels FROM ed GROUP BY 1)
SELECT 'train' AS split, 'real_ng' AS role, o_orderkey AS sample_id, o_orderpriority AS category, labels, labels IS NULL AS excluded_outside_roi FROM orders LEFT JOIN lt ON sample_id = o_orderkey WHERE o_orderstatus = 'F' UNION ALL
SELECT 'train', 'synthetic_ng', sample_id, category, labels, false FROM (SELECT DISTINCT sample_id, category FROM gen) JOIN lt USING (sample_id) UNION ALL
SELECT 'val', 'real_ok', o_orderkey, o_orderpriority, NULL, false FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 4 = 0""")
def _(t):
    """Samples of a training set with the text of their label files: real defects cut to the ROI, generated ones, and images without any."""
    orders = t.orders.select(F.col("o_orderkey").alias("sample_id"), F.col("o_orderpriority").alias("category"), (F.col("o_orderstatus") == "F").alias("ng"))
    real = u.roi_clip(b.gt_runs(t), b.roi_runs(t)).select("sample_id", *u.RUN)
    drawn = b.instance_runs(t).filter(F.col("conf") >= 0.9).join(orders.filter("not ng").select("sample_id"), "sample_id").select("sample_id", "category", *u.RUN)
    boxes = rg.component_boxes(rg.connected_components(real.unionByName(drawn.select("sample_id", *u.RUN)), "sample_id"), "sample_id", pm.H, pm.W)
    labels = written(rg.label_text(boxes, "sample_id"), "label-texts")
    inside = F.lit(False).alias("excluded_outside_roi")
    ng = orders.filter("ng").join(labels, "sample_id", "left").select("sample_id", "category", F.lit("train").alias("split"), "labels", F.col("labels").isNull().alias("excluded_outside_roi"))
    made = drawn.select("sample_id", "category").distinct().join(labels, "sample_id").select("sample_id", "category", F.lit("train").alias("split"), "labels", inside)
    ok = orders.filter("not ng and sample_id % 4 = 0").select("sample_id", "category", F.lit("val").alias("split"), F.lit(None).cast("string").alias("labels"), inside)
    return rp.training_manifest(("sample_id", "category", "labels", "excluded_outside_roi"), real_ng=ng, synthetic_ng=made, real_ok=ok)


@query("ablation_summary", f"""WITH {b.DECISIONS}, h AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY sha256(concat_ws(':', '42', sample_id))) AS rank, count(*) OVER (PARTITION BY category) AS pool FROM dec WHERE truth = 'NG'),
sz AS (SELECT DISTINCT category, n AS ng_count FROM (SELECT DISTINCT category, pool FROM h) c, (VALUES (40), (60), (70), (80)) v(n) WHERE n <= pool UNION SELECT DISTINCT category, pool FROM h),
ngx AS (SELECT h.category, ng_count, score FROM h JOIN sz ON sz.category = h.category AND rank <= ng_count), okx AS (SELECT sz.category, ng_count, score FROM dec JOIN sz USING (category) WHERE truth = 'OK'),
al AS (SELECT *, true AS y FROM ngx UNION ALL SELECT *, false FROM okx), rk AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY category, ng_count, score) - 1) / 2.0::DOUBLE AS r FROM al WINDOW w AS (PARTITION BY category, ng_count ORDER BY score))
SELECT category, ng_count, count(*) FILTER (NOT y) AS calibration_ok, (sum(r) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0::DOUBLE) / (count(*) FILTER (y) * count(*) FILTER (NOT y)) AS calibration_auroc,
  count(*) FILTER (y AND score >= 260000)::DOUBLE / count(*) FILTER (y) AS recall FROM rk GROUP BY 1, 2""")
def _(t):
    """Each NG cohort judged against all OK of its category, per (category, NG count)."""
    rows = b.decisions(t).select("sample_id", "category", "truth", "score")
    ng = s.nested_prefix_cohorts(rows.filter("truth = 'NG'"), "category", seeded(42, F.col("sample_id")), (40, 60, 70, 80))
    wins = m.wins_at_score(rows.filter("truth IN ('OK', 'NG')"), ["category"], "score", F.col("truth") == "NG")
    judged = ng.select("category", "ng_count", "score").join(wins, ["category", "score"])
    hits, every = F.count_if(F.col("score") >= 260000.0), F.count(F.lit(1))
    return judged.groupBy("category", "ng_count").agg(F.max("n").alias("calibration_ok"), (hits.cast("double") / every).alias("recall"),
                                                      (F.sum("wins").cast("double") / (2 * every * F.max("n"))).alias("calibration_auroc"))


@query("calibrate_candidate", f"""WITH {pm.CURVE}, mc AS (SELECT category, arg_max(conf, (round(mean_iou, 9), conf)) AS mask_conf_threshold FROM curve GROUP BY 1),
sc AS (SELECT o_orderpriority AS category, o_orderstatus = 'F' AS is_ng, coalesce(max(conf), 0) AS score FROM orders LEFT JOIN ins ON ins.sample_id = o_orderkey GROUP BY o_orderkey, 1, 2),
gg AS (SELECT category, score AS threshold, count(*) FILTER (is_ng) AS p, count(*) FILTER (NOT is_ng) AS n FROM sc GROUP BY 1, 2),
ww AS (SELECT category, threshold, sum(p) OVER d AS tp, sum(n) OVER d AS fp, sum(p) OVER (PARTITION BY category) AS pp, sum(n) OVER (PARTITION BY category) AS nn FROM gg WINDOW d AS (PARTITION BY category ORDER BY threshold DESC)),
uu AS (SELECT * FROM ww WHERE threshold > 0 UNION ALL SELECT category, nextafter(max(threshold), 'inf'::DOUBLE), 0, 0, max(pp), max(nn) FROM ww GROUP BY 1),
sweep AS (SELECT category, threshold, CAST(pp - tp AS BIGINT) AS fn, tp::DOUBLE / pp AS recall, fp::DOUBLE / nn AS ok_false_positive_rate FROM uu), {FIRST_SQL.format(target=0.95, cap=0.2)}
SELECT best.category, threshold AS image_threshold, recall, ok_false_positive_rate, status, mask_conf_threshold FROM best JOIN mc USING (category)""")
def _(t):
    scores = pm.image_scores(t, t.orders.select(F.col("o_orderkey").alias("sample_id"), F.col("o_orderpriority").alias("category"),
                                                (F.col("o_orderstatus") == "F").alias("is_ng")))
    image = c.recall_first(c.threshold_sweep(scores, ["category"], "image_score", "is_ng", 0.0), ["category"], 0.95, 0.2)
    mask = c.mask_conf_threshold(pm.curve(t).select("category", "conf", F.round("mean_iou", 9).alias("mean_iou")), ["category"])
    return image.join(mask, "category").select("category", F.col("threshold").alias("image_threshold"), "recall", "ok_false_positive_rate", "status", "mask_conf_threshold")


NESTED = f"""WITH {ESCALATED} SELECT category, batch_no, sample_id, official, CASE WHEN reviewed THEN truth END AS truth, CASE WHEN reviewed THEN 'reviewed' ELSE 'pseudo_ok' END AS review, label_source FROM rev"""


def report_documents(t):
    """Nested batch reports cut into pages of a few hundred rows, so that no report document grows without bound."""
    rows = r.reviewed_batch(b.decisions(t), KEYS).withColumn("page", F.floor(F.col("sample_id") / 5000))
    item = F.struct("sample_id", "official", F.when(F.col("review") == "reviewed", F.col("truth")).alias("truth"), "review", "label_source")
    return rows.groupBy(*KEYS, "page").agg(F.collect_list(item).alias("rows")).withColumn("official_model", F.lit("pretrained"))


@query("scan_json_reports", NESTED)
def _(t):
    path = fs.sink_report_json(report_documents(t), scratch(t.spark, "reports"))
    return fs.scan_json_reports(t.spark, path).select(*KEYS, "sample_id", "official", "truth", "review", "label_source")


@query("sink_report_json", f"WITH {ESCALATED} SELECT category, batch_no, count(*) AS n FROM rev GROUP BY 1, 2")
def _(t):
    path = fs.sink_report_json(report_documents(t), scratch(t.spark, "reports"))
    stored = t.spark.read.schema(fs.REPORT_SCHEMA).json(path)
    return stored.groupBy(*KEYS).agg(F.sum(F.size("rows")).cast("bigint").alias("n"))


@query("sink_table_csv", SQL["review_stats"])
def _(t):
    plan = r.spot_check_plan(r.review_segments(b.decisions(t), KEYS), KEYS)
    table = r.review_stats(plan, KEYS)
    return t.spark.read.schema(table.schema).option("header", True).csv(fs.sink_table_csv(table, scratch(t.spark, "csv")))


@query("sink_cases_partitioned", f"""WITH {b.DECISIONS} SELECT sample_id, category, score, CASE WHEN truth = 'NG' THEN CASE WHEN official = 'NG' THEN 'tp' ELSE 'fn' END
  ELSE CASE WHEN official = 'NG' THEN 'fp' ELSE 'tn' END END AS "case" FROM dec""")
def _(t):
    cases = b.decisions(t).select("sample_id", "category", "score", confusion_case("truth", F.col("official") == "NG").alias("case"))
    return t.spark.read.parquet(fs.sink_cases_partitioned(cases, scratch(t.spark, "cases"))).select("sample_id", "category", "score", "case")


@query("scan_state_tables", f"WITH {b.DECISIONS} SELECT sample_id, category, truth FROM dec WHERE category = '2-HIGH'")
def _(t):
    path = scratch(t.spark, "samples")
    b.decisions(t).select("sample_id", "category", "truth").write.partitionBy("category").parquet(path)
    return fs.scan_state_table(t.spark, path, "2-HIGH").select("sample_id", "category", "truth")


@query("scan_files")
def _(t):
    files = fs.scan_files(t.spark, t.folder, (".parquet",))
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


@query("review_exchange", f"""WITH {b.DECISIONS} SELECT sample_id, category, official AS model_decision, official AS reviewed_decision, 'model_assumed_review' AS label_source FROM dec""")
def _(t):
    rows = b.decisions(t).select("sample_id", "category", F.col("official").alias("decision"), F.concat(F.lit("mask/"), F.col("sample_id").cast("string")).alias("mask_path"))
    path = export_review_batch(rows, scratch(t.spark, "review"))
    return assumed_review(import_review_batch(t.spark, path)).select("sample_id", "category", "model_decision", "reviewed_decision", "label_source")
