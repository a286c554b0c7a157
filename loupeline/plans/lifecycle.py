"""Lifecycle queries: pools, reviews, milestones, registry, snapshots."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.functions.decisions import PROMOTION_RULE, boundary_flag, milestone_due
from loupeline.operators import gate as g
from loupeline.operators import lifecycle as l
from loupeline.operators import runs as u
from loupeline.operators.calibration import recalibration_due
from loupeline.operators.frame_store import FrameStore, table_identity
from loupeline.operators.ordering import fill_forward
from loupeline.plans import gate as pg
from loupeline.plans.registry import query
from loupeline.session import shared_dir, sized, written
from loupeline.sources import bindings as b

KEYS = ["category", "batch_no"]


def predictions(t):
    return b.decisions(t).withColumns({"is_boundary": boundary_flag("score", "threshold"), "is_conflict": F.col("official") != F.col("shadow")})


def union_pools(source, **rules):
    return " UNION ALL ".join(f"SELECT sample_id, category, '{p}' AS pool FROM {source} WHERE {w}" for p, w in rules.items())


ROUTED = union_pools("dec", raw_pool="true", alarm_candidate_pool="official = 'NG'", ok_pending_pool="official = 'OK'",
                     boundary_hard_pool="abs(score - threshold) <= abs(threshold) * 0.05::DOUBLE", model_conflict_pool="official <> shadow")


@query("route_pools", f"WITH {b.DECISIONS} {ROUTED}")
def _(t):
    return l.route_pools(predictions(t))


REVIEWS = f"""{b.DECISIONS}, rv AS (SELECT CASE WHEN sample_id % 101 = 0 THEN sample_id + 1000000000000 ELSE sample_id END AS sample_id, category, batch_no,
  CASE WHEN sample_id % 103 = 0 THEN 'unknown_reviewer' ELSE label_source END AS label_source, official AS model_decision,
  CASE label_source WHEN 'sampling_pseudo_ok' THEN 'OK' WHEN 'model_assumed_review' THEN official ELSE truth END AS reviewed_decision,
  sample_id % 31 <> 0 AS mask_ok FROM dec WHERE label_source IS NOT NULL AND label_source <> 'initial_calibration_yolo_train_ok'),
good AS (SELECT rv.* FROM rv WHERE sample_id < 1000000000000 AND label_source <> 'unknown_reviewer')"""
REVIEW_POOLS = union_pools("good", sampling_pseudo_ok_pool="reviewed_decision = 'OK' AND label_source = 'sampling_pseudo_ok'",
                           confirmed_ok_pool="reviewed_decision = 'OK' AND label_source <> 'sampling_pseudo_ok'",
                           historical_false_positive_pool="reviewed_decision = 'OK' AND model_decision = 'NG'",
                           confirmed_ng_pool="reviewed_decision = 'NG'",
                           historical_false_negative_pool="reviewed_decision = 'NG' AND model_decision = 'OK'",
                           labeled_pool="reviewed_decision = 'NG' AND mask_ok", annotation_qc_failed_pool="reviewed_decision = 'NG' AND NOT mask_ok")


def reviewed(t):
    rows, k = b.decisions(t), F.col("sample_id")
    source = F.col("label_source")
    reviews = rows.filter(source.isNotNull() & (source != "initial_calibration_yolo_train_ok")).select(
        F.when(k % 101 == 0, k + 1000000000000).otherwise(k).alias("sample_id"),
        F.when(k % 103 == 0, "unknown_reviewer").otherwise(source).alias("label_source"), F.col("official").alias("model_decision"),
        F.when(source == "sampling_pseudo_ok", "OK").when(source == "model_assumed_review", F.col("official")).otherwise(
            F.col("truth")).alias("reviewed_decision"), (k % 31 != 0).alias("mask_ok"))
    earlier = k % 7 == 0  # samples that an earlier batch has already reviewed
    samples = rows.select("sample_id", *KEYS, "created_at", F.when(earlier, "NG").alias("reviewed_decision"),
                          F.when(earlier, "human_review").alias("label_source"), F.when(earlier, F.concat(F.lit("old/"), k.cast("string"))).alias("mask_path"))
    return l.apply_review(samples, reviews.withColumn("mask_path", F.when(F.col("mask_ok"), F.concat(F.lit("new/"), k.cast("string")))))


@query("apply_review", f"WITH {REVIEWS} {REVIEW_POOLS}")
def _(t):
    return reviewed(t)["membership"]


@query("apply_review_samples", f"""WITH {REVIEWS} SELECT d.sample_id, d.category, d.batch_no,
  CASE WHEN g.sample_id IS NOT NULL THEN g.reviewed_decision WHEN d.sample_id % 7 = 0 THEN 'NG' END AS reviewed_decision,
  CASE WHEN g.sample_id IS NOT NULL THEN g.label_source WHEN d.sample_id % 7 = 0 THEN 'human_review' END AS label_source,
  CASE WHEN g.sample_id IS NOT NULL THEN CASE WHEN g.mask_ok THEN concat('new/', d.sample_id) END WHEN d.sample_id % 7 = 0 THEN concat('old/', d.sample_id) END AS mask_path
FROM dec d LEFT JOIN good g USING (sample_id)""")
def _(t):
    return reviewed(t)["samples"].select("sample_id", *KEYS, "reviewed_decision", "label_source", "mask_path")


@query("apply_review_rejects", f"""WITH {REVIEWS} SELECT sample_id, concat_ws(',', CASE WHEN sample_id >= 1000000000000 THEN 'unknown_sample' END,
  CASE WHEN label_source = 'unknown_reviewer' THEN 'unrecognized_label_source' END) AS error FROM rv WHERE sample_id >= 1000000000000 OR label_source = 'unknown_reviewer'""")
def _(t):
    return reviewed(t)["rejects"]


@query("pool_counts", f"""WITH {REVIEWS}, mb AS ({REVIEW_POOLS} UNION ALL {ROUTED}), p(pool) AS (VALUES {", ".join(f"('{p}')" for p in l.POOLS)})
SELECT c.category, p.pool, count(DISTINCT mb.sample_id) AS n FROM (SELECT DISTINCT category FROM dec) c CROSS JOIN p
LEFT JOIN mb ON mb.category = c.category AND mb.pool = p.pool GROUP BY 1, 2""")
def _(t):
    membership = reviewed(t)["membership"].unionByName(l.route_pools(predictions(t)))
    return l.pool_counts(membership, b.decisions(t).select("category").distinct())


@query("confirmed_rows", f"""WITH {REVIEWS} SELECT sample_id, category, 'labeled_pool' AS pool, label_source FROM good WHERE reviewed_decision = 'NG' AND mask_ok""")
def _(t):
    state = reviewed(t)
    return l.confirmed_rows(state["samples"], state["membership"], "NG").select("sample_id", "category", "pool", "label_source")


@query("pseudo_ok_training_filter", f"""WITH {REVIEWS} SELECT category, count(*) AS training_ok, count(*) FILTER (label_source <> 'sampling_pseudo_ok') AS without_pseudo
FROM good WHERE reviewed_decision = 'OK' GROUP BY 1""")
def _(t):
    state = reviewed(t)
    every = l.confirmed_rows(state["samples"], state["membership"], "OK", True).groupBy("category").agg(F.count(F.lit(1)).alias("training_ok"))
    strict = l.confirmed_rows(state["samples"], state["membership"], "OK", False).groupBy("category").agg(F.count(F.lit(1)).alias("without_pseudo"))
    return every.join(strict, "category")


@query("validate_mask_for_pool", f"""WITH {b.DECISIONS}, {b.GT_RECTS}, {b.ROI}, {b.clipped_sql('gtr', 'cg')} SELECT sample_id, category,
  CASE WHEN sample_id % 31 = 0 OR sample_id NOT IN (SELECT sample_id FROM cg) THEN 'annotation_qc_failed_pool' ELSE 'labeled_pool' END AS pool FROM dec WHERE truth = 'NG'""")
def _(t):
    """A confirmed NG is labelled only by a mask of the image's size with at least one defect pixel in view."""
    area = u.roi_clip(b.gt_stacks(t), b.roi_runs(t)).groupBy("sample_id").agg(F.sum(u.length()).alias("pixels"))
    ng = b.decisions(t).filter("truth = 'NG'").withColumn("same_size", F.col("sample_id") % 31 != 0).join(area, "sample_id", "left")
    usable = F.col("same_size") & (F.coalesce("pixels", F.lit(0)) > 0)
    return ng.select("sample_id", "category", F.when(usable, "labeled_pool").otherwise("annotation_qc_failed_pool").alias("pool"))


@query("lock_initial_ok", f"""WITH {b.CONTENTS}, st AS (SELECT c.category, c.sha256, min(c.sample_id) AS sid, bool_or(l.quality = 0) AS other
    FROM con c JOIN labels l ON l.doc_id = c.sample_id GROUP BY 1, 2),
bk AS (SELECT category, sha256, min(sample_id) AS nid FROM con WHERE truth IS NULL GROUP BY 1, 2)
SELECT bk.category, bk.sha256, coalesce(sid, nid) AS sample_id, CASE WHEN sid IS NULL THEN 'created' WHEN other THEN 'collision' ELSE 'locked' END AS action,
  CASE WHEN sid IS NULL OR NOT other THEN 'train_locked' END AS split FROM bk LEFT JOIN st USING (category, sha256)""")
def _(t):
    rows = b.contents(t)
    quality = t.labels.select(F.col("doc_id").alias("sample_id"), "quality")
    stored = rows.join(quality, "sample_id").withColumn(
        "label_source", F.when(F.col("quality") == 0, "human_review").otherwise("initial_calibration_yolo_train_ok"))
    return l.lock_initial_ok(rows.filter("truth IS NULL"), stored)


@query("exclusion_accounting", f"""WITH {b.DECISIONS}, x AS (SELECT category, CASE WHEN label_source = 'initial_calibration_yolo_train_ok' THEN 'i'
  WHEN label_source IS NULL OR label_source NOT IN ('human_review', 'folder_ground_truth') THEN 'u' WHEN sample_id % 53 = 0 THEN 'm' END AS r FROM dec)
SELECT category, count(*) FILTER (r = 'i') AS excluded_initialization, count(*) FILTER (r = 'u') AS excluded_unverified,
  count(*) FILTER (r = 'm') AS missing_prediction_records FROM x GROUP BY 1""")
def _(t):
    return l.exclusion_accounting(b.decisions(t), ["category"], F.col("sample_id") % 53 != 0)


@query("next_milestone", """WITH ms AS (SELECT 40 + 20 * i AS m FROM generate_series(0, 3) AS g(i) UNION ALL SELECT 100 + 40 * i FROM generate_series(0, 2000) AS g(i)),
i AS (SELECT c_custkey AS case_id, c_custkey % 1013 AS labeled_ng, c_nationkey * 12 AS last_milestone FROM customer)
SELECT case_id, labeled_ng, last_milestone, (SELECT max(m) FROM ms WHERE m <= labeled_ng HAVING max(m) > i.last_milestone) AS milestone FROM i""")
def _(t):
    cases = t.customer.select(F.col("c_custkey").alias("case_id"), (F.col("c_custkey") % 1013).alias("labeled_ng"),
                              (F.col("c_nationkey") * 12).cast("bigint").alias("last_milestone"))
    return cases.withColumn("milestone", milestone_due(F.col("labeled_ng"), F.col("last_milestone")))


NG_CTES = """nb AS (SELECT category, batch_no, count(*) FILTER (truth = 'NG' AND sample_id % 31 <> 0) AS ng FROM dec
  WHERE label_source IN ('human_review', 'folder_ground_truth') GROUP BY 1, 2),
rn AS (SELECT category, batch_no, CAST(sum(ng) OVER (PARTITION BY category ORDER BY batch_no) AS BIGINT) AS labeled_ng FROM nb),
ms AS (SELECT 40 + 20 * i AS m FROM generate_series(0, 3) AS g(i) UNION ALL SELECT 100 + 40 * i FROM generate_series(0, 20000) AS g(i)),
rc AS (SELECT category, batch_no, labeled_ng, (SELECT max(m) FROM ms WHERE m <= labeled_ng) AS reached FROM rn),
mile AS (SELECT category, batch_no, labeled_ng, CASE WHEN reached > coalesce(lag(reached) OVER (PARTITION BY category ORDER BY batch_no), 0) THEN reached END AS milestone FROM rc)"""
NG_BATCHES = f"{b.DECISIONS}, {NG_CTES}"


def ng_batches(t):
    verified = b.decisions(t).filter(F.col("label_source").isin("human_review", "folder_ground_truth"))
    return verified.groupBy(*KEYS).agg(F.count_if((F.col("truth") == "NG") & (F.col("sample_id") % 31 != 0)).alias("ng"))


def milestone_rows(t):
    return l.milestones(ng_batches(t), "category", "batch_no", "ng")


@query("milestones", f"WITH {NG_BATCHES} SELECT * FROM mile")
def _(t):
    return milestone_rows(t)


SHADOW_MIN_NG, SHADOW_MAX_BATCHES = 40, 5


def window_sql(layer):
    """Metric rows of a layer that belong to the shadow window of a candidate."""
    return f"""w_{layer} AS (SELECT r.*, u.version FROM rows_{layer} r JOIN under u USING (category, batch_no) JOIN due d ON d.category = u.category AND d.version = u.version
  WHERE r.batch_no <= d.verdict_batch)"""


TRAINED = """trained AS (SELECT category, milestone, batch_no AS start_batch, concat(category, '-seg-v', milestone, '-', substr(sha256(concat_ws(':', category, milestone)), 1, 12)) AS version
  FROM mile WHERE milestone IS NOT NULL)"""
MODELS = f"""{pg.PAIRS}, {NG_CTES}, {TRAINED},
under AS (SELECT x.category, x.batch_no, (SELECT arg_max(version, start_batch) FROM trained y WHERE y.category = x.category AND y.start_batch < x.batch_no) AS version
  FROM (SELECT DISTINCT category, batch_no FROM dec) x),
wb AS (SELECT u.category, u.version, u.batch_no, count(r.sample_id) FILTER (r.label = 'NG' AND r.gt_status = 'valid') AS ng FROM under u
  LEFT JOIN (SELECT * FROM rows_official WHERE {pg.VERIFIED}) r ON r.category = u.category AND r.batch_no = u.batch_no WHERE u.version IS NOT NULL GROUP BY 1, 2, 3),
wr AS (SELECT *, CAST(sum(ng) OVER w AS BIGINT) AS shadow_ng, row_number() OVER w AS shadow_batches FROM wb WINDOW w AS (PARTITION BY category, version ORDER BY batch_no)),
due AS (SELECT category, version, min(batch_no) AS verdict_batch, min(shadow_ng) AS shadow_ng, min(shadow_batches) AS shadow_batches
  FROM wr WHERE shadow_ng >= {SHADOW_MIN_NG} OR shadow_batches >= {SHADOW_MAX_BATCHES} GROUP BY 1, 2),
{window_sql('official')}, {window_sql('shadow')}, {pg.verdict_sql('version', 'w_official', 'w_shadow')},
models AS (SELECT t.*, d.verdict_batch, v.decision FROM trained t LEFT JOIN due d USING (category, version) LEFT JOIN verdict v USING (category, version)),
md AS (SELECT *, lead(start_batch) OVER (PARTITION BY category ORDER BY milestone) AS next_start FROM models),
mds AS (SELECT *, CASE WHEN next_start IS NOT NULL AND (verdict_batch IS NULL OR next_start < verdict_batch) THEN 'superseded' WHEN verdict_batch IS NULL THEN 'shadow_candidate'
  WHEN decision = 'promote' THEN 'promoted' ELSE 'rejected_shadow' END AS status FROM md)"""


def trained(t):
    """One candidate per reached milestone."""
    m = F.col("milestone")
    version = F.concat("category", F.lit("-seg-v"), m.cast("string"), F.lit("-"),
                       F.substring(F.sha2(F.concat_ws(":", "category", m.cast("string")), 256), 1, 12))
    return milestone_rows(t).filter(m.isNotNull()).select("category", "milestone", F.col("batch_no").alias("start_batch"), version.alias("version"))


def shadow_verdicts(t, candidates, pixel_counts=None):
    """Verdict of every candidate on all reviewed pairs of its shadow window.

    A batch belongs to the newest candidate trained before it; the window closes with the first batch that brings enough
    labelled NG or batches. All windows of all models are judged in one pass.
    """
    starts = candidates.select("category", F.col("start_batch").alias("batch_no"), F.col("version").alias("_started"))
    batches = b.decisions(t).select(*KEYS).distinct().join(starts, KEYS, "left")
    under = fill_forward(batches, ["category"], [F.col("batch_no")], {"version": "_started"}, inclusive=False)
    under = sized(under.filter("version IS NOT NULL").select(*KEYS, "version"), "shadow-batches")
    sides = [written(side.join(under, KEYS), "shadow-rows") for side in pg.pairs(t, pixel_counts=pixel_counts)]
    model = ["category", "version"]
    ng = sides[0].groupBy(*model, "batch_no").agg(F.count_if((F.col("label") == "NG") & (F.col("gt_status") == "valid")).alias("valid_ng"))
    counted = under.join(ng, [*model, "batch_no"], "left").fillna(0, ["valid_ng"])
    window = g.shadow_window(counted, model, min_ng=SHADOW_MIN_NG, max_batches=SHADOW_MAX_BATCHES).filter("due")
    due = sized(window.select(*model, F.col("batch_no").alias("verdict_batch"), "shadow_ng", "shadow_batches"), "verdict-batches")
    cohorts = [side.join(due.select(*model, "verdict_batch"), model).filter("batch_no <= verdict_batch") for side in sides]
    return written(due.join(g.promotion_gate(*cohorts, model), model, "left"), "verdicts")


def judged(t, pixel_counts=None):
    """Candidates with their verdicts (batch and decision), and the verdicts in full.

    The gate is the dearest step of the lifecycle and several queries ask for its verdicts, so they are kept for the application, by the identity
    of the files they are made from.
    """
    store = FrameStore(t.spark, f"{shared_dir(t.spark)}/loupeline/{t.spark.sparkContext.applicationId}/gate")
    identity = ":".join([str(SHADOW_MIN_NG), str(SHADOW_MAX_BATCHES), *(table_identity(table) for table in (t.orders, t.lineitem))])
    candidates = store.get("candidates", identity, lambda: trained(t))
    verdicts = store.get("verdicts", identity, lambda: shadow_verdicts(t, candidates, pixel_counts))
    return candidates.join(verdicts.select("category", "version", "verdict_batch", "decision"), ["category", "version"], "left"), verdicts


def models(t, pixel_counts=None):
    return judged(t, pixel_counts)[0]


@query("promotion_gate", f"WITH {MODELS} SELECT due.verdict_batch, due.shadow_ng, due.shadow_batches, verdict.* FROM due JOIN verdict USING (category, version)")
def _(t):
    return judged(t)[1].filter("decision IS NOT NULL")


@query("gate_pairs", f"""WITH {MODELS}, ru AS (SELECT verdict.*, verdict_batch % 5 <> 0 AS ok FROM verdict JOIN due USING (category, version)) SELECT category, version,
  {pg.pair_sql('fn', 'fn_pair')}, {pg.pair_sql('fp', 'fp_pair')}, {pg.pair_sql('iou_micro', 'iou_pair', True)}, {pg.pair_sql('error_cost', 'cost_pair')},
  {pg.pair_sql('tolerant_agreement_micro', 't5_pair', True)}
FROM ru""")
def _(t):
    verdicts = judged(t)[1].filter("decision IS NOT NULL")
    ruled = verdicts.withColumn("rule", F.when(F.col("verdict_batch") % 5 != 0, F.lit(PROMOTION_RULE)).otherwise("shadow_iou_v1"))
    return g.gate_pairs(ruled, PROMOTION_RULE).select("category", "version", "fn_pair", "fp_pair", "iou_pair", "cost_pair", "t5_pair")


@query("supersede", f"WITH {MODELS} SELECT category, milestone, start_batch, version, next_start, status FROM mds")
def _(t):
    return l.superseded(models(t)).select("category", "milestone", "start_batch", "version", "next_start", "status")


FORCE = f"""{MODELS}, sw AS (SELECT category, verdict_batch AS decided_batch, max(version) AS version FROM mds WHERE status = 'promoted' GROUP BY 1, 2),
bt AS (SELECT DISTINCT category, batch_no FROM dec),
uf AS (SELECT bt.*, coalesce((SELECT arg_max(version, decided_batch) FROM sw WHERE sw.category = bt.category AND decided_batch < bt.batch_no), 'pretrained') AS used_model,
  coalesce((SELECT arg_max(version, decided_batch) FROM sw WHERE sw.category = bt.category AND decided_batch <= bt.batch_no), 'pretrained') AS next_model FROM bt)"""


def in_force(t, known=None):
    switches = l.superseded(models(t) if known is None else known).filter("status = 'promoted'").select("category", F.col("verdict_batch").alias("decided_batch"), "version")
    return l.model_in_force(b.decisions(t).select(*KEYS).distinct(), switches)


@query("model_in_force", f"WITH {FORCE} SELECT *, CASE WHEN used_model <> next_model THEN batch_no + 1 END AS switch_effective_from_batch FROM uf")
def _(t):
    return in_force(t)


@query("history_events", f"""WITH {MODELS}, tm AS (SELECT category, batch_no, concat(strftime(max(created_at)::TIMESTAMP, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00') AS at FROM dec GROUP BY 1, 2), fl AS (SELECT category, batch_no, labeled_ng, floor(labeled_ng / 5.0::DOUBLE) > floor(coalesce(lag(labeled_ng) OVER (PARTITION BY category ORDER BY batch_no), 0) / 5.0::DOUBLE) AS due FROM rn),
tr AS (SELECT category, min(verdict_batch) AS since FROM mds WHERE status = 'promoted' GROUP BY 1)
SELECT tm.at, ev.* FROM (SELECT category, batch_no, 'pretrained_recalibrated' AS event, CAST(labeled_ng AS VARCHAR) AS detail FROM fl LEFT JOIN tr USING (category) WHERE due AND (since IS NULL OR batch_no <= since) UNION ALL
SELECT category, start_batch, 'candidate_trained', version FROM mds UNION ALL SELECT category, verdict_batch, 'promoted', version FROM mds WHERE status = 'promoted' UNION ALL
SELECT category, verdict_batch, 'rejected_shadow', version FROM mds WHERE status = 'rejected_shadow' UNION ALL SELECT category, next_start, 'superseded', version FROM mds WHERE status = 'superseded') ev LEFT JOIN tm USING (category, batch_no)""")
def _(t):
    status = l.superseded(models(t))
    # once a trained model serves, the pretrained one is not calibrated any more
    trained = status.filter("status = 'promoted'").groupBy("category").agg(F.min("verdict_batch").alias("since"))
    due = recalibration_due(ng_batches(t), "category", "batch_no", "ng").filter("due").join(trained, "category", "left")
    recalibrated = due.filter("since IS NULL OR batch_no <= since").select(*KEYS, F.col("n_ng").cast("string").alias("detail"))

    def at(batch, condition):
        return status.filter(condition).select("category", F.col(batch).alias("batch_no"), F.col("version").alias("detail"))

    ends = b.decisions(t).groupBy(*KEYS).agg(F.max("created_at").alias("at"))
    return l.history_events(ends, pretrained_recalibrated=recalibrated, candidate_trained=at("start_batch", "true"),
                            promoted=at("verdict_batch", "status = 'promoted'"), rejected_shadow=at("verdict_batch", "status = 'rejected_shadow'"),
                            superseded=at("next_start", "status = 'superseded'"))


EVENTS = """ev AS (SELECT p_brand AS category, p_partkey AS seq, CASE WHEN p_size % 4 = 0 THEN 'rollback' ELSE 'promote' END AS action,
  CASE WHEN p_size % 4 <> 0 THEN concat(p_type, '-', p_partkey) END AS version FROM part)"""
# Replay in the oracle: previous = production before the latest promotion.
REPLAY = f"""{EVENTS}, num AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY seq) AS i FROM ev),
st AS (SELECT category, 0::BIGINT AS i, 0::BIGINT AS seq, NULL::VARCHAR AS action, NULL::VARCHAR AS production, NULL::VARCHAR AS previous, NULL::VARCHAR AS error FROM (SELECT DISTINCT category FROM ev)
  UNION ALL SELECT n.category, n.i, n.seq, n.action, CASE WHEN n.action = 'promote' THEN n.version WHEN st.previous IS NOT NULL THEN st.previous ELSE st.production END,
    CASE WHEN n.action = 'promote' THEN st.production ELSE st.previous END, CASE WHEN n.action = 'rollback' AND st.previous IS NULL THEN 'no_previous_model' END
  FROM st JOIN num n ON n.category = st.category AND n.i = st.i + 1)"""


def registry_events(t):
    rollback = F.col("p_size") % 4 == 0
    return t.part.select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("seq"), F.when(rollback, "rollback").otherwise("promote").alias("action"),
                         F.when(~rollback, F.concat_ws("-", "p_type", F.col("p_partkey").cast("string"))).alias("version"))


@query("registry_rollback", f"WITH RECURSIVE {REPLAY} SELECT category, seq, action, CASE WHEN error IS NULL THEN production END AS production, previous, error FROM st WHERE i > 0")
def _(t):
    return l.registry_states(registry_events(t))


@query("registry_current", f"WITH RECURSIVE {REPLAY} SELECT category, arg_max(production, i) AS version FROM st WHERE i > 0 AND error IS NULL GROUP BY 1")
def _(t):
    return l.registry_current(l.registry_states(registry_events(t)))


@query("registry_promote", f"""WITH {EVENTS}, la AS (SELECT category, max(seq) AS last FROM ev WHERE action = 'promote' GROUP BY 1)
SELECT category, version, CASE WHEN seq = last THEN 'production' ELSE 'archived' END AS status FROM ev JOIN la USING (category) WHERE action = 'promote'""")
def _(t):
    return l.registry_status(registry_events(t))


@query("register_candidate", """SELECT p_partkey AS model_id, p_brand AS category, CASE WHEN p_size % 7 = 0 THEN 'missing_or_empty_checkpoint' WHEN p_size % 5 = 0 THEN 'smoke_test_failed' END AS error,
  CASE WHEN p_size % 7 = 0 OR p_size % 5 = 0 THEN 'failed' ELSE 'candidate' END AS status FROM part""")
def _(t):
    tried = t.part.select(F.col("p_partkey").alias("model_id"), F.col("p_brand").alias("category"), (F.col("p_size") % 7).alias("checkpoint_bytes"),
                          (F.col("p_size") % 5 != 0).alias("smoke_ok"))
    return l.register_candidate(tried).select("model_id", "category", "error", "status")


STATUS_SQL = "CASE p_size % 4 WHEN 0 THEN 'shadow_candidate' WHEN 1 THEN 'candidate_insufficient_or_rejected' WHEN 2 THEN 'rejected_shadow' ELSE 'production' END"


@query("latest_candidate", f"""WITH x AS (SELECT p_brand AS category, p_partkey AS created_at, concat(p_type, '-', p_partkey) AS version, {STATUS_SQL} AS status FROM part)
SELECT category, arg_max(version, created_at) AS version, max(created_at) AS created_at FROM x WHERE status IN ('shadow_candidate', 'candidate_insufficient_or_rejected') GROUP BY 1""")
def _(t):
    k = F.col("p_size") % 4
    rows = t.part.select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("created_at"),
                         F.concat_ws("-", "p_type", F.col("p_partkey").cast("string")).alias("version"),
                         F.when(k == 0, "shadow_candidate").when(k == 1, "candidate_insufficient_or_rejected").when(k == 2, "rejected_shadow").otherwise("production").alias("status"))
    return l.latest_candidate(rows)


@query("model_evaluations", f"""WITH {MODELS}, tr AS (SELECT o_orderpriority AS category, o_orderkey AS ts, CASE WHEN o_orderkey % 3 = 0 THEN 'production' ELSE 'candidate' END AS role,
  CASE WHEN o_orderkey % 2 = 0 THEN concat('pretrained-', o_custkey) ELSE concat('yolo-', o_custkey) END AS version, o_totalprice / 500000 AS recall FROM orders),
f AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY ts, version) AS k FROM tr WHERE role = 'production' AND version LIKE 'pretrained%')
SELECT category, version, 'initial_pretrained' AS kind, 0 AS milestone, recall FROM f WHERE k = 1 UNION ALL
SELECT category, version, 'yolo', milestone, milestone / 1000.0::DOUBLE FROM models""")
def _(t):
    k = F.col("o_orderkey")
    reports = t.orders.select(F.col("o_orderpriority").alias("category"), k.alias("at"), F.when(k % 3 == 0, "production").otherwise("candidate").alias("role"),
                              F.concat_ws("-", F.when(k % 2 == 0, "pretrained").otherwise("yolo"), F.col("o_custkey").cast("string")).alias("version"),
                              (F.col("o_totalprice") / 500000).alias("recall"))
    return l.model_evaluations(reports, models(t).withColumn("recall", F.col("milestone") / F.lit(1000.0)))


SNAP = f"""{b.DECISIONS}, {b.GT_RECTS}, {b.ROI}, {b.clipped_sql('gtr', 'cg')}, inr AS (SELECT DISTINCT sample_id FROM cg),
sn0 AS (SELECT d.*, sha256(CAST(d.sample_id AS VARCHAR)) AS sha256, inr.sample_id IS NOT NULL AS in_roi, CASE label_source WHEN 'sampling_pseudo_ok' THEN 'OK' ELSE truth END AS rd,
  d.sample_id % 17 = 0 AS cal FROM dec d LEFT JOIN inr USING (sample_id) WHERE label_source IS NOT NULL AND label_source <> 'model_assumed_review'),
sn1 AS (SELECT *, CAST(concat('0x', substr(sha256(concat_ws(':', '42', category, sha256)), 1, 16)) AS UBIGINT)::DOUBLE / 18446744073709551616::DOUBLE >= 0.25::DOUBLE AS train FROM sn0),
sb AS (SELECT category, batch_no, count(*) FILTER (rd = 'OK' AND NOT cal) AS a, count(*) FILTER (rd = 'NG' AND in_roi AND train) AS c,
  count(*) FILTER (rd = 'OK' AND NOT cal AND label_source = 'sampling_pseudo_ok') AS p, count(*) FILTER (rd = 'NG') AS n, count(*) FILTER (rd = 'NG' AND NOT in_roi) AS x FROM sn1 GROUP BY 1, 2),
snap AS (SELECT category, batch_no, CAST(sum(a) OVER w AS BIGINT) AS eligible_training_ok, CAST(sum(c) OVER w AS BIGINT) AS eligible_training_ng, CAST(sum(p) OVER w AS BIGINT) AS eligible_pseudo_ok,
  CAST(sum(n) OVER w AS BIGINT) AS confirmed_valid_ng, CAST(sum(x) OVER w AS BIGINT) AS excluded_training_ng_outside_roi FROM sb WINDOW w AS (PARTITION BY category ORDER BY batch_no))"""


def snapshots(t, models=None):
    seen = u.roi_clip(b.gt_stacks(t), b.roi_runs(t)).select("sample_id").distinct().withColumn("in_roi", F.lit(True))
    rows = b.decisions(t).filter("label_source IS NOT NULL AND label_source <> 'model_assumed_review'").join(seen, "sample_id", "left")
    return l.batch_snapshot(rows.withColumns({
        "sha256": F.sha2(F.col("sample_id").cast("string"), 256), "in_roi": F.coalesce("in_roi", F.lit(False)),
        "reviewed_decision": F.when(F.col("label_source") == "sampling_pseudo_ok", "OK").otherwise(F.col("truth")),
        "in_calibration": F.col("sample_id") % 17 == 0, "stored_split": F.lit(None).cast("string")}), trained=models)


@query("batch_snapshot", f"""WITH {SNAP}, {NG_CTES}, {TRAINED}
SELECT snap.*, (SELECT arg_max(version, milestone) FROM trained y WHERE y.category = snap.category AND y.start_batch <= snap.batch_no) AS latest_model,
  (SELECT max(milestone) FROM trained y WHERE y.category = snap.category AND y.start_batch <= snap.batch_no) AS latest_milestone FROM snap""")
def _(t):
    return snapshots(t, trained(t))
