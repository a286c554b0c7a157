"""Review policy, ranking and top-k queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.operators import metrics as m
from loupeline.operators import review as r
from loupeline.operators import splits as s
from loupeline.operators.ordering import rank_within, seeded
from loupeline.plans.metrics import RATES
from loupeline.plans.registry import query
from loupeline.sources import bindings as b

KEYS = ["category", "batch_no"]
SEGMENTS = f"""{b.DECISIONS}, rk AS (SELECT *, row_number() OVER (PARTITION BY category, batch_no ORDER BY score DESC, sample_id) AS rank,
    count(*) OVER (PARTITION BY category, batch_no) AS n FROM dec WHERE official = 'OK'),
seg AS (SELECT *, CASE WHEN rank <= round_even(n * 0.2::DOUBLE, 0) THEN 'high'
    WHEN rank <= round_even(n * 0.2::DOUBLE, 0) + round_even(n * 0.4::DOUBLE, 0) THEN 'middle' ELSE 'low' END AS segment FROM rk)"""
PLAN = f"""{SEGMENTS}, hr AS (SELECT *, row_number() OVER (PARTITION BY category, batch_no, segment
      ORDER BY sha256(concat_ws(':', '42', category, batch_no, sample_id))) AS pick,
    count(*) OVER (PARTITION BY category, batch_no, segment) AS m FROM seg),
plan AS (SELECT *, pick <= CASE segment WHEN 'high' THEN m WHEN 'middle' THEN least(m, greatest(5, round_even(m * 0.1::DOUBLE, 0)))
    ELSE least(m, greatest(2, round_even(m * 0.02::DOUBLE, 0))) END AS sampled FROM hr)"""
ESCALATED = f"""{PLAN}, st AS (SELECT category, batch_no, segment, count(*) AS members, count(*) FILTER (sampled) AS sampled,
    count(*) FILTER (sampled AND truth = 'NG') AS ng_in_sample, count(*) FILTER (truth = 'NG') AS all_ng FROM plan GROUP BY 1, 2, 3),
stats AS (SELECT *, ng_in_sample > 0 AND sampled < members AS escalated FROM st),
esc AS (SELECT plan.*, escalated, plan.sampled OR escalated AS reviewed FROM plan JOIN stats USING (category, batch_no, segment)),
rev AS (SELECT sample_id, category, batch_no, truth, official, label_source, reviewed FROM esc UNION ALL
  SELECT sample_id, category, batch_no, truth, official, label_source, true FROM dec WHERE official = 'NG')"""


def plan(t):
    return r.spot_check_plan(r.review_segments(b.decisions(t), KEYS), KEYS)


@query("review_segments", f"WITH {SEGMENTS} SELECT sample_id, category, batch_no, rank, segment FROM seg")
def _(t):
    return r.review_segments(b.decisions(t), KEYS).select("sample_id", *KEYS, "rank", "segment")


@query("spot_check_plan", f"WITH {PLAN} SELECT sample_id, category, batch_no, segment, sampled FROM plan")
def _(t):
    return plan(t).select("sample_id", *KEYS, "segment", "sampled")


@query("segment_escalation", f"WITH {ESCALATED} SELECT sample_id, category, batch_no, segment, sampled, escalated, reviewed FROM esc")
def _(t):
    return r.segment_escalation(plan(t), KEYS).select("sample_id", *KEYS, "segment", "sampled", "escalated", "reviewed")


@query("pseudo_ok", f"WITH {ESCALATED} SELECT sample_id, category, batch_no FROM rev WHERE NOT reviewed")
def _(t):
    return r.reviewed_batch(b.decisions(t), KEYS).filter("review = 'pseudo_ok'").select("sample_id", *KEYS)


@query("review_stats", f"""WITH {ESCALATED} SELECT category, batch_no, segment, members, sampled, ng_in_sample, escalated,
  CASE WHEN escalated THEN members ELSE sampled END AS reviewed, CASE WHEN escalated THEN all_ng ELSE ng_in_sample END AS ng_found FROM stats""")
def _(t):
    return r.review_stats(plan(t), KEYS)


@query("pseudo_ok_hidden_ng", f"""WITH {ESCALATED} SELECT category, batch_no, count(*) AS pseudo_ok,
  count(*) FILTER (truth = 'NG') AS hidden_ng FROM rev WHERE NOT reviewed GROUP BY 1, 2""")
def _(t):
    pseudo = r.reviewed_batch(b.decisions(t), KEYS).filter("review = 'pseudo_ok'")
    return pseudo.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("pseudo_ok"), F.count_if(F.col("truth") == "NG").alias("hidden_ng"))


@query("batch_report", f"""WITH {ESCALATED}, c AS (SELECT category, batch_no, count(*) AS "count", count(*) FILTER (reviewed) AS reviewed,
    count(*) FILTER (truth = 'OK') AS input_ok, count(*) FILTER (truth = 'NG') AS input_ng,
    count(*) FILTER (official = 'OK') AS predicted_ok, count(*) FILTER (official = 'NG') AS predicted_ng,
    count(*) FILTER (v AND truth = 'NG' AND official = 'NG') AS tp, count(*) FILTER (v AND truth = 'OK' AND official = 'NG') AS fp,
    count(*) FILTER (v AND truth = 'NG' AND official = 'OK') AS fn, count(*) FILTER (v AND truth = 'OK' AND official = 'OK') AS tn
  FROM (SELECT *, reviewed AND coalesce(label_source IN ('human_review', 'folder_ground_truth'), false) AS v FROM rev) GROUP BY 1, 2)
SELECT *, {RATES} FROM c""")
def _(t):
    return batch_report(r.reviewed_batch(b.decisions(t), KEYS))


def batch_report(reviewed):
    ng, hit = F.col("truth") == "NG", F.col("official") == "NG"
    v = F.col("reviewed") & F.coalesce(F.col("label_source").isin("human_review", "folder_ground_truth"), F.lit(False))
    return m.with_rates(reviewed.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("count"), F.count_if("reviewed").alias("reviewed"),
        F.count_if(~ng).alias("input_ok"), F.count_if(ng).alias("input_ng"),
        F.count_if(~hit).alias("predicted_ok"), F.count_if(hit).alias("predicted_ng"),
        F.count_if(v & ng & hit).alias("tp"), F.count_if(v & ~ng & hit).alias("fp"),
        F.count_if(v & ng & ~hit).alias("fn"), F.count_if(v & ~ng & ~hit).alias("tn")))


@query("top_fraction_mean", """WITH r AS (SELECT l_orderkey AS sample_id, l_extendedprice AS v,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC) AS k, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT sample_id, round(avg(v), 6) AS image_score FROM r WHERE k <= greatest(1, ceil(n * 0.3::DOUBLE)) GROUP BY 1""")
def _(t):
    values = t.lineitem.select(F.col("l_orderkey").alias("sample_id"), F.col("l_extendedprice").alias("value"))
    return r.top_fraction_mean(values, "sample_id", "value", 0.3).select(
        "sample_id", F.round("image_score", 6).alias("image_score"))


@query("earliest_ng", f"""WITH {b.DECISIONS}, k AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY created_at, sample_id) AS rn
  FROM dec WHERE truth = 'NG') SELECT sample_id, category, rn FROM k WHERE rn <= 40""")
def _(t):
    ng = b.decisions(t).filter("truth = 'NG'")
    return r.top_ranked(ng, ["category"], [F.col("created_at"), F.col("sample_id")], 40, "rn").select(
        "sample_id", "category", F.col("rn").cast("bigint").alias("rn"))


@query("round_robin_ok", f"""WITH {b.CONTENTS}, bench AS (SELECT sha256(text) AS sha256 FROM benchmark),
ok AS (SELECT * FROM con WHERE coalesce(truth, 'OK') = 'OK' AND sha256 NOT IN (SELECT sha256 FROM bench)),
t AS (SELECT *, row_number() OVER (PARTITION BY category, batch_id ORDER BY sha256(concat_ws(':', '42', batch_id, sample_id))) AS turn FROM ok),
p AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY turn, batch_id) AS pick FROM t)
SELECT sample_id, category, batch_id, pick FROM p WHERE pick <= 100""")
def _(t):
    calibration = t.benchmark.select(F.sha2("text", 256).alias("sha256"))
    ok = b.contents(t).filter("coalesce(truth, 'OK') = 'OK'").join(calibration, "sha256", "left_anti")
    out = s.round_robin_ok(ok, "category", "batch_id", seeded(42, F.col("batch_id"), F.col("sample_id")), 100)
    return out.select("sample_id", "category", "batch_id", F.col("pick").cast("bigint").alias("pick"))


@query("stream_shuffle", f"""WITH {b.ARRIVALS} SELECT sample_id, category,
  row_number() OVER (PARTITION BY category ORDER BY sha256(concat_ws(':', '42', category, sample_id))) AS position FROM arr""")
def _(t):
    return s.stream_shuffle(b.arrivals(t), "category", seeded(42, F.col("category"), F.col("sample_id"))).select(
        "sample_id", "category", "position")


@query("stratified_batches", f"""WITH {b.DECISIONS}, c AS (SELECT category, count(*) FILTER (truth = 'NG') AS ng,
    CAST(ceil(count(*) / 200.0::DOUBLE) AS BIGINT) AS nb FROM dec GROUP BY 1),
h AS (SELECT sample_id, category, truth, row_number() OVER (PARTITION BY category, truth ORDER BY sha256(concat_ws(':', '42', sample_id))) - 1 AS i FROM dec),
bat AS (SELECT c.category, j, 200 - (ng // nb) - CASE WHEN j < ng % nb THEN 1 ELSE 0 END AS room FROM c, generate_series(0, nb - 1) AS g(j)),
fill AS (SELECT category, j, sum(room) OVER (PARTITION BY category ORDER BY j) - room AS lo, sum(room) OVER (PARTITION BY category ORDER BY j) AS hi FROM bat)
SELECT h.sample_id, h.category, CAST(h.i % nb + 1 AS BIGINT) AS batch_no FROM h JOIN c USING (category) WHERE truth = 'NG' UNION ALL
SELECT h.sample_id, h.category, CAST(j + 1 AS BIGINT) FROM h JOIN fill ON fill.category = h.category AND i >= lo AND i < hi WHERE truth = 'OK'""")
def _(t):
    return s.stratified_batches(b.decisions(t), "category", "truth", seeded(42, F.col("sample_id")), 200).select(
        "sample_id", "category", "batch_no")


@query("stream_position", f"""WITH {b.DECISIONS}, p AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY batch_no, sample_id) AS pos
  FROM dec WHERE label_source IS DISTINCT FROM 'initial_calibration_yolo_train_ok')
SELECT sample_id, category, batch_no AS confirmed_review_batch, pos AS observed_stream_position FROM p UNION ALL
SELECT sample_id, category, 0, 0 FROM dec WHERE label_source = 'initial_calibration_yolo_train_ok'""")
def _(t):
    rows = b.decisions(t)
    initial = F.col("label_source").eqNullSafe("initial_calibration_yolo_train_ok")
    placed = rank_within(rows.filter(~initial), ["category"], [F.col("batch_no"), F.col("sample_id")], "pos")
    zero = F.lit(0).cast("bigint")
    return placed.select("sample_id", "category", F.col("batch_no").alias("confirmed_review_batch"),
                         F.col("pos").alias("observed_stream_position")).unionByName(
        rows.filter(initial).select("sample_id", "category", zero.alias("confirmed_review_batch"),
                                    zero.alias("observed_stream_position")))
