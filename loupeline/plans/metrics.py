"""Metric queries on orders, line items and events."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.functions.decisions import boundary_flag, confusion_case, decide, is_verified
from loupeline.operators import metrics as m
from loupeline.plans.registry import query
from loupeline.sources import bindings as b

RATES = """CASE WHEN tp+fp+fn+tn > 0 THEN 2*fn+fp END AS error_cost,
  tp::DOUBLE / nullif(tp+fn, 0) AS recall, fp::DOUBLE / nullif(fp+tn, 0) AS ok_false_positive_rate,
  tp::DOUBLE / nullif(tp+fp, 0) AS precision, (tp+tn)::DOUBLE / nullif(tp+fp+fn+tn, 0) AS accuracy"""
COUNTS = """count(*) FILTER (y AND p) AS tp, count(*) FILTER (NOT y AND p) AS fp,
  count(*) FILTER (y AND NOT p) AS fn, count(*) FILTER (NOT y AND NOT p) AS tn"""
LINE_THRESHOLD = 60000.0


def lines_with_call(t):
    return b.line_scores(t).withColumn("predicted_ng", decide("score", F.lit(LINE_THRESHOLD)) == "NG")


@query("classification_metrics", f"""WITH {b.LINES}, c AS (
  SELECT category, {COUNTS} FROM (SELECT category, is_ng AS y, score >= {LINE_THRESHOLD} AS p FROM lines) GROUP BY 1)
SELECT *, {RATES} FROM c""")
def _(t):
    return m.classification_metrics(lines_with_call(t), ["category"], "is_ng", "predicted_ng")


@query("metrics_rollup", f"""WITH {b.LINES}, c AS (
  SELECT category, batch_no, CAST(2 - grouping(category) - grouping(batch_no) AS BIGINT) AS level, {COUNTS}
  FROM (SELECT category, batch_no, is_ng AS y, score >= {LINE_THRESHOLD} AS p FROM lines)
  GROUP BY ROLLUP (category, batch_no))
SELECT *, {RATES} FROM c""")
def _(t):
    return m.metrics_rollup(lines_with_call(t), ["category", "batch_no"], "is_ng", "predicted_ng")


@query("auroc", f"""WITH {b.LINES}, s AS (SELECT category, score, is_ng,
    rank() OVER (PARTITION BY category ORDER BY score) + (count(*) OVER (PARTITION BY category, score) - 1) / 2.0::DOUBLE AS r
  FROM lines)
SELECT category, (sum(r) FILTER (is_ng) - count(*) FILTER (is_ng) * (count(*) FILTER (is_ng) + 1) / 2.0::DOUBLE)
  / nullif(count(*) FILTER (is_ng) * count(*) FILTER (NOT is_ng), 0) AS auroc FROM s GROUP BY 1""")
def _(t):
    return m.auroc(b.line_scores(t), ["category"], "score", "is_ng")


@query("auroc_tied_scores", f"""WITH {b.LINES}, g AS (SELECT category, tied_score s, count(*) FILTER (is_ng) p,
    count(*) FILTER (NOT is_ng) n FROM lines GROUP BY 1, 2)
SELECT a.category, sum(a.p * CASE WHEN a.s > c.s THEN c.n WHEN a.s = c.s THEN 0.5 * c.n ELSE 0 END)::DOUBLE
  / (max(t.p) * max(t.n))::DOUBLE AS auroc
FROM g a JOIN g c ON a.category = c.category
JOIN (SELECT category, sum(p) p, sum(n) n FROM g GROUP BY 1) t ON t.category = a.category GROUP BY 1""")
def _(t):
    return m.auroc(b.line_scores(t), ["category"], "tied_score", "is_ng")


@query("decide", f"WITH {b.DECISIONS} SELECT sample_id, category, score, threshold, official AS decision FROM dec")
def _(t):
    return b.decisions(t).select("sample_id", "category", "score", "threshold",
                                 decide("score", "threshold").alias("decision"))


@query("boundary_flag", f"""WITH {b.DECISIONS} SELECT sample_id, score,
  abs(score - threshold) <= abs(threshold) * 0.05::DOUBLE AS is_boundary FROM dec""")
def _(t):
    return b.decisions(t).select("sample_id", "score", boundary_flag("score", "threshold").alias("is_boundary"))


@query("confusion_case", f"""WITH {b.DECISIONS} SELECT sample_id, truth AS label, score,
  CASE WHEN truth = 'NG' THEN CASE WHEN score >= threshold THEN 'tp' ELSE 'fn' END
       WHEN truth = 'OK' THEN CASE WHEN score >= threshold THEN 'fp' ELSE 'tn' END END AS "case" FROM dec""")
def _(t):
    return b.decisions(t).select("sample_id", F.col("truth").alias("label"), "score",
                                 confusion_case("truth", F.col("official") == "NG").alias("case"))


@query("verified_filter", f"""WITH {b.DECISIONS} SELECT sample_id, category, truth, label_source, official FROM dec
WHERE label_source IN ('human_review', 'folder_ground_truth') AND truth IN ('OK', 'NG') AND official IN ('OK', 'NG')""")
def _(t):
    return b.decisions(t).filter(is_verified("truth", "label_source", "official")).select(
        "sample_id", "category", "truth", "label_source", "official")


@query("case_counts", f"""WITH {b.DECISIONS} SELECT category,
  count(*) FILTER (truth = 'NG' AND official = 'NG') AS tp, count(*) FILTER (truth = 'OK' AND official = 'NG') AS fp,
  count(*) FILTER (truth = 'NG' AND official = 'OK') AS fn, count(*) FILTER (truth = 'OK' AND official = 'OK') AS tn
FROM dec GROUP BY 1""")
def _(t):
    cases = b.decisions(t).select("category", confusion_case("truth", F.col("official") == "NG").alias("case"))
    return m.case_counts(cases, ["category"])


@query("latency_stats", f"""WITH {b.DECISIONS} SELECT category, round(avg(latency_ms), 9) AS mean_ms,
  round(quantile_cont(latency_ms, 0.95), 9) AS p95_ms FROM dec GROUP BY 1""")
def _(t):
    return m.latency_stats(b.decisions(t), ["category"], "latency_ms").select(
        "category", F.round("mean_ms", 9).alias("mean_ms"), F.round("p95_ms", 9).alias("p95_ms"))


@query("cohort_fingerprint", f"""WITH {b.CONTENTS}, e AS (SELECT category, coalesce(sha256, '') AS name, count(*) AS n FROM con GROUP BY 1, 2),
l4 AS (SELECT category, substr(name, 1, 4) AS name, sum(n) AS n, sha256(string_agg(concat(name, '=', n), ',' ORDER BY name)) AS d FROM e GROUP BY 1, 2),
l2 AS (SELECT category, substr(name, 1, 2) AS name, sum(n) AS n, sha256(string_agg(concat(name, '=', d), ',' ORDER BY name)) AS d FROM l4 GROUP BY 1, 2),
l0 AS (SELECT category, CAST(sum(n) AS BIGINT) AS members, sha256(string_agg(concat(name, '=', d), ',' ORDER BY name)) AS d FROM l2 GROUP BY 1)
SELECT category, members, substr(sha256(concat_ws(':', members, d, 'fraction=0.25;seed=42')), 1, 12) AS fingerprint FROM l0""")
def _(t):
    return m.cohort_fingerprint(b.contents(t), ["category"], "sha256", settings="fraction=0.25;seed=42")
