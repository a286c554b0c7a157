"""Calibration queries: line-item scores (continuous and tied) and labelled documents."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.functions.decisions import LADDER_QUANTILES, RECALL_LEVELS
from loupeline.operators import calibration as c
from loupeline.operators.lookups import resolve_config
from loupeline.plans.registry import query
from loupeline.sources import bindings as b

QS = ", ".join(f"({q}::DOUBLE)" for q in LADDER_QUANTILES)
OK_RANKS = f"""{b.LINES}, ok AS (SELECT category, score, row_number() OVER (PARTITION BY category ORDER BY score) - 1 AS i,
  count(*) OVER (PARTITION BY category) AS n FROM lines WHERE NOT is_ng),
qs(q) AS (VALUES {QS}),
rungs AS (SELECT category, q, score AS value FROM ok JOIN qs ON i = ceil((n - 1) * q))"""


def sweep_sql(score: str, floor: str = "") -> str:
    return f"""{b.LINES}, g AS (SELECT category, {score} AS threshold, count(*) FILTER (is_ng) AS p,
    count(*) FILTER (NOT is_ng) AS n FROM lines GROUP BY 1, 2),
  w AS (SELECT category, threshold, sum(p) OVER d AS tp, sum(n) OVER d AS fp, sum(p) OVER (PARTITION BY category) AS pp,
      sum(n) OVER (PARTITION BY category) AS nn FROM g WINDOW d AS (PARTITION BY category ORDER BY threshold DESC)),
  u AS (SELECT * FROM w {floor} UNION ALL
        SELECT category, nextafter(max(threshold), 'inf'::DOUBLE), 0, 0, max(pp), max(nn) FROM w GROUP BY 1),
  sweep AS (SELECT category, threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(pp - tp AS BIGINT) AS fn,
      CAST(nn - fp AS BIGINT) AS tn, tp::DOUBLE / pp AS recall, fp::DOUBLE / nn AS ok_false_positive_rate FROM u)"""


SWEEP = sweep_sql("score")
TIED = sweep_sql("tied_score", "WHERE threshold > 0")
FIRST_SQL = """e AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY ok_false_positive_rate, recall DESC, threshold DESC) AS k
    FROM sweep WHERE ok_false_positive_rate <= {cap}::DOUBLE AND recall >= {target}::DOUBLE),
  y AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY recall - ok_false_positive_rate DESC, recall DESC, threshold DESC) AS k
    FROM sweep WHERE ok_false_positive_rate <= {cap}::DOUBLE),
  un AS (SELECT category, min(ok_false_positive_rate) FILTER (recall >= {target}::DOUBLE) AS f FROM sweep GROUP BY 1),
  best AS (SELECT y.category, coalesce(e.threshold, y.threshold) AS threshold, coalesce(e.recall, y.recall) AS recall,
      coalesce(e.ok_false_positive_rate, y.ok_false_positive_rate) AS ok_false_positive_rate,
      coalesce(e.fn, y.fn) AS ng_below_threshold,
      CASE WHEN e.category IS NOT NULL THEN 'target_recall_achieved'
           ELSE 'target_recall_unreachable_under_cap_youden_fallback' END AS status,
      e.category IS NOT NULL AS reachable_under_cap, coalesce(un.f > {cap}::DOUBLE, false) AS fpr_cap_binding
    FROM y LEFT JOIN e ON e.category = y.category AND e.k = 1 JOIN un ON un.category = y.category WHERE y.k = 1)"""


def first_sql(target, cap):
    return FIRST_SQL.format(target=target, cap=cap)


def sweep(t):
    return c.threshold_sweep(b.line_scores(t), ["category"], "score", "is_ng")


def tied_sweep(t):
    return c.threshold_sweep(b.line_scores(t), ["category"], "tied_score", "is_ng", 0.0)


@query("quantile_higher", f"WITH {OK_RANKS} SELECT category, q, value FROM rungs")
def _(t):
    ok = b.line_scores(t).filter(~F.col("is_ng"))
    return c.quantile_higher(ok, ["category"], "score", LADDER_QUANTILES)


@query("ok_quantile_threshold", f"""WITH {b.LINES}, ok AS (SELECT category, score, row_number() OVER (PARTITION BY category
    ORDER BY score) - 1 AS i, count(*) OVER (PARTITION BY category) AS n FROM lines WHERE NOT is_ng)
SELECT category, score AS threshold, 0.9::DOUBLE AS quantile FROM ok WHERE i = ceil((n - 1) * 0.9::DOUBLE)""")
def _(t):
    ok = b.line_scores(t).filter(~F.col("is_ng"))
    return c.ok_quantile_threshold(ok, ["category"], "score", 0.9)


@query("ladder_threshold", f"""WITH {OK_RANKS}, ng AS (SELECT category, score FROM lines WHERE is_ng),
judged AS (SELECT r.category, r.q, r.value, (SELECT count(*) FROM ng WHERE ng.category = r.category AND ng.score < r.value) AS missed
  FROM rungs r),
pick AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY (missed = 0) DESC, CASE WHEN missed = 0 THEN -q ELSE q END) AS k
  FROM judged)
SELECT category, value AS threshold, q AS quantile, missed = 0 AS all_ng_caught, missed AS ng_missed_at_fallback,
  (SELECT count(*) FROM ok WHERE ok.category = pick.category) AS calibration_ok,
  (SELECT count(*) FROM ng WHERE ng.category = pick.category) AS calibration_ng FROM pick WHERE k = 1""")
def _(t):
    return c.ladder_threshold(b.line_scores(t), ["category"], "score", "is_ng")


@query("threshold_sweep", f"WITH {SWEEP} SELECT * FROM sweep")
def _(t):
    return sweep(t)


@query("threshold_sweep_tied", f"WITH {TIED} SELECT * FROM sweep")
def _(t):
    return tied_sweep(t)


@query("recall_first", f"WITH {SWEEP}, {first_sql(0.5, 0.55)} SELECT * FROM best")
def _(t):
    return c.recall_first(sweep(t), ["category"], 0.5, 0.55)


@query("recall_first_fallback", f"WITH {SWEEP}, {first_sql(0.95, 0.2)} SELECT * FROM best")
def _(t):
    return c.recall_first(sweep(t), ["category"], 0.95, 0.2)


@query("youden_fallback", f"WITH {SWEEP}, {first_sql(0.95, 0.2)} SELECT category, threshold, recall, ok_false_positive_rate FROM y WHERE k = 1")
def _(t):
    return c.youden_fallback(sweep(t), ["category"], 0.2)


@query("max_recall_fallback", f"""WITH {SWEEP}, r AS (SELECT *, row_number() OVER (PARTITION BY category
  ORDER BY recall DESC, ok_false_positive_rate, threshold DESC) AS k FROM sweep WHERE ok_false_positive_rate <= 0.2::DOUBLE)
SELECT category, threshold, recall, ok_false_positive_rate, 'max_recall_fallback' AS status FROM r WHERE k = 1""")
def _(t):
    return c.max_recall_fallback(sweep(t), ["category"], 0.95, 0.2)


@query("recall_ladder", f"""WITH {SWEEP}, lv(level) AS (VALUES {", ".join(f"({v}::DOUBLE)" for v in RECALL_LEVELS)}),
r AS (SELECT category, level, threshold, ok_false_positive_rate, row_number() OVER (PARTITION BY category, level
  ORDER BY ok_false_positive_rate, threshold DESC) AS k FROM sweep JOIN lv ON recall >= level)
SELECT category, level AS recall_level, threshold, ok_false_positive_rate FROM r WHERE k = 1""")
def _(t):
    return c.recall_ladder(sweep(t), ["category"])


@query("calibration_diagnostics", f"""WITH {TIED}, {first_sql(0.95, 0.2)}
SELECT category, reachable_under_cap, fpr_cap_binding, ng_below_threshold,
  (SELECT count(*) FROM lines WHERE lines.category = best.category AND is_ng AND tied_score <= 0) AS zero_score_ng FROM best""")
def _(t):
    best = c.recall_first(tied_sweep(t), ["category"], 0.95, 0.2)
    zero = c.zero_score_ng(b.line_scores(t), ["category"], "tied_score", "is_ng")
    return best.join(zero, "category").select("category", "reachable_under_cap", "fpr_cap_binding",
                                              "ng_below_threshold", "zero_score_ng")


# Per-category settings: override, else default.
SETTINGS = [("zero_ng_quantile", None, 0.90), ("zero_ng_quantile", "fr", 0.95), ("target_recall", None, 0.95),
            ("target_recall", "en", 0.90), ("max_fpr", None, 0.2), ("max_fpr", "en", 0.9), ("min_calibration_ok", None, 50.0),
            ("full_rule_min_ng", None, 30.0)]
SETTING_KEYS = ("zero_ng_quantile", "target_recall", "max_fpr", "min_calibration_ok", "full_rule_min_ng")


def settings_frame(t):
    return t.spark.createDataFrame(SETTINGS, "key string, category string, value double")


SETTINGS_SQL = "cfg(key, category, value) AS (VALUES " + ", ".join(
    f"('{k}', {'NULL' if g is None else repr(g)}, {v}::DOUBLE)" for k, g, v in SETTINGS) + ")"


@query("resolve_config", f"""WITH {SETTINGS_SQL}, cats AS (SELECT DISTINCT lang AS category FROM documents),
keys AS (SELECT DISTINCT key FROM cfg)
SELECT c.category, k.key, coalesce(o.value, d.value) AS value FROM cats c CROSS JOIN keys k
LEFT JOIN cfg o ON o.key = k.key AND o.category = c.category LEFT JOIN cfg d ON d.key = k.key AND d.category IS NULL""")
def _(t):
    return resolve_config(t.documents.select(F.col("lang").alias("category")).distinct(), settings_frame(t),
                          SETTING_KEYS)


DOC_RANKS = f"""{b.CONTENTS}, s AS (SELECT category, n_chars::DOUBLE AS score, truth = 'NG' AS is_ng FROM con WHERE truth IS NOT NULL),
{SETTINGS_SQL}, st AS (SELECT c.category, {", ".join(f"coalesce(max(value) FILTER (key = '{k}' AND cfg.category = c.category), max(value) FILTER (key = '{k}' AND cfg.category IS NULL)) AS {k}" for k in SETTING_KEYS)}
  FROM (SELECT DISTINCT category FROM s) c CROSS JOIN cfg GROUP BY 1),
cnt AS (SELECT category, count(*) FILTER (NOT is_ng) AS n, count(*) FILTER (is_ng) AS p FROM s GROUP BY 1),
okr AS (SELECT s.category, score, row_number() OVER (PARTITION BY s.category ORDER BY score) - 1 AS i FROM s WHERE NOT is_ng),
zero AS (SELECT okr.category, score AS t FROM okr JOIN st USING (category) JOIN cnt USING (category) WHERE i = ceil((n - 1) * zero_ng_quantile)),
qs(q) AS (VALUES {QS}),
rg AS (SELECT okr.category, q, score AS t, (SELECT count(*) FROM s x WHERE x.category = okr.category AND x.is_ng AND x.score < okr.score) AS missed
  FROM okr JOIN cnt USING (category) JOIN qs ON i = ceil((n - 1) * q)),
lad AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY (missed = 0) DESC, CASE WHEN missed = 0 THEN -q ELSE q END) AS k FROM rg),
cand AS (SELECT DISTINCT category, score AS t FROM s WHERE score > 0 UNION SELECT category, nextafter(max(score), 'inf'::DOUBLE) FROM s GROUP BY 1),
sw AS (SELECT c.category, c.t, count(*) FILTER (is_ng AND score >= c.t)::DOUBLE / nullif(max(p), 0) AS r, count(*) FILTER (NOT is_ng AND score >= c.t)::DOUBLE / nullif(max(n), 0) AS f
  FROM cand c JOIN s ON s.category = c.category JOIN cnt ON cnt.category = c.category GROUP BY 1, 2),
el AS (SELECT sw.*, row_number() OVER (PARTITION BY category ORDER BY f, r DESC, t DESC) AS k FROM sw JOIN st USING (category) WHERE f <= max_fpr AND r >= target_recall),
yo AS (SELECT sw.*, row_number() OVER (PARTITION BY category ORDER BY r - f DESC, r DESC, t DESC) AS k FROM sw JOIN st USING (category) WHERE f <= max_fpr),
ruled AS (SELECT cnt.category, n, p, CASE WHEN n < min_calibration_ok THEN 'insufficient_calibration_ok' WHEN p = 0 THEN 'ok_quantile'
  WHEN p < full_rule_min_ng THEN 'ladder' ELSE 'recall_first' END AS rule FROM cnt JOIN st USING (category))"""


@query("choose_threshold_rule", f"""WITH {DOC_RANKS}
SELECT ruled.category, rule, n AS calibration_ok, p AS calibration_ng, CASE rule
  WHEN 'ok_quantile' THEN (SELECT t FROM zero WHERE zero.category = ruled.category)
  WHEN 'ladder' THEN (SELECT t FROM lad WHERE lad.category = ruled.category AND k = 1)
  WHEN 'recall_first' THEN coalesce((SELECT t FROM el WHERE el.category = ruled.category AND k = 1),
                                    (SELECT t FROM yo WHERE yo.category = ruled.category AND k = 1)) END AS threshold FROM ruled""")
def _(t):
    rows = b.contents(t).filter(F.col("truth").isNotNull()).select(
        "category", F.col("n_chars").cast("double").alias("score"), (F.col("truth") == "NG").alias("is_ng"))
    flat = resolve_config(rows.select("category").distinct(), settings_frame(t), SETTING_KEYS)
    settings = flat.groupBy("category").pivot("key", list(SETTING_KEYS)).agg(F.first("value"))
    return c.choose_threshold_rule(rows, ["category"], "score", "is_ng", settings)


@query("recalibration_due", f"""WITH {b.DECISIONS}, g AS (SELECT category, batch_no, count(*) FILTER (truth = 'NG') AS ng
  FROM dec WHERE label_source IN ('human_review', 'folder_ground_truth') GROUP BY 1, 2),
r AS (SELECT category, batch_no, CAST(sum(ng) OVER (PARTITION BY category ORDER BY batch_no) AS BIGINT) AS n_ng FROM g)
SELECT category, batch_no, n_ng, floor(n_ng / 5.0::DOUBLE) >
  floor(coalesce(lag(n_ng) OVER (PARTITION BY category ORDER BY batch_no), 0) / 5.0::DOUBLE) AS due FROM r""")
def _(t):
    verified = b.decisions(t).filter(F.col("label_source").isin("human_review", "folder_ground_truth"))
    batches = verified.groupBy("category", "batch_no").agg(F.count_if(F.col("truth") == "NG").alias("ng"))
    return c.recalibration_due(batches, "category", "batch_no", "ng")


@query("threshold_history", f"""WITH {b.DECISIONS}, g AS (SELECT category, batch_no, max(score) FILTER (truth = 'OK') AS threshold
  FROM dec GROUP BY 1, 2)
SELECT category, batch_no, threshold, lag(threshold) OVER w AS previous_threshold, lag(batch_no) OVER w AS previous_batch_no
FROM g WHERE threshold IS NOT NULL WINDOW w AS (PARTITION BY category ORDER BY batch_no)""")
def _(t):
    calibrations = b.decisions(t).groupBy("category", "batch_no").agg(
        F.max(F.when(F.col("truth") == "OK", F.col("score"))).alias("threshold")).filter("threshold IS NOT NULL")
    return c.threshold_history(calibrations, "category", "batch_no")


@query("pixel_threshold", """WITH px AS (SELECT CAST(l_linenumber AS BIGINT) AS category, l_extendedprice AS value FROM lineitem WHERE l_returnflag <> 'R'),
o AS (SELECT category, value, row_number() OVER (PARTITION BY category ORDER BY value) - 1 AS i,
  count(*) OVER (PARTITION BY category) AS n FROM px)
SELECT category, 0.997::DOUBLE AS quantile, value AS pixel_threshold FROM o WHERE i = ceil((n - 1) * 0.997::DOUBLE)""")
def _(t):
    pixels = t.lineitem.filter("l_returnflag <> 'R'").select(
        F.col("l_orderkey").alias("image"), F.col("l_linenumber").cast("bigint").alias("category"),
        F.col("l_extendedprice").alias("value"))
    return c.pixel_threshold(pixels, ["category"], "image", "value")
