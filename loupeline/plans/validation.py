"""Validation, provenance and path lookup queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.functions import validation as v
from loupeline.functions.decisions import INITIAL_SOURCE
from loupeline.operators import lookups as k
from loupeline.operators import review as r
from loupeline.operators import splits as s
from loupeline.plans.masks import RECTS, ng_areas
from loupeline.plans.registry import query
from loupeline.plans.review import ESCALATED, KEYS
from loupeline.plans.splits import SPLIT_TOKEN, unit_sql
from loupeline.sources import bindings as b


def case(name, condition):
    return f"CASE WHEN {condition} THEN '{name}' END"


@query("validate_predictions", f"""WITH {b.DECISIONS} SELECT sample_id, concat_ws(',', {case('feature_norm_decision', 'sample_id % 67 = 0')}, {case('final_decision', 'sample_id % 83 = 0')},
  {case('feature_norm_score', 'sample_id % 73 = 0')}, {case('patchcore_score', 'sample_id % 59 = 0')}, {case('latency_ms', 'sample_id % 71 = 0')}, {case('thresholds_used', 'sample_id % 79 = 0')},
  {case('threshold_nan', 'sample_id % 79 <> 0 AND sample_id % 61 = 0')}, {case('plugin_name', 'sample_id % 89 = 0')},
  {case('pixel_score_map_bytes', 'sample_id % 97 = 0')}, {case('binary_mask_bytes', 'sample_id % 53 = 0')}) AS violations FROM dec""")
def _(t):
    key = F.col("sample_id")
    bad = lambda n: key % n == 0
    nan = F.lit(float("nan"))
    rows = b.decisions(t).select(
        key.cast("string").alias("sample_id"), key.alias("_key"), "category", F.when(bad(73), nan).otherwise(F.col("score")).alias("feature_norm_score"),
        F.when(~bad(59), F.col("score")).alias("patchcore_score"), F.when(~bad(67), F.col("shadow")).alias("feature_norm_decision"), F.col("official").alias("patchcore_decision"),
        F.when(bad(83), "MAYBE").otherwise(F.col("official")).alias("final_decision"), F.when(bad(71), -1.0).otherwise(F.col("latency_ms")).alias("latency_ms"),
        F.when(bad(79), F.create_map().cast("map<string,double>")).otherwise(F.create_map(
            F.lit("image_threshold"), F.col("threshold"), F.lit("pixel_threshold"), F.when(bad(61), nan).otherwise(F.lit(0.5)))).alias("thresholds_used"),
        F.when(bad(89), " ").otherwise("detector").alias("plugin_name"), F.lit("3").alias("plugin_version"), F.lit("v1").alias("model_version"),
        F.when(bad(97), 0).otherwise(1024).alias("pixel_score_map_bytes"), F.when(~bad(53), 512).alias("binary_mask_bytes"))
    return rows.select(F.col("_key").alias("sample_id"), v.prediction_violations().alias("violations"))


@query("validate_labels", """WITH x AS (SELECT *, l_linenumber % 4 <> 0 AS three FROM lineitem)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, concat_ws(',', CASE WHEN l_linenumber % 4 = 0 OR l_linenumber % 5 = 0 THEN 'points' END,
  CASE WHEN l_linenumber - 1 > 3 THEN 'class_range' END, CASE WHEN l_quantity / 40 > 1 THEN 'coordinates' END) AS violations FROM x""")
def _(t):
    """Label lines spelled from line items: some short of a point, some with a stray token, class or coordinate."""
    n = F.col("l_linenumber")
    text = lambda c: c.cast("string")
    three = [text(F.col("l_discount")), text(F.col("l_tax")), text(F.col("l_quantity") / 40), text(F.col("l_discount")), text(F.col("l_tax"))]
    line = F.concat_ws(" ", text(n - 1), *three, F.when(n % 4 != 0, text(F.col("l_tax"))), F.when(n % 5 == 0, F.lit("0.5")))
    return t.lineitem.withColumn("line", line).select("l_orderkey", "l_partkey", "l_suppkey", n.cast("bigint").alias("l_linenumber"),
                                                      v.label_line_violations("line", 4).alias("violations"))


@query("validate_policy", f"""WITH p AS (SELECT c_custkey AS policy_id, c_custkey % 6 - 1 AS seed, c_custkey % 9 AS min_real_train_ng, 18 + c_custkey % 7 AS min_true_ok,
    c_custkey % 11 AS max_support_ng, 20 + c_custkey % 45 AS max_support_ok, c_custkey % 4 AS max_train_synthetic, c_acctbal / 10000 AS share, c_custkey % 13 AS factor FROM customer)
SELECT policy_id, concat_ws(',', {case('seed', 'seed < 0')}, {case('min_real_train_ng', 'min_real_train_ng < 1')}, {case('max_support_ng', 'max_support_ng < 1')},
  {case('max_train_synthetic', 'max_train_synthetic < 1')}, {case('true_ok_range', 'NOT (min_true_ok >= 20 AND min_true_ok <= max_support_ok AND max_support_ok <= 60) OR max_support_ok % 2 <> 0')},
  {case('support_cap', 'min_real_train_ng < 5 OR max_support_ng < min_real_train_ng')}, {case('max_synthetic_fraction', 'NOT (share > 0 AND share < 1)')},
  {case('area_match_factor', 'factor < 1 OR factor > 10')}) AS violations FROM p""")
def _(t):
    c = F.col("c_custkey")
    policies = t.customer.select(
        c.alias("policy_id"), (c % 6 - 1).alias("seed"), (c % 9).alias("min_real_train_ng"), (18 + c % 7).alias("min_true_ok"),
        (c % 11).alias("max_support_ng"), (20 + c % 45).alias("max_support_ok"), F.lit(20).alias("refresh_new_real_ng"), F.lit(8).alias("max_events"),
        (c % 4).alias("max_train_synthetic"), F.lit(0.1).alias("max_synthetic_per_real_ng"), (F.col("c_acctbal") / 10000).alias("max_synthetic_fraction"),
        F.lit(0.02).alias("max_positive_fraction_increase"), (c % 13).cast("double").alias("area_match_factor"))
    return policies.select("policy_id", v.policy_violations().alias("violations"))


@query("support_provenance", f"""WITH {ESCALATED}, ob AS (SELECT sample_id, truth, label_source FROM rev WHERE reviewed)
SELECT d.sample_id, d.category, CASE WHEN d.label_source IS NULL OR d.label_source NOT IN ('human_review', 'folder_ground_truth', 'initial_calibration_yolo_train_ok') THEN 'untrusted_source'
  WHEN d.label_source = 'initial_calibration_yolo_train_ok' AND NOT (d.truth = 'OK' AND d.sample_id % 3 <> 0) THEN 'invalid_initialization'
  WHEN d.label_source <> 'initial_calibration_yolo_train_ok' AND ob.sample_id IS NULL THEN 'no_matching_observation' ELSE '' END AS violations
FROM dec d LEFT JOIN ob ON ob.sample_id = d.sample_id""")
def _(t):
    rows = b.decisions(t)
    seen = r.reviewed_batch(rows, KEYS).filter("review = 'reviewed'").select(
        "sample_id", F.col("truth").alias("observed_label"), F.col("label_source").alias("observed_source"))
    support = rows.select("sample_id", "category", F.col("truth").alias("label"), "label_source", (F.col("sample_id") % 3 != 0).alias("in_bank"),
                          F.when(F.col("label_source") == INITIAL_SOURCE, "initialization").otherwise("line").alias("camera_id"))
    return support.join(seen, "sample_id", "left").select("sample_id", "category", v.support_violations().alias("violations"))


URL = "string_split(lower(url), '/')"


@query("truth_from_path", f"""WITH p AS (SELECT page_id, list_has_any({URL}, ['fr', 'de']) AS ok, list_has_any({URL}, ['es', 'http:']) AS ng FROM pages)
SELECT page_id, CASE WHEN ok AND NOT ng THEN 'OK' WHEN ng AND NOT ok THEN 'NG' END AS truth, CASE WHEN ok AND ng THEN 'both_labels' WHEN NOT ok AND NOT ng THEN 'no_label' END AS error FROM p""")
def _(t):
    paths = t.pages.select("page_id", F.col("url").alias("path"))
    return k.truth_from_path(paths, ("FR", "DE"), ("ES", "http:")).select("page_id", "truth", "error")


ALIASES = [("secure", "https:"), ("plain", "http:"), ("french", "fr"), ("french", "FR-BE")]


@query("category_from_path", f"""WITH p AS (SELECT page_id, {URL} AS parts, CASE page_id % 4 WHEN 0 THEN 'secure' WHEN 1 THEN 'plain' WHEN 2 THEN 'french' ELSE 'en' END AS category FROM pages)
SELECT page_id, category, CASE WHEN NOT list_has_any(parts, CASE category WHEN 'secure' THEN ['https:'] WHEN 'plain' THEN ['http:'] WHEN 'french' THEN ['fr', 'fr-be'] ELSE ['en'] END)
  THEN 'category_mismatch' END AS error FROM p""")
def _(t):
    n = F.col("page_id") % 4
    paths = t.pages.select("page_id", F.col("url").alias("path"), F.when(n == 0, "secure").when(n == 1, "plain").when(n == 2, "french").otherwise("en").alias("category"))
    aliases = t.spark.createDataFrame(ALIASES, "category string, alias string")
    return k.category_from_path(paths, aliases).select("page_id", "category", "error")


IMAGES = "img AS (SELECT o_orderkey AS k, concat('lot', o_custkey % 50, '/', o_orderpriority, '/NG/', o_orderkey, '.png') AS image FROM orders)"
FILES = """mk AS (SELECT k, 1 AS depth, concat('lot', o_custkey % 50, '/', o_orderpriority, '/mask/', k, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN '_t' ELSE '_mask' END, CASE k % 2 WHEN 0 THEN '.png' ELSE '.BMP' END) AS mask, k % 3 AS sx, k % 2 AS ex
    FROM (SELECT *, o_orderkey AS k FROM orders) WHERE k % 7 <> 0
  UNION ALL SELECT k, 1, concat('lot', o_custkey % 50, '/', o_orderpriority, '/mask/', k, '_t.jpg'), 1, 2 FROM (SELECT *, o_orderkey AS k FROM orders) WHERE k % 11 = 0
  UNION ALL SELECT k, 2, concat('lot', o_custkey % 50, '/masks/', k, '.tif'), 0, 3 FROM (SELECT *, o_orderkey AS k FROM orders) WHERE k % 13 = 0)"""


def image_paths(t):
    key = F.col("o_orderkey").cast("string")
    lot = F.concat(F.lit("lot"), (F.col("o_custkey") % 50).cast("string"))
    return t.orders.select(F.col("o_orderkey").alias("k"), key.alias("key"), lot.alias("lot"), F.concat_ws("/", lot, "o_orderpriority").alias("root"),
                           F.concat(F.concat_ws("/", lot, "o_orderpriority", F.lit("NG"), key), F.lit(".png")).alias("image"))


def mask_paths(t):
    rows, n = image_paths(t), F.col("k")
    suffix = F.when(n % 3 == 0, "").when(n % 3 == 1, "_t").otherwise("_mask")
    main = rows.filter(n % 7 != 0).select(F.concat("root", F.lit("/mask/"), "key", suffix, F.when(n % 2 == 0, ".png").otherwise(".BMP")).alias("mask"))
    second = rows.filter(n % 11 == 0).select(F.concat("root", F.lit("/mask/"), "key", F.lit("_t.jpg")).alias("mask"))
    far = rows.filter(n % 13 == 0).select(F.concat("lot", F.lit("/masks/"), "key", F.lit(".tif")).alias("mask"))
    return main.unionByName(second).unionByName(far)


@query("mask_lookup_strict", f"""WITH {IMAGES}, {FILES}, d AS (SELECT k, depth, count(DISTINCT mask) AS n, min(mask) AS mask FROM mk GROUP BY 1, 2),
nr AS (SELECT k, min(depth) AS depth FROM mk GROUP BY 1)
SELECT image, CASE WHEN n = 1 THEN mask END AS mask, coalesce(n, 0) AS n_matches, CASE WHEN n > 1 THEN 'ambiguous_masks' END AS error
FROM img LEFT JOIN nr USING (k) LEFT JOIN d ON d.k = img.k AND d.depth = nr.depth""")
def _(t):
    return k.mask_lookup_strict(image_paths(t).select("image"), mask_paths(t), ignore_case=True)


@query("mask_lookup_exact", f"""WITH {IMAGES}, {FILES}, ex AS (SELECT * FROM mk WHERE NOT contains(mask, '.BMP')), d AS (SELECT k, depth, count(DISTINCT mask) AS n, min(mask) AS mask FROM ex GROUP BY 1, 2),
nr AS (SELECT k, min(depth) AS depth FROM ex GROUP BY 1)
SELECT image, CASE WHEN n = 1 THEN mask END AS mask, coalesce(n, 0) AS n_matches, CASE WHEN n > 1 THEN 'ambiguous_masks' END AS error
FROM img LEFT JOIN nr USING (k) LEFT JOIN d ON d.k = img.k AND d.depth = nr.depth""")
def _(t):
    """Mask extensions as exact names: an upper-case extension is another name."""
    return k.mask_lookup_strict(image_paths(t).select("image"), mask_paths(t))


@query("mask_lookup_priority", f"""WITH {IMAGES}, {FILES}, rk AS (SELECT k, mask, row_number() OVER (PARTITION BY k ORDER BY CASE sx WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END,
    CASE ex WHEN 1 THEN '.bmp' WHEN 2 THEN '.jpg' ELSE '.png' END) AS n FROM mk WHERE depth = 1)
SELECT image, mask FROM img LEFT JOIN rk ON rk.k = img.k AND n = 1""")
def _(t):
    return k.mask_lookup_priority(image_paths(t).select("image"), mask_paths(t))


@query("model_display_name", """WITH m AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'pretrained' ELSE concat(o_orderpriority, '-seg-v', o_custkey, '-', substr(sha256(CAST(o_orderkey AS VARCHAR)), 1, 12)) END AS version FROM orders)
SELECT o_orderkey, CASE WHEN version = 'pretrained' THEN '预训练模型' ELSE concat('YOLO-v', string_split(string_split(version, '-seg-v')[2], '-')[1]) END AS name FROM m""")
def _(t):
    n = F.col("o_orderkey")
    version = F.when(n % 5 == 0, "pretrained").otherwise(F.concat("o_orderpriority", F.lit("-seg-v"), F.col("o_custkey").cast("string"), F.lit("-"),
                                                                  F.substring(F.sha2(n.cast("string"), 256), 1, 12)))
    return t.orders.select("o_orderkey", k.model_display_name(version).alias("name"))


@query("split_lookup_or_compute", f"""WITH {b.CONTENTS} SELECT sample_id, category, CASE WHEN truth = 'NG' THEN 'train'
  WHEN {unit_sql(SPLIT_TOKEN.format(seed=42))} < 0.25::DOUBLE THEN 'calibration' ELSE 'train' END AS split FROM con""")
def _(t):
    rows = b.contents(t)
    stored = rows.filter("truth = 'NG'").select("sample_id", F.lit("train").alias("split"))
    return k.split_lookup_or_compute(rows, stored).select("sample_id", "category", "split")


@query("area_stratified_support", f"""WITH {b.CONTENTS}, o AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n_chars, sha256, sample_id) - 1 AS i, count(*) OVER (PARTITION BY category) AS n FROM con),
c AS (SELECT category, max(n) AS n, least(max(n), 40) AS kk FROM o GROUP BY 1),
w AS (SELECT DISTINCT category, CASE WHEN kk = 1 THEN 0 WHEN j = kk - 1 THEN n - 1 ELSE CAST(floor(j * ((n - 1)::DOUBLE / greatest(kk - 1, 1))) AS BIGINT) END AS i FROM c, generate_series(0, kk - 1) AS g(j))
SELECT o.sample_id, o.category, o.n_chars FROM o JOIN w ON w.category = o.category AND w.i = o.i""")
def _(t):
    return s.linspace_support(b.contents(t), "category", ["n_chars", "sha256", "sample_id"], 40).select("sample_id", "category", "n_chars")


AREAS = f"""{RECTS}, {b.clipped_sql('gtr', 'c')}, {b.pixels_sql('c', 'cp')}, n AS (SELECT sample_id, category, count(*) AS px FROM cp GROUP BY 1, 2),
real AS (SELECT n.category, px::DOUBLE / coalesce((rx1 - rx0 + 1) * (ry1 - ry0 + 1), {b.IMAGE_HEIGHT * b.IMAGE_WIDTH}) AS area FROM n LEFT JOIN roi ON roi.category = n.category),
so AS (SELECT category, area, row_number() OVER (PARTITION BY category ORDER BY area) - 1 AS i, count(*) OVER (PARTITION BY category) AS n FROM real),
tg AS (SELECT DISTINCT category, j AS target_id, (n - 1) * ((j + 0.5::DOUBLE) / 8) AS pos FROM so, generate_series(0, 7) AS g(j)),
target AS (SELECT tg.category, target_id, lo.area + (hi.area - lo.area) * (pos - floor(pos)) AS target FROM tg JOIN so lo ON lo.category = tg.category AND lo.i = floor(pos)
  JOIN so hi ON hi.category = tg.category AND hi.i = ceil(pos)),
item AS (SELECT o_orderpriority AS category, o_orderkey AS item_id, (1 + (o_custkey * 7919) % 4001) / 100000.0::DOUBLE AS area FROM orders WHERE o_orderstatus <> 'F'),
band AS (SELECT t.category, target_id, target, item_id, area, abs(ln(area / target)) AS log_distance FROM target t JOIN item ON item.category = t.category
  AND area >= target / 2.0::DOUBLE AND area <= target * 2.0::DOUBLE)"""


def targets(t):
    areas = ng_areas(t).filter("area > 0")
    budgets = areas.select("category").distinct().withColumn("budget", F.lit(8).cast("bigint"))
    return s.area_targets(areas, "category", "area", budgets)


def items(t):
    return t.orders.filter("o_orderstatus <> 'F'").select(F.col("o_orderpriority").alias("category"), F.col("o_orderkey").alias("item_id"),
                                                          ((1 + F.col("o_custkey") * 7919 % 4001) / F.lit(100000.0)).alias("area"))


@query("area_targets", f"WITH {AREAS} SELECT category, target_id, round(target, 12) AS target FROM target")
def _(t):
    return targets(t).select("category", "target_id", F.round("target", 12).alias("target"))


@query("area_band_join", f"WITH {AREAS} SELECT category, target_id, item_id, round(log_distance, 9) AS log_distance FROM band")
def _(t):
    return s.area_band_join(targets(t), items(t), "category", 2.0).select("category", "target_id", "item_id", F.round("log_distance", 9).alias("log_distance"))


@query("area_match_select", f"""WITH RECURSIVE {AREAS}, sh AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY category, target_id ORDER BY log_distance, item_id) AS rn FROM band) WHERE rn <= 8),
tl AS (SELECT category, target_id, list(item_id ORDER BY rn) AS near FROM sh GROUP BY 1, 2),
g AS (SELECT DISTINCT category, -1::BIGINT AS target_id, CAST([] AS BIGINT[]) AS used, NULL::BIGINT AS item_id FROM item UNION ALL
  SELECT g.category, tl.target_id, list_append(used, list_filter(near, lambda x: NOT list_contains(used, x))[1]), list_filter(near, lambda x: NOT list_contains(used, x))[1]
  FROM g JOIN tl ON tl.category = g.category AND tl.target_id = g.target_id + 1)
SELECT category, target_id, item_id FROM g WHERE target_id >= 0 AND item_id IS NOT NULL""")
def _(t):
    return s.area_match_select(targets(t), items(t), "category", 2.0).select("category", "target_id", "item_id")
