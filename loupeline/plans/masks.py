"""Mask algebra queries; the SQL works on single pixels and rectangles."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.operators import large_images as li
from loupeline.operators import regions as rg
from loupeline.operators import runs as u
from loupeline.operators.calibration import mask_conf_threshold
from loupeline.operators.review import region_topk, top_ranked
from loupeline.plans.registry import query
from loupeline.sources import bindings as b

H, W = b.IMAGE_HEIGHT, b.IMAGE_WIDTH
ID = ["sample_id"]
RECTS = f"{b.GT_RECTS}, {b.INSTANCES}, {b.ROI}"
PIX = f"{RECTS}, {b.pixels_sql('gtr', 'gp')}, {b.pixels_sql('ins', 'pp', 'conf >= 0.5::DOUBLE')}"
MASK_CONF, SHADOW_CONF = 0.5, 0.3


def kept(t, conf=MASK_CONF):
    return b.instance_runs(t).filter(F.col("conf") >= conf)


def kept_stacks(t, conf=MASK_CONF):
    return b.instance_stacks(t).filter(F.col("conf") >= conf)


def heat_milli():
    """Heat sum of a region in thousandths: confidences are whole thousandths here, so it compares as an integer."""
    return F.round(F.col("mean") * F.col("area") * 1000).cast("bigint").alias("heat_milli")


def as_bigint(runs, *extra):
    return runs.select("sample_id", *extra, *[F.col(c).cast("bigint").alias(c) for c in ("y", "x0", "x1")])


RUNS_SQL = """isl AS (SELECT *, x - row_number() OVER (PARTITION BY sample_id, y ORDER BY x) AS k FROM {pix})
SELECT sample_id, CAST(y AS BIGINT) AS y, CAST(min(x) AS BIGINT) AS x0, CAST(max(x) AS BIGINT) AS x1 FROM isl GROUP BY sample_id, y, k"""


@query("merge_runs", f"WITH {PIX}, {RUNS_SQL.format(pix='gp')}")
def _(t):
    return as_bigint(u.merge_runs(b.gt_runs(t).select("sample_id", *u.RUN), ID))


@query("dilate_runs", f"""WITH {RECTS}, near AS (SELECT sample_id, category, greatest(x0 - 5, 0) AS x0, greatest(y0 - 5, 0) AS y0,
  least(x1 + 5, {W - 1}) AS x1, least(y1 + 5, {H - 1}) AS y1 FROM gtr), {b.pixels_sql('near', 'np')}, {RUNS_SQL.format(pix='np')}""")
def _(t):
    return as_bigint(u.dilate_runs(b.gt_runs(t).select("sample_id", *u.RUN), ID, 5, H, W))


@query("mask_to_runs", """WITH ch AS (SELECT doc_id AS sample_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) - 1 AS i FROM documents),
fg AS (SELECT sample_id, i // 64 AS y, i % 64 AS x FROM ch WHERE unicode(c) >= 128),
isl AS (SELECT *, x - row_number() OVER (PARTITION BY sample_id, y ORDER BY x) AS k FROM fg)
SELECT sample_id, CAST(y AS BIGINT) AS y, CAST(min(x) AS BIGINT) AS x0, CAST(max(x) AS BIGINT) AS x1 FROM isl GROUP BY sample_id, y, k""")
def _(t):
    """A text read as a raster 64 wide: pixel values are code points, foreground is the internal convention >= 128."""
    rasters = t.documents.select(F.col("doc_id").alias("sample_id"), "text")
    return as_bigint(u.raster_to_runs(rasters, "sample_id", "text", 64))


@query("binarize_mask", """WITH px AS (SELECT doc_id AS sample_id, doc_id % 2 = 0 AS external, unicode(unnest(string_split(text, ''))) AS v FROM documents)
SELECT sample_id, external, count(*) AS pixels, count(*) FILTER (CASE WHEN external THEN v < 128 ELSE v >= 128 END) AS defect_pixels FROM px GROUP BY 1, 2""")
def _(t):
    """External masks mark defects dark, internal masks bright; the background class tells the operator which."""
    rasters = t.documents.filter(F.length("text") > 0).select(F.col("doc_id").alias("sample_id"), "text", (F.col("doc_id") % 2 == 0).alias("external"))
    runs = None
    for external, background in ((True, r"\x{80}-\x{10FFFF}"), (False, r"\x00-\x7f")):
        part = u.raster_to_runs(rasters.filter(F.col("external") == external), "sample_id", "text", 64, background)
        runs = part if runs is None else runs.unionByName(part)
    area = runs.groupBy("sample_id").agg(F.sum(u.length()).cast("bigint").alias("defect_pixels"))
    return rasters.join(area, "sample_id", "left").select(
        "sample_id", "external", F.length("text").cast("bigint").alias("pixels"), F.coalesce("defect_pixels", F.lit(0).cast("bigint")).alias("defect_pixels"))


@query("mask_intersection", f"""WITH {PIX}, i AS (SELECT sample_id, count(*) AS n FROM gp JOIN pp USING (sample_id, y, x) GROUP BY 1),
a AS (SELECT sample_id, count(*) AS n FROM gp GROUP BY 1), p AS (SELECT sample_id, count(*) AS n FROM pp GROUP BY 1)
SELECT sample_id, coalesce(a.n, 0) AS area_a, coalesce(p.n, 0) AS area_b, coalesce(i.n, 0) AS intersection,
  coalesce(a.n, 0) + coalesce(p.n, 0) - coalesce(i.n, 0) AS "union" FROM a FULL JOIN p USING (sample_id) LEFT JOIN i USING (sample_id)""")
def _(t):
    return u.mask_intersection(b.gt_runs(t), kept(t), ID)


@query("mask_union_area", f"""WITH {PIX} SELECT sample_id, count(*) AS union_area FROM (SELECT sample_id, y, x FROM gp UNION SELECT sample_id, y, x FROM pp) GROUP BY 1""")
def _(t):
    return u.mask_intersection(b.gt_runs(t), kept(t), ID).select("sample_id", F.col("union").alias("union_area"))


@query("roi_clip", f"WITH {RECTS}, {b.clipped_sql('gtr', 'c')}, {b.pixels_sql('c', 'cp')}, {RUNS_SQL.format(pix='cp')}")
def _(t):
    clipped = u.roi_clip(b.gt_runs(t), b.roi_runs(t))
    return as_bigint(u.merge_runs(clipped.select("sample_id", *u.RUN), ID))


TOLERANT = """cg AS (SELECT p.* FROM {g} p), cp AS (SELECT p.* FROM {p} p),
area AS (SELECT sample_id, count(*) AS a FROM cg GROUP BY 1),
mt AS (SELECT sample_id, count(*) AS m FROM cg WHERE EXISTS (SELECT 1 FROM {pr} r WHERE r.sample_id = cg.sample_id AND cg.x BETWEEN r.x0 - 5 AND r.x1 + 5
  AND cg.y BETWEEN r.y0 - 5 AND r.y1 + 5) GROUP BY 1),
ex AS (SELECT sample_id, count(*) AS e FROM cp WHERE NOT EXISTS (SELECT 1 FROM {gr} r WHERE r.sample_id = cp.sample_id AND cp.x BETWEEN r.x0 - 5 AND r.x1 + 5
  AND cp.y BETWEEN r.y0 - 5 AND r.y1 + 5) GROUP BY 1)"""


@query("tolerant_counts", f"""WITH {PIX}, keep AS (SELECT * FROM ins WHERE conf >= 0.5::DOUBLE), {TOLERANT.format(g='gp', p='pp', pr='keep', gr='gtr')}
SELECT sample_id, coalesce(m, 0) AS tolerant_matched_pixels, a + least(coalesce(e, 0), a) AS tolerant_total_pixels
FROM area LEFT JOIN mt USING (sample_id) LEFT JOIN ex USING (sample_id)""")
def _(t):
    return u.tolerant_counts(b.gt_stacks(t), kept_stacks(t), ID, H, W)


@query("ng_mask_area", f"""WITH {RECTS}, {b.clipped_sql('gtr', 'c')}, {b.pixels_sql('c', 'cp')},
s AS (SELECT DISTINCT sample_id, category FROM gtr), n AS (SELECT sample_id, count(*) AS px FROM cp GROUP BY 1)
SELECT s.sample_id, s.category, coalesce(px, 0)::DOUBLE / coalesce((rx1 - rx0 + 1) * (ry1 - ry0 + 1), {H * W}) AS area
FROM s LEFT JOIN n USING (sample_id) LEFT JOIN roi ON roi.category = s.category""")
def _(t):
    return ng_areas(t)


def ng_areas(t):
    """Defect share of the inspected area per NG sample, 0 when the defect lies outside."""
    gt, roi = b.gt_runs(t), b.roi_runs(t)
    inside = u.mask_area(u.merge_runs(u.roi_clip(gt, roi).select("sample_id", *u.RUN), ID), ID)
    size = u.mask_area(roi, ["category"]).withColumnRenamed("area", "roi_area")
    samples = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("sample_id"), F.col("o_orderpriority").alias("category"))
    joined = samples.join(inside, "sample_id", "left").join(size, "category", "left")
    return joined.select("sample_id", "category", (F.coalesce("area", F.lit(0)).cast("double")
                                                   / F.coalesce("roi_area", F.lit(H * W))).alias("area"))


@query("roi_exclude", f"""WITH {RECTS}, {b.clipped_sql('gtr', 'c')} SELECT DISTINCT sample_id, category FROM gtr
WHERE sample_id NOT IN (SELECT sample_id FROM c)""")
def _(t):
    gt = b.gt_runs(t)
    inside = u.roi_clip(gt, b.roi_runs(t)).select("sample_id")
    return gt.select("sample_id", "category").distinct().join(inside, "sample_id", "left_anti")


@query("roi_bbox_crop", f"""WITH {RECTS}, {b.clipped_sql('gtr', 'c')}, cc AS (SELECT c.sample_id, c.category, c.x0 - rx0 AS x0, c.x1 - rx0 AS x1,
  c.y0 - ry0 AS y0, c.y1 - ry0 AS y1 FROM c JOIN roi USING (category)), {b.pixels_sql('cc', 'cp')}, {RUNS_SQL.format(pix='cp')}""")
def _(t):
    cropped = u.roi_bbox_crop(b.gt_runs(t), b.roi_runs(t))
    return as_bigint(u.merge_runs(cropped.select("sample_id", *u.RUN), ID))


@query("roi_rescale_nearest", f"""WITH {b.ROI}, sz AS (SELECT o_orderpriority AS category, 48 + count(*) % 33 AS height, 70 + count(*) % 91 AS width FROM orders GROUP BY 1),
grid AS (SELECT sz.category, y, x, y * {H} // height AS sy, x * {W} // width AS sx FROM sz, generate_series(0, height - 1) AS a(y), generate_series(0, width - 1) AS c(x)),
px AS (SELECT g.category AS sample_id, y, x FROM grid g JOIN roi ON roi.category = g.category AND sx BETWEEN rx0 AND rx1 AND sy BETWEEN ry0 AND ry1),
isl AS (SELECT *, x - row_number() OVER (PARTITION BY sample_id, y ORDER BY x) AS k FROM px)
SELECT sample_id AS category, CAST(y AS BIGINT) AS y, CAST(min(x) AS BIGINT) AS x0, CAST(max(x) AS BIGINT) AS x1 FROM isl GROUP BY 1, 2, k""")
def _(t):
    sizes = t.orders.groupBy(F.col("o_orderpriority").alias("category")).agg(F.count(F.lit(1)).alias("n")).select(
        "category", F.lit(H).alias("src_height"), F.lit(W).alias("src_width"), (48 + F.col("n") % 33).alias("height"),
        (70 + F.col("n") % 91).alias("width"))
    out = u.roi_rescale_nearest(b.roi_runs(t), sizes)
    return out.select("category", *[F.col(c).cast("bigint").alias(c) for c in ("y", "x0", "x1")])


@query("instance_union", f"WITH {PIX}, {RUNS_SQL.format(pix='pp')}")
def _(t):
    return as_bigint(u.merge_runs(kept_stacks(t), ID))


CONF_PIX = """cm AS (SELECT sample_id, category, y, x, max(conf) AS conf FROM (SELECT sample_id, category, conf, x0, x1,
    unnest(generate_series(y0, y1)) AS y FROM {source}) r, generate_series(r.x0, r.x1) AS g(x) GROUP BY ALL)"""


@query("confidence_map", f"""WITH {RECTS}, {CONF_PIX.format(source='ins')} SELECT sample_id, CAST(y AS BIGINT) AS y, count(*) AS pixels, max(conf) AS top_conf,
  CAST(sum(round(conf * 1000)) AS BIGINT) AS conf_milli FROM cm GROUP BY 1, 2""")
def _(t):
    stretches = u.confidence_map(b.instance_stacks(t), ID)
    return stretches.groupBy("sample_id", F.col("y").cast("bigint").alias("y")).agg(
        F.sum(u.length()).cast("bigint").alias("pixels"), F.max("conf").alias("top_conf"),
        F.sum(F.round(F.col("conf") * 1000).cast("bigint") * u.length()).cast("bigint").alias("conf_milli"))


@query("instance_image_score", f"""WITH {b.INSTANCES} SELECT o_orderkey AS sample_id, coalesce(max(conf), 0) AS image_score
FROM orders LEFT JOIN ins ON ins.sample_id = o_orderkey GROUP BY 1""")
def _(t):
    return image_scores(t, t.orders.select(F.col("o_orderkey").alias("sample_id")))


def image_scores(t, samples):
    """``samples`` with the highest confidence of their instances, 0 without any."""
    best = b.instance_scores(t).groupBy("sample_id").agg(F.max("conf").alias("best"))
    return samples.join(best, "sample_id", "left").select(*samples.columns, F.coalesce("best", F.lit(0.0)).alias("image_score"))


@query("instances_top20", f"""WITH {b.INSTANCES}, r AS (SELECT sample_id, inst, conf, row_number() OVER (PARTITION BY sample_id ORDER BY conf DESC, inst) AS rank FROM ins)
SELECT sample_id, inst, conf, rank, conf >= 0.5::DOUBLE AS kept FROM r WHERE rank <= 20""")
def _(t):
    ranked = top_ranked(b.instance_rects(t), ID, [F.col("conf").desc(), F.col("inst")], 20)
    return ranked.select("sample_id", "inst", "conf", F.col("rank").cast("bigint").alias("rank"), (F.col("conf") >= MASK_CONF).alias("kept"))


@query("instance_roi_filter", f"""WITH {RECTS}, {b.clipped_sql('ins', 'c')}
SELECT sample_id, inst, sum((x1 - x0 + 1) * (y1 - y0 + 1))::BIGINT AS area FROM c GROUP BY 1, 2""")
def _(t):
    inside = rg.instance_roi_filter(b.instance_runs(t), b.roi_runs(t), ["sample_id", "inst"])
    return u.mask_area(inside, ["sample_id", "inst"])


COMPONENTS = """rects AS (SELECT sample_id, row_number() OVER () AS id, x0, y0, x1, y1 FROM {source}),
adj AS (SELECT a.sample_id, a.id AS i, c.id AS j FROM rects a JOIN rects c ON a.sample_id = c.sample_id AND a.x0 <= c.x1 + 1 AND c.x0 <= a.x1 + 1
  AND a.y0 <= c.y1 + 1 AND c.y0 <= a.y1 + 1),
reach AS (SELECT sample_id, i, j FROM adj UNION SELECT r.sample_id, r.i, a.j FROM reach r JOIN adj a ON a.i = r.j AND a.sample_id = r.sample_id),
comp AS (SELECT sample_id, i AS id, min(j) AS root FROM reach GROUP BY 1, 2),
px AS (SELECT DISTINCT r.sample_id, c.root, y, x FROM rects r JOIN comp c ON c.id = r.id, generate_series(r.y0, r.y1) AS gy(y), generate_series(r.x0, r.x1) AS gx(x)),
st AS (SELECT sample_id, root, count(*) AS area, min(x) AS bx0, min(y) AS by0, max(x) + 1 AS bx1, max(y) + 1 AS by1, min(y * 1000 + x) AS first FROM px GROUP BY 1, 2),
lab AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY first) AS label FROM st)"""


@query("connected_components", f"""WITH RECURSIVE {b.INSTANCES}, {COMPONENTS.format(source="ins WHERE conf >= 0.5::DOUBLE")}
SELECT sample_id, label, area, bx0, by0, bx1, by1 FROM lab""")
def _(t):
    labelled = rg.connected_components(kept_stacks(t), "sample_id")
    boxes = rg.region_boxes(labelled, "sample_id")
    return boxes.select("sample_id", "label", "area", *[F.col(c).cast("bigint").alias(c) for c in ("bx0", "by0", "bx1", "by1")])


@query("connected_components_tiled", f"""WITH RECURSIVE {b.INSTANCES}, {COMPONENTS.format(source="ins WHERE conf >= 0.5::DOUBLE")}
SELECT sample_id, label, area, bx0, by0, bx1, by1 FROM lab""")
def _(t):
    """The same labels from tiles of 16 by 16 pixels whose borders are joined: 24 tiles an image here."""
    boxes = rg.region_boxes(li.connected_components_tiled(kept_stacks(t), "sample_id", 16, 16), "sample_id")
    return boxes.select("sample_id", "label", "area", *[F.col(c).cast("bigint").alias(c) for c in ("bx0", "by0", "bx1", "by1")])


@query("component_boxes", f"""WITH RECURSIVE {b.GT_RECTS}, {COMPONENTS.format(source="gtr")}
SELECT sample_id, label, least(bx0 / {W - 1}.0::DOUBLE, 1) AS "left", least(by0 / {H - 1}.0::DOUBLE, 1) AS top,
  least(bx1 / {W - 1}.0::DOUBLE, 1) AS "right", least(by1 / {H - 1}.0::DOUBLE, 1) AS bottom FROM lab""")
def _(t):
    return rg.component_boxes(rg.connected_components(b.gt_stacks(t), "sample_id"), "sample_id", H, W)


@query("dataset_stats", f"""WITH RECURSIVE {b.GT_RECTS}, {b.ROI}, {b.clipped_sql('gtr', 'cl')}, {COMPONENTS.format(source="cl")},
o AS (SELECT o_orderkey AS sample_id, CASE WHEN o_orderkey % 4 = 0 THEN 'val' ELSE 'train' END AS split, o_orderstatus = 'F' AS ng FROM orders),
n AS (SELECT sample_id, count(*) AS c FROM lab GROUP BY 1)
SELECT split, count(*) FILTER (NOT ng OR c IS NOT NULL) AS images, count(*) FILTER (ng AND c IS NOT NULL) AS ng, CAST(coalesce(sum(c), 0) AS BIGINT) AS components,
  count(*) FILTER (ng AND c IS NULL) AS excluded_outside_roi FROM o LEFT JOIN n USING (sample_id) GROUP BY 1""")
def _(t):
    clipped = u.roi_clip(b.gt_stacks(t), b.roi_runs(t))
    parts = rg.connected_components(clipped, "sample_id").groupBy("sample_id").agg(F.max("label").alias("c"))
    samples = t.orders.select(F.col("o_orderkey").alias("sample_id"), F.when(F.col("o_orderkey") % 4 == 0, "val").otherwise("train").alias("split"),
                              (F.col("o_orderstatus") == "F").alias("is_ng")).join(parts, "sample_id", "left")
    has = F.col("c").isNotNull()
    return samples.groupBy("split").agg(
        F.count_if(~F.col("is_ng") | has).alias("images"), F.count_if(F.col("is_ng") & has).alias("ng"),
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("components"), F.count_if(F.col("is_ng") & ~has).alias("excluded_outside_roi"))


HOT = """peak AS (SELECT sample_id, max(conf) AS peak FROM cm GROUP BY 1),
hot AS (SELECT cm.*, greatest(0.3::DOUBLE, 0.7::DOUBLE * peak) AS thr FROM cm JOIN peak USING (sample_id) WHERE conf >= greatest(0.3::DOUBLE, 0.7::DOUBLE * peak)),
hins AS (SELECT ins.* FROM ins JOIN peak USING (sample_id) WHERE conf >= greatest(0.3::DOUBLE, 0.7::DOUBLE * peak))"""
REGIONS = f"""{b.INSTANCES}, {CONF_PIX}, {HOT}, {COMPONENTS.format(source="hins")},
rs AS (SELECT px.sample_id, lab.label, count(*) AS area, max(conf) AS peak, avg(conf) AS mean, any_value(thr) AS thr, any_value(bx0) AS bx0, any_value(by0) AS by0,
  any_value(bx1) AS bx1, any_value(by1) AS by1 FROM px JOIN lab ON lab.sample_id = px.sample_id AND lab.root = px.root JOIN hot ON hot.sample_id = px.sample_id
  AND hot.y = px.y AND hot.x = px.x GROUP BY 1, 2)"""


def heat(t):
    """Instances with their confidence as heat; where they overlap the highest counts."""
    return b.instance_stacks(t).withColumnRenamed("conf", "value")


@query("hybrid_regions", f"""WITH RECURSIVE {REGIONS}, rk AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY peak DESC, area DESC, label) AS rank FROM rs WHERE area >= 24)
SELECT sample_id, label, rank, area, peak, CAST(round(mean * area * 1000) AS BIGINT) AS heat_milli, bx0, by0, bx1, by1, thr AS threshold_used FROM rk WHERE rank <= 3""")
def _(t):
    out = rg.hybrid_regions(heat(t), "sample_id", 0.3, 0.7, 24, 3, overlapping=True)
    return out.select("sample_id", "label", F.col("rank").cast("bigint").alias("rank"), "area", "peak", heat_milli(),
                      *[F.col(c).cast("bigint").alias(c) for c in ("bx0", "by0", "bx1", "by1")], "threshold_used")


@query("hybrid_region_mask", f"""WITH RECURSIVE {REGIONS}, rk AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY peak DESC, area DESC, label) AS rank FROM rs WHERE area >= 24),
kp AS (SELECT px.sample_id, px.y, px.x FROM px JOIN lab ON lab.sample_id = px.sample_id AND lab.root = px.root JOIN rk ON rk.sample_id = lab.sample_id AND rk.label = lab.label AND rank <= 3),
{RUNS_SQL.format(pix='kp')}""")
def _(t):
    return as_bigint(rg.hybrid_region_mask(heat(t), "sample_id", 0.3, 0.7, 24, 3, overlapping=True))


@query("region_stats", f"WITH RECURSIVE {REGIONS} SELECT sample_id, label, area, peak, CAST(round(mean * area * 1000) AS BIGINT) AS heat_milli FROM rs")
def _(t):
    stats = rg.region_stats(rg.above_peak(heat(t), "sample_id", 0.3, 0.7), "sample_id", overlapping=True)
    return stats.select("sample_id", "label", "area", "peak", heat_milli())


@query("region_topk", f"""WITH RECURSIVE {b.INSTANCES}, {COMPONENTS.format(source="ins WHERE conf >= 0.5::DOUBLE")},
pk AS (SELECT lab.sample_id, label, area, max(conf) AS peak FROM lab JOIN comp ON comp.sample_id = lab.sample_id AND comp.root = lab.root
  JOIN (SELECT sample_id, row_number() OVER () AS id, conf FROM ins WHERE conf >= 0.5::DOUBLE) i ON i.id = comp.id GROUP BY 1, 2, 3),
rk AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY peak DESC, area DESC, label) AS rank FROM pk WHERE area >= 20)
SELECT sample_id, label, rank, area, peak FROM rk WHERE rank <= 2""")
def _(t):
    stats = rg.region_stats(heat(t).filter(F.col("value") >= MASK_CONF), "sample_id", overlapping=True)
    return region_topk(stats, "sample_id", 20, 2).select("sample_id", "label", F.col("rank").cast("bigint").alias("rank"), "area", "peak")


@query("heat_floor", f"""WITH {b.INSTANCES}, {b.ROI}, f AS (SELECT ins.*, x0 BETWEEN rx0 AND rx1 OR rx0 IS NULL AS valid FROM ins LEFT JOIN roi USING (category))
SELECT sample_id, inst, valid, CASE WHEN valid THEN conf ELSE min(conf) FILTER (valid) OVER (PARTITION BY sample_id) END AS value FROM f""")
def _(t):
    roi = t.spark.createDataFrame([(c, r[0], r[2]) for c, r in b.ROI_RECTS.items()], "category string, rx0 int, rx1 int")
    cells = b.instance_rects(t).join(roi, "category", "left").select(
        "sample_id", "inst", F.col("conf").alias("value"), (F.col("rx0").isNull() | F.col("x0").between(F.col("rx0"), F.col("rx1"))).alias("valid"))
    return rg.heat_floor(cells, "sample_id").select("sample_id", "inst", "valid", "value")


GRID = "grid(g) AS (SELECT unnest([0.001, 0.002, 0.005, 0.995, 0.999])::DOUBLE UNION ALL SELECT i / 100.0::DOUBLE FROM generate_series(1, 99) AS s(i))"
CURVE = f"""{b.GT_RECTS}, {b.INSTANCES}, {b.ROI}, {b.clipped_sql('gtr', 'cg')}, {b.clipped_sql('ins', 'cins')}, {CONF_PIX.format(source='cins')}, {b.pixels_sql('cg', 'gp')}, {GRID},
ar AS (SELECT n.sample_id, n.category, count(gp.x) AS a FROM (SELECT DISTINCT sample_id, category FROM gtr) n LEFT JOIN gp USING (sample_id) GROUP BY 1, 2),
cf AS (SELECT cm.sample_id, conf, count(*) AS n, count(gp.x) AS h FROM cm JOIN ar USING (sample_id) LEFT JOIN gp ON gp.sample_id = cm.sample_id AND gp.y = cm.y AND gp.x = cm.x GROUP BY 1, 2),
pt AS (SELECT ar.category, g, ar.sample_id, coalesce(coalesce(sum(h), 0)::DOUBLE / nullif(max(a) + coalesce(sum(n), 0) - coalesce(sum(h), 0), 0), 0) AS iou
  FROM ar CROSS JOIN grid LEFT JOIN cf ON cf.sample_id = ar.sample_id AND cf.conf >= g GROUP BY 1, 2, 3),
curve AS (SELECT category, g AS conf, avg(iou) AS mean_iou FROM pt GROUP BY 1, 2)"""


def curve(t):
    return u.mask_conf_curve(b.gt_stacks(t), b.instance_stacks(t, only_ng=True), ["category"], "sample_id", b.roi_runs(t))


@query("mask_conf_curve", f"WITH {CURVE} SELECT category, conf, round(mean_iou, 9) AS mean_iou FROM curve")
def _(t):
    return curve(t).select("category", "conf", F.round("mean_iou", 9).alias("mean_iou"))


@query("mask_conf_threshold", f"""WITH {CURVE}, r AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY round(mean_iou, 9) DESC, conf DESC) AS k FROM curve)
SELECT category, conf AS mask_conf_threshold, round(mean_iou, 9) AS mean_iou FROM r WHERE k = 1""")
def _(t):
    return mask_conf_threshold(curve(t).select("category", "conf", F.round("mean_iou", 9).alias("mean_iou")), ["category"])
