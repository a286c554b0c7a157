"""Domain tables bound to the given tables, each with the SQL that states the same view.

The given data has no images. Scores, decisions and labels come from ``orders``, ``lineitem`` and ``events``;
contents from ``documents`` and ``benchmark``; masks are rectangles whose corners are arithmetic on order and
line keys, so that mask work grows with those tables.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loupeline.functions.decisions import decide

IMAGE_WIDTH, IMAGE_HEIGHT = 96, 64
THRESHOLDS = {"default": 250000.0, "1-URGENT": 300000.0, "5-LOW": 200000.0}


def threshold_of(category: Column) -> Column:
    out = None
    for key, value in THRESHOLDS.items():
        if key != "default":
            out = F.when(category == key, F.lit(value)) if out is None else out.when(category == key, F.lit(value))
    return out.otherwise(F.lit(THRESHOLDS["default"]))


def decisions(t) -> DataFrame:
    """One row per inspected sample: official and shadow score, hidden truth, label source, review batch."""
    o, key = t.orders, F.col("o_orderkey")
    source = (F.when(key % 10 < 5, "human_review").when(key % 10 < 7, "folder_ground_truth")
               .when(key % 10 == 7, "model_assumed_review").when(key % 10 == 8, "sampling_pseudo_ok")
               .when(key % 20 == 9, "initial_calibration_yolo_train_ok"))
    base = o.select(
        key.alias("sample_id"), F.col("o_orderpriority").alias("category"),
        ((F.year("o_orderdate") - 1995) * 4 + F.quarter("o_orderdate")).cast("bigint").alias("batch_no"),
        F.col("o_custkey").alias("camera_id"), F.col("o_orderdate").alias("created_at"),
        F.col("o_totalprice").alias("score"),
        ((F.col("o_totalprice") + (F.col("o_custkey") * 7919 % 500000)) / 2).alias("shadow_score"),
        F.when(F.col("o_orderstatus") == "F", "NG").otherwise("OK").alias("truth"),
        source.alias("label_source"), ((key * 13 % 400) / F.lit(10.0)).alias("latency_ms"))
    threshold = threshold_of(F.col("category"))
    return base.withColumns({"threshold": threshold, "official": decide("score", threshold),
                             "shadow": decide("shadow_score", threshold)})


DECISIONS = """dec0 AS (
  SELECT o_orderkey AS sample_id, o_orderpriority AS category,
    CAST((year(o_orderdate) - 1995) * 4 + quarter(o_orderdate) AS BIGINT) AS batch_no,
    o_custkey AS camera_id, o_orderdate AS created_at, o_totalprice AS score,
    (o_totalprice + ((o_custkey * 7919) % 500000)) / 2 AS shadow_score,
    CASE WHEN o_orderstatus = 'F' THEN 'NG' ELSE 'OK' END AS truth,
    CASE WHEN o_orderkey % 10 < 5 THEN 'human_review' WHEN o_orderkey % 10 < 7 THEN 'folder_ground_truth'
         WHEN o_orderkey % 10 = 7 THEN 'model_assumed_review' WHEN o_orderkey % 10 = 8 THEN 'sampling_pseudo_ok'
         WHEN o_orderkey % 20 = 9 THEN 'initial_calibration_yolo_train_ok' END AS label_source,
    ((o_orderkey * 13) % 400) / 10.0::DOUBLE AS latency_ms,
    CASE o_orderpriority WHEN '1-URGENT' THEN 300000.0::DOUBLE WHEN '5-LOW' THEN 200000.0::DOUBLE
         ELSE 250000.0::DOUBLE END AS threshold
  FROM orders),
dec AS (SELECT *, CASE WHEN score >= threshold THEN 'NG' ELSE 'OK' END AS official,
          CASE WHEN shadow_score >= threshold THEN 'NG' ELSE 'OK' END AS shadow FROM dec0)"""


def line_scores(t) -> DataFrame:
    """Large score table: one row per line item."""
    return t.lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("sample_id"),
        F.col("l_linenumber").cast("bigint").alias("category"),
        ((F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")).cast("bigint").alias("batch_no"),
        F.col("l_extendedprice").alias("score"), F.col("l_discount").alias("tied_score"),
        (F.col("l_returnflag") == "R").alias("is_ng"))


LINES = """lines AS (
  SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS sample_id,
    CAST(l_linenumber AS BIGINT) AS category,
    CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS BIGINT) AS batch_no,
    l_extendedprice AS score, l_discount AS tied_score, l_returnflag = 'R' AS is_ng
  FROM lineitem)"""


def arrivals(t) -> DataFrame:
    """Stream of inspected samples from ``events``; content repeats because few distinct values exist."""
    return t.events.select(
        F.col("event_id").alias("sample_id"), F.col("event_type").alias("category"),
        F.col("user_id").alias("camera_id"), F.col("value").alias("score"), F.col("ts").alias("created_at"),
        F.dayofmonth("ts").cast("bigint").alias("batch_no"),
        F.sha2(F.concat_ws(":", F.col("user_id").cast("string"), F.col("props")), 256).alias("sha256"))


ARRIVALS = """arr AS (
  SELECT event_id AS sample_id, event_type AS category, user_id AS camera_id, value AS score, ts AS created_at,
    CAST(dayofmonth(ts) AS BIGINT) AS batch_no,
    sha256(concat_ws(':', CAST(user_id AS VARCHAR), props)) AS sha256
  FROM events)"""


def contents(t) -> DataFrame:
    """Content table: one row per document, whole text hashed, label where one exists."""
    docs = t.documents.select(
        F.col("doc_id").alias("sample_id"), F.col("lang").alias("category"), F.col("source").alias("batch_id"),
        F.sha2("text", 256).alias("sha256"), F.col("n_chars"))
    return docs.join(t.labels.select(F.col("doc_id").alias("sample_id"),
                                     F.when(F.col("toxic") == 1, "NG").otherwise("OK").alias("truth")),
                     "sample_id", "left")


CONTENTS = """con AS (
  SELECT d.doc_id AS sample_id, d.lang AS category, d.source AS batch_id, sha256(d.text) AS sha256, d.n_chars,
    CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN 'NG' ELSE 'OK' END AS truth
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


def gt_stacks(t) -> DataFrame:
    """Ground truth: two rectangles per NG order, each a run on the rows y..y1."""
    k = F.col("o_orderkey")

    def rect(x0, y0, w, h):
        return F.struct(x0.cast("int").alias("x0"), y0.cast("int").alias("y0"), (x0 + w - 1).cast("int").alias("x1"),
                        (y0 + h - 1).cast("int").alias("y1"))

    rects = F.array(rect(k * 37 % 70, k * 11 % 44, 4 + k % 11, 3 + k % 7), rect(k * 53 % 80, k * 29 % 54, 2 + k % 5, 2 + k % 4))
    ng = t.orders.filter("o_orderstatus = 'F'").select(k.alias("sample_id"), F.col("o_orderpriority").alias("category"),
                                                       F.inline(rects))
    return ng.select("sample_id", "category", F.col("y0").alias("y"), "y1", "x0", "x1")


def gt_runs(t) -> DataFrame:
    """Ground-truth runs, a row for every image row."""
    return gt_stacks(t).select("sample_id", "category", F.explode(F.sequence("y", "y1")).alias("y"), "x0", "x1")


GT_RECTS = """gtr AS (
  SELECT o_orderkey AS sample_id, o_orderpriority AS category, (o_orderkey * 37) % 70 AS x0, (o_orderkey * 11) % 44 AS y0,
    (o_orderkey * 37) % 70 + 3 + o_orderkey % 11 AS x1, (o_orderkey * 11) % 44 + 2 + o_orderkey % 7 AS y1
  FROM orders WHERE o_orderstatus = 'F' UNION ALL
  SELECT o_orderkey, o_orderpriority, (o_orderkey * 53) % 80, (o_orderkey * 29) % 54,
    (o_orderkey * 53) % 80 + 1 + o_orderkey % 5, (o_orderkey * 29) % 54 + 1 + o_orderkey % 4
  FROM orders WHERE o_orderstatus = 'F')"""


def instance_scores(t) -> DataFrame:
    """Confidence of every detected instance, without its place."""
    return t.lineitem.select(F.col("l_orderkey").alias("sample_id"), _conf().alias("conf"))


def _conf() -> Column:
    return ((F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 101) % 1000).cast("double") / F.lit(1000.0)


def instance_rects(t, only_ng: bool = False) -> DataFrame:
    """One detected instance per line item, near the order's first defect, with a confidence."""
    k, p, s, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    x0 = F.greatest(F.lit(0), k * 37 % 70 + p % 9 - 4).cast("int")
    y0 = F.greatest(F.lit(0), k * 11 % 44 + s % 7 - 3).cast("int")
    inst = F.concat_ws("-", p.cast("string"), s.cast("string"), n.cast("string"), F.col("l_quantity").cast("int").cast("string"))
    rects = t.lineitem.select(k.alias("sample_id"), inst.alias("inst"), _conf().alias("conf"), x0.alias("x0"), y0.alias("y0"),
                              (x0 + 2 + (p % 12)).cast("int").alias("x1"), (y0 + 1 + n).cast("int").alias("y1"))
    orders = t.orders.filter("o_orderstatus = 'F'") if only_ng else t.orders
    category = orders.select(F.col("o_orderkey").alias("sample_id"), F.col("o_orderpriority").alias("category"))
    return rects.join(category, "sample_id")


def instance_stacks(t, only_ng: bool = False) -> DataFrame:
    """Instances as runs on the rows y..y1."""
    return instance_rects(t, only_ng).select("sample_id", "category", "inst", "conf", F.col("y0").alias("y"), "y1", "x0", "x1")


def instance_runs(t, only_ng: bool = False) -> DataFrame:
    return instance_rects(t, only_ng).select("sample_id", "category", "inst", "conf", F.explode(F.sequence("y0", "y1")).alias("y"),
                                    "x0", "x1")


INSTANCES = """ins0 AS (
  SELECT l_orderkey AS sample_id, o_orderpriority AS category,
    concat_ws('-', l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT)) AS inst,
    ((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 101) % 1000)::DOUBLE / 1000.0::DOUBLE AS conf,
    greatest(0, (l_orderkey * 37) % 70 + l_partkey % 9 - 4) AS x0, greatest(0, (l_orderkey * 11) % 44 + l_suppkey % 7 - 3) AS y0,
    l_partkey % 12 AS w, l_linenumber AS h
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
ins AS (SELECT sample_id, category, inst, conf, x0, y0, x0 + 2 + w AS x1, y0 + 1 + h AS y1 FROM ins0)"""

# One ROI rectangle per category (x from, y from, x to, y to); a category left out is inspected in full.
ROI_RECTS = {"1-URGENT": (10, 3, 80, 58), "3-MEDIUM": (30, 3, 80, 58), "4-NOT SPECIFIED": (40, 3, 80, 58), "5-LOW": (50, 3, 80, 58)}


def roi_runs(t) -> DataFrame:
    frame = t.spark.createDataFrame([(c, *r) for c, r in ROI_RECTS.items()], "category string, x0 int, y0 int, x1 int, y1 int")
    return frame.select("category", F.explode(F.sequence("y0", "y1")).alias("y"), "x0", "x1")


ROI = "roi(category, rx0, ry0, rx1, ry1) AS (VALUES " + ", ".join(
    f"('{c}', {', '.join(map(str, r))})" for c, r in ROI_RECTS.items()) + ")"


def clipped_sql(source: str, name: str) -> str:
    """Rectangles of ``source`` cut to the ROI, where there is one."""
    return f"""{name} AS (SELECT * FROM (SELECT s.* EXCLUDE (x0, y0, x1, y1), greatest(x0, coalesce(rx0, x0)) AS x0,
    greatest(y0, coalesce(ry0, y0)) AS y0, least(x1, coalesce(rx1, x1)) AS x1, least(y1, coalesce(ry1, y1)) AS y1
  FROM {source} s LEFT JOIN roi ON roi.category = s.category) WHERE x0 <= x1 AND y0 <= y1)"""


def pixels_sql(rects: str, name: str, where: str = "true") -> str:
    return f"""{name} AS (SELECT DISTINCT sample_id, category, y, x FROM (SELECT sample_id, category, x0, x1,
    unnest(generate_series(y0, y1)) AS y FROM {rects} WHERE {where}) r, generate_series(r.x0, r.x1) AS g(x))"""
