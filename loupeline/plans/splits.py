"""Split, role, quota and content-set queries on documents, benchmark, labels and events."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.functions.decisions import unit_hash
from loupeline.operators import sets as g
from loupeline.operators import splits as s
from loupeline.operators.ordering import seeded
from loupeline.plans.registry import query
from loupeline.sources import bindings as b

UNIT = "CAST(concat('0x', substr(sha256({token}), 1, 16)) AS UBIGINT)::DOUBLE / 18446744073709551616::DOUBLE"


def unit_sql(token):
    return UNIT.format(token=token)


SPLIT_TOKEN = "concat_ws(':', '{seed}', category, sha256)"
TAGGED = f"""{b.CONTENTS}, tag AS (SELECT *, CAST(sample_id % 3 AS BIGINT) AS split_ord,
  CASE sample_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split,
  concat(batch_id, '/', sample_id) AS path, coalesce(truth, 'OK') AS label FROM con)"""


def tagged(t):
    rows = b.contents(t)
    order = F.col("sample_id") % 3
    return rows.withColumns({
        "split_ord": order, "split": F.when(order == 0, "train").when(order == 1, "val").otherwise("test"),
        "path": F.concat_ws("/", "batch_id", F.col("sample_id").cast("string")), "label": F.coalesce("truth", F.lit("OK"))})


ROLE_CASES = (("reference", 0.1), ("calibration", 0.3), ("bank", 0.5))
ROLES = f"""{b.CONTENTS}, u AS (SELECT *, {unit_sql("concat_ws(':', '42', sample_id)")} AS share FROM con),
roles AS (SELECT sample_id, category, sha256, truth, CASE WHEN share < 0.1::DOUBLE THEN 'reference' WHEN share < 0.3::DOUBLE THEN 'calibration'
  WHEN share < 0.5::DOUBLE THEN 'bank' ELSE 'stream' END AS role FROM u)"""


def roles(t):
    share, role = unit_hash(seeded(42, F.col("sample_id"))), None
    for name, limit in ROLE_CASES:
        role = F.when(share < F.lit(limit), name) if role is None else role.when(share < F.lit(limit), name)
    return b.contents(t).select("sample_id", "category", "sha256", "truth", role.otherwise("stream").alias("role"))


def heldout(t):
    return t.benchmark.select(F.sha2("text", 256).alias("sha256"))


@query("content_digest", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def _(t):
    return t.documents.select("doc_id", g.content_digest("text").alias("sha256"))


CANON = "lower(regexp_replace(trim({0}), '\\s+', ' ', 'g'))"
PIXELS = "sha256(concat_ws(':', length({0}), {0}))".format(CANON.format("text"))


@query("pixel_digest", f"SELECT doc_id, {PIXELS} AS pixel_sha256 FROM documents")
def _(t):
    return t.documents.select("doc_id", g.pixel_digest("text").alias("pixel_sha256"))


@query("hash_split", f"""WITH {b.CONTENTS} SELECT sample_id, category, CASE WHEN {unit_sql(SPLIT_TOKEN.format(seed=42))} < 0.25::DOUBLE
  THEN 'calibration' ELSE 'train' END AS split FROM con""")
def _(t):
    return s.hash_split(b.contents(t)).select("sample_id", "category", "split")


@query("sticky_split", f"""WITH {b.CONTENTS}, a AS (SELECT sample_id, category, truth,
  CASE WHEN {unit_sql(SPLIT_TOKEN.format(seed=7))} < 0.5::DOUBLE THEN 'calibration' ELSE 'train' END AS old,
  CASE WHEN {unit_sql(SPLIT_TOKEN.format(seed=42))} < 0.25::DOUBLE THEN 'calibration' ELSE 'train' END AS new FROM con)
SELECT sample_id, category, CASE WHEN truth IS NOT NULL THEN old ELSE new END AS split, truth IS NULL AS is_new FROM a""")
def _(t):
    rows = b.contents(t)
    existing = s.hash_split(rows.filter("truth IS NOT NULL"), 0.5, 7).select("sample_id", "split")
    return s.sticky_split(rows, existing).select("sample_id", "category", "split", "is_new")


@query("dedup_content", f"""WITH {TAGGED}, k AS (SELECT *, row_number() OVER (PARTITION BY category, sha256 ORDER BY split_ord, path) AS n FROM tag)
SELECT category, sha256, split_ord, path, sample_id, split FROM k WHERE n = 1""")
def _(t):
    rows = tagged(t).select("category", "sha256", "split_ord", "path", "sample_id", "split")
    return s.dedup_content(rows, ["category", "sha256"], ["split_ord", "path"])


@query("except_test", f"""WITH {TAGGED} SELECT sample_id, category, sha256, split FROM tag WHERE split <> 'test'
  AND sha256 NOT IN (SELECT sha256 FROM tag WHERE split = 'test')""")
def _(t):
    rows = tagged(t).select("sample_id", "category", "sha256", "split")
    return g.except_content(rows.filter("split <> 'test'"), rows.filter("split = 'test'"))


RESERVE = (32, 100, 50, 60)


@query("bank_shrink", f"""WITH {TAGGED}, c AS (SELECT category, count(DISTINCT sha256) AS ok FROM tag WHERE label = 'OK' GROUP BY 1)
SELECT category, ok, least(50, greatest(0, ok - 32 - 100 - 60)) AS bank_count,
  ok >= 32 + 100 + least(50, greatest(0, ok - 32 - 100 - 60)) + 60 AS enough FROM c""")
def _(t):
    counts = tagged(t).filter("label = 'OK'").groupBy("category").agg(F.countDistinct("sha256").alias("ok"))
    return s.bank_shrink(counts, *RESERVE)


ROLE_PLAN = f"""{TAGGED}, d AS (SELECT *, row_number() OVER (PARTITION BY category, sha256 ORDER BY split_ord, path) AS n FROM tag WHERE label = 'OK'),
hr AS (SELECT sample_id, category, sha256, row_number() OVER (PARTITION BY category ORDER BY sha256(concat_ws(':', '42', category, sha256))) AS r,
  count(*) OVER (PARTITION BY category) AS ok FROM d WHERE n = 1),
bk AS (SELECT *, least(50, greatest(0, ok - 192)) AS bank FROM hr),
reserved AS (SELECT sample_id, category, sha256, CASE WHEN ok < 192 + bank THEN 'insufficient_ok' WHEN r <= 32 THEN 'reference'
  WHEN r <= 132 THEN 'calibration' WHEN r <= 132 + bank THEN 'bank' ELSE 'stream' END AS role FROM bk)"""


def reserved(t):
    ok = tagged(t).filter("label = 'OK'").select("category", "sha256", "split_ord", "path", "sample_id")
    first = s.dedup_content(ok, ["category", "sha256"], ["split_ord", "path"])
    return s.reserve_roles(first, "category", seeded(42, F.col("category"), F.col("sha256")), *RESERVE)


@query("reserve_roles", f"WITH {ROLE_PLAN} SELECT sample_id, category, role FROM reserved")
def _(t):
    return reserved(t).select("sample_id", "category", "role")


@query("init_manifest", f"""WITH {ROLE_PLAN}, ng AS (SELECT category, count(DISTINCT sha256) AS available_ng FROM tag WHERE label = 'NG' GROUP BY 1),
o AS (SELECT category, count(*) FILTER (role = 'stream') AS ok, count(*) FILTER (role = 'reference') AS reference_ok,
  count(*) FILTER (role = 'calibration') AS calibration_ok, count(*) FILTER (role = 'bank') AS bank_ok FROM reserved GROUP BY 1)
SELECT o.*, coalesce(available_ng, 0) AS available_ng,
  coalesce(available_ng, 0)::DOUBLE / nullif(ok + coalesce(available_ng, 0), 0) AS actual_ng_ratio FROM o LEFT JOIN ng USING (category)""")
def _(t):
    def n(role):
        return F.count_if(F.col("role") == role)

    counts = reserved(t).groupBy("category").agg(n("stream").alias("ok"), n("reference").alias("reference_ok"),
                                                 n("calibration").alias("calibration_ok"), n("bank").alias("bank_ok"))
    ng = tagged(t).filter("label = 'NG'").groupBy("category").agg(F.countDistinct("sha256").alias("available_ng"))
    both = counts.join(ng, "category", "left").withColumn("available_ng", F.coalesce("available_ng", F.lit(0).cast("bigint")))
    return both.withColumn("actual_ng_ratio", F.try_divide(F.col("available_ng").cast("double"),
                                                           (F.col("ok") + F.col("available_ng")).cast("double")))


@query("ratio_downsample", f"""WITH {b.DECISIONS}, n AS (SELECT category, count(*) FILTER (truth = 'OK') AS ok, count(*) FILTER (truth = 'NG') AS ng FROM dec GROUP BY 1),
h AS (SELECT sample_id, category, row_number() OVER (PARTITION BY category ORDER BY sha256(concat_ws(':', '42', category, sample_id))) AS r FROM dec WHERE truth = 'NG')
SELECT sample_id, category, 'OK' AS truth FROM dec WHERE truth = 'OK' UNION ALL
SELECT h.sample_id, h.category, 'NG' FROM h JOIN n USING (category) WHERE r <= least(round_even(ok * 0.1::DOUBLE / (1.0::DOUBLE - 0.1::DOUBLE), 0), ng)""")
def _(t):
    rows = b.decisions(t).select("sample_id", "category", "truth")
    return s.ratio_downsample(rows, "category", "truth", seeded(42, F.col("category"), F.col("sample_id")), 0.1)


@query("capped_split", f"""WITH {b.DECISIONS}, h AS (SELECT sample_id, category, truth, row_number() OVER (PARTITION BY category, truth
  ORDER BY sha256(concat_ws(':', '42', sample_id))) AS r FROM dec)
SELECT sample_id, category, truth FROM h WHERE truth = 'NG' OR r <= 400""")
def _(t):
    rows = b.decisions(t).select("sample_id", "category", "truth")
    return s.capped_split(rows, "category", "truth", seeded(42, F.col("sample_id")), 400)


@query("nested_prefix_cohorts", f"""WITH {b.DECISIONS}, h AS (SELECT sample_id, category, row_number() OVER (PARTITION BY category
    ORDER BY sha256(concat_ws(':', '42', sample_id))) AS rank, count(*) OVER (PARTITION BY category) AS pool FROM dec WHERE truth = 'NG'),
sizes AS (SELECT DISTINCT category, n AS ng_count FROM (SELECT DISTINCT category, pool FROM h) c, (VALUES (40), (60), (70), (80)) v(n) WHERE n <= pool
  UNION SELECT DISTINCT category, pool FROM h)
SELECT h.sample_id, h.category, h.rank, sizes.ng_count FROM h JOIN sizes ON sizes.category = h.category AND h.rank <= sizes.ng_count""")
def _(t):
    ng = b.decisions(t).filter("truth = 'NG'").select("sample_id", "category")
    return s.nested_prefix_cohorts(ng, "category", seeded(42, F.col("sample_id")), (40, 60, 70, 80))


@query("split_preflight", f"""WITH {TAGGED}, c AS (SELECT category, {", ".join(
    f"count(*) FILTER (split = '{x}' AND label = '{y}') AS {x}_{y.lower()}" for x in ("train", "val", "test") for y in ("OK", "NG"))}
  FROM tag GROUP BY 1)
SELECT *, concat_ws(',', CASE WHEN train_ok < 100 THEN 'train_ok' END, CASE WHEN train_ng < 40 THEN 'train_ng' END,
  CASE WHEN val_ok < 80 THEN 'val_ok' END, CASE WHEN val_ng < 30 THEN 'val_ng' END, CASE WHEN test_ok = 0 THEN 'test_ok' END,
  CASE WHEN test_ng = 0 THEN 'test_ng' END) AS violations FROM c""")
def _(t):
    return g.split_preflight(tagged(t))


@query("role_overlap", f"""WITH {ROLES}, a AS (SELECT sha256, role FROM roles UNION ALL SELECT sha256(text), 'test' FROM benchmark)
SELECT sha256, string_agg(DISTINCT role, ',' ORDER BY role) AS roles FROM a GROUP BY 1 HAVING count(DISTINCT role) > 1""")
def _(t):
    return g.role_overlap(roles(t).select("sha256", "role").unionByName(heldout(t).withColumn("role", F.lit("test"))))


@query("heldout_overlap", f"""WITH {ROLES} SELECT sample_id, category, sha256 FROM roles WHERE role IN ('bank', 'stream')
  AND (sha256 IN (SELECT sha256 FROM roles WHERE role IN ('reference', 'calibration')) OR sha256 IN (SELECT sha256(text) FROM benchmark))""")
def _(t):
    rows = roles(t)
    forbidden = g.forbidden_set(rows.filter("role IN ('reference', 'calibration')"), heldout(t))
    return g.heldout_overlap(rows.filter("role IN ('bank', 'stream')"), forbidden).select("sample_id", "category", "sha256")


@query("forbidden_set", f"""WITH {ROLES} SELECT sha256 FROM roles WHERE role IN ('reference', 'calibration') OR truth = 'NG'
  UNION SELECT sha256(text) FROM benchmark""")
def _(t):
    rows = roles(t)
    return g.forbidden_set(rows.filter("role = 'reference'"), rows.filter("role = 'calibration'"),
                           rows.filter("truth = 'NG'"), heldout(t))


@query("union_training_ok", f"""WITH {ROLES}, tr AS (
  SELECT sample_id, category, sha256, 'bank' AS origin FROM roles WHERE role = 'bank' UNION ALL
  SELECT sample_id, category, sha256, 'confirmed' FROM roles WHERE role = 'stream' AND truth = 'OK' UNION ALL
  SELECT sample_id, category, sha256, 'pseudo' FROM roles WHERE role = 'stream' AND truth IS NULL)
SELECT * FROM tr WHERE sha256 NOT IN (SELECT sha256 FROM roles WHERE role = 'calibration')""")
def _(t):
    rows = roles(t)
    part = rows.select("sample_id", "category", "sha256", "role", "truth")
    pick = lambda condition: part.filter(condition).drop("role", "truth")
    return g.union_training_ok(pick("role = 'bank'"), pick("role = 'stream' AND truth = 'OK'"),
                               pick("role = 'stream' AND truth IS NULL"), rows.filter("role = 'calibration'"))


@query("support_still_available", f"""WITH {ROLES}, av AS (SELECT DISTINCT category, sha256 FROM roles WHERE role = 'stream')
SELECT category, count(*) AS support, count(*) FILTER (NOT k) AS missing, count(*) FILTER (NOT k) = 0 AS available
FROM (SELECT r.category, (r.category, r.sha256) IN (SELECT (category, sha256) FROM av) AS k FROM roles r WHERE truth = 'OK') GROUP BY 1""")
def _(t):
    rows = roles(t)
    return g.support_still_available(rows.filter("truth = 'OK'"), rows.filter("role = 'stream'"))


@query("unseen_samples", f"""WITH {b.ARRIVALS} SELECT sample_id, category, sha256 FROM arr a WHERE batch_no > 15
  AND NOT EXISTS (SELECT 1 FROM arr s WHERE s.batch_no <= 15 AND s.category = a.category AND s.sha256 = a.sha256)""")
def _(t):
    rows = b.arrivals(t)
    return g.except_content(rows.filter("batch_no > 15"), rows.filter("batch_no <= 15"),
                            ["category", "sha256"]).select("sample_id", "category", "sha256")


@query("generation_due", f"""WITH {b.DECISIONS}, x AS (SELECT category, sha256(CAST(sample_id AS VARCHAR)) AS sha256, batch_no FROM dec WHERE truth = 'NG')
SELECT c.category, count(*) FILTER (batch_no > 20) AS new_real_ng, max(e.event_count) AS event_count,
  (max(e.event_count) = 0 OR count(*) FILTER (batch_no > 20) >= 20) AND max(e.event_count) < 8 AS due
FROM x c JOIN (SELECT category, count(DISTINCT batch_no // 4) AS event_count FROM dec WHERE batch_no <= 20 GROUP BY 1) e USING (category) GROUP BY 1""")
def _(t):
    rows = b.decisions(t)
    ng = rows.filter("truth = 'NG'").withColumn("sha256", F.sha2(F.col("sample_id").cast("string"), 256))
    events = rows.filter("batch_no <= 20").groupBy("category").agg(F.countDistinct(F.floor(F.col("batch_no") / 4)).alias("event_count"))
    return g.generation_due(ng, ng.filter("batch_no <= 20"), events)


GENERATED = """gen AS (SELECT doc_id AS item_id, sha256(text) AS image_sha256,
  CASE doc_id % 4 WHEN 0 THEN 'human_approved' WHEN 1 THEN 'structurally_valid_unreviewed' WHEN 2 THEN 'human_approved' ELSE 'rejected' END AS selection_status,
  CASE doc_id % 4 WHEN 0 THEN true WHEN 2 THEN NULL ELSE false END AS approved, doc_id % 41 <> 0 AS request_ok,
  doc_id % 43 <> 0 AS checksum_ok, doc_id % 47 <> 0 AS mask_binary, CASE WHEN doc_id % 37 = 0 THEN 16 ELSE 8 END AS image_width, 64 AS mask_pixels, least(64, n_chars % 80) AS white_pixels FROM documents)"""


@query("generated_gate", f"""WITH {GENERATED}, el AS (SELECT *, coalesce(approved, false) AND selection_status = 'human_approved' AS human_approved FROM gen),
ok AS (SELECT *, min(item_id) OVER (PARTITION BY image_sha256) AS first FROM el WHERE human_approved OR selection_status = 'structurally_valid_unreviewed'),
ban AS (SELECT sha256(text) AS sha256 FROM benchmark UNION SELECT sha256(text) FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT item_id, human_approved, concat_ws(',', CASE WHEN NOT request_ok THEN 'request_mismatch' END, CASE WHEN NOT checksum_ok THEN 'checksum' END,
  CASE WHEN image_sha256 IN (SELECT sha256 FROM ban) THEN 'forbidden' END, CASE WHEN item_id > first THEN 'duplicate' END,
  CASE WHEN image_width <> 8 THEN 'size_mismatch' END, CASE WHEN NOT mask_binary THEN 'mask_not_binary' END, CASE WHEN white_pixels = 0 THEN 'mask_empty' END,
  CASE WHEN white_pixels >= mask_pixels THEN 'mask_full' END) AS violations FROM ok""")
def _(t):
    k = F.col("doc_id")
    items = t.documents.select(
        k.alias("item_id"), F.sha2("text", 256).alias("image_sha256"),
        F.when(k % 4 == 1, "structurally_valid_unreviewed").when(k % 4 == 3, "rejected").otherwise("human_approved").alias("selection_status"),
        F.when(k % 4 == 0, True).when(k % 4 == 2, F.lit(None)).otherwise(False).alias("approved"),
        (k % 41 != 0).alias("request_ok"), (k % 43 != 0).alias("checksum_ok"), (k % 47 != 0).alias("mask_binary"),
        F.lit(8).alias("image_height"), F.when(k % 37 == 0, 16).otherwise(8).alias("image_width"), F.lit(8).alias("mask_height"), F.lit(8).alias("mask_width"), F.least(F.lit(64).cast("bigint"), F.col("n_chars") % 80).alias("white_pixels"))
    toxic = b.contents(t).filter("truth = 'NG'")
    return g.generated_gate(items, g.forbidden_set(heldout(t), toxic), True)


@query("pixel_dedup", f"""WITH px AS (SELECT doc_id AS item_id, lang, {PIXELS} AS pixel_sha256 FROM documents),
seen AS (SELECT pixel_sha256 FROM px JOIN labels ON labels.doc_id = px.item_id UNION SELECT {PIXELS} FROM benchmark)
SELECT pixel_sha256, min(item_id) AS item_id, arg_min(lang, item_id) AS lang FROM px
WHERE pixel_sha256 NOT IN (SELECT pixel_sha256 FROM seen) GROUP BY 1""")
def _(t):
    items = t.documents.select(F.col("doc_id").alias("item_id"), "lang", g.pixel_digest("text").alias("pixel_sha256"))
    known = items.join(t.labels.select(F.col("doc_id").alias("item_id")), "item_id", "left_semi").select("pixel_sha256")
    seen = known.unionByName(t.benchmark.select(g.pixel_digest("text").alias("pixel_sha256")))
    return g.pixel_dedup(items, seen)


@query("synthetic_quota", f"""WITH {b.DECISIONS}, c AS (SELECT category, batch_no, count(*) FILTER (truth = 'NG') AS real_ng, count(*) FILTER (truth = 'OK') AS train_ok
  FROM dec WHERE label_source IN ('human_review', 'folder_ground_truth') GROUP BY 1, 2),
d AS (SELECT *, real_ng + train_ok AS total, 1.0::DOUBLE - real_ng / (real_ng + train_ok)::DOUBLE - 0.02::DOUBLE AS room FROM c)
SELECT category, batch_no, real_ng, train_ok, CAST(CASE WHEN real_ng > 0 THEN greatest(0, floor(least(20.0::DOUBLE, 0.1::DOUBLE * real_ng,
  0.03::DOUBLE * total / (1.0::DOUBLE - 0.03::DOUBLE), CASE WHEN room > 0 THEN 0.02::DOUBLE * total / room END) + 1e-10::DOUBLE)) ELSE 0 END AS BIGINT) AS budget FROM d""")
def _(t):
    verified = b.decisions(t).filter("label_source IN ('human_review', 'folder_ground_truth')")
    counts = verified.groupBy("category", "batch_no").agg(F.count_if(F.col("truth") == "NG").alias("real_ng"),
                                                          F.count_if(F.col("truth") == "OK").alias("train_ok"))
    return s.synthetic_quota(counts)
