"""Embedding queries: reference, bank and query vectors by id, category by label."""
from __future__ import annotations

from pyspark.sql import functions as F

from loupeline.operators import vectors as v
from loupeline.operators.frame_store import FrameStore
from loupeline.plans.registry import query
from loupeline.session import scratch

DIM = 64
VEC = "v AS (SELECT vec_id, CAST(label AS BIGINT) AS category, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"
ROLE = "CASE WHEN vec_id % 5 = 0 THEN 'reference' WHEN vec_id % 5 < 3 THEN 'bank' ELSE 'query' END"
PARTS = f"{VEC}, r AS (SELECT *, {ROLE} AS role FROM v)"


def vectors(t):
    return t.embeddings.select("vec_id", F.col("label").cast("bigint").alias("category"), "embedding")


def role(t, name):
    k = F.col("vec_id") % 5
    return vectors(t).filter({"reference": k == 0, "bank": (k == 1) | (k == 2), "query": k >= 3}[name])


@query("nearest_bank", f"""WITH {PARTS} SELECT q.vec_id, q.category, round(min(list_distance(q.e, b.e)), 6) AS distance
FROM r q JOIN r b ON q.category = b.category AND q.role = 'query' AND b.role = 'bank' GROUP BY 1, 2""")
def _(t):
    return v.nearest_bank(role(t, "query"), role(t, "bank")).select("vec_id", "category", F.round("distance", 6).alias("distance"))


@query("nearest_bank_blocked", f"""WITH {PARTS} SELECT q.vec_id, q.category, round(min(list_distance(q.e, b.e)), 6) AS distance
FROM r q JOIN r b ON q.category = b.category AND q.role = 'query' AND b.role = 'bank' GROUP BY 1, 2""")
def _(t):
    hits = v.nearest_bank(role(t, "query"), role(t, "bank"), broadcast_bytes=0, block_rows=128, pivots=8)
    return hits.select("vec_id", "category", F.round("distance", 6).alias("distance"))


RES = f"""{PARTS}, rr AS (SELECT q.vec_id, q.category, q.role, arg_max(x.vec_id, list_cosine_similarity(q.e, x.e)) AS ref_id,
    arg_max(x.e, list_cosine_similarity(q.e, x.e)) AS re, any_value(q.e) AS e FROM r q JOIN r x ON x.category = q.category AND x.role = 'reference'
  GROUP BY 1, 2, 3),
res AS (SELECT vec_id, category, role, ref_id, list_transform(generate_series(1, {DIM}), lambda i: e[i] - re[i]) AS d FROM rr)"""


@query("residual_features", f"""WITH {RES} SELECT vec_id, category, ref_id, round(sqrt(list_dot_product(d, d)), 6) AS residual_norm,
  round(list_sum(d), 6) AS residual_sum FROM res WHERE role = 'query'""")
def _(t):
    out = v.residual_features(role(t, "query"), role(t, "reference"))
    total = F.aggregate("residual", F.lit(0.0), lambda a, x: a + x)
    norm = F.sqrt(F.aggregate("residual", F.lit(0.0), lambda a, x: a + x * x))
    return out.select("vec_id", "category", "ref_id", F.round(norm, 6).alias("residual_norm"), F.round(total, 6).alias("residual_sum"))


@query("bank_score", f"""WITH {RES}, nn AS (SELECT q.vec_id, min(list_distance(q.d, b.d)) AS distance FROM res q JOIN res b ON q.category = b.category
  AND q.role = 'query' AND b.role = 'bank' GROUP BY 1),
k AS (SELECT vec_id // 25 AS image, distance, row_number() OVER (PARTITION BY vec_id // 25 ORDER BY distance DESC) AS rn, count(*) OVER (PARTITION BY vec_id // 25) AS n FROM nn)
SELECT image, round(avg(distance), 6) AS image_score FROM k WHERE rn <= greatest(1, ceil(n * 0.25::DOUBLE)) GROUP BY 1""")
def _(t):
    queries = role(t, "query").withColumn("image", F.floor(F.col("vec_id") / 25))
    scores = v.bank_score(queries, role(t, "bank"), role(t, "reference"), "image", fraction=0.25)
    return scores.select("image", F.round("image_score", 6).alias("image_score"))


@query("global_descriptor", f"""WITH {VEC}, p AS (SELECT vec_id // 16 AS image, i, avg(e[i]) AS m FROM v, generate_series(1, {DIM}) AS g(i) GROUP BY 1, 2)
SELECT image, i - 1 AS dim, round(m / sqrt(sum(m * m) OVER (PARTITION BY image)), 6) AS value FROM p""")
def _(t):
    images = vectors(t).withColumn("image", F.floor(F.col("vec_id") / 16))
    flat = v.global_descriptor(images, ["image"], DIM).select("image", F.posexplode("descriptor").alias("dim", "value"))
    return flat.select("image", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


KCENTER = """cen AS (SELECT category, list(m ORDER BY i) AS c FROM (SELECT category, i, avg(e[i]) AS m FROM v, generate_series(1, 64) AS g(i) GROUP BY 1, 2) GROUP BY 1),
fst AS (SELECT v.category, arg_max(vec_id, list_dot_product(e, c)) AS id, arg_max(e, list_dot_product(e, c)) AS fe FROM v JOIN cen USING (category) GROUP BY 1),
it AS (SELECT 1 AS rank, v.category, v.vec_id, e, id AS pick, 0.0::DOUBLE AS distance, CASE WHEN v.vec_id = id THEN -1 ELSE 1 - list_dot_product(e, fe) END AS gap
    FROM v JOIN fst USING (category)
  UNION ALL SELECT rank + 1, category, vec_id, e, n, g, CASE WHEN gap < 0 OR vec_id = n THEN -1 ELSE least(gap, 1 - list_dot_product(e, ne)) END
    FROM (SELECT *, first_value(vec_id) OVER w AS n, first_value(e) OVER w AS ne, first_value(gap) OVER w AS g FROM it WINDOW w AS (PARTITION BY category ORDER BY gap DESC, vec_id))
    WHERE rank < {k})"""


@query("kcenter_select", f"""WITH RECURSIVE {VEC}, {KCENTER.format(k=6)} SELECT category, rank, pick AS vec_id, round(any_value(distance), 6) AS distance FROM it GROUP BY 1, 2, 3""")
def _(t):
    return v.kcenter_select(vectors(t), 6, DIM).select("category", "rank", "vec_id", F.round("distance", 6).alias("distance"))


@query("coreset_fraction")
def _(t):
    return v.coreset_fraction(vectors(t), 0.02)


@query("bank_build", f"""WITH RECURSIVE v0 AS (SELECT vec_id, CAST(label AS BIGINT) AS category, CAST(embedding AS DOUBLE[]) AS e,
    sha256(list_aggregate(list_transform(embedding, lambda x: CAST(CAST(round(CAST(x AS DOUBLE) * 1e6::DOUBLE) AS BIGINT) AS VARCHAR)), 'string_agg', ',')) AS sha256 FROM embeddings),
d AS (SELECT *, row_number() OVER (PARTITION BY category, sha256 ORDER BY vec_id DESC) AS rn FROM v0), v AS (SELECT category, vec_id, e FROM d WHERE rn = 1),
{KCENTER.format(k=4)}
SELECT v.category, count(*) AS content, count(*) FILTER (vec_id NOT IN (SELECT pick FROM it)) AS bank FROM v GROUP BY 1""")
def _(t):
    parts = v.bank_build(vectors(t), 4, DIM)
    bank = parts["bank"].groupBy("category").agg(F.count(F.lit(1)).alias("bank"))
    return parts["content"].groupBy("category").agg(F.count(F.lit(1)).alias("content")).join(bank, "category")


@query("score_reuse", f"""WITH {PARTS}, hit AS (SELECT q.vec_id, q.category, b.vec_id AS bank_id, list_distance(q.e, b.e) AS d FROM r q JOIN r b ON q.category = b.category AND q.role = 'query' AND b.role = 'bank'),
one AS (SELECT vec_id, category, round(min(d), 6) AS first FROM hit GROUP BY 1, 2), two AS (SELECT vec_id, round(min(d), 6) AS second FROM hit WHERE category <> 1 OR bank_id % 10 <> 1 GROUP BY 1)
SELECT vec_id, category, first, second, category = 1 AS recomputed FROM one LEFT JOIN two USING (vec_id)""")
def _(t):
    """Scores of all categories, then again after one category's bank has lost vectors: only that category is computed anew."""
    store, queries, bank = FrameStore(t.spark, scratch(t.spark, "scores")), role(t, "query"), role(t, "bank")
    first = v.stored_scores(store, queries, bank)
    done = len(store.computed)
    second = v.stored_scores(store, queries, bank.filter("category <> 1 or vec_id % 10 <> 1"))
    anew = t.spark.createDataFrame([(int(group),) for _, group in store.computed[done:]], "category bigint").withColumn("recomputed", F.lit(True))
    both = first.select("vec_id", "category", F.round("distance", 6).alias("first")).join(second.select("vec_id", F.round("distance", 6).alias("second")), "vec_id", "left")
    return both.join(anew, "category", "left").select("vec_id", "category", "first", "second", F.coalesce("recomputed", F.lit(False)).alias("recomputed"))


@query("coreset_radius", f"""WITH {VEC} SELECT category, count(*) AS members, CAST(ceil(count(*) * 0.02::DOUBLE) AS BIGINT) AS picks, true AS covered FROM v GROUP BY 1""")
def _(t):
    """Size of every coreset, and whether each vector is as near to a pick of its shard as the shard's stated radius says."""
    picked = v.coreset_fraction(vectors(t), 0.02, with_radius=True)
    return v.coreset_cover(vectors(t), picked).select("category", "members", "picks", "covered")
