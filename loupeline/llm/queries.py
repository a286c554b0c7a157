"""The operators bound to the given tables with production parameters, and SQL where SQL can express one."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from loupeline.llm import centroids, decontamination, html_text, language, neighbours, ngram_join, packing, quality, simhash, substring_dedup, url_filter, variants, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build
    return wrap


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


# Override rules, and the sites the list blocks.
URL_RULES = (url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"), url_filter.Rule("block", "example.org", "/en/1"),
             url_filter.Rule("allow", "com", "/fr/"), url_filter.Rule("block", "com", "/de/"))
BLOCKED_SITES = tuple(f"{name}.example.{top}" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
                      for top in ("com", "net", "org"))


def _url_sql() -> str:
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in URL_RULES]
    best = sorted(zip(URL_RULES, fits), key=lambda x: -len(x[0].text))
    rule = " ".join(f"WHEN {fit} THEN '{r.text}'" for r, fit in best)
    verdict = " ".join(f"WHEN {fit} THEN '{r.verdict}'" for r, fit in best)
    listed = " OR ".join(f"host = '{site}' OR ends_with(host, '.{site}')" for site in BLOCKED_SITES)
    return f"""WITH rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host,
          regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest)
SELECT page_id, host, path, CASE {rule} END AS rule, ({listed}) AS listed,
       CASE {verdict} WHEN {listed} THEN 'block' ELSE 'allow' END AS verdict FROM parts"""


@query("op1_url_filter", _url_sql())
def op1(spark: SparkSession, folder: str) -> DataFrame:
    sites = spark.createDataFrame([(site,) for site in BLOCKED_SITES], "key string")
    return url_filter.judge_urls(read(spark, folder, "pages").select("page_id", "url"), URL_RULES, sites).drop("url")


@query("op10_html_text")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_main_text(read(spark, folder, "pages").select("page_id", "url", "html"))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_best_fit_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), tokenizer_path(), size=2048, end_id=0)


def remainder(n: int):
    """crc32 of the document number as text, modulo ``n``; null for a null number."""
    return F.crc32(F.col("doc_id").cast("string")) % n


@query("op6_language_id")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = language.learn(docs.where(remainder(4) != 2))
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return language.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


@query("op7_simhash_near_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


_WORDS = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

DECONTAMINATION_SQL = f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '{_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '{_WORDS}') AS w FROM benchmark),
starts AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS p FROM starts),
sizes AS (SELECT DISTINCT n FROM phrases),
windows AS (SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS p FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, s, n, item_id FROM windows JOIN phrases USING (n, p)),
hits AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query("op2_benchmark_decontamination", DECONTAMINATION_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.decontaminate(read(spark, folder, "documents"), read(spark, folder, "benchmark"), keep=["doc_id"], clean=False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(x, {5 * (k // 4) + 1}, 5))::BIGINT >> {15 - 5 * (k % 4)} & 31)::INT + 1, 1)" for k in range(32))

WARC_SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
newest AS (SELECT x, max(page_id) AS newest FROM p GROUP BY x)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to FROM p JOIN newest USING (x)"""


@query("op8_warc", WARC_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    manifest = warc.write_archives(read(spark, folder, "pages"))
    found = warc.resolve_revisits(warc.read_archives(spark, manifest))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_quality_classifier")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    network = quality.learn(docs, read(spark, folder, "labels"), "quality", remainder(5) != 0)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    scored = quality.classify(docs.select("doc_id", held_out.alias("held_out"), "text"), network, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op5_nearest_neighbours")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


_SPACES = "[\\x20\\x09-\\x0D]+"

SUBSTRING_SQL = """WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS p FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d WHERE len(w) >= 20)),
repeated AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY p ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM repeated),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS k, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""


@query("op3_substring_dedup", SUBSTRING_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(read(spark, folder, "documents"), keep=["doc_id"])
    words = F.regexp_replace(F.regexp_replace(F.coalesce("kept_text", F.lit("")), _SPACES, " "), "^ | $", "")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(words, 256).alias("kept_sha256"))


def _centroid_sql(k: int = 16, rounds: int = 3) -> str:
    near = """(SELECT vec_id, q, c AS cluster, d AS distance FROM (SELECT v.vec_id, v.q, t.c, d, row_number() OVER (PARTITION BY v.rowid ORDER BY d, t.c) AS n
 FROM v, {t} t, LATERAL (SELECT list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.q, t.q)])::BIGINT AS d)) WHERE n = 1)"""
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER () AS rowid, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
             f"t0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM v ORDER BY c LIMIT {k})"]
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED {near.format(t=f't{i}')}")
        steps.append(f"""m{i} AS MATERIALIZED (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS q FROM
 (SELECT cluster, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, unnest(range(1, len(q) + 1)) AS i FROM a{i}) GROUP BY ALL) GROUP BY cluster)""")
        steps.append(f"t{i + 1} AS MATERIALIZED (SELECT t.c, coalesce(m.q, t.q) AS q FROM t{i} t LEFT JOIN m{i} m ON m.cluster = t.c)")
    steps.append(f"a AS MATERIALIZED {near.format(t=f't{rounds}')}")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, cluster::INT AS cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(t.q, ',')) AS centroid_sha256 FROM a JOIN t{rounds} t ON t.c = a.cluster"""


@query("op13_centroid_clustering", _centroid_sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(read(spark, folder, "embeddings"), k=16, rounds=3, dimensions=64, scale=64))


# crc32 by a table made of eight steps per byte; letters beyond ASCII have two bytes
VARIANTS_SQL = f"""WITH runs AS MATERIALIZED (SELECT doc_id, run, count(*) AS m FROM (SELECT doc_id,
  unnest(regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
steps AS MATERIALIZED (SELECT list(list_reduce(list_prepend(c, range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY c) AS t FROM (SELECT unnest(range(256)) AS c)),
hashed AS MATERIALIZED (SELECT runs.*, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten([CASE WHEN u < 128 THEN [u::BIGINT] ELSE [(192 + (u >> 6))::BIGINT, (128 + (u & 63))::BIGINT] END
    FOR u IN [unicode(x) FOR x IN string_split(doc_id || ':' || run, '')]])), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM runs, steps),
words AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, m FROM hashed),
v AS MATERIALIZED (SELECT word, sum(m)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3),
cuts AS MATERIALIZED (SELECT DISTINCT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
shorter AS (SELECT DISTINCT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM cuts a JOIN v b ON b.word = a.rest),
near AS MATERIALIZED (SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT * FROM shorter UNION SELECT b, bn, a, an FROM shorter),
best AS (SELECT a AS word, count(*) AS n_near, max(bn) AS bn FROM near GROUP BY a),
told AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 2 * v.n THEN (SELECT min(b) FROM near WHERE near.a = v.word AND near.bn = best.bn) END AS form,
  CASE WHEN bn >= 2 * v.n THEN bn END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (WITH RECURSIVE c AS (SELECT word, form AS at FROM told WHERE form IS NOT NULL UNION ALL SELECT c.word, told.form FROM c JOIN told ON told.word = c.at WHERE told.form IS NOT NULL)
  SELECT c.word, c.at FROM c JOIN told ON told.word = c.at AND told.form IS NULL)
SELECT told.word, form, coalesce(chain.at, told.word) AS root, n, n_near, form_n FROM told LEFT JOIN chain ON chain.word = told.word"""


@query("op11_spelling_variants", VARIANTS_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = variants.thinned(variants.runs(read(spark, folder, "documents")), every=97)
    return variants.group(variants.vocabulary(found, letters=5, occurrences=3))


JACCARD_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{url_filter.UPPER}', '{url_filter.LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT k, unnest(CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
sizes AS MATERIALIZED (SELECT k, count(*) AS n FROM s GROUP BY k),
met AS MATERIALIZED (SELECT a.k AS i, b.k AS j, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.k < b.k GROUP BY ALL),
links AS MATERIALIZED (SELECT i, j FROM met JOIN sizes x ON x.k = i JOIN sizes y ON y.k = j WHERE 100 * m >= 90 * (x.n + y.n - m)),
sides AS MATERIALIZED (SELECT i, j FROM links UNION ALL SELECT j, i FROM links),
reach AS (SELECT k AS i, k AS j FROM d UNION SELECT reach.i, sides.j FROM reach JOIN sides ON sides.i = reach.j),
least AS (SELECT reach.i AS k, min(d.doc_id) AS component_id FROM reach JOIN d ON d.k = reach.j GROUP BY reach.i)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN sizes USING (k) JOIN least USING (k)"""


@query("op12_ngram_join", JACCARD_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, folder, "documents"), share=(90, 100), shingle=3)
