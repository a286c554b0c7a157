"""Streaming queries (run to the end of what is available) and pluggable functions."""
from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from loupeline.functions import scoring
from loupeline.functions.review import review_provider, review_violations
from loupeline.operators import lifecycle as l
from loupeline.operators import review as r
from loupeline.plans import lifecycle as pl
from loupeline.plans import vectors as pv
from loupeline.plans.registry import query
from loupeline.plans.review import ESCALATED, KEYS, plan
from loupeline.session import scratch, written
from loupeline.sources import bindings as b
from loupeline.streaming import counters, ingest, triggers
from loupeline.streaming.key_store import KeyStore, ingest_bucketed


def as_stream(t, rows, name, files_per_trigger=2):
    """``rows`` written in the partitions they have and read back as a stream, some files per micro-batch."""
    path = scratch(t.spark, name)
    rows.write.parquet(path)
    return ingest.stream_files(t.spark, path, rows.schema, files_per_trigger)


def run_to_table(t, stream, name):
    """Runs an append stream into Parquet and returns what it wrote."""
    out = scratch(t.spark, name)
    ingest.run_available(stream.writeStream.format("parquet").option("path", out), scratch(t.spark, name + "-checkpoint"))
    return t.spark.read.schema(stream.schema).parquet(out)


def stream_arrivals(t):
    return b.arrivals(t).select("sample_id", "category", "sha256")


@query("ingest_dedup_stream", f"WITH {b.ARRIVALS} SELECT DISTINCT category, sha256 FROM arr")
def _(t):
    stream, out = as_stream(t, stream_arrivals(t), "arrivals"), scratch(t.spark, "accepted")
    ingest.ingest_dedup(stream, out, scratch(t.spark, "accepted-checkpoint"))
    return t.spark.read.schema(stream.schema).parquet(out).select("category", "sha256")


@query("ingest_against_store", f"WITH {b.ARRIVALS} SELECT DISTINCT category, sha256 FROM arr")
def _(t):
    stream, store = as_stream(t, stream_arrivals(t), "arrivals"), scratch(t.spark, "store")
    ingest.ingest_against_store(stream, store, scratch(t.spark, "store-checkpoint"))
    return t.spark.read.parquet(store).select("category", "sha256")


@query("ingest_bucketed_store", f"WITH {b.ARRIVALS} SELECT category, sha256, count(*) AS arrivals FROM arr GROUP BY 1, 2")
def _(t):
    """Two streams into one store of bucketed keys, merged in between; joined back so that every accepted content shows once."""
    rows = stream_arrivals(t)
    store = KeyStore(t.spark, scratch(t.spark, "bucketed"), ", ".join(f"{n} {k}" for n, k in rows.dtypes))
    for i, part in enumerate(("sample_id % 2 = 0", "true")):
        stream = as_stream(t, rows.filter(part), f"arrivals-{i}", 4)
        ingest_bucketed(stream, store, scratch(t.spark, f"bucketed-checkpoint-{i}"))
        store.compact()
    counted = rows.groupBy("category", "sha256").agg(F.count(F.lit(1)).alias("arrivals"))
    return store.rows().join(counted, ["category", "sha256"]).select("category", "sha256", "arrivals")


@query("ingest_two_checkpoints", f"""WITH {b.ARRIVALS} SELECT category, sha256, coalesce(min(sample_id) FILTER (batch_no <= 15), min(sample_id)) AS sample_id FROM arr GROUP BY 1, 2""")
def _(t):
    """Two streams with checkpoints of their own feed one store: the second adds only what the first lacks."""
    store, arrivals = scratch(t.spark, "store"), b.arrivals(t)
    for i, part in enumerate(("batch_no <= 15", "true")):
        rows = arrivals.filter(part).select("sample_id", "category", "sha256")
        ingest.ingest_against_store(as_stream(t, rows, f"arrivals-{i}", 1000), store, scratch(t.spark, f"store-checkpoint-{i}"))
    return t.spark.read.parquet(store).select("category", "sha256", "sample_id")


@query("route_pools_stream", f"WITH {b.DECISIONS} {pl.ROUTED}")
def _(t):
    rows = pl.predictions(t).select("sample_id", "category", "official", "is_boundary", "is_conflict")
    return run_to_table(t, l.route_pools(as_stream(t, rows, "predictions")), "routed")


@query("sink_event_log", f"WITH {b.ARRIVALS} SELECT 'sample_ingested' AS event, concat(strftime(created_at::TIMESTAMP, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00') AS at, sample_id, category FROM arr")
def _(t):
    stream, log = as_stream(t, b.arrivals(t).select("sample_id", "category", "created_at"), "arrivals"), scratch(t.spark, "events")
    ingest.event_log(stream, log, scratch(t.spark, "events-checkpoint"), "sample_ingested", ["sample_id", "category"], at="created_at")
    return t.spark.read.parquet(log).select("event", "at", "sample_id", "category")


@query("resume_exactly_once", f"WITH {b.ARRIVALS} SELECT sample_id, category FROM arr")
def _(t):
    """Two runs over one checkpoint, new files arriving in between: nothing twice, nothing lost."""
    path, out, checkpoint = [scratch(t.spark, n) for n in ("inbox", "processed", "inbox-checkpoint")]
    rows = b.arrivals(t).select("sample_id", "category", "batch_no")
    for part in ("batch_no <= 15", "batch_no > 15"):
        rows.filter(part).write.mode("append").parquet(path)
        stream = ingest.stream_files(t.spark, path, rows.schema, 2)
        ingest.run_available(stream.writeStream.format("parquet").option("path", out), checkpoint)
    return t.spark.read.parquet(out).select("sample_id", "category")


NG_FLAG = "label_source IN ('human_review', 'folder_ground_truth')"
TOTALS = f"""{b.DECISIONS}, tot AS (SELECT category, count(*) FILTER (truth = 'NG') AS total FROM dec WHERE {NG_FLAG} GROUP BY 1)"""


def labeled(t):
    return b.decisions(t).filter(NG_FLAG).select("category", (F.col("truth") == "NG").alias("labeled_ng"))


@query("milestone_stream", f"""WITH {TOTALS}, ms AS (SELECT 40 + 20 * i AS m FROM generate_series(0, 3) AS g(i) UNION ALL SELECT 100 + 40 * i FROM generate_series(0, 200000) AS g(i))
SELECT category, max(m) AS milestone FROM tot JOIN ms ON m <= total GROUP BY 1""")
def _(t):
    fired = run_to_table(t, counters.milestone_stream(as_stream(t, labeled(t), "labels")), "milestones")
    return fired.groupBy("category").agg(F.max("milestone").alias("milestone"))


@query("recalibration_stream", f"WITH {TOTALS} SELECT category, total // 5 AS multiple FROM tot")
def _(t):
    fired = run_to_table(t, counters.recalibration_stream(as_stream(t, labeled(t), "labels")), "recalibrations")
    return fired.groupBy("category").agg(F.max("multiple").alias("multiple"))


@query("shadow_window_stream", f"WITH {b.DECISIONS} SELECT category AS model, count(*) AS verdicts FROM (SELECT DISTINCT category FROM dec) GROUP BY 1")
def _(t):
    rows = b.decisions(t).filter(NG_FLAG).select(F.col("category").alias("model"), (F.col("truth") == "NG").alias("valid_ng"))
    due = run_to_table(t, counters.shadow_stream(as_stream(t, rows, "shadow")), "verdicts")
    return due.groupBy("model").agg(F.count(F.lit(1)).alias("verdicts"))


PARTS = (2, 5)  # micro-batches that the same rows are dealt to


def firings(t, rows, trigger, name):
    """All firings of a trigger over ``rows`` (with ``part_2`` and ``part_5``), for both sizes of micro-batches.

    Every micro-batch is a run of its own over one checkpoint, so the state is stored and read again between all of them.
    """
    out, kept = None, [c for c in rows.columns if not c.startswith("part_")]
    stored = written(rows, f"{name}-rows")
    with triggers.state_store(t.spark):
        for n in PARTS:
            inbox, sink, checkpoint = [scratch(t.spark, f"{name}-{what}") for what in ("inbox", "fired", "checkpoint")]
            for part in range(n):
                stored.filter(F.col(f"part_{n}") == part).select(*kept).write.mode("append").parquet(inbox)
                stream = trigger(ingest.stream_files(t.spark, inbox, stored.select(*kept).schema, 1000))
                ingest.run_available(stream.writeStream.format("parquet").option("path", sink), checkpoint)
            fired = t.spark.read.schema(stream.schema).parquet(sink).withColumn("parts", F.lit(n).cast("bigint"))
            out = fired if out is None else out.unionByName(fired)
    return out


def dealt(t):
    """Verified decisions with the micro-batch they fall into, by review batch."""
    rows = b.decisions(t).filter(NG_FLAG).select("category", "batch_no", (F.col("truth") == "NG").alias("ng"))
    return rows.withColumns({f"part_{n}": F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor(F.col("batch_no") * n / F.lit(28)).cast("int"))) for n in PARTS})


DEALT = f"""{b.DECISIONS}, sizes(parts) AS (VALUES {", ".join(f"({n})" for n in PARTS)}),
cnt AS (SELECT parts, category, greatest(0, least(parts - 1, CAST(floor(batch_no * parts / 28.0::DOUBLE) AS BIGINT))) AS part, count(*) FILTER (truth = 'NG') AS ng FROM dec, sizes WHERE {NG_FLAG} GROUP BY ALL),
run AS (SELECT parts, category, part, CAST(sum(ng) OVER (PARTITION BY parts, category ORDER BY part) AS BIGINT) AS total FROM cnt)"""
FIRED = """fired AS (SELECT * FROM (SELECT *, coalesce(max(level) OVER (PARTITION BY parts, category ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), {start}) AS before FROM lev) WHERE level > before)
SELECT parts::BIGINT AS parts, category, total, level, row_number() OVER (PARTITION BY parts, category ORDER BY part) AS firing FROM fired"""


@query("milestone_firings", f"""WITH {DEALT}, ms AS (SELECT 40 + 20 * i AS m FROM generate_series(0, 3) AS g(i) UNION ALL SELECT 100 + 40 * i FROM generate_series(0, 200000) AS g(i)),
lev AS (SELECT run.*, coalesce((SELECT max(m) FROM ms WHERE m <= total), 0) AS level FROM run), {FIRED.format(start=0)}""")
def _(t):
    rows = dealt(t).withColumnRenamed("ng", "labeled_ng").drop("batch_no")
    return firings(t, rows, triggers.milestone_firings, "milestones")


@query("recalibration_firings", f"WITH {DEALT}, lev AS (SELECT *, total // 5 AS level FROM run), {FIRED.format(start=-1)}")
def _(t):
    rows = dealt(t).withColumnRenamed("ng", "labeled_ng").drop("batch_no")
    return firings(t, rows, triggers.recalibration_firings, "recalibrations")


@query("shadow_firings", f"""WITH {DEALT}, e AS (SELECT *, row_number() OVER (PARTITION BY parts, category ORDER BY part) AS batches FROM run)
SELECT parts::BIGINT AS parts, category AS model, min(total) AS shadow_ng, min(batches) AS shadow_batches FROM e WHERE total >= 150 OR batches >= 4 GROUP BY 1, 2""")
def _(t):
    rows = dealt(t).withColumnsRenamed({"ng": "valid_ng", "category": "model"}).drop("batch_no")
    return firings(t, rows, lambda source: triggers.shadow_firings(source, min_ng=150, max_batches=4), "shadows")


@query("score_with", f"""WITH {pv.PARTS} SELECT q.vec_id, round(min(list_distance(q.e, b.e)), 6) AS score FROM r q CROSS JOIN r b WHERE q.role = 'query' AND b.role = 'bank' GROUP BY 1""")
def _(t):
    scored = scoring.score_against_bank(pv.role(t, "query"), pv.role(t, "bank"))
    return scored.select("vec_id", F.round("score", 6).alias("score"))


def text_predict(texts):
    """Small stand-in for a model over a batch: every non-empty line is a one-row defect, the score is their number."""
    lines = texts.str.split("\n").explode()
    at = lines.groupby(level=0).cumcount()
    kept = pd.DataFrame({"y": at, "end": lines.str.len() - 1})[lines.str.len() > 0]
    masks = kept.groupby(level=0).apply(lambda f: [(int(y), 0, int(x)) for y, x in zip(f["y"], f["end"])]).reindex(texts.index)
    masks = masks.map(lambda m: m if isinstance(m, list) else [])
    return pd.DataFrame({"score": masks.map(len).astype(float), "mask": masks})


@query("predict_fn", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, count(*) FILTER (line <> '')::DOUBLE AS score, count(*) FILTER (line <> '') AS mask_runs, CAST(coalesce(sum(length(line)), 0) AS BIGINT) AS mask_pixels FROM l GROUP BY 1""")
def _(t):
    predicted = scoring.predict_items(t.documents, "doc_id", "text", text_predict)
    pixels = F.aggregate("runs", F.lit(0).cast("bigint"), lambda a, run: a + run["x1"] - run["x0"] + 1)
    return predicted.select("doc_id", "score", F.size("runs").cast("bigint").alias("mask_runs"), pixels.alias("mask_pixels"))


def line_counter(config):
    """A plugin as a user would write one: made by name inside every task."""
    class Lines:
        def predict(self, frame):
            text = frame["text"].fillna("")
            return pd.DataFrame({"score": text.str.count(config["mark"]).astype(float), "doc_id": frame["doc_id"]})

        def healthcheck(self):
            return {"ok": True}

        def close(self):
            pass

    return Lines()


@query("score_with_plugin", "SELECT doc_id, (length(coalesce(text, '')) - length(replace(coalesce(text, ''), '.', '')))::DOUBLE AS score FROM documents")
def _(t):
    """Every document scored by a plugin that is named, not passed."""
    return scoring.score_with_plugin(t.documents.select("doc_id", "text"), "loupeline.plans.streams:line_counter", "doc_id bigint, score double", {"mark": r"\."})


@query("review_provider", f"""WITH {b.DECISIONS} SELECT sample_id, official AS reviewed_decision, CASE WHEN official = 'NG' AND sample_id % 19 = 0 THEN 'mask_required' ELSE '' END AS violations FROM dec""")
def _(t):
    mask = F.when(F.col("sample_id") % 19 != 0, F.concat(F.lit("mask/"), F.col("sample_id").cast("string")))
    rows = b.decisions(t).select("sample_id", "category", F.col("official").alias("decision"), mask.alias("mask_path"))
    return review_violations(review_provider("model_assumed_review")(rows)).select("sample_id", "reviewed_decision", "violations")


@query("review_callback", f"WITH {ESCALATED} SELECT sample_id, category, batch_no, sampled, reviewed, CASE WHEN reviewed THEN truth END AS truth FROM esc")
def _(t):
    """The reviewer's answers arrive as a table after the plan is made; only planned or escalated rows show them."""
    planned = plan(t).drop("truth")
    answers = b.decisions(t).select("sample_id", "truth")
    settled = r.segment_escalation(planned.join(answers, "sample_id"), KEYS)
    return settled.select("sample_id", *KEYS, "sampled", "reviewed", F.when(F.col("reviewed"), F.col("truth")).alias("truth"))
