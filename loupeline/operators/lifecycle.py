"""Feedback routing, milestones, registry state and batch snapshots as DataFrame operators."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loupeline.functions.decisions import INITIAL_SOURCE, PSEUDO_SOURCE, REVIEW_SOURCES, VERIFIED_SOURCES, milestone_due, reasons, unit_hash, utc_text
from loupeline.operators.ordering import fill_forward, running_totals, seeded
from loupeline.operators.review import top_ranked
from loupeline.session import sized

# The closed set of feedback pools
POOLS = ("raw_pool", "ok_pending_pool", "alarm_candidate_pool", "boundary_hard_pool", "model_conflict_pool",
         "confirmed_ok_pool", "confirmed_ng_pool", "historical_false_positive_pool", "historical_false_negative_pool",
         "labeled_pool", "annotation_qc_failed_pool", "sampling_pseudo_ok_pool")

# What membership in a pool proves about a sample, and the pool whose proof is only sampled
EVIDENCE_POOLS = {"labeled_pool": "NG", "confirmed_ok_pool": "OK", "sampling_pseudo_ok_pool": "OK"}
PSEUDO_POOL = "sampling_pseudo_ok_pool"


def pools(**rules: Column) -> Column:
    """Array of the pools whose rule holds."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def route_pools(predictions: DataFrame, decision: str = "official") -> DataFrame:
    """Pools of a newly ingested sample."""
    ng = F.col(decision) == "NG"
    return predictions.select("sample_id", "category", F.explode(pools(
        raw_pool=F.lit(True), alarm_candidate_pool=ng, ok_pending_pool=~ng, boundary_hard_pool=F.col("is_boundary"),
        model_conflict_pool=F.col("is_conflict"))).alias("pool"))


def apply_review(samples: DataFrame, reviews: DataFrame, order: str | None = None) -> dict[str, DataFrame]:
    """All samples with the reviews applied, the new pool memberships and the refused reviews.

    ``reviews`` has sample_id, reviewed_decision, label_source, model_decision, mask_ok and optionally mask_path. Samples that are not
    reviewed keep what is stored. Of several reviews of a sample the last by ``order`` counts (without it, the largest by value); the
    pools of all of them are joined, each once.
    """
    known = samples.select("sample_id", "category")
    joined = reviews.join(known.withColumn("_known", F.lit(True)), "sample_id", "left")
    error = reasons(unknown_sample=F.col("_known").isNull(), unrecognized_label_source=~F.coalesce(
        F.col("label_source").isin(*REVIEW_SOURCES), F.lit(False)))
    judged = joined.withColumn("error", error)
    good = judged.filter(F.col("error") == "")
    ok, pseudo = F.col("reviewed_decision") == "OK", F.col("label_source") == PSEUDO_SOURCE
    routed = pools(sampling_pseudo_ok_pool=ok & pseudo, confirmed_ok_pool=ok & ~pseudo,
                   historical_false_positive_pool=ok & (F.col("model_decision") == "NG"), confirmed_ng_pool=~ok,
                   historical_false_negative_pool=~ok & (F.col("model_decision") == "OK"), labeled_pool=~ok & F.col("mask_ok"),
                   annotation_qc_failed_pool=~ok & ~F.col("mask_ok"))
    mask = F.col("mask_path") if "mask_path" in reviews.columns else F.lit(None).cast("string")
    values = F.struct("reviewed_decision", "label_source", mask.alias("mask_path"))
    last = F.max(F.struct(*([F.col(order).alias("_order")] if order else []), values.alias("_new")))
    update = good.groupBy("sample_id").agg(last["_new"].alias("_new"))
    merged = samples.join(update, "sample_id", "left")
    for name in ("reviewed_decision", "label_source", "mask_path"):
        stored = F.col(name) if name in samples.columns else F.lit(None).cast("string")
        merged = merged.withColumn(name, F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(stored))
    return {"samples": merged.drop("_new"), "membership": good.select("sample_id", "category", F.explode(routed).alias("pool")).distinct(),
            "rejects": judged.filter(F.col("error") != "").select("sample_id", "error")}


def lock_initial_ok(bank: DataFrame, samples: DataFrame, sha: str = "sha256") -> DataFrame:
    """Bank OK to ``train_locked``: created when new, kept when already initial, a collision when it has another role."""
    stored = samples.groupBy("category", sha).agg(F.min("sample_id").alias("_stored"), F.max("label_source").alias("_source"),
                                                  F.count_if(~F.col("label_source").eqNullSafe(F.lit(INITIAL_SOURCE))).alias("_other"))
    first = bank.groupBy("category", sha).agg(F.min("sample_id").alias("_new"))
    action = F.when(F.col("_stored").isNull(), "created").when(F.col("_other") > 0, "collision").otherwise("locked")
    return first.join(stored, ["category", sha], "left").select(
        "category", sha, F.coalesce("_stored", "_new").alias("sample_id"), action.alias("action"),
        F.when(action != "collision", "train_locked").alias("split"))


def confirmed_rows(samples: DataFrame, membership: DataFrame, decision: str, include_pseudo: bool = True) -> DataFrame:
    """Reviewed samples in the pools that count as training evidence for ``decision``."""
    evidence = F.create_map(*[F.lit(x) for pair in EVIDENCE_POOLS.items() for x in pair])
    proven = membership.select("sample_id", "pool", evidence[F.col("pool")].alias("_proves")).filter(F.col("_proves") == decision)
    if not include_pseudo:
        proven = proven.filter(F.col("pool") != PSEUDO_POOL)
    return samples.join(proven.distinct(), "sample_id").filter(F.col("reviewed_decision") == F.col("_proves")).drop("_proves")


def pool_counts(membership: DataFrame, categories: DataFrame) -> DataFrame:
    """Members per pool, zero-filled over all pools; a membership that was recorded twice counts once."""
    domain = categories.select("category", F.explode(F.array(*[F.lit(p) for p in POOLS])).alias("pool"))
    counts = membership.select("category", "sample_id", "pool").distinct().groupBy("category", "pool").agg(F.count(F.lit(1)).alias("n"))
    return domain.join(counts, ["category", "pool"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def exclusion_reason(prediction_found: Column) -> Column:
    """Why a stored sample is left out of the reports: initialization, then unverified, then a missing prediction."""
    verified = F.coalesce(F.col("label_source").isin(*VERIFIED_SOURCES) & F.col("truth").isin("OK", "NG"), F.lit(False))
    return (F.when(F.coalesce(F.col("label_source") == INITIAL_SOURCE, F.lit(False)), "excluded_initialization")
             .when(~verified, "excluded_unverified").when(~prediction_found, "missing_prediction_records"))


def exclusion_accounting(rows: DataFrame, keys: Sequence[str], prediction_found: Column) -> DataFrame:
    reason = exclusion_reason(prediction_found)
    names = ("excluded_initialization", "excluded_unverified", "missing_prediction_records")
    return rows.withColumn("_reason", reason).groupBy(*keys).agg(*[F.count_if(F.col("_reason") == n).alias(n) for n in names])


def milestones(batches: DataFrame, key: str, order: str, ng: str, **policy) -> DataFrame:
    """Batches at which training is due. The last trained milestone is the one already reached a batch before."""
    run = running_totals(batches, [key], [F.col(order)], {"labeled_ng": ng})
    reached = milestone_due(F.col("labeled_ng"), F.lit(0), **policy)
    before = milestone_due(F.col("labeled_ng") - F.col(ng), F.lit(0), **policy)
    due = F.when(reached > F.coalesce(before, F.lit(0)), reached)
    return run.select(key, order, "labeled_ng", due.alias("milestone"))


def model_in_force(batches: DataFrame, switches: DataFrame, key: str = "category", initial: str = "pretrained") -> DataFrame:
    """Model serving each batch and the next one; a switch decided after batch b counts from b + 1.

    An as-of join: switches and batches in one order, the version filled forward.
    """
    events = switches.select(key, F.col("decided_batch").alias("batch_no"), "version").unionByName(
        batches.select(key, "batch_no", F.lit(None).cast("string").alias("version")))
    per_batch = events.groupBy(key, "batch_no").agg(F.max("version").alias("version"))
    used = fill_forward(per_batch, [key], [F.col("batch_no")], {"used_model": "version"}, inclusive=False)
    used = used.withColumn("used_model", F.coalesce("used_model", F.lit(initial)))
    after = F.coalesce("version", "used_model")
    return used.join(batches.select(key, "batch_no"), [key, "batch_no"], "left_semi").select(
        key, "batch_no", "used_model", after.alias("next_model"),
        F.when(after != F.col("used_model"), F.col("batch_no") + 1).alias("switch_effective_from_batch"))


def superseded(models: DataFrame, key: str = "category") -> DataFrame:
    """Shadow status after the next milestone: superseded when it starts before the verdict batch.

    One row per trained model, so a category's window is as long as its list of trainings.
    """
    order = Window.partitionBy(key).orderBy("milestone")
    following = F.lead("start_batch").over(order)
    closed = F.col("next_start").isNotNull() & (F.col("verdict_batch").isNull() | (F.col("next_start") < F.col("verdict_batch")))
    status = F.when(closed, "superseded").when(F.col("verdict_batch").isNull(), "shadow_candidate").when(
        F.col("decision") == "promote", "promoted").otherwise("rejected_shadow")
    return models.withColumn("next_start", following).withColumn("status", status)


def registry_states(events: DataFrame, key: str = "category", seq: str = "seq") -> DataFrame:
    """Production and previous model after every promote and rollback event.

    A rollback returns to the model that served before the latest promotion. That model is the latest promoted one
    not rolled back in between, so it is a fill-forward over promotions and needs no replay. The first promotion has
    nothing to return to: rolling it back is an error and leaves it in place.
    """
    promote = F.col("action") == "promote"
    numbered = running_totals(events.withColumn("_p", promote.cast("bigint")), [key], [F.col(seq)], {"_run": "_p"})
    rolled = numbered.filter(~promote).select(key, "_run").distinct().withColumn("_rolled", F.lit(True))
    promotions = numbered.filter(promote).join(rolled, [key, "_run"], "left").withColumn(
        "_kept", F.when(F.col("_rolled").isNull() | (F.col("_run") == 1), F.col("version")))
    before = fill_forward(promotions, [key], [F.col("_run")], {"_previous": "_kept"}, inclusive=False)
    state = before.select(key, "_run", F.col("version").alias("_version"), "_previous")
    joined = numbered.join(state, [key, "_run"], "left")
    production = F.when(promote, F.col("_version")).otherwise(F.col("_previous"))
    error = F.when(~promote & F.col("_previous").isNull(), "no_previous_model")
    return joined.select(key, seq, "action", production.alias("production"), F.col("_previous").alias("previous"), error.alias("error"))


def registry_current(states: DataFrame, key: str = "category", seq: str = "seq") -> DataFrame:
    """Model in production after the last successful event."""
    good = states.filter(F.col("error").isNull())
    return good.groupBy(key).agg(F.max_by("production", seq).alias("version"))


def registry_status(events: DataFrame, key: str = "category", seq: str = "seq") -> DataFrame:
    """Status of every promoted version: production, or archived once a later promotion replaced it."""
    last = events.filter(F.col("action") == "promote").groupBy(key).agg(F.max(seq).alias("_last"))
    return events.filter(F.col("action") == "promote").join(last, key).select(
        key, "version", F.when(F.col(seq) == F.col("_last"), "production").otherwise("archived").alias("status"))


def register_candidate(models: DataFrame) -> DataFrame:
    """candidate when the checkpoint exists and the smoke test passed, else failed with the reason."""
    empty = ~F.coalesce(F.col("checkpoint_bytes") > 0, F.lit(False))
    error = F.when(empty, "missing_or_empty_checkpoint").when(~F.coalesce("smoke_ok", F.lit(False)), "smoke_test_failed")
    return models.withColumn("error", error).withColumn("status", F.when(error.isNull(), "candidate").otherwise("failed"))


def latest_candidate(models: DataFrame, key: str = "category") -> DataFrame:
    """Newest model still waiting for a verdict."""
    waiting = models.filter(F.col("status").isin("shadow_candidate", "candidate_insufficient_or_rejected"))
    return waiting.groupBy(key).agg(F.max(F.struct("created_at", "version")).alias("m")).select(
        key, F.col("m.version").alias("version"), F.col("m.created_at").alias("created_at"))


def model_evaluations(test_reports: DataFrame, models: DataFrame, key: str = "category") -> DataFrame:
    """Earliest production report of the pretrained model, then every trained version by milestone."""
    first = top_ranked(test_reports.filter((F.col("role") == "production") & F.col("version").startswith("pretrained")), [key],
                       [F.col("at"), F.col("version")], 1, "_rn")
    initial = first.select(key, "version", F.lit("initial_pretrained").alias("kind"), F.lit(0).cast("bigint").alias("milestone"), "recall")
    return initial.unionByName(models.select(key, "version", F.lit("yolo").alias("kind"), "milestone", "recall"))


def history_events(times: DataFrame | None = None, **events: DataFrame) -> DataFrame:
    """One log from the event frames, each with category, batch_no and detail.

    With ``times`` (category, batch_no, at), the end of every batch, each event carries the UTC text of its batch's.
    """
    out = None
    for name, rows in events.items():
        part = rows.select("category", "batch_no", F.lit(name).alias("event"), "detail")
        out = part if out is None else out.unionByName(part)
    if times is None:
        return out
    stamps = sized(times.select("category", "batch_no", utc_text("at").alias("at")), "batch-times")
    return out.join(stamps, ["category", "batch_no"], "left").select("at", "category", "batch_no", "event", "detail")


def batch_snapshot(rows: DataFrame, fraction: float = 0.25, seed: object = 42, trained: DataFrame | None = None) -> DataFrame:
    """End-of-batch training evidence per category, from samples confirmed up to each batch.

    ``rows`` has category, batch_no, sha256, reviewed_decision, label_source, in_calibration, stored_split, in_roi.
    Running sums of per-batch counts, never a re-read of earlier batches. ``trained`` (category, start_batch, version, milestone) adds the
    latest model trained up to each batch, NULL before the first.
    """
    ok = (F.col("reviewed_decision") == "OK") & ~F.col("in_calibration")
    ng = F.col("reviewed_decision") == "NG"
    share = unit_hash(seeded(seed, F.col("category"), F.col("sha256")))
    split = F.coalesce("stored_split", F.when(share < F.lit(fraction), "calibration").otherwise("train"))
    names = {"eligible_training_ok": ok, "eligible_training_ng": ng & F.col("in_roi") & (split == "train"),
             "eligible_pseudo_ok": ok & (F.col("label_source") == PSEUDO_SOURCE), "confirmed_valid_ng": ng,
             "excluded_training_ng_outside_roi": ng & ~F.col("in_roi")}
    per_batch = rows.groupBy("category", "batch_no").agg(*[F.count_if(rule).alias(f"_{n}") for n, rule in names.items()])
    run = running_totals(per_batch, ["category"], [F.col("batch_no")], {n: f"_{n}" for n in names})
    if trained is None:
        return run.select("category", "batch_no", *names)
    starts = trained.groupBy("category", F.col("start_batch").alias("batch_no")).agg(F.max(F.struct("milestone", "version")).alias("_new"))
    known = run.select("category", "batch_no", *names, F.lit(1).alias("_own")).join(starts, ["category", "batch_no"], "full_outer")  # a model may start in a batch without rows
    filled = fill_forward(known, ["category"], [F.col("batch_no")], {"_latest": "_new"}).filter("_own = 1")
    return filled.select("category", "batch_no", *names, F.col("_latest.version").alias("latest_model"), F.col("_latest.milestone").alias("latest_milestone"))
