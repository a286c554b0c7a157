"""Content-set operators: overlaps, exclusions, availability, generation gates."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loupeline.functions.decisions import reasons


def canonical_text(text: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.trim(F.col(text) if isinstance(text, str) else text), r"\s+", " "))


def content_digest(content: Column | str) -> Column:
    return F.sha2(F.col(content) if isinstance(content, str) else content, 256)


def pixel_digest(text: Column | str) -> Column:
    """Digest of the decoded content with its size, equal for different encodings of the same content."""
    canon = canonical_text(text)
    return F.sha2(F.concat_ws(":", F.length(canon).cast("string"), canon), 256)


def role_overlap(rows: DataFrame, sha: str = "sha256", role: str = "role") -> DataFrame:
    """Content held by more than one role. Roles are a closed set, so each set stays tiny however hot the content."""
    held = rows.groupBy(sha).agg(F.sort_array(F.collect_set(role)).alias("roles"))
    return held.filter(F.size("roles") > 1).select(sha, F.array_join("roles", ",").alias("roles"))


def heldout_overlap(train: DataFrame, forbidden: DataFrame, sha: str = "sha256") -> DataFrame:
    return train.join(forbidden.select(sha), sha, "left_semi")


def except_content(rows: DataFrame, excluded: DataFrame, on: Sequence[str] = ("sha256",)) -> DataFrame:
    """Rows whose content is not in ``excluded``."""
    return rows.join(excluded.select(*on), list(on), "left_anti")


def forbidden_set(*parts: DataFrame, sha: str = "sha256") -> DataFrame:
    out = parts[0].select(sha)
    for part in parts[1:]:
        out = out.unionByName(part.select(sha))
    return out.distinct()


def union_training_ok(bank: DataFrame, confirmed: DataFrame, pseudo: DataFrame | None, calibration: DataFrame,
                      sha: str = "sha256") -> DataFrame:
    """Bank, confirmed and (optionally) pseudo OK, each tagged by origin, minus calibration content."""
    out = bank.withColumn("origin", F.lit("bank")).unionByName(confirmed.withColumn("origin", F.lit("confirmed")))
    if pseudo is not None:
        out = out.unionByName(pseudo.withColumn("origin", F.lit("pseudo")))
    return except_content(out, calibration, [sha])


def support_still_available(support: DataFrame, available: DataFrame, category: str = "category",
                            sha: str = "sha256") -> DataFrame:
    """Per category: how many support items are gone from the training set, and whether all are still there."""
    known = available.select(category, sha).distinct().withColumn("_known", F.lit(True))
    marked = support.join(known, [category, sha], "left")
    return marked.groupBy(category).agg(
        F.count(F.lit(1)).alias("support"), F.count_if(F.col("_known").isNull()).alias("missing")).withColumn(
        "available", F.col("missing") == 0)


def generation_due(current: DataFrame, last: DataFrame, events: DataFrame, category: str = "category",
                   sha: str = "sha256", refresh: int = 20, max_events: int = 8) -> DataFrame:
    """First event, or enough new real NG since the last one, while the event budget lasts."""
    fresh = current.select(category, sha).distinct().join(last.select(category, sha), [category, sha], "left_anti")
    counts = fresh.groupBy(category).agg(F.count(F.lit(1)).alias("new_real_ng"))
    n = F.coalesce("new_real_ng", F.lit(0).cast("bigint"))
    done = F.coalesce("event_count", F.lit(0).cast("bigint"))
    return current.select(category).distinct().join(counts, category, "left").join(events, category, "left").select(
        category, n.alias("new_real_ng"), done.alias("event_count"),
        (((done == 0) | (n >= refresh)) & (done < max_events)).alias("due"))


def generated_gate(items: DataFrame, forbidden: DataFrame, allow_unreviewed: bool) -> DataFrame:
    """Items eligible for selection with the reasons that refuse them.

    Expects item_id, image_sha256, selection_status, approved, request_ok, checksum_ok, image_height, image_width, mask_height,
    mask_width, mask_binary, white_pixels. Repeats of one image are all refused but the first, counted per hash without gathering rows.
    """
    human = F.coalesce("approved", F.lit(False)) & (F.col("selection_status") == "human_approved")
    open_item = F.col("selection_status") == "structurally_valid_unreviewed"
    eligible = items.withColumn("human_approved", human).filter(human | (F.lit(allow_unreviewed) & open_item))
    first = eligible.groupBy("image_sha256").agg(F.min("item_id").alias("_first"))
    banned = forbidden.select(F.col("sha256").alias("image_sha256")).distinct().withColumn("_banned", F.lit(True))
    marked = eligible.join(first, "image_sha256").join(banned, "image_sha256", "left")
    return marked.select("item_id", "human_approved", reasons(
        request_mismatch=~F.col("request_ok"), checksum=~F.col("checksum_ok"), forbidden=F.col("_banned").isNotNull(),
        duplicate=F.col("item_id") > F.col("_first"), size_mismatch=~(F.col("image_height").eqNullSafe(F.col("mask_height")) & F.col("image_width").eqNullSafe(F.col("mask_width"))),
        mask_not_binary=~F.col("mask_binary"), mask_empty=F.col("white_pixels") == 0,
        mask_full=F.col("white_pixels") >= F.col("mask_height") * F.col("mask_width")).alias("violations"))


def pixel_dedup(items: DataFrame, seen: DataFrame, digest: str = "pixel_sha256", order: str = "item_id") -> DataFrame:
    """First item of each unseen pixel content."""
    fresh = items.join(seen.select(digest).distinct(), digest, "left_anti")
    rest = [c for c in items.columns if c not in (digest, order)]
    kept = fresh.groupBy(digest).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return kept.select(digest, *[F.col(f"_first.{c}").alias(c) for c in [order, *rest]])


def split_preflight(rows: DataFrame, category: str = "category", min_ng: int = 40, min_val_ok: int = 80,
                    min_val_ng: int = 30, min_train_ok: int = 100) -> DataFrame:
    """Pool sizes per category and the minimum counts they miss."""
    def pool(split, label):
        return F.count_if((F.col("split") == split) & (F.col("label") == label))

    counts = rows.groupBy(category).agg(*[pool(s, l).alias(f"{s}_{l.lower()}") for s in ("train", "val", "test")
                                          for l in ("OK", "NG")])
    return counts.withColumn("violations", reasons(
        train_ok=F.col("train_ok") < min_train_ok, train_ng=F.col("train_ng") < min_ng, val_ok=F.col("val_ok") < min_val_ok,
        val_ng=F.col("val_ng") < min_val_ng, test_ok=F.col("test_ok") == 0, test_ng=F.col("test_ng") == 0))
