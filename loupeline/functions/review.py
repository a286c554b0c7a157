"""Review providers: DataFrame functions from predictions to review rows."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loupeline.functions.decisions import reasons
from loupeline.operators.lookups import category_from_path, mask_lookup_strict, truth_from_path

REVIEW_SCHEMA = "sample_id bigint, category string, decision string, mask_path string"


def export_review_batch(predictions: DataFrame, path: str) -> str:
    """Predictions handed to a reviewer as JSON lines."""
    predictions.select("sample_id", "category", "decision", "mask_path").write.mode("overwrite").json(path)
    return path


def import_review_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEW_SCHEMA).json(path)


def assumed_review(predictions: DataFrame) -> DataFrame:
    """The model's decision taken as the review; never counted as verified truth."""
    return predictions.select(
        "sample_id", "category", F.col("decision").alias("model_decision"), F.col("decision").alias("reviewed_decision"),
        F.lit("model_assumed_review").alias("label_source"), F.when(F.col("decision") == "NG", F.col("mask_path")).alias("mask_path"),
        F.lit("model_assumed_review").alias("reviewer"))


def folder_truth_review(predictions: DataFrame, files: DataFrame, masks: DataFrame | None = None, aliases: DataFrame | None = None, ok_names: Sequence[str] = ("ok",),
                        ng_names: Sequence[str] = ("ng",)) -> DataFrame:
    """Truth, category check and mask of each sample from the folders of its file. ``files`` has sample_id and path, one row per sample.

    With ``aliases`` (category, alias) a path has to name its sample's category. With ``masks`` (column mask: the paths of all mask files) the
    mask of an NG sample is looked up (``mask_lookup_strict``); otherwise ``files`` brings it in its column mask. ``error`` names the first
    rule a sample breaks: no_file, no_label, both_labels, category_mismatch, ambiguous_masks; such a row has no truth and no mask.
    """
    judged = truth_from_path(files, ok_names, ng_names)
    if aliases is not None:
        placed = predictions.select("sample_id", "category").join(files.select("sample_id", "path"), "sample_id")
        wrong = category_from_path(placed, aliases).select("sample_id", F.col("error").alias("_category"))
        judged = judged.join(wrong, "sample_id", "left").withColumn("error", F.coalesce("error", "_category"))
    if masks is not None:
        wanted = judged.filter((F.col("truth") == "NG") & F.col("error").isNull()).select("sample_id", F.col("path").alias("image"))
        found = mask_lookup_strict(wanted, masks).select("sample_id", "mask", F.col("error").alias("_mask"))
        judged = judged.drop("mask").join(found, "sample_id", "left").withColumn("error", F.coalesce("error", "_mask"))
    fine = F.col("error").isNull()
    truth = judged.select("sample_id", F.when(fine, F.col("truth")).alias("truth"), "error", F.when(fine, F.col("mask")).alias("mask"), F.lit(True).alias("_file"))
    joined = predictions.join(truth, "sample_id", "left").withColumn("error", F.when(F.col("_file").isNull(), "no_file").otherwise(F.col("error")))
    return joined.select(
        "sample_id", "category", F.col("decision").alias("model_decision"), F.col("truth").alias("reviewed_decision"),
        F.lit("folder_ground_truth").alias("label_source"), F.when(F.col("truth") == "NG", F.col("mask")).alias("mask_path"),
        F.lit("automatic_folder_ground_truth").alias("reviewer"), "error")


def review_violations(reviews: DataFrame) -> DataFrame:
    """What makes a review row invalid under its own provider's rules."""
    assumed, folder = F.col("label_source") == "model_assumed_review", F.col("label_source") == "folder_ground_truth"
    return reviews.withColumn("violations", reasons(
        changed_decision=assumed & (F.col("model_decision") != F.col("reviewed_decision")),
        mask_required=assumed & (F.col("reviewed_decision") == "NG") & F.col("mask_path").isNull(),
        reviewer=folder & (F.col("reviewer") != "automatic_folder_ground_truth"), no_truth=F.col("reviewed_decision").isNull()))


# Provider names
PROVIDERS: dict[str, Callable[..., DataFrame]] = {"model_assumed_review": assumed_review, "folder_ground_truth": folder_truth_review}


def review_provider(name: str) -> Callable[..., DataFrame]:
    if name not in PROVIDERS:
        raise ValueError(f"unknown review provider: {name}")
    return PROVIDERS[name]
