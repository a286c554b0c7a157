"""Lookups: configuration, masks by path, unseen content, models in force."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loupeline.operators.splits import sticky_split


def resolve_config(categories: DataFrame, settings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Value per (category, key): the category's override, else the default row (NULL category)."""
    wanted = categories.select("category", F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"))
    overrides = settings.filter(F.col("category").isNotNull()).select("key", "category", F.col("value").alias("own"))
    defaults = settings.filter(F.col("category").isNull()).select("key", F.col("value").alias("default"))
    found = wanted.join(overrides, ["key", "category"], "left").join(defaults, "key", "left")
    return found.select("category", "key", F.coalesce("own", "default").alias("value"))


def path_parts(path: str) -> Column:
    return F.split(F.lower(path), "/")


def truth_from_path(paths: DataFrame, ok_names: Sequence[str] = ("ok",), ng_names: Sequence[str] = ("ng",), path: str = "path") -> DataFrame:
    """OK or NG from exactly one matching path component, case-insensitive; otherwise an error row."""
    parts = path_parts(path)
    is_ok, is_ng = [F.arrays_overlap(parts, F.array(*[F.lit(n.lower()) for n in names])) for names in (ok_names, ng_names)]
    return paths.withColumns({
        "truth": F.when(is_ok & ~is_ng, "OK").when(is_ng & ~is_ok, "NG"),
        "error": F.when(is_ok & is_ng, "both_labels").when(~is_ok & ~is_ng, "no_label")})


def category_from_path(paths: DataFrame, aliases: DataFrame, path: str = "path") -> DataFrame:
    """Checks that a path holds an accepted directory name of its category (its own name when none is listed)."""
    names = aliases.groupBy("category").agg(F.collect_set(F.lower("alias")).alias("_names"))  # a few names per category
    joined = paths.join(names, "category", "left")
    accepted = F.coalesce("_names", F.array(F.lower("category")))
    return joined.withColumn("error", F.when(~F.arrays_overlap(path_parts(path), accepted), "category_mismatch")).drop("_names")


# Mask lookup order
MASK_DIRECTORIES = ("mask", "masks")
MASK_SUFFIXES = ("", "_t", "_mask")
MASK_EXTENSIONS = (".png", ".bmp", ".jpg", ".jpeg", ".tif", ".tiff")
PRIORITY_SUFFIXES = ("_t", "_mask", "")


def split_path(path: str, ignore_case: bool = True) -> dict[str, Column]:
    """Directory, stem and extension (lower-cased with ``ignore_case``) of a path."""
    name = F.element_at(F.split(path, "/"), -1)
    extension = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    return {"_dir": F.regexp_replace(path, "/?[^/]*$", ""), "_stem": F.regexp_replace(name, r"\.[^.]*$", ""),
            "_ext": F.lower(extension) if ignore_case else extension}


def mask_keys(masks: DataFrame, suffixes: Sequence[str], ignore_case: bool = True) -> DataFrame:
    """Each mask under every image stem it could belong to: ``(root, stem, suffix_no, ext, mask)``.

    The few readings of a mask's name are exploded on the mask side, so images join on (root, stem) directly instead of
    probing suffix and extension combinations.
    """
    parts = masks.withColumns(split_path("mask", ignore_case))
    readings = F.array_compact(F.array(*[F.when(F.col("_stem").endswith(s), F.struct(
        F.expr(f"substring(_stem, 1, length(_stem) - {len(s)})").alias("stem"), F.lit(i).alias("suffix_no"))) for i, s in enumerate(suffixes)]))
    directory = F.element_at(F.split("_dir", "/"), -1)
    kept = parts.filter(directory.isin(*MASK_DIRECTORIES) & F.col("_ext").isin(*MASK_EXTENSIONS))
    return kept.select("mask", F.regexp_replace("_dir", "/?[^/]*$", "").alias("root"), "_ext", F.inline(readings))


def mask_lookup_strict(images: DataFrame, masks: DataFrame, ignore_case: bool = False) -> DataFrame:
    """Mask in the nearest ancestor that has any match; more than one match there is an error. Mask extensions are exact names unless
    ``ignore_case`` is set.

    Matches are counted and reduced per image, not gathered.
    """
    parts = images.withColumns(split_path("image"))
    pieces = F.split("_dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(pieces)), lambda d: F.struct(
        d.alias("depth"), F.array_join(F.slice(pieces, F.lit(1), F.size(pieces) - d), "/").alias("root")))
    wanted = parts.select("image", F.col("_stem").alias("stem"), F.inline(ancestors))
    found = wanted.join(mask_keys(masks, MASK_SUFFIXES, ignore_case), ["root", "stem"])
    per_depth = found.groupBy("image", "depth").agg(F.countDistinct("mask").alias("n"), F.min("mask").alias("mask"))
    nearest = per_depth.groupBy("image").agg(F.min(F.struct("depth", "n", "mask")).alias("_hit"))
    n = F.coalesce("_hit.n", F.lit(0).cast("bigint"))
    return images.join(nearest, "image", "left").select(
        *images.columns, F.when(n == 1, F.col("_hit.mask")).alias("mask"), n.alias("n_matches"), F.when(n > 1, "ambiguous_masks").alias("error"))


def mask_lookup_priority(images: DataFrame, masks: DataFrame, ignore_case: bool = True) -> DataFrame:
    """First mask by suffix order and then by sorted extension, in the mask folder next to the label folder."""
    parts = images.withColumns(split_path("image"))
    wanted = parts.select("image", F.col("_stem").alias("stem"), F.regexp_replace("_dir", "/?[^/]*$", "").alias("root"))
    found = wanted.join(mask_keys(masks, PRIORITY_SUFFIXES, ignore_case), ["root", "stem"])
    best = found.groupBy("image").agg(F.min(F.struct("suffix_no", "_ext", "mask")).alias("_hit"))
    return images.join(best, "image", "left").select(*images.columns, F.col("_hit.mask").alias("mask"))


def model_display_name(version: Column | str) -> Column:
    """Short name of a model version: the cold-start model's label or the milestone of a trained one."""
    version = F.col(version) if isinstance(version, str) else version
    return F.when(version == "pretrained", "预训练模型").otherwise(F.concat(F.lit("YOLO-v"), F.regexp_extract(version, "-seg-v([^-]+)", 1)))


def split_lookup_or_compute(rows: DataFrame, existing: DataFrame, fraction: float = 0.25, seed: object = 42) -> DataFrame:
    """Stored split, else the split the hash would give; nothing is written."""
    return sticky_split(rows, existing, fraction, seed).drop("is_new")
