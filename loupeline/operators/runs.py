"""Mask algebra on run tables ``(keys..., y, x0, x1)`` with inclusive ends.

One operator does the work: a sweep along each image row. Every run gives an opening and a closing event per layer,
and running sums of the events tell which layers cover each stretch. Intersections, unions, differences and
tolerance bands of any number of masks come out of a single shuffle. No pair of runs is ever formed,
so crowded rows cost ``n log n``, and runs of one layer may overlap.

Tables may also hold stacks, ``(keys..., y, y1, x0, x1)``: the same run on the rows y..y1. ``merge_runs``, ``confidence_map``, ``roi_clip`` and the
counts take them as they are and lay them out row by row only inside a task (``run_arrays``).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loupeline.session import sized

from loupeline.functions.decisions import METRIC_VERSION, TOLERANCE_PIXELS
from loupeline.operators import run_arrays as ra

RUN = ("y", "x0", "x1")


def length() -> Column:
    return F.col("x1") - F.col("x0") + 1


def sweep(layers: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Disjoint stretches ``(keys, y, x0, x1)`` with one boolean per layer telling whether it covers them."""
    def events(number, runs):
        ends = F.array(F.struct(F.col("x0").alias("x"), F.lit(1).alias("d")),
                       F.struct((F.col("x1") + 1).alias("x"), F.lit(-1).alias("d")))
        return runs.select(*keys, "y", F.lit(number).alias("_layer"), F.inline(ends))

    all_events = reduce(DataFrame.unionByName, [events(i, r) for i, r in enumerate(layers.values())])
    row = Window.partitionBy(*keys, "y").orderBy("x")  # default frame: peers at the same x count together
    covers = [(F.sum(F.when(F.col("_layer") == i, F.col("d")).otherwise(0)).over(row) > 0).alias(n) for i, n in enumerate(layers)]
    swept = all_events.select(*keys, "y", F.col("x").alias("x0"), (F.lead("x").over(row) - 1).alias("x1"), *covers)
    return swept.filter(F.col("x1") >= F.col("x0"))


def _ends(runs: DataFrame) -> str:
    """The columns y, x0, x1 of ``runs`` with their types."""
    return ", ".join(f"{c} {dict(runs.dtypes)[c]}" for c in RUN)


def merge_runs(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Disjoint, non-touching runs covering the same pixels. Whole bands of image rows are merged inside a task."""
    def merge(rows, first):
        y, y1, x0, x1 = ra.numbers(rows, "y", "y1", "x0", "x1")
        which, y = ra.laid_out(y, y1)
        unit, *ends = ra.merged(ra.units(rows, first)[which], y, x0[which], x1[which])
        return unit, ends

    return ra.per_image(ra.dealt(runs, keys), keys, merge, _ends(runs))


def stacks(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equal runs on consecutive rows as one rectangle ``(keys, x0, x1, y0, y1)``."""
    column = Window.partitionBy(*keys, "x0", "x1").orderBy("y")
    return runs.select(*keys, *RUN).withColumn("_stack", F.col("y") - F.dense_rank().over(column)).groupBy(
        *keys, "x0", "x1", "_stack").agg(F.min("y").alias("y0"), F.max("y").alias("y1")).drop("_stack")


def spread(runs: DataFrame, keys: Sequence[str], radius: int, height: Column | int, width: Column | int) -> DataFrame:
    """Square dilation as overlapping runs: wider by ``radius`` and repeated on the neighbouring rows.

    Stacked runs are spread together: a stack of h rows gives h + 2 radius rows instead of h (2 radius + 1).
    """
    height, width = [c if isinstance(c, Column) else F.lit(c) for c in (height, width)]
    rows = F.sequence(F.greatest(F.col("y0") - radius, F.lit(0)), F.least(F.col("y1") + radius, height - 1))
    return stacks(runs, keys).select(*keys, F.explode(rows).alias("y"), F.greatest(F.col("x0") - radius, F.lit(0)).alias("x0"),
                                     F.least(F.col("x1") + radius, width - 1).alias("x1"))


def dilate_runs(runs: DataFrame, keys: Sequence[str], radius: int, height, width) -> DataFrame:
    return merge_runs(spread(runs, keys, radius, height, width), keys)


def mask_area(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pixels of disjoint runs."""
    return runs.groupBy(*keys).agg(F.sum(length()).alias("area"))


def mask_intersection(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pixel counts of two masks, their intersection and union, per key."""
    swept = sweep({"a": a, "b": b}, keys)

    def pixels(condition):
        return F.coalesce(F.sum(F.when(condition, length())), F.lit(0)).cast("bigint")

    return swept.groupBy(*keys).agg(pixels(F.col("a")).alias("area_a"), pixels(F.col("b")).alias("area_b"),
                                    pixels(F.col("a") & F.col("b")).alias("intersection")).withColumn(
        "union", F.col("area_a") + F.col("area_b") - F.col("intersection"))


def roi_clip(runs: DataFrame, roi: DataFrame, category: str = "category", keep_unlisted: bool = True) -> DataFrame:
    """Runs cut to the ROI of their category; categories without an ROI pass through when ``keep_unlisted``.

    ROI tables hold one image per category. Its pieces are stored per image row, so one join on (category, y) brings them to the
    runs: a table of this size is broadcast by its known size and the runs are not shuffled at all. A category without
    an ROI is recognised by a second such join, on the list of categories that have one. Stacks are cut by the stacks of the ROI in
    the same way, a block of ``ROI_BLOCK`` rows at a time.
    """
    if "y1" in runs.columns:
        return _clip_stacks(runs, roi, category, keep_unlisted)
    pieces = roi.select(category, "y", F.struct(F.col("x0").alias("r0"), F.col("x1").alias("r1")).alias("r"))
    shape = sized(pieces.groupBy(category, "y").agg(F.collect_set("r").alias("_pieces")), "roi-rows")
    listed = sized(roi.select(category).distinct().withColumn("_listed", F.lit(True)), "roi-categories")
    whole = F.struct(F.col("x0").alias("r0"), F.col("x1").alias("r1"))
    met = F.filter(F.coalesce("_pieces", F.array().cast("array<struct<r0:int,r1:int>>")), lambda p: (p["r0"] <= F.col("x1")) & (F.col("x0") <= p["r1"]))
    chosen = F.when(F.col("_listed"), met)
    if keep_unlisted:
        chosen = chosen.otherwise(F.array(whole.cast("struct<r0:int,r1:int>")))
    cut = runs.join(listed, category, "left").join(shape, [category, "y"], "left").withColumn("_p", F.explode(chosen))
    return cut.withColumns({"x0": F.greatest("x0", "_p.r0"), "x1": F.least("x1", "_p.r1")}).drop("_listed", "_pieces", "_p").select(*runs.columns)


ROI_BLOCK = 64


def _clip_stacks(runs: DataFrame, roi: DataFrame, category: str, keep_unlisted: bool) -> DataFrame:
    kinds, block = dict(runs.dtypes), F.lit(ROI_BLOCK)

    def blocks(y0, y1):
        return F.explode(F.sequence(F.floor(F.col(y0) / block), F.floor(F.col(y1) / block)))

    piece = F.struct(F.col("x0").alias("r0"), F.col("x1").alias("r1"), F.col("y0").alias("t0"), F.col("y1").alias("t1"))
    cut = stacks(roi, [category]).withColumn("_block", blocks("y0", "y1")).withColumns(
        {"y0": F.greatest(F.col("y0"), F.col("_block") * block), "y1": F.least(F.col("y1"), F.col("_block") * block + (block - 1))})
    shape = sized(cut.groupBy(category, "_block").agg(F.collect_set(piece).alias("_pieces")), "roi-blocks")
    listed = sized(roi.select(category).distinct().withColumn("_listed", F.lit(True)), "roi-categories")
    placed = runs.withColumn("_block", blocks("y", "y1")).join(listed, category, "left").join(shape, [category, "_block"], "left")
    met = F.filter("_pieces", lambda p: (p["r0"] <= F.col("x1")) & (F.col("x0") <= p["r1"]) & (p["t0"] <= F.col("y1")) & (F.col("y") <= p["t1"]))
    kind = dict(shape.dtypes)["_pieces"]
    whole = F.array(F.struct(F.col("x0").alias("r0"), F.col("x1").alias("r1"), F.greatest(F.col("y"), F.col("_block") * block).alias("t0"),
                             F.least(F.col("y1"), F.col("_block") * block + (block - 1)).alias("t1")).cast(kind[6:-1]))
    chosen = F.when(F.col("_listed"), F.coalesce(met, F.array().cast(kind)))
    placed = placed.withColumn("_p", F.explode(chosen.otherwise(whole) if keep_unlisted else chosen))
    ends = {"x0": F.greatest("x0", "_p.r0"), "x1": F.least("x1", "_p.r1"), "y": F.greatest("y", "_p.t0"), "y1": F.least("y1", "_p.t1")}
    return placed.withColumns({c: e.cast(kinds[c]) for c, e in ends.items()}).select(*runs.columns)


def overlap_counts(gt: DataFrame, predictions: dict[str, DataFrame], keys: Sequence[str], height, width,
                   radius: int = TOLERANCE_PIXELS) -> DataFrame:
    """All pixel counts of every prediction against the ground truth, from one sweep.

    Per prediction ``p``: ``p_intersection, p_union, p_pixels, p_matched`` (ground truth within the tolerance of the
    prediction) and ``p_total`` (area plus excess, the excess capped at the area of this image).
    """
    marked = [layer.select(*keys, "y", (F.col("y1") if "y1" in layer.columns else F.col("y")).alias("y1"), "x0", "x1", F.lit(1 << i).alias("layers"))
              for i, layer in enumerate([gt, *predictions.values()])]
    return layer_counts(reduce(DataFrame.unionByName, marked), list(predictions), keys, height, width, radius)


def layer_counts(marked: DataFrame, names: Sequence[str], keys: Sequence[str], height, width, radius: int = TOLERANCE_PIXELS) -> DataFrame:
    """``overlap_counts`` of one table of runs or stacks: bit 0 of ``layers`` marks ground truth, bit i the prediction ``names[i - 1]``.

    A run that several predictions share is shuffled once. Every stack goes to all bands of image rows that its tolerance meets.
    """
    names = list(names)
    last = (F.col("y1") if "y1" in marked.columns else F.col("y")).cast("bigint")
    height, width = [c if isinstance(c, Column) else F.lit(c) for c in (height, width)]
    low, high = F.greatest(F.col("y") - radius, F.lit(0)), F.least(last + radius, height - 1)
    wide = marked.withColumns({"_s0": low.cast("bigint"), "_s1": high.cast("bigint"), "_w0": F.greatest(F.col("x0") - radius, F.lit(0)).cast("bigint"),
                               "_w1": F.least(F.col("x1") + radius, width - 1).cast("bigint")})
    placed = ra.dealt(wide, keys, ["layers", "_s0", "_s1", "_w0", "_w1"], reach=(F.least(F.col("y").cast("bigint"), "_s0"), F.greatest(last, "_s1")))
    shown = ["gt_pixels", *(f"{n}_{c}" for n in names for c in ("intersection", "pixels", "matched", "excess"))]
    band, bits = ra.BAND, (4 * (len(names) + 1) - 1).bit_length()

    def count(rows, first):
        y, y1, x0, x1, s0, s1, w0, w1, layers, top = ra.numbers(rows, "y", "y1", "x0", "x1", "_s0", "_s1", "_w0", "_w1", "layers", "_band")
        unit, top = ra.units(rows, first), top * band
        parts = []  # runs (unit, y, x0, x1, layer) of the masks themselves (even layers) and of what is near them (odd ones)
        for low, high, a, b, near in ((y, y1, x0, x1, 0), (s0, s1, w0, w1, 1)):
            which, row = ra.laid_out(np.maximum(low, top), np.minimum(high, top + (band - 1)))
            for i in range(len(names) + 1):
                own = (layers[which] >> i & 1).astype(bool) & (a[which] <= b[which])
                parts.append((unit[which[own]], row[own], a[which[own]], b[which[own]], 2 * i + near))
        held = [np.concatenate([p[i] for p in parts]) for i in range(4)]
        if not len(held[0]):
            return np.zeros(0, np.int64), [np.zeros(0, np.int64) for _ in shown]
        rows = ra.Rows(*held)
        events = np.sort(np.concatenate([((rows.place(u, r, end) + d) << bits) | (2 * layer + d) for u, r, a, b, layer in parts for d, end in ((0, a), (1, b))]))
        place, code = events >> bits, events & ((1 << bits) - 1)
        length, owner = np.diff(place, append=place[-1:]), place // (rows.span * rows.height)
        covers = [np.cumsum((code == 2 * layer).astype(np.int64) - (code == 2 * layer + 1)) > 0 for layer in range(2 * len(names) + 2)]

        def pixels(condition):
            return np.bincount(owner, weights=length * condition, minlength=len(first)).astype(np.int64)

        gt, near_gt = covers[:2]
        out = [pixels(gt)]
        for i in range(len(names)):
            p, near = covers[2 * i + 2:2 * i + 4]
            out += [pixels(gt & p), pixels(p), pixels(gt & near), pixels(p & ~near_gt)]
        return np.arange(len(first)), out

    out = ra.per_image(placed, keys, count, ", ".join(f"{c} bigint" for c in shown)).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in shown])
    for n in names:
        out = out.withColumns({
            f"{n}_union": F.col("gt_pixels") + F.col(f"{n}_pixels") - F.col(f"{n}_intersection"),
            f"{n}_total": F.col("gt_pixels") + F.least(F.col(f"{n}_excess"), F.col("gt_pixels"))}).drop(f"{n}_excess")
    return out


def tolerant_counts(gt: DataFrame, prediction: DataFrame, keys: Sequence[str], height, width,
                    radius: int = TOLERANCE_PIXELS) -> DataFrame:
    counts = overlap_counts(gt, {"p": prediction}, keys, height, width, radius).filter("gt_pixels > 0")
    return counts.select(*keys, F.col("p_matched").alias("tolerant_matched_pixels"),
                         F.col("p_total").alias("tolerant_total_pixels"))


def gt_status(truth: Column, mask_found: Column, mask_readable: Column, mask_valid: Column, clipped_pixels: Column) -> Column:
    """Ground-truth ladder of an image, first failing step wins."""
    return (F.when(truth != "NG", "not_required").when(~mask_found, "missing_gt").when(~mask_readable, "unreadable_gt")
             .when(~mask_valid, "invalid_gt").when(F.coalesce(clipped_pixels, F.lit(0)) == 0, "outside_roi").otherwise("valid"))


def metric_label(truth: Column, status: Column, has_roi: Column) -> Column:
    """OK/NG, EXCLUDED outside the ROI; an unusable ground truth is INVALID_GT only where an ROI exists."""
    return (F.when(status == "outside_roi", "EXCLUDED")
             .when(status.isin("missing_gt", "unreadable_gt", "invalid_gt") & has_roi, "INVALID_GT").otherwise(truth))


def metric_rows(samples: DataFrame, counts: DataFrame, name: str, on: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Per-image rows of one prediction layer: status, label, counts that exist only where the ground truth is valid.

    ``samples`` needs truth, predicted_ng, mask_found, mask_readable, mask_valid, has_roi, prediction_found.
    """
    joined = samples.join(counts, list(on), "left")
    status = gt_status(F.col("truth"), F.col("mask_found"), F.col("mask_readable"), F.col("mask_valid"), F.col("gt_pixels"))
    rows = joined.withColumn("_status", status).withColumn("label", metric_label(F.col("truth"), F.col("_status"), F.col("has_roi")))
    valid = F.col("_status") == "valid"
    shown = F.col("predicted_ng") & F.col("prediction_found")  # without a mask the prediction is empty
    zero, gt = F.lit(0).cast("bigint"), F.col("gt_pixels")

    def count(column, absent):
        return F.when(valid, F.when(shown, F.coalesce(F.col(f"{name}_{column}"), absent)).otherwise(absent))

    rows = rows.withColumns({
        "intersection": count("intersection", zero), "union": count("union", gt), "predicted_pixels": count("pixels", zero),
        "tolerant_matched_pixels": count("matched", zero), "tolerant_total_pixels": count("total", gt),
        "gt_pixels": F.when(valid, gt), "tolerance_pixels": F.when(valid, F.lit(TOLERANCE_PIXELS)),
        "metric_version": F.when(valid, F.lit(METRIC_VERSION))})
    lost = valid & F.col("predicted_ng") & ~F.col("prediction_found")
    return rows.withColumns({
        "iou": F.col("intersection").cast("double") / F.col("union"),
        "tolerant_agreement": F.col("tolerant_matched_pixels").cast("double") / F.col("tolerant_total_pixels"),
        "gt_status": F.when(lost, "missing_prediction").otherwise(F.col("_status"))}).select(
        *samples.columns, "label", "gt_status", "intersection", "union", "gt_pixels", "predicted_pixels", "iou",
        "tolerant_matched_pixels", "tolerant_total_pixels", "tolerant_agreement", "tolerance_pixels", "metric_version")


def confidence_map(instances: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Highest instance confidence per stretch ``(keys, y, x0, x1, conf)``.

    Whole bands of image rows are painted inside a task, from the lowest confidence to the highest.
    """
    known = instances.filter(F.col("conf").isNotNull())

    def paint(rows, first):
        unit, y, x0, x1, conf = paint_top(rows, first)
        return unit, [y, x0, x1, conf]

    return ra.per_image(ra.dealt(known, keys, ["conf"]), keys, paint, f"{_ends(instances)}, conf double")


def paint_top(rows: pa.Table, first: np.ndarray, value: str = "conf") -> tuple[np.ndarray, ...]:
    """Stretches (unit, y, x0, x1) in their order with the highest value on each."""
    y, y1, x0, x1 = ra.numbers(rows, "y", "y1", "x0", "x1")
    levels, rank = np.unique(rows.column(value).to_numpy(), return_inverse=True)  # NaN counts as the highest, as in Spark
    which, y = ra.laid_out(y, y1)
    placed, places, top = ra.painted(ra.units(rows, first)[which], y, x0[which], x1[which], rank[which])
    shown = np.flatnonzero(top >= 0)
    unit, y, x0 = placed.back(places[shown])
    return unit, y, x0, x0 + places[shown + 1] - places[shown] - 1, levels[top[shown]]


def conf_grid() -> list[float]:
    """The 104 confidences of the mask calibration: hundredths with finer steps at both ends."""
    return [0.001, 0.002, 0.005] + [i / 100 for i in range(1, 100)] + [0.995, 0.999]


def mask_conf_curve(gt: DataFrame, instances: DataFrame, keys: Sequence[str], sample: str, roi: DataFrame | None = None, category: str = "category") -> DataFrame:
    """Mean IoU of the kept instances against the ground truth at every grid confidence.

    Per image the IoU changes only at its own confidences: stretches are summed per step of the grid and suffix sums over those few values give
    spans of grid points with one IoU. Both happen in the task that holds the image, band by band, so what is shuffled after it is a row per
    category and span, not per image. Grid points above an image's top confidence have IoU 0, so they only count in the denominator. With an ``roi``
    both masks are cut to it first; an image whose ground truth lies outside stays in the mean with IoU 0. ``instances`` and ``gt`` are runs or
    stacks that may overlap.
    """
    ids, grid = [sample, *keys], np.array(conf_grid())  # sorted by the sample first: most rows differ in it
    listed, kinds = gt.select(*ids).distinct(), len(grid) + 1
    if roi is not None:
        gt, instances = roi_clip(gt, roi, category), roi_clip(instances, roi, category)

    def side(runs, conf):
        return runs.select(*ids, "y", (F.col("y1") if "y1" in runs.columns else F.col("y")).alias("y1"), "x0", "x1", conf.alias("conf"))

    # ground truth goes without a confidence
    both = side(instances.filter("conf is not null"), F.col("conf")).unionByName(side(gt, F.lit(None).cast("double")))

    def count(rows, first):
        """Per band and step (the number of grid points up to the highest confidence): pixels and hits; at step 0 the ground truth's area."""
        y, y1, x0, x1 = ra.numbers(rows, "y", "y1", "x0", "x1")
        truth = rows.column("conf").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        step = np.searchsorted(grid, pc.fill_null(rows.column("conf"), 0.0).to_numpy(), side="right")  # NaN counts as the highest, as in Spark
        which, y = ra.laid_out(y, y1)
        unit, a, b, truth, step = ra.units(rows, first)[which], x0[which], x1[which], truth[which], step[which]
        placed, places, top = ra.painted(unit, y, a, b, np.where(truth, 0, step))
        opened, closed = [np.bincount(np.searchsorted(places, end[truth]), minlength=len(places)) for end in (placed.place(unit, y, a), placed.place(unit, y, b) + 1)]
        inside, length = np.cumsum(opened - closed) > 0, np.diff(places, append=places[-1:])
        owner = places // (placed.span * placed.height)
        found, at = np.unique(owner * kinds + np.maximum(top, 0), return_inverse=True)  # 0: no instance
        pixels, hits = [np.bincount(at, weights=length * c, minlength=len(found)).astype(np.int64) for c in (np.ones(len(places)), inside)]
        area = np.bincount(owner, weights=length * inside, minlength=len(first)).astype(np.int64)
        held, some = found % kinds > 0, np.flatnonzero(area > 0)
        # in the order of units, so that the rows of an image stay side by side
        unit = np.append((found // kinds)[held], some)
        order = np.argsort(unit, kind="stable")
        none = np.zeros(len(some), np.int64)
        return unit[order], [np.append(c, d)[order] for c, d in (((found % kinds)[held], none), (pixels[held], area[some]), (hits[held], none))]

    def spans(rows, first):
        """Sums of the IoU over the images of a category that keep one value on the grid points ``low`` to ``high`` - 1."""
        image, (step, pixels, hits) = ra.units(rows, first), ra.numbers(rows, "step", "pixels", "hits")
        area = np.bincount(image, weights=np.where(step == 0, pixels, 0), minlength=len(first))
        held = (step > 0) & (area[image] > 0)
        if not held.any():
            return np.zeros(0, np.int64), [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        found, at = np.unique(image[held] * kinds + (kinds - 1 - step[held]), return_inverse=True)  # highest step first, bands added up
        owner, high = found // kinds, kinds - 1 - found % kinds
        new = np.append(True, owner[1:] != owner[:-1])
        low = np.append(np.where(new[1:], 0, high[1:]), 0)

        def from_top(values):
            each = np.bincount(at, weights=values[held]).astype(np.int64)
            total = np.cumsum(each)
            return total - (total - each)[new][np.cumsum(new) - 1]

        pixels, hits = from_top(pixels), from_top(hits)
        leads, group = rows.take(pa.array(first)), np.zeros(len(first), np.int64)
        for name in keys:
            own = ra.codes(leads, name)
            group = np.unique(group * (len(leads) + 1) + own, return_inverse=True)[1]
        found, at = np.unique((group[owner] * kinds + low) * kinds + high, return_inverse=True)
        return np.unique(group, return_index=True)[1][found // kinds ** 2], [found // kinds % kinds, found % kinds, np.bincount(at, weights=hits / (area[owner] + pixels - hits))]

    placed = ra.dealt(both, ids, ["conf"], together=True)
    sums = ra.per_image(placed, ids, count, "step int, pixels bigint, hits bigint", (spans, "low int, high int, iou double")).groupBy(*keys, "low", "high").agg(
        F.sum("iou").alias("iou"))
    points = sums.select(*keys, "iou", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("_at")).groupBy(*keys, "_at").agg(F.sum("iou").alias("iou_sum"))
    images = listed.groupBy(*keys).agg(F.count(F.lit(1)).alias("images")).select("*", F.posexplode(F.array(*[F.lit(g) for g in conf_grid()])).alias("_at", "conf"))
    return images.join(points, [*keys, "_at"], "left").select(
        *keys, "conf", (F.coalesce("iou_sum", F.lit(0.0)) / F.col("images")).alias("mean_iou"))


def pixels_to_runs(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Foreground pixels ``(keys, y, x)`` to maximal runs by gaps and islands inside one image row."""
    row = Window.partitionBy(*keys, "y").orderBy("x")
    return pixels.withColumn("_island", F.col("x") - F.row_number().over(row)).groupBy(*keys, "y", "_island").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1")).drop("_island")


def raster_to_runs(rasters: DataFrame, key: str, raster: str, width: int | str, background: str = r"\x00-\x7f") -> DataFrame:
    """Row-major rasters held as strings to runs of foreground, without a row per pixel.

    The raster is cut where foreground meets background; running lengths place the pieces and each foreground piece
    is laid over the image rows it spans. ``width`` is a number or a column; ``background`` is the character class of
    background values.
    """
    rasters, width = rasters.withColumn("_width", F.col(width) if isinstance(width, str) else F.lit(width)), F.col("_width")
    edge = f"(?<=[{background}])(?=[^{background}])|(?<=[^{background}])(?=[{background}])"
    pieces = rasters.select(key, "_width", F.posexplode(F.split(raster, edge)).alias("_i", "_piece"))
    until = Window.partitionBy(key).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.select(key, "_width", "_piece", F.length("_piece").cast("bigint").alias("_n"),
                           F.sum(F.length("_piece")).over(until).alias("_end"))
    start, last = F.col("_end") - F.col("_n"), F.col("_end") - 1
    lit = placed.filter((F.col("_n") > 0) & F.rlike("_piece", F.lit(f"^[^{background}]"))).select(
        key, "_width", start.alias("_start"), last.alias("_last"),
        F.explode(F.sequence(F.floor(start / width), F.floor(last / width))).alias("y"))
    base = F.col("y") * width
    return lit.select(key, "y", (F.greatest(F.col("_start"), base) - base).alias("x0"),
                      (F.least(F.col("_last"), base + width - 1) - base).alias("x1"))


def roi_bbox(roi: DataFrame, category: str = "category") -> DataFrame:
    """Bounding box with exclusive maxima."""
    return roi.groupBy(category).agg(F.min("x0").alias("bx0"), F.min("y").alias("by0"), (F.max("x1") + 1).alias("bx1"),
                                     (F.max("y") + 1).alias("by1"))


def roi_bbox_crop(runs: DataFrame, roi: DataFrame, category: str = "category") -> DataFrame:
    """Runs cut to the ROI and shifted into the coordinates of its bounding box."""
    inside = roi_clip(runs, roi, category, keep_unlisted=False).join(roi_bbox(roi, category), category)
    return inside.withColumns({"y": F.col("y") - F.col("by0"), "x0": F.col("x0") - F.col("bx0"),
                               "x1": F.col("x1") - F.col("bx0")}).drop("bx0", "by0", "bx1", "by1")


def roi_rescale_nearest(roi: DataFrame, sizes: DataFrame, category: str = "category") -> DataFrame:
    """ROI runs at another size: target pixel x shows source pixel floor(x * src_width / width), rows likewise.

    A source run [a, b] therefore shows at targets ceil(a * width / src_width) .. ceil((b + 1) * width / src_width) - 1.
    ``sizes`` has src_height, src_width, height, width per category.
    """
    def first(position, size, source):
        return F.ceil(position * F.col(size) / F.col(source)).cast("int")

    placed = roi.join(sizes, category)
    rows = F.sequence(first(F.col("y"), "height", "src_height"), first(F.col("y") + 1, "height", "src_height") - 1)
    some = first(F.col("y") + 1, "height", "src_height") > first(F.col("y"), "height", "src_height")
    out = placed.filter(some).select(category, F.explode(rows).alias("y"), first(F.col("x0"), "width", "src_width").alias("x0"),
                                     (first(F.col("x1") + 1, "width", "src_width") - 1).alias("x1"))
    return out.filter(F.col("x1") >= F.col("x0"))
