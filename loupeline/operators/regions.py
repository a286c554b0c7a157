"""Connected components of run tables and the region statistics built on them."""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loupeline.operators import run_arrays as ra
from loupeline.operators.review import region_topk
from loupeline.operators.runs import RUN, length, merge_runs, paint_top, roi_clip
from loupeline.session import written


def _label(image_id: np.ndarray, y: np.ndarray, x0: np.ndarray, x1: np.ndarray) -> np.ndarray:
    """Component number (1.. per image, in scan order) of disjoint runs sorted by image, y, x0; 8-connectivity."""
    n, span = len(y), int(x1.max()) + 4
    image = np.unique(image_id, return_inverse=True)[1].astype(np.int64)
    row = image * (int(y.max()) + 3) + y
    starts, ends = row * span + x0 + 1, row * span + x1 + 1
    below = (row + 1) * span
    low = np.searchsorted(ends, below + x0, side="left")
    high = np.searchsorted(starts, below + x1 + 2, side="right")
    counts = np.maximum(high - low, 0)
    beside = np.flatnonzero(starts[1:] == ends[:-1] + 1)  # runs that touch inside one row
    a = np.concatenate((np.repeat(np.arange(n), counts), beside))
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    b = np.concatenate((np.repeat(low - first, counts) + np.arange(counts.sum()), beside + 1))
    label = np.arange(n)
    while True:
        lowest = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, lowest)
        np.minimum.at(new, b, lowest)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    root = label == np.arange(n)
    order = np.cumsum(root)
    starts_image = np.concatenate(([True], image[1:] != image[:-1]))
    offset = np.maximum.accumulate(np.where(starts_image, order - root, 0))
    return order[label] - offset


def connected_components(runs: DataFrame, sample: str, carry: Sequence[str] = (), disjoint: bool = False) -> DataFrame:
    """Runs with ``label``. Spark groups and sorts the images; each task labels complete images batch by batch.

    ``disjoint`` runs (they may touch) are labelled as they are and keep their ``carry`` columns; others, runs or stacks, are merged in the same task first.
    One image is bounded by its pixels. An image cut by an Arrow batch waits for its remaining rows. The shuffle key
    is a hash of the image id: a plain ``repartition(sample)`` is dropped when the input already has that partitioning,
    and adaptive execution may then change the input's partitioning under the Python stage.
    """
    columns = [sample, "y", "x0", "x1"]
    if not disjoint:
        return _merged_components(runs, sample)
    placed = runs.select(*columns, *carry).repartition(F.xxhash64(sample)).sortWithinPartitions(sample, "y", "x0")

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for batch in batches:
            frame = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            if frame.empty:
                continue
            open_image = (frame[sample] == frame[sample].iloc[-1]).to_numpy()
            waiting, done = frame[open_image], frame[~open_image]
            if len(done):
                yield done.assign(label=_label(*[done[c].to_numpy() for c in columns]))
        if waiting is not None and len(waiting):
            yield waiting.assign(label=_label(*[waiting[c].to_numpy() for c in columns]))

    schema = ", ".join(f"{name} {kind}" for name, kind in placed.dtypes)
    return placed.mapInPandas(label, f"{schema}, label bigint")


def _merged_components(runs: DataFrame, sample: str) -> DataFrame:
    def merge_and_label(rows, first):
        y, y1, x0, x1 = ra.numbers(rows, "y", "y1", "x0", "x1")
        which, y = ra.laid_out(y, y1)
        unit, *ends = ra.merged(ra.units(rows, first)[which], y, x0[which], x1[which])
        return unit, [*ends, _label(unit, *ends)]

    kinds = dict(runs.dtypes)
    return ra.per_image(ra.dealt(runs, [sample], band=None), [sample], merge_and_label, ", ".join(f"{c} {kinds[c]}" for c in RUN) + ", label bigint")


def labelled_heat(instances: DataFrame, sample: str) -> DataFrame:
    """Heat of instances (runs or stacks with ``value``, which may overlap; the highest counts) as disjoint stretches with ``value`` and ``label``.

    Painting and labelling are one pass over complete images, so only the instances are shuffled.
    """
    def paint_and_label(rows, first):
        unit, y, x0, x1, value = paint_top(rows, first, "value")
        return unit, [y, x0, x1, value, _label(unit, y, x0, x1)]

    kinds = dict(instances.dtypes)
    placed = ra.dealt(instances.filter("value is not null"), [sample], ["value"], band=None)
    return ra.per_image(placed, [sample], paint_and_label, ", ".join(f"{c} {kinds[c]}" for c in RUN) + ", value double, label bigint")


def region_boxes(labelled: DataFrame, sample: str) -> DataFrame:
    """Area and bounding box (exclusive maxima) per component."""
    return labelled.groupBy(sample, "label").agg(
        F.sum(length()).cast("bigint").alias("area"), F.min("x0").alias("bx0"), F.min("y").alias("by0"),
        (F.max("x1") + 1).alias("bx1"), (F.max("y") + 1).alias("by1"))


def heat_components(heat: DataFrame, sample: str, overlapping: bool) -> DataFrame:
    """Labelled stretches of thresholded heat: disjoint runs as they are, or instances that overlap."""
    return labelled_heat(heat, sample) if overlapping else connected_components(heat, sample, carry=["value"], disjoint=True)


def region_stats(heat: DataFrame, sample: str, overlapping: bool = False) -> DataFrame:
    """Area, box, peak and mean heat of the connected regions of thresholded heat runs (sample, y, x0, x1, value).

    Heat stretches are labelled themselves and keep their value, so statistics need no join back to the heat. ``overlapping`` heat is
    instances whose highest value counts: a threshold on the heat keeps the same pixels as one on the instances.
    """
    labelled = heat_components(heat, sample, overlapping)
    return labelled.groupBy(sample, "label").agg(
        F.sum(length()).cast("bigint").alias("area"), F.max("value").alias("peak"),
        (F.sum(F.col("value") * length()) / F.sum(length())).alias("mean"), F.min("x0").alias("bx0"), F.min("y").alias("by0"),
        (F.max("x1") + 1).alias("bx1"), (F.max("y") + 1).alias("by1"))


def above_peak(heat: DataFrame, sample: str, pixel_threshold: float, peak_fraction: float) -> DataFrame:
    """Heat reaching max(absolute threshold, fraction of the image's peak), with ``threshold_used``; one image per window."""
    peak = F.max("value").over(Window.partitionBy(sample))
    used = F.greatest(F.lit(float(pixel_threshold)), F.lit(float(peak_fraction)) * peak)
    return heat.withColumn("threshold_used", used).filter(F.col("value") >= F.col("threshold_used"))


def hybrid_regions(heat: DataFrame, sample: str, pixel_threshold: float, peak_fraction: float = 0.7, min_area: int = 128,
                   max_regions: int = 3, overlapping: bool = False) -> DataFrame:
    """Regions above the hybrid threshold, the largest peaks kept and ranked. ``heat`` holds valid (in-ROI) stretches only.

    The hottest stretch is always kept, so each image's first-ranked peak gives its threshold back without a second pass.
    """
    stats = region_stats(above_peak(heat, sample, pixel_threshold, peak_fraction), sample, overlapping)
    top = F.max("peak").over(Window.partitionBy(sample))
    used = F.greatest(F.lit(float(pixel_threshold)), F.lit(float(peak_fraction)) * top)
    return region_topk(stats.withColumn("threshold_used", used), sample, min_area, max_regions)


def hybrid_region_mask(heat: DataFrame, sample: str, pixel_threshold: float, peak_fraction: float = 0.7, min_area: int = 128,
                       max_regions: int = 3, overlapping: bool = False) -> DataFrame:
    """Mask of the regions that ``hybrid_regions`` keeps, as disjoint runs. Regions are labelled once; the kept labels of an image are few."""
    labelled = written(heat_components(above_peak(heat, sample, pixel_threshold, peak_fraction), sample, overlapping), "labelled-heat")
    stats = labelled.groupBy(sample, "label").agg(F.sum(length()).cast("bigint").alias("area"), F.max("value").alias("peak"))
    kept = region_topk(stats, sample, min_area, max_regions).select(sample, "label")
    return merge_runs(labelled.join(kept, [sample, "label"]).select(sample, "y", "x0", "x1"), [sample])


def component_boxes(labelled: DataFrame, sample: str, height: int, width: int) -> DataFrame:
    """One box per component with corners on the 0..1 image scale, clipped."""
    def unit(value, size):
        return F.least(F.greatest(value / F.lit(max(1, size - 1)).cast("double"), F.lit(0.0)), F.lit(1.0))

    return region_boxes(labelled, sample).select(
        sample, "label", unit(F.col("bx0"), width).alias("left"), unit(F.col("by0"), height).alias("top"),
        unit(F.col("bx1"), width).alias("right"), unit(F.col("by1"), height).alias("bottom"))


def label_text(boxes: DataFrame, sample: str) -> DataFrame:
    """Label file of an image as text: a line per component in the order of its labels, class 0 and the corners of its box."""
    left, top, right, bottom = [F.col(c) for c in ("left", "top", "right", "bottom")]
    line = F.format_string("0" + " %.6f" * 8, left, top, right, top, right, bottom, left, bottom)
    lines = F.array_sort(F.collect_list(F.struct("label", line.alias("line"))))  # the components of one image
    return boxes.groupBy(sample).agg(F.array_join(F.transform(lines, lambda x: x["line"]), "\n").alias("labels"))


def heat_floor(heat: DataFrame, sample: str) -> DataFrame:
    """Heat outside the ROI set to the image's lowest valid heat."""
    lowest = F.min(F.when(F.col("valid"), F.col("value"))).over(Window.partitionBy(sample))
    return heat.withColumn("value", F.when(F.col("valid"), F.col("value")).otherwise(lowest))


def instance_roi_filter(instances: DataFrame, roi: DataFrame, keys: Sequence[str], category: str = "category") -> DataFrame:
    """Instance runs cut to the ROI; instances that never touch it disappear."""
    return roi_clip(instances, roi, category).select(*instances.columns)
