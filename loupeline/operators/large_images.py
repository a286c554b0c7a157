"""Connected components of images that no single task could hold: tiles are labelled locally, and only their borders meet.

An image is cut into tiles. Every tile is labelled on its own; a component of a tile goes by its first pixel in scan order. Pieces at tile
borders are joined with their neighbours across the border, which gives links between tile components. Links are contracted by
alternating stars, one table on shared storage per round, until every component knows the first pixel of its whole; labels are
the ranks of these pixels. No step groups by image.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loupeline.operators.ordering import rank_within
from loupeline.operators.regions import connected_components
from loupeline.operators.runs import merge_runs
from loupeline.session import written

CELL = 64  # columns per join cell on a border row


def _pixel(y, x) -> Column:
    """A pixel's place in scan order as one number."""
    return F.shiftleft(F.col(y).cast("bigint"), 32) + F.col(x)


def star_contraction(links: DataFrame, group: Sequence[str]) -> DataFrame:
    """``(group, node, root)`` for every linked node of ``links`` (group, u, v): the smallest node it reaches inside its group."""
    group = list(group)
    now = written(links.select(*group, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "links")
    seen = None
    while True:
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*group, "u", "v"))).first())
        if not state[0] or state == seen:
            break
        seen = state
        both = now.unionByName(now.select(*group, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*group, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, [*group, "u"]).where("v > u and v <> m").select(*group, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(*group, "u").agg(F.min("v").alias("m"))
        down = large.join(least, [*group, "u"]).where("v <> m").select(*group, F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(down.unionByName(least.select(*group, "u", F.col("m").alias("v"))).distinct(), "links")
    return now.groupBy(*group, F.col("u").alias("node")).agg(F.min("v").alias("root"))


def tiles(runs: DataFrame, height: int, width: int) -> DataFrame:
    """Runs cut at tile columns: ``_t`` numbers the tile, ``px0, px1`` are the piece's ends."""
    first, last = F.floor(F.col("x0") / width), F.floor(F.col("x1") / width)
    cut = runs.withColumn("_tx", F.explode(F.sequence(first, last))).withColumn("_ty", F.floor(F.col("y") / height))
    return cut.withColumns({"px0": F.greatest("x0", (F.col("_tx") * width).cast("int")), "px1": F.least("x1", ((F.col("_tx") + 1) * width - 1).cast("int"))})


def _across_rows(pieces: DataFrame, sample: str, height: int) -> DataFrame:
    """Links of tile components over a horizontal border; 8-connected pieces meet in a cell of columns."""
    def cells(rows: DataFrame, low: Column, high: Column) -> DataFrame:
        return rows.withColumn("_cell", F.explode(F.sequence(F.floor(low / CELL), F.floor(high / CELL))))

    above = pieces.where(F.col("y") % height == height - 1).select(sample, F.col("y"), F.col("px0").alias("a0"), F.col("px1").alias("a1"), F.col("node").alias("u"))
    below = pieces.where((F.col("y") % height == 0) & (F.col("y") > 0)).select(sample, (F.col("y") - 1).alias("y"), F.col("px0").alias("b0"), F.col("px1").alias("b1"), F.col("node").alias("v"))
    met = cells(above, F.greatest(F.col("a0") - 1, F.lit(0)), F.col("a1") + 1).join(cells(below, F.col("b0"), F.col("b1")), [sample, "y", "_cell"])
    return met.where("a0 <= b1 + 1 and b0 <= a1 + 1").select(sample, "u", "v")


def _across_columns(pieces: DataFrame, sample: str, width: int) -> DataFrame:
    """Links of tile components over a vertical border, also to the rows above and below."""
    left = pieces.where(F.col("px1") % width == width - 1).select(sample, (F.col("px1") + 1).alias("x"), F.explode(F.sequence(F.col("y") - 1, F.col("y") + 1)).alias("y"), F.col("node").alias("u"))
    right = pieces.where((F.col("px0") % width == 0) & (F.col("px0") > 0)).select(sample, F.col("px0").alias("x"), "y", F.col("node").alias("v"))
    return left.join(right, [sample, "x", "y"]).select(sample, "u", "v")


def connected_components_tiled(runs: DataFrame, sample: str, height: int = 2048, width: int = 2048, disjoint: bool = False) -> DataFrame:
    """``(sample, y, x0, x1, label)``: the runs and labels of ``regions.connected_components``, for images of any size.

    A task holds one tile of ``height`` by ``width`` pixels. ``disjoint`` runs (they may touch) are labelled as they are, others merged first.
    """
    columns = [sample, "y", "x0", "x1"]
    ready = runs.select(*columns) if disjoint else merge_runs(runs, [sample])
    cut = tiles(ready, height, width)
    placed = cut.select(F.struct(sample, "_ty", "_tx").alias("_tile"), "y", F.col("px0").alias("x0"), F.col("px1").alias("x1"), F.struct("x0", "x1").alias("_run"))
    named = placed.withColumn("_key", F.concat_ws(":", F.col(f"_tile.{sample}").cast("string"), "_tile._ty", "_tile._tx"))
    labelled = connected_components(named.select("_key", "y", "x0", "x1", F.col(f"_tile.{sample}").alias(sample), F.col("_run.x0").alias("rx0"), F.col("_run.x1").alias("rx1")), "_key",
                                    carry=[sample, "rx0", "rx1"], disjoint=True)
    held = written(labelled, "tile-labels")
    firsts = held.groupBy("_key", "label").agg(F.min(_pixel("y", "x0")).alias("node"))
    pieces = written(held.join(firsts, ["_key", "label"]).select(sample, "y", F.col("x0").alias("px0"), F.col("x1").alias("px1"), "rx0", "rx1", "node"), "tile-pieces")
    roots = star_contraction(_across_rows(pieces, sample, height).unionByName(_across_columns(pieces, sample, width)), [sample])
    nodes = pieces.select(sample, "node").distinct().join(roots, [sample, "node"], "left").select(sample, "node", F.coalesce("root", "node").alias("root"))
    nodes = written(nodes, "tile-components")
    numbers = rank_within(nodes.select(sample, "root").distinct(), [sample], [F.col("root")], "label")
    named_nodes = written(nodes.join(numbers, [sample, "root"]).select(sample, "node", F.col("label").cast("bigint").alias("label")), "tile-numbers")
    whole = pieces.where("px0 = rx0").select(sample, "y", F.col("rx0").alias("x0"), F.col("rx1").alias("x1"), "node")
    return whole.join(named_nodes, [sample, "node"]).select(sample, "y", "x0", "x1", "label")
