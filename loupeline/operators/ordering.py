"""Exact ranks and running totals that never put a whole group into one task.

A plain ``Window.partitionBy(category)`` sends every row of a category to one task. Categories are few and
one of them may hold a third of all rows, so the operators here split the order instead:

* ``sorted_table`` range-sorts by (group, order) once and writes the result with each row's range id and
  position; Spark's range exchange balances the pieces whatever the group sizes are;
* only one row per (range, group) is aggregated further, so the offsets table has at most
  ``ranges + groups`` rows, however large the data is.

Seeded orders need no sort at all: SHA-256 prefixes are uniform, so ``hash_rank`` ranks inside fixed cells.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loupeline.session import sized, written

POSITION_MASK = (1 << 33) - 1  # low 33 bits of monotonically_increasing_id: row position in its partition


def sorted_table(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Globally sorted copy of ``df`` with ``_range`` and ``_pos`` (0-based position inside the range)."""
    ordered = df.orderBy(*[F.col(g) for g in group], *order)
    placed = ordered.withColumn("_range", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(POSITION_MASK)))
    return written(placed, "sorted")


def _offsets(pieces: DataFrame, group: Sequence[str], sums: Sequence[str]) -> DataFrame:
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    out = pieces
    for name in sums:
        out = (out.withColumn(f"_before_{name}", F.coalesce(F.sum(name).over(earlier), F.lit(0).cast("bigint")))
                  .withColumn(f"_all_{name}", F.sum(name).over(whole)))
    return out.drop(*sums)


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank",
                size: str | None = None) -> DataFrame:
    """1-based dense position of each row in its group; ``size`` adds the group's row count.

    ``order`` must end in a unique column for a deterministic result.
    """
    placed = sorted_table(df, group, order)
    pieces = placed.groupBy("_range", *group).agg(F.count(F.lit(1)).alias("n"), F.min("_pos").alias("_first"))
    offsets = sized(_offsets(pieces, group, ["n"]), "offsets")
    out = placed.join(offsets, ["_range", *group]).withColumn(
        name, F.col("_pos") - F.col("_first") + F.col("_before_n") + 1)
    if size:
        out = out.withColumn(size, F.col("_all_n"))
    return out.drop("_range", "_pos", "_first", "_before_n", "_all_n")


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[Column], values: dict[str, str],
                   totals: dict[str, str] | None = None) -> DataFrame:
    """Inclusive running sums ``values = {output: input}``; ``totals`` adds whole-group sums."""
    placed = sorted_table(df, group, order)
    inputs = sorted({*values.values(), *(totals or {}).values()})
    pieces = placed.groupBy("_range", *group).agg(*[F.sum(c).alias(c) for c in inputs])
    offsets = _offsets(pieces, group, inputs)
    inside = Window.partitionBy("_range", *group).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    out = placed
    for output, source in values.items():
        out = out.withColumn(f"_run_{output}", F.sum(source).over(inside))
    out = out.join(offsets, ["_range", *group])
    for output, source in values.items():
        out = out.withColumn(output, F.col(f"_run_{output}") + F.col(f"_before_{source}"))
    for output, source in (totals or {}).items():
        out = out.withColumn(output, F.col(f"_all_{source}"))
    scratch = [c for c in out.columns if c.startswith(("_run_", "_before_", "_all_"))]
    return out.drop("_range", "_pos", *scratch)


def hash_rank(df: DataFrame, group: Sequence[str], token: Column, name: str = "rank",
              size: str | None = None, digits: int = 3) -> DataFrame:
    """1-based rank in SHA-256 order of ``token`` (unique per row of a group): the seeded shuffle of this library.

    The first ``digits`` hex characters cut each group into ``16**digits`` equal cells. Counting and ranking share
    the (group, cell) distribution; the offsets window sees at most ``16**digits`` rows per group.
    """
    keyed = df.withColumn("_hash", F.sha2(token, 256)).withColumn("_cell", F.substring("_hash", 1, digits))
    cells = keyed.groupBy(*group, "_cell").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*group, "_cell",
                           F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint")).alias("_before"),
                           F.sum("n").over(Window.partitionBy(*group)).alias("_all"))
    inside = Window.partitionBy(*group, "_cell").orderBy("_hash")
    out = keyed.withColumn("_rn", F.row_number().over(inside)).join(offsets, [*group, "_cell"])
    out = out.withColumn(name, F.col("_rn") + F.col("_before"))
    if size:
        out = out.withColumn(size, F.col("_all"))
    return out.drop("_hash", "_cell", "_rn", "_before", "_all")


def seeded(seed: object, *parts: Column) -> Column:
    """Token ``seed:part:part`` for ``hash_rank`` and the hash split."""
    return F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])


def with_previous(df: DataFrame, group: Sequence[str], order: Sequence[Column], columns: dict[str, str]) -> DataFrame:
    """``lag`` over a group of any size: ``columns = {output: input}`` taken from the preceding row."""
    ranked = rank_within(df, group, order, "_rank")
    before = ranked.select(*group, (F.col("_rank") + 1).alias("_rank"),
                           *[F.col(source).alias(output) for output, source in columns.items()])
    return ranked.join(before, [*group, "_rank"], "left").drop("_rank")


def fill_forward(df: DataFrame, group: Sequence[str], order: Sequence[Column], columns: dict[str, str],
                 inclusive: bool = True) -> DataFrame:
    """Latest non-null value at or (not ``inclusive``) before each row: ``columns = {output: input}``.

    The as-of building block: union both sides of an as-of join, put the value on one side only, fill forward.
    """
    placed = sorted_table(df, group, order)

    def latest(source):
        return F.max(F.when(F.col(source).isNotNull(), F.struct(F.col("_pos").alias("p"), F.col(source).alias("v"))))

    pieces = placed.groupBy("_range", *group).agg(*[latest(s)["v"].alias(f"_last_{o}") for o, s in columns.items()])
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_range", *group, *[F.last(f"_last_{o}", True).over(earlier).alias(f"_earlier_{o}") for o in columns])
    inside = Window.partitionBy("_range", *group).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    out = placed
    for output, source in columns.items():
        out = out.withColumn(f"_here_{output}", F.last(source, True).over(inside))
    out = out.join(offsets, ["_range", *group])
    for output in columns:
        out = out.withColumn(output, F.coalesce(f"_here_{output}", f"_earlier_{output}"))
    scratch = [c for c in out.columns if c.startswith(("_here_", "_earlier_"))]
    return out.drop("_range", "_pos", *scratch)
