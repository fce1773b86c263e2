"""Heavy hitters: items above a share of all rows, with exact counts.

A first pass finds candidates with a summary of bounded size (Spark's frequent
items sketch, ``approx_top_k_accumulate``): a sketch a task, combined by groups
of tasks and then once more, so no task reads more than some hundreds of them
and the number of distinct items does not matter.  A second pass counts the
candidates exactly; only their rows are shuffled, combined map-side.

No item is missed.  With a hash map of ``m`` slots the sketch's counts are at
most ``3.5 / m`` of all rows below the truth, however often it is merged.  ``m``
is chosen so that this is a quarter of the share: an item above the share keeps
a count above three quarters of it, of which there are at most
``4 / (3 * share)``, the number of candidates that are taken.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketches of tasks are combined by so many groups first.
SKETCH_GROUPS = 256
#: What the sketch may track at most (a limit of the SQL function).
MOST_TRACKED = 1_000_000
#: Filled share of the sketch's hash map, and its error in units of 1 / slots.
_FILL, _ERROR = 0.75, 3.5


def tracked_for(parts: int) -> int:
    """Items that a sketch tracks for a share of ``1 / parts`` of all rows."""
    tracked = ceil(_FILL * _ERROR * 4 * parts)
    if parts < 1 or tracked > MOST_TRACKED:
        raise ValueError(f"parts must be from 1 to {int(MOST_TRACKED / (_FILL * _ERROR * 4))}")
    return tracked


def candidates(df: DataFrame, item: Column, parts: int) -> tuple[int, list[int]]:
    """The number of non-null items and the hashes of at most ``4/3 * parts``
    of them, all items above the share included.

    Sketches hold 64-bit hashes, so their size does not depend on the items'
    lengths; items whose hashes collide are candidates together."""
    tracked, most = tracked_for(parts), ceil(4 * parts / 3)
    hashed = df.select(F.when(item.isNotNull(), F.xxhash64(item)).alias("h")).filter("h is not null")
    grouped = hashed.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)))
    sketches = grouped.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("s"))
    # by a constant: no sketches, no row
    merged = sketches.groupBy(F.lit(0).alias("all")).agg(F.sum("n").alias("n"), F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))
    row = merged.select("n", F.expr(f"transform(approx_top_k_estimate(s, {most}), x -> x.item)").alias("items")).first()
    return (row["n"], list(row["items"])) if row else (0, [])


def heavy_hitters(df: DataFrame, item: str, parts: int, count: str = "n") -> DataFrame:
    """``(item, count)`` of the items in more than ``1 / parts`` of the rows
    whose ``item`` is not null; no rows if there are none.  ``df`` is read
    twice and must give the same rows both times.  The driver reads at most
    ``4/3 * parts`` hashes and a number."""
    total, hashes = candidates(df, F.col(item), parts)
    found = df.sparkSession.createDataFrame([(h,) for h in hashes], "h long")
    rows = df.select(item).filter(F.col(item).isNotNull()).withColumn("h", F.xxhash64(item))
    # at most 4/3 * parts rows of 8 bytes
    kept = rows.join(F.broadcast(found), "h", "left_semi")
    return kept.groupBy(item).agg(F.count(F.lit(1)).alias(count)).filter(F.col(count) * F.lit(parts) > F.lit(total))
