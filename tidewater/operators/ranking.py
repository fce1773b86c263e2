"""Ranking functions per group without a window per group.

``group_ranks`` returns rank, dense_rank, row_number, ntile, percent_rank and
cume_dist -- the values ``Window.partitionBy(g).orderBy(v)`` would give --
from one global prefix-sum pass (``weighted_prefix``) and one small aggregate
per group.  A group holding a third of the table is range-split over many
tasks instead of sorted in one.

Each distinct (group, value) adds two marker rows to the pass: one sorting
just before the value's rows, weighted with the value's row count and with 1
as a distinct-value count, and one sorting just after them, weighted with the
row count.  At a data row the prefix sums are then, over the whole table in
(group, value, tiebreak) order:

* ``_pos``   rows before it                    -> row_number, ntile
* ``_below`` rows with a smaller value         -> rank, percent_rank
* ``_upto``  rows with a value at most its own -> cume_dist
* ``_dist``  distinct values up to its own     -> dense_rank

and the group's first position, size and first distinct count turn them into
per-group numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import broadcast_if_small
from tidewater.operators.sequence import weighted_prefix


def ntile_of(row_number: F.Column, n: F.Column, buckets: int) -> F.Column:
    """SQL ntile(buckets) from a 1-based row number and the group size: the
    first ``n % buckets`` tiles get one row more than the rest."""
    q = F.floor(n / buckets)
    rem = n % buckets
    big = rem * (q + 1)
    return F.when(row_number <= big, F.floor((row_number - 1) / (q + 1)) + 1).otherwise(
        rem + F.floor((row_number - big - 1) / q) + 1
    )


def group_ranks(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    tiebreak: str,
    ntile: int = 4,
    num_partitions: int | None = None,
) -> DataFrame:
    group = list(group)
    zero = F.lit(0).cast("long")
    data = df.select(
        "*", F.lit(1).alias("_kind"), F.lit(1).cast("long").alias("_one"), zero.alias("_wb"), zero.alias("_wa"),
        zero.alias("_wd"),
    )
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("_cnt"))
    before = counts.select(
        *group, value, F.lit(0).alias("_kind"), zero.alias("_one"), F.col("_cnt").alias("_wb"), zero.alias("_wa"),
        F.lit(1).cast("long").alias("_wd"),
    )
    after = counts.select(
        *group, value, F.lit(2).alias("_kind"), zero.alias("_one"), zero.alias("_wb"), F.col("_cnt").alias("_wa"),
        zero.alias("_wd"),
    )
    both = data.unionByName(before, allowMissingColumns=True).unionByName(after, allowMissingColumns=True)
    pref = weighted_prefix(
        both,
        [*group, value, "_kind", tiebreak],
        ["_one", "_wb", "_wa", "_wd"],
        ["_pos", "_upto", "_below", "_dist"],
        num_partitions,
    ).filter(F.col("_kind") == 1)

    stats = pref.groupBy(*group).agg(
        F.min("_pos").alias("_g_first"), F.count(F.lit(1)).alias("_g_n"), F.min("_dist").alias("_d_first")
    )
    keys = [f"_gk{i}" for i in range(len(group))]
    stats = broadcast_if_small(stats.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], "_g_first", "_g_n", "_d_first"))
    # null-safe on the group keys: a null group is a group, as in a window
    out = pref.join(stats, [pref[g].eqNullSafe(stats[k]) for g, k in zip(group, keys)])

    n = F.col("_g_n")
    rn = F.col("_pos") - F.col("_g_first") + 1
    rank = F.col("_below") - F.col("_g_first") + 1
    return out.select(
        *df.columns,
        rank.cast("bigint").alias("rnk"),
        (F.col("_dist") - F.col("_d_first") + 1).cast("bigint").alias("drnk"),
        rn.cast("bigint").alias("rn"),
        ntile_of(rn, n, ntile).cast("bigint").alias("quartile" if ntile == 4 else f"ntile_{ntile}"),
        F.when(n > 1, (rank - 1).cast("double") / (n - 1).cast("double")).otherwise(F.lit(0.0)).alias("pct_rank"),
        ((F.col("_upto") - F.col("_g_first")).cast("double") / n.cast("double")).alias("cume"),
    )
