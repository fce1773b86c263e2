"""Exact, interpolated percentiles per group, safe for hot groups.

Spark's ``percentile`` keeps a value->count map per group and merges all of
a group's maps in one task; for a hot group with mostly distinct doubles that
map is the whole group.  Here the work is spread instead:

1. count each distinct (group, value) -- a partial aggregate, so duplicates
   collapse on the map side;
2. an exclusive prefix sum of those counts in (group, value) order over the
   whole table (range-partitioned, so a hot group spans many tasks);
3. per group: its first position and size (a small aggregate);
4. the wanted positions ``p * (n - 1)`` (floor and ceil) are looked up by an
   equi-join on the group plus a range test on the prefix sum; each position
   matches exactly one distinct value;
5. linear interpolation ``lo * (1 - f) + hi * f``, as SQL ``percentile_cont``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import broadcast_if_small
from tidewater.operators.sequence import weighted_prefix


def exact_percentiles(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    count_col: str | None = None,
) -> DataFrame:
    group = list(group)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_w"))
    pref = weighted_prefix(counted, [*group, value], "_w", "_before")

    stats = pref.groupBy(*group).agg(F.min("_before").alias("_g0"), F.sum("_w").cast("long").alias("_n"))
    wanted = stats.select(
        *group,
        "_g0",
        "_n",
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("_q"), F.lit(float(p)).alias("_p")) for name, p in probs.items()])
        ).alias("_t"),
    ).select(*group, "_g0", "_n", "_t._q", (F.col("_t._p") * (F.col("_n") - 1)).alias("_rn"))
    wanted = wanted.select(
        *group,
        "_n",
        "_q",
        (F.col("_rn") - F.floor("_rn")).alias("_frac"),
        (F.col("_g0") + F.floor("_rn")).cast("long").alias("_lo"),
        (F.col("_g0") + F.ceil("_rn")).cast("long").alias("_hi"),
    )
    # the fraction and the group size ride along, so no join back is needed
    targets = wanted.select(
        *group, "_q", "_frac", "_n",
        F.explode(F.array(F.struct(F.lit("lo").alias("_side"), F.col("_lo").alias("_pos")),
                          F.struct(F.lit("hi").alias("_side"), F.col("_hi").alias("_pos")))).alias("_x"),
    ).select(*group, "_q", "_frac", "_n", "_x._side", "_x._pos")

    # targets descends from pref: rename its keys so the join is unambiguous
    t = broadcast_if_small(
        targets.select(*[F.col(g).alias(f"_k_{i}") for i, g in enumerate(group)], "_q", "_frac", "_n", "_side", "_pos")
    )
    found = pref.join(
        t,
        [F.col(g).eqNullSafe(F.col(f"_k_{i}")) for i, g in enumerate(group)]
        + [(F.col("_pos") >= F.col("_before")) & (F.col("_pos") < F.col("_before") + F.col("_w"))],
    ).select(*group, "_q", "_frac", "_n", "_side", F.col(value).alias("_v"))

    picked = found.groupBy(*group, "_q").agg(
        F.max(F.when(F.col("_side") == "lo", F.col("_v"))).alias("_vlo"),
        F.max(F.when(F.col("_side") == "hi", F.col("_v"))).alias("_vhi"),
        F.max("_frac").alias("_frac"),
        F.max("_n").alias("_n"),
    )
    interp = picked.withColumn(
        "_val",
        F.when(F.col("_frac") == 0, F.col("_vlo")).otherwise(
            F.col("_vlo") * (F.lit(1.0) - F.col("_frac")) + F.col("_vhi") * F.col("_frac")
        ),
    )
    wide = interp.groupBy(*group).agg(
        *[F.max(F.when(F.col("_q") == name, F.col("_val"))).alias(name) for name in probs],
        F.max("_n").alias("_n"),
    )
    if count_col:
        wide = wide.withColumnRenamed("_n", count_col)
    else:
        wide = wide.drop("_n")
    return wide
