"""Join helpers: size-checked broadcast, band (range) joins and interval joins.

Broadcast policy.  A side is broadcast only when its size is bounded:
either by construction (a fixed parameter table, the 5 regions and 25
nations), or by a row count checked at run time with ``broadcast_if_small``.
Everything else is left to the planner, where AQE turns a sort-merge join into
a broadcast join only after it has measured the shuffled side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds for a checked broadcast: rows, and bytes of the rows as JSON text
# (a stand-in for their in-memory size that does not depend on plan stats).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def broadcast_if_small(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES
) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and about
    ``max_bytes`` of data.

    The probe reads at most ``max_rows + 1`` rows (a bounded job), so it is
    cheap even when the side turns out large; then the join stays a shuffle
    join.
    """
    probe = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct(*df.columns)))).alias("b")
    ).first()
    small = probe["n"] <= max_rows and (probe["b"] or 0) <= max_bytes
    return F.broadcast(df) if small else df


def band_join(
    df: DataFrame,
    bands: DataFrame,
    value: Column,
    low: str = "lo",
    high: str = "hi",
) -> DataFrame:
    """Attach to each row of ``df`` the band with ``lo <= value < hi``.

    ``bands`` is a parameter table (a handful of rows), so it is broadcast and
    the non-equi predicate runs as a broadcast nested-loop join on the map
    side: the big side is never shuffled.
    """
    return df.join(F.broadcast(bands), (value >= bands[low]) & (value < bands[high]), "inner")


def time_bucket(ts: Column, width_seconds: int) -> Column:
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(width_seconds * 1_000_000)).cast("long")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    lower_seconds: int,
    upper_seconds: int,
) -> DataFrame:
    """Inner join of rows with equal ``keys`` and ``left_ts + lower <= right_ts <= left_ts + upper``.

    The time bounds are turned into an extra equi key: both sides get a time
    bucket of the interval's width, and each left row is repeated for the few
    buckets its interval touches.  The join then shuffles on (keys, bucket),
    so one hot key is spread over many buckets instead of landing in one task,
    and the exact bounds are applied as a post-filter.
    """
    width = max(upper_seconds - lower_seconds, 1)
    lb = F.floor(
        (F.unix_micros(F.col(left_ts).cast("timestamp")) + F.lit(lower_seconds * 1_000_000))
        / F.lit(width * 1_000_000)
    ).cast("long")
    ub = F.floor(
        (F.unix_micros(F.col(left_ts).cast("timestamp")) + F.lit(upper_seconds * 1_000_000))
        / F.lit(width * 1_000_000)
    ).cast("long")
    l2 = left.withColumn("_tb", F.explode(F.sequence(lb, ub)))
    r2 = right.withColumn("_tb", time_bucket(F.col(right_ts), width))
    cond = [l2[k] == r2[k] for k in keys] + [l2["_tb"] == r2["_tb"]]
    delta = F.unix_micros(r2[right_ts].cast("timestamp")) - F.unix_micros(l2[left_ts].cast("timestamp"))
    cond.append(delta.between(lower_seconds * 1_000_000, upper_seconds * 1_000_000))
    out = l2.join(r2, cond)
    return out.drop(l2["_tb"]).drop(r2["_tb"])
