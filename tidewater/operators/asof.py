"""Ordered scans per key that stay balanced when one key is huge.

The usual tools -- ``Window.partitionBy(key).orderBy(t)`` for lag/lead or a
last-non-null fill, a join on ``key`` for an as-of match -- put every row of
a key in one task.  Both operators here work on global positions in
(key, order...) order, range-partitioned, so a key holding a third of the
table is spread over a third of the tasks:

* ``carry_last``: last non-null value before each row within its key (an
  as-of lookup) -- a prefix count of non-null values, then an equi-join on
  that count, which is unique on one side;
* ``halo_window``: row-bounded frames (lag, lead, moving sums).  Positions are
  cut into fixed blocks of ``block_rows``; rows within ``before``/``after``
  rows of a block edge are copied into the neighbour block, so every frame is
  complete inside one (block, key) window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tidewater.operators.sequence import sequence_number, weighted_prefix

DEFAULT_BLOCK_ROWS = 1_000_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def carry_last(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    value: str,
    out: str,
    num_partitions: int | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Add ``out``: the last non-null ``value`` among earlier rows with the
    same ``key`` in ``order`` (including the row itself if ``inclusive``).

    One global prefix count of non-null values in (key, order...) order
    (``weighted_prefix``, range-partitioned) gives every row the index of the
    last non-null row before it, and every non-null row its own index.  An
    equi-join on that index -- unique on the value side, so no key can be hot
    -- fetches the value, kept only if that row has the same key.
    """
    has = F.col(value).isNotNull().cast("long")
    pref = weighted_prefix(
        df.withColumn("_has", has), [F.col(key), *[_col(c) for c in order]], "_has", "_nn", num_partitions
    )
    target = F.col("_nn") - F.lit(1) + (F.col("_has") if inclusive else F.lit(0))
    rows = pref.withColumn("_want", target)
    vals = pref.filter(F.col("_has") == 1).select(
        F.col("_nn").alias("_idx"), F.col(key).alias("_vk"), F.col(value).alias("_vv")
    )
    res = rows.join(vals, rows["_want"] == vals["_idx"], "left")
    res = res.withColumn(out, F.when(F.col("_vk").eqNullSafe(F.col(key)), F.col("_vv")))
    return res.drop("_has", "_nn", "_want", "_idx", "_vk", "_vv")


def halo_window(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    compute: Callable[[WindowSpec], dict[str, Column]],
    before: int,
    after: int,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Evaluate row-bounded window expressions per ``key`` in ``order``.

    ``compute(w)`` returns the output columns as expressions over the window
    spec ``w`` (already partitioned and ordered); their frames may reach at
    most ``before`` rows back and ``after`` rows ahead.
    """
    if block_rows <= before + after:
        raise ValueError("block_rows must exceed the frame reach")
    pos = sequence_number(df, [F.col(key), *[_col(c) for c in order]], "_seq")
    blk = F.floor(F.col("_seq") / F.lit(block_rows)).cast("long")
    off = F.col("_seq") % F.lit(block_rows)
    pos = pos.withColumn("_blk", blk)
    targets = F.array_compact(
        F.array(
            F.col("_blk"),
            F.when(off >= F.lit(block_rows - before), F.col("_blk") + 1),
            F.when(off < F.lit(after), F.col("_blk") - 1),
        )
    )
    ext = pos.withColumn("_ab", F.explode(targets))
    w = Window.partitionBy("_ab", key).orderBy("_seq")
    cols = compute(w)
    res = ext.select("*", *[c.alias(n) for n, c in cols.items()]).filter(F.col("_ab") == F.col("_blk"))
    return res.drop("_seq", "_blk", "_ab")
