"""Operators on inputs where one key owns most rows: results must equal the
naive per-key formulation."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import rows
from tidewater.operators.asof import halo_window
from tidewater.operators.joins import interval_join
from tidewater.operators.ranking import group_ranks


def _hot(spark, n=3000):
    # key 0 owns two thirds of the rows; timestamps collide on purpose
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 != 0, F.lit(0)).otherwise(F.col("id") % 11 + 1).cast("long").alias("k"),
        F.col("id").alias("rid"),
        (F.lit(1_700_000_000) + (F.col("id") * 37 % 5000) * 60).cast("timestamp").alias("ts"),
        (F.col("id") % 13).cast("double").alias("v"),
    )


def test_interval_join_hot_key_and_bounds(spark):
    df = _hot(spark)
    left = df.select(F.col("k"), F.col("rid").alias("lid"), F.col("ts").alias("lts"))
    right = df.select(F.col("k"), F.col("rid").alias("rid2"), F.col("ts").alias("rts"))
    got = interval_join(left, right, ["k"], "lts", "rts", 0, 7200).select("lid", "rid2")
    a, b = left.alias("a"), right.alias("b")
    delta = F.unix_timestamp("b.rts") - F.unix_timestamp("a.lts")
    want = a.join(b, (F.col("a.k") == F.col("b.k")) & delta.between(0, 7200)).select("lid", "rid2")
    assert rows(got) == rows(want)


def test_halo_window_hot_key(spark):
    df = _hot(spark)

    def exprs(w):
        return {"prev": F.lag("rid", 1).over(w), "nxt": F.lead("rid", 2).over(w), "s3": F.sum("v").over(w.rowsBetween(-3, 0))}

    got = halo_window(df, "k", ["ts", "rid"], exprs, before=3, after=2, block_rows=7)
    w = Window.partitionBy("k").orderBy("ts", "rid")
    want = df.select("*", *[c.alias(n) for n, c in exprs(w).items()])
    assert rows(got) == rows(want)


def test_group_ranks_hot_group_with_ties(spark):
    df = _hot(spark)
    got = group_ranks(df, ["k"], "v", "rid", ntile=4)
    w = Window.partitionBy("k").orderBy("v")
    w2 = Window.partitionBy("k").orderBy("v", "rid")
    want = df.select(
        "*",
        F.rank().over(w).cast("bigint").alias("rnk"),
        F.dense_rank().over(w).cast("bigint").alias("drnk"),
        F.row_number().over(w2).cast("bigint").alias("rn"),
        F.ntile(4).over(w2).cast("bigint").alias("quartile"),
        F.percent_rank().over(w).alias("pct_rank"),
        F.cume_dist().over(w).alias("cume"),
    )
    assert rows(got) == rows(want)
