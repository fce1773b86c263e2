"""
ties -- operators against plain windows or direct answers."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import rows
from tidewater.operators.asof import carry_last
from tidewater.operators.graph import connected_components
from tidewater.operators.ranking import group_ranks
from tidewater.plans.events import events_last_day_df


def test_group_ranks_nulls_ties_and_single_row_group(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 2.0, 2), ("a", 2.0, 3), ("a", None, 4), ("a", 1.0, 5), ("b", 7.0, 6), (None, 3.0, 7)],
        "g string, v double, t long",
    )
    got = group_ranks(df, ["g"], "v", "t", ntile=4)
    w = Window.partitionBy("g").orderBy("v")
    w2 = Window.partitionBy("g").orderBy("v", "t")
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


def test_carry_last_null_keys_and_all_null_values(spark):
    df = spark.createDataFrame(
        [(None, 1, 10), (None, 2, None), ("x", 1, None), ("x", 2, None), ("y", 1, 5), ("y", 2, None), ("y", 3, 6)],
        "k string, t long, v long",
    )
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    want = df.withColumn("last", F.last("v", ignorenulls=True).over(w))
    assert rows(carry_last(df, "k", ["t"], "v", "last")) == rows(want)
    w_in = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want_in = df.withColumn("last", F.last("v", ignorenulls=True).over(w_in))
    assert rows(carry_last(df, "k", ["t"], "v", "last", inclusive=True)) == rows(want_in)


def test_components_empty_and_single_edge(spark):
    empty = spark.createDataFrame([], "src long, dst long")
    assert connected_components(empty).count() == 0
    one = spark.createDataFrame([(9, 4)], "src long, dst long")
    assert rows(connected_components(one)) == [(4, 4), (4, 9)]


def test_events_last_day_single_event_and_peers(spark):
    df = spark.createDataFrame(
        [(1, 7, "2024-01-01 00:00:00", 1.5), (2, 8, "2024-01-01 00:00:00", 2.0), (3, 8, "2024-01-01 00:00:00", 3.0),
         (4, 8, "2024-01-02 00:00:00", 4.0), (5, 8, "2024-01-02 00:00:01", 0.25)],
        "event_id long, user_id long, ts string, value double",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r.event_id: (r.n_24h, r.value_24h) for r in events_last_day_df(df).collect()}
    # peers at the same instant count; the frame reaches back exactly one day
    assert got == {1: (1, 1.5), 2: (2, 5.0), 3: (2, 5.0), 4: (3, 9.0), 5: (2, 4.25)}
