"""Position-based scans must equal plain windows, also across range and block edges."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from conftest import SF_SMALL, rows
from tidewater.operators.asof import carry_last, halo_window
from tidewater.operators.quantiles import exact_percentiles
from tidewater.operators.ranking import group_ranks
from tidewater.operators.sequence import sequence_number, weighted_prefix
from tidewater.plans.events import events_last_day_df, event_sequences_df, last_click_before_purchase_df


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_sequence_number_is_global_row_number(spark):
    ev = _events(spark).select("event_id", "user_id", "ts")
    got = sequence_number(ev, ["user_id", "ts", "event_id"], "seq", num_partitions=5)
    want = ev.withColumn("seq", F.row_number().over(Window.orderBy("user_id", "ts", "event_id")) - 1)
    assert rows(got) == rows(want)


def test_weighted_prefix_matches_running_sum(spark):
    ev = _events(spark).select("event_id", "user_id", (F.col("event_id") % 7).alias("w"))
    got = weighted_prefix(ev, ["user_id", "event_id"], "w", "before", num_partitions=4)
    w = Window.orderBy("user_id", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = ev.withColumn("before", F.coalesce(F.sum("w").over(w), F.lit(0)))
    assert rows(got) == rows(want)


def test_carry_last_across_ranges(spark):
    ev = _events(spark).select("event_id", "user_id", "ts", "event_type")
    ev = ev.withColumn("v", F.when(F.col("event_type") == "click", F.col("event_id")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    want = ev.withColumn("last", F.last("v", ignorenulls=True).over(w))
    for parts in (3, 17, None):
        got = carry_last(ev, "user_id", ["ts", "event_id"], "v", "last", num_partitions=parts)
        assert rows(got) == rows(want), parts


def test_carry_last_one_hot_key(spark):
    # one key owning every row: the carry must run through many ranges
    df = spark.range(0, 500).select(F.lit(1).alias("k"), F.col("id").alias("t"),
                                    F.when(F.col("id") % 37 == 0, F.col("id")).alias("v"))
    got = carry_last(df, "k", ["t"], "v", "last", num_partitions=10)
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    assert rows(got) == rows(df.withColumn("last", F.last("v", ignorenulls=True).over(w)))


def test_halo_window_lag_lead_sum(spark):
    ev = _events(spark)
    got = event_sequences_df(ev, block_rows=5)
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = ev.select(
        "event_id", "user_id", "ts",
        F.lag("event_type").over(w).alias("prev_type"),
        F.lead("event_type").over(w).alias("next_type"),
        F.lag("ts").over(w).alias("prev_ts"),
        F.sum(F.col("value").cast("decimal(18,2)")).over(w.rowsBetween(-2, 0)).cast("double").alias("value_sum_3"),
    )
    assert rows(got) == rows(want)


def test_last_click_many_ranges(spark):
    ev = _events(spark)
    assert rows(last_click_before_purchase_df(ev, num_partitions=9)) == rows(last_click_before_purchase_df(ev))


def test_events_last_day_many_ranges(spark):
    ev = _events(spark)
    # many small range partitions: one user's events and probes span several
    got = events_last_day_df(ev, num_partitions=13)
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy(micros).rangeBetween(-86_400_000_000, 0)
    want = ev.select(
        "event_id", "user_id", "ts",
        F.count(F.lit(1)).over(w).alias("n_24h"),
        F.sum(F.col("value").cast("decimal(18,2)")).over(w).cast("double").alias("value_24h"),
    )
    assert rows(got) == rows(want)


def test_exact_percentiles_with_hot_group_and_ties(spark):
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 2000, F.lit("hot")).otherwise((F.col("id") % 3).cast("string")).alias("g"),
        (F.col("id") % 97).cast("double").alias("v"),
    )
    got = exact_percentiles(df, ["g"], "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99})
    want = df.groupBy("g").agg(
        F.percentile("v", 0.1).alias("p10"), F.percentile("v", 0.5).alias("p50"), F.percentile("v", 0.99).alias("p99")
    )
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[0] == y[0]
        assert all(abs(p - q) < 1e-9 for p, q in zip(x[1:], y[1:]))


def test_group_ranks_match_window_functions(spark):
    s = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select(
        "c_custkey", "c_mktsegment", F.round(F.col("c_acctbal") / 1000).alias("bal")
    )
    got = group_ranks(s, ["c_mktsegment"], "bal", "c_custkey", ntile=4)
    w = Window.partitionBy("c_mktsegment").orderBy("bal")
    w2 = Window.partitionBy("c_mktsegment").orderBy("bal", "c_custkey")
    want = s.select(
        "*",
        F.rank().over(w).cast("bigint").alias("rnk"),
        F.dense_rank().over(w).cast("bigint").alias("drnk"),
        F.row_number().over(w2).cast("bigint").alias("rn"),
        F.ntile(4).over(w2).cast("bigint").alias("quartile"),
        F.percent_rank().over(w).alias("pct_rank"),
        F.cume_dist().over(w).alias("cume"),
    )
    assert rows(got) == rows(want)
