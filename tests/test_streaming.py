"""Each stream equals its batch twin over the same rows (closed windows)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidewater.streaming import jobs as S


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _cutoff(ev):
    return ev.agg((F.max("ts") - F.expr(f"INTERVAL {S.DELAY}")).alias("c")).first()["c"]


def test_stream_daily_equals_batch(spark):
    ev = _events(spark)
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    want = (
        ev.groupBy(day.alias("window_start"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value_sum"))
        .withColumn("window_end", (F.col("window_start") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz"))
        .filter(F.col("window_end") <= F.lit(_cutoff(ev)))
    )
    assert rows(S.stream_daily(spark, SF_SMALL)) == rows(want)


def test_stream_dedup_keeps_each_event_once(spark):
    got = S.stream_dedup(spark, SF_SMALL)
    want = _events(spark).select("event_id", "user_id", "ts", "event_type")
    assert rows(got) == rows(want)


def test_stream_user_totals_equal_batch(spark):
    ev = _events(spark)
    want = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        (F.sum(F.col("value").cast("decimal(18,2)")) * 100).cast("long").alias("value_cents"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n_purchases"),
    )
    assert rows(S.stream_user_totals(spark, SF_SMALL)) == rows(want)


def test_stream_late_report_counts_held_back_rows(spark):
    ev = _events(spark)
    rep = S.stream_late_report(spark, SF_SMALL)
    late = ev.filter((F.col("event_type") == S.LATE_TYPE) & (F.to_date("ts") == F.date_sub(F.lit(S._cuts(ev)[0]), 1))).count()
    assert rep.agg(F.sum("n_late")).first()[0] == late
    assert rep.filter(F.col("n_late") != 0).select("event_type").distinct().collect()[0][0] == S.LATE_TYPE


def test_stream_interval_join_equals_batch(spark):
    from tidewater.plans.events import signup_to_purchase_df

    batch = signup_to_purchase_df(_events(spark)).drop("purchase_value")
    assert rows(S.stream_signup_to_purchase(spark, SF_SMALL)) == rows(batch)


def test_stream_by_segment_equals_batch(spark):
    ev = _events(spark)
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_mktsegment")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    want = (
        ev.join(cust, ev.user_id == cust.c_custkey)
        .groupBy(day.alias("window_start"), "c_mktsegment")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value_sum"))
        .withColumn("window_end", (F.col("window_start") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz"))
        .filter(F.col("window_end") <= F.lit(_cutoff(ev)))
    )
    assert rows(S.stream_by_segment(spark, SF_SMALL)) == rows(want)
