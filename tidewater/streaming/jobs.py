"""Structured Streaming jobs over the replayed event log.

Each job replays ``events`` into a landing folder in day slices
(``feed.run_slices``), runs the streaming query on one checkpoint, and
returns what the sink holds as a batch DataFrame.  Aggregations run in
append mode, so only windows closed by the watermark are emitted; the oracle
statements apply the same rule (window end at or before the final watermark,
which is the latest event time minus the allowed delay).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.exact import units
from tidewater.plans.catalog import job
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables
from tidewater.streaming.feed import day_slices, new_feed, run_slices, to_parquet

# Fixed parameters of the stream jobs.
DELAY = "1 hour"  # allowed lateness (watermark delay)
DELAY_SQL = "INTERVAL 1 HOUR"
SESSION_GAP = "6 hours"
SESSION_GAP_SQL = "INTERVAL 6 HOUR"
SIGNUP_WINDOW = "2 hours"
SIGNUP_WINDOW_SECONDS = 2 * 3600
# Events of this type on the last day of the first slice arrive with the last one.
LATE_TYPE = "error"
LATE_DAY_SQL = "(SELECT CAST(min(ts) AS DATE) + CAST(date_diff('day', min(ts), max(ts)) // 3 AS INTEGER) FROM events)"

_CLOSED = f"(SELECT max(ts) - {DELAY_SQL} FROM events)"


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz")


def _cents(c: str = "value") -> F.Column:
    """Money as exact cents in a long: state and sums stay long arithmetic."""
    return units(c)


def _cuts(events: DataFrame) -> list:
    """The days after a third and two thirds of the log's days: it arrives in
    three slices.  None for an empty log, which is one slice."""
    lo, hi = events.agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return [] if lo is None else [lo + timedelta(days=k * (hi - lo).days // 3 + 1) for k in (1, 2)]


def _replay(spark: SparkSession, sf_dir: str, name: str, build, output_mode: str = "append") -> DataFrame:
    events = Tables(spark, sf_dir).events
    feed = new_feed(spark, events, name)
    out = scratch_path(spark, f"{name}-sink")
    schema = run_slices(feed, events, day_slices("ts", _cuts(events)), to_parquet(out), build, output_mode, name)
    return spark.read.schema(schema).parquet(out)


# --------------------------------------------------------------------------
# windowed aggregates
# --------------------------------------------------------------------------


def _daily(stream: DataFrame) -> DataFrame:
    return (
        stream.withWatermark("ts", DELAY)
        .groupBy(F.window("ts", "1 day").alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(_cents()).alias("value_sum"))
    )


@job(
    "stream_daily",
    f"""
    SELECT window_start, window_end, event_type, COUNT(*) AS n_events,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
    FROM (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
                 CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end FROM events)
    WHERE window_end <= {_CLOSED}
    GROUP BY window_start, window_end, event_type
    """,
    group="streaming",
)
def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling daily counts and sums per event type, watermark 1 hour."""
    out = _replay(spark, sf_dir, "stream_daily", _daily)
    return out.select(
        _ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end"), "event_type",
        "n_events", (F.col("value_sum").cast("double") / F.lit(100.0)).alias("value_sum"),
    )


@job(
    "stream_sliding",
    f"""
    SELECT window_start, window_end, COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users
    FROM (
      SELECT user_id, CAST(s AS TIMESTAMP) AS window_start, CAST(s + INTERVAL 2 HOUR AS TIMESTAMP) AS window_end
      FROM (SELECT user_id, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) AS s FROM events)
    )
    WHERE window_end <= {_CLOSED}
    GROUP BY window_start, window_end
    """,
    group="streaming",
)
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-hour windows sliding every hour: events and distinct users."""

    def build(stream: DataFrame) -> DataFrame:
        # exact distinct users per window: count the (window, user) pairs
        # first, so the state holds one row per pair, not a set per window
        return (
            stream.withWatermark("ts", DELAY)
            .groupBy(F.window("ts", "2 hours", "1 hour").alias("w"), "user_id")
            .agg(F.count(F.lit(1)).alias("n"))
        )

    pairs = _replay(spark, sf_dir, "stream_sliding", build)
    return pairs.groupBy(_ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end")).agg(
        F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("n_users")
    )


@job(
    "stream_sessions",
    f"""
    SELECT user_id, CAST(MIN(ts) AS TIMESTAMP) AS session_start,
           CAST(MAX(ts) + {SESSION_GAP_SQL} AS TIMESTAMP) AS session_end, COUNT(*) AS n_events
    FROM (
      SELECT *, SUM(CASE WHEN prev IS NULL OR ts >= prev + {SESSION_GAP_SQL} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)
    )
    GROUP BY user_id, sid
    HAVING MAX(ts) + {SESSION_GAP_SQL} <= {_CLOSED}
    """,
    group="streaming",
)
def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user sessions closed by six idle hours (``session_window``)."""

    def build(stream: DataFrame) -> DataFrame:
        return (
            stream.withWatermark("ts", DELAY)
            .groupBy(F.session_window("ts", SESSION_GAP).alias("s"), "user_id")
            .agg(F.count(F.lit(1)).alias("n_events"))
        )

    out = _replay(spark, sf_dir, "stream_sessions", build)
    return out.select("user_id", _ntz("s.start").alias("session_start"), _ntz("s.end").alias("session_end"), "n_events")


@job(
    "stream_dedup",
    "SELECT event_id, user_id, ts, event_type FROM events",
    group="streaming",
)
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replayed events dropped with ``dropDuplicatesWithinWatermark``.

    Each slice re-sends the last half hour of the previous one (an at-least-
    once producer retrying); the duplicates are on time, so only the
    deduplication state removes them."""
    events = Tables(spark, sf_dir).events
    feed = new_feed(spark, events, "stream_dedup")
    out = scratch_path(spark, "stream_dedup-sink")
    t = F.col("ts")
    overlap, cuts = F.expr("INTERVAL 30 MINUTES"), [F.lit(c).cast("timestamp_ntz") for c in _cuts(events)]
    starts = [t >= c - overlap for c in cuts]
    slices = [a & b for a, b in zip([F.lit(True), *starts], [*(t < c for c in cuts), F.lit(True)])]

    def build(stream: DataFrame) -> DataFrame:
        return (
            stream.withWatermark("ts", DELAY)
            .dropDuplicatesWithinWatermark(["event_id"])
            .select("event_id", "user_id", "ts", "event_type")
        )

    schema = run_slices(feed, events, slices, to_parquet(out), build, "append", "stream_dedup")
    return spark.read.schema(schema).parquet(out).withColumn("ts", _ntz("ts"))


@job(
    "stream_signup_to_purchase",
    f"""
    SELECT s.user_id, s.event_id AS signup_id, s.ts AS signup_ts,
           p.event_id AS purchase_id, p.ts AS purchase_ts
    FROM events s JOIN events p
      ON s.user_id = p.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
     AND p.ts >= s.ts AND p.ts <= s.ts + INTERVAL 2 HOUR
    """,
    group="streaming",
)
def stream_signup_to_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-stream interval join; both sides watermarked, so join state is
    dropped once a signup is older than the watermark plus two hours.

    The equality key is (user, two-hour bucket), as in the batch
    ``interval_join``: a signup is repeated for the (at most two) buckets its
    interval touches, a purchase has one, so every pair meets exactly once and
    a hot user's state and work are spread over its time buckets."""
    width = F.lit(SIGNUP_WINDOW_SECONDS * 1_000_000)

    def bucket(ts: F.Column) -> F.Column:
        return F.floor(F.unix_micros(ts) / width).cast("long")

    def build(stream: DataFrame) -> DataFrame:
        s = stream.filter(F.col("event_type") == "signup").select(
            F.col("user_id").alias("s_user"), F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_ts")
        ).withWatermark("signup_ts", DELAY)
        s = s.withColumn(
            "s_bucket",
            F.explode(F.sequence(bucket(F.col("signup_ts")), bucket(F.col("signup_ts") + F.expr(f"INTERVAL {SIGNUP_WINDOW}")))),
        )
        p = stream.filter(F.col("event_type") == "purchase").select(
            F.col("user_id").alias("p_user"), F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
        ).withWatermark("purchase_ts", DELAY)
        p = p.withColumn("p_bucket", bucket(F.col("purchase_ts")))
        cond = (
            (F.col("s_user") == F.col("p_user"))
            & (F.col("s_bucket") == F.col("p_bucket"))
            & (F.col("purchase_ts") >= F.col("signup_ts"))
            & (F.col("purchase_ts") <= F.col("signup_ts") + F.expr(f"INTERVAL {SIGNUP_WINDOW}"))
        )
        return s.join(p, cond, "inner")

    out = _replay(spark, sf_dir, "stream_signup_to_purchase", build)
    return out.select(
        F.col("s_user").alias("user_id"), "signup_id", _ntz("signup_ts").alias("signup_ts"),
        "purchase_id", _ntz("purchase_ts").alias("purchase_ts"),
    )


@job(
    "stream_by_segment",
    f"""
    SELECT window_start, window_end, c_mktsegment, COUNT(*) AS n_events,
           CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
    FROM (SELECT e.*, c.c_mktsegment, CAST(date_trunc('day', e.ts) AS TIMESTAMP) AS window_start,
                 CAST(date_trunc('day', e.ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end
          FROM events e JOIN customer c ON e.user_id = c.c_custkey)
    WHERE window_end <= {_CLOSED}
    GROUP BY window_start, window_end, c_mktsegment
    """,
    group="streaming",
)
def stream_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-static join: daily totals per customer segment.

    Events are first combined per (day, user) -- a windowed aggregate with
    partial aggregation map-side -- and only those rows are joined with the
    customer table (re-read per micro-batch, pruned to two columns), then
    summed per (day, segment) in a second windowed aggregate chained on the
    first one's window.  A user holding a third of the stream reaches the
    join as one row per day, whether the customer side is broadcast or
    shuffled."""
    customer = Tables(spark, sf_dir).customer.select(F.col("c_custkey"), "c_mktsegment")

    def build(stream: DataFrame) -> DataFrame:
        per_user = (
            stream.withWatermark("ts", DELAY)
            .groupBy(F.window("ts", "1 day").alias("w"), "user_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(_cents()).alias("v"))
        )
        return (
            per_user.join(customer, per_user.user_id == customer.c_custkey)
            .groupBy(F.col("w"), "c_mktsegment")
            .agg(F.sum("n").alias("n_events"), F.sum("v").alias("value_sum"))
        )

    out = _replay(spark, sf_dir, "stream_by_segment", build)
    return out.select(
        _ntz("w.start").alias("window_start"), _ntz("w.end").alias("window_end"), "c_mktsegment",
        "n_events", (F.col("value_sum").cast("double") / F.lit(100.0)).alias("value_sum"),
    )


@job(
    "stream_user_totals",
    """
    SELECT user_id, COUNT(*) AS n_events,
           CAST(SUM(CAST(value AS DECIMAL(18,2)) * 100) AS BIGINT) AS value_cents,
           MIN(ts) AS first_ts, MAX(ts) AS last_ts,
           COUNT(*) FILTER (WHERE event_type = 'purchase') AS n_purchases
    FROM events GROUP BY user_id
    """,
    group="streaming",
)
def stream_user_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals per user as a built-in stateful aggregation in update
    mode: partial aggregates are combined on the map side before the state
    store, so a user holding a third of the stream costs a few rows per task.
    Each micro-batch writes the rows it updated to a folder of its own
    (``foreachBatch``), which a retry of the batch overwrites; the
    latest row per user -- the one with the most events, as counts only grow
    -- is the current state."""

    def build(stream: DataFrame) -> DataFrame:
        return stream.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n_events"),
            F.sum(_cents()).alias("value_cents"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
            F.count(F.when(F.col("event_type") == "purchase", 1)).alias("n_purchases"),
        )

    events = Tables(spark, sf_dir).events
    feed = new_feed(spark, events, "stream_user_totals")
    out = scratch_path(spark, "stream_user_totals-sink")

    def start(writer):
        return writer.foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{out}/batch={n}")).start()

    schema = run_slices(feed, events, day_slices("ts", _cuts(events)), start, build, "update", "stream_user_totals")
    updates = spark.read.schema(schema).parquet(f"{out}/batch=*")
    latest = updates.groupBy("user_id").agg(
        F.max_by(F.struct(*[c for c in updates.columns if c != "user_id"]), "n_events").alias("s")
    )
    return latest.select(
        "user_id", "s.n_events", "s.value_cents", _ntz("s.first_ts").alias("first_ts"),
        _ntz("s.last_ts").alias("last_ts"), "s.n_purchases",
    )


@job(
    "stream_late_report",
    f"""
    SELECT window_start, event_type,
           COUNT(*) FILTER (WHERE NOT late) AS n_stream,
           COUNT(*) AS n_table,
           COUNT(*) FILTER (WHERE late) AS n_late
    FROM (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
                 (event_type = '{LATE_TYPE}' AND CAST(ts AS DATE) = {LATE_DAY_SQL}) AS late
          FROM events)
    WHERE window_start + INTERVAL 1 DAY <= {_CLOSED}
    GROUP BY window_start, event_type
    """,
    group="streaming",
)
def stream_late_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed daily windows of the stream against the whole table.

    The day's error events are held back and arrive with the last slice,
    long after the watermark passed them, so the stream drops them; the report
    shows, per window, what the stream counted, what the table holds and the
    difference (rows lost as late)."""
    events = Tables(spark, sf_dir).events
    feed = new_feed(spark, events, "stream_late_report")
    out = scratch_path(spark, "stream_late_report-sink")
    cuts = _cuts(events)
    late = F.lit(False)
    if cuts:
        late = (F.col("event_type") == LATE_TYPE) & (F.to_date("ts") == F.lit(cuts[0] - timedelta(days=1)))
        late = F.coalesce(late, F.lit(False))
    *early, last = day_slices("ts", cuts)
    slices = [*(s & ~late for s in early), last | late]
    schema = run_slices(feed, events, slices, to_parquet(out), _daily, "append", "stream_late_report")
    streamed = spark.read.schema(schema).parquet(out).select(
        _ntz("w.start").alias("window_start"), "event_type", F.col("n_events").alias("n_stream")
    )
    # closed = window end at or before the final watermark (one scalar)
    cutoff = events.agg((F.max("ts") - F.expr(f"INTERVAL {DELAY}")).alias("c")).first()["c"]
    table = (
        events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type")
        .agg(F.count(F.lit(1)).alias("n_table"))
        .filter(F.col("window_start") + F.expr("INTERVAL 1 DAY") <= F.lit(cutoff))
    )
    # a window whose rows were all late has no stream row at all
    return table.join(streamed, ["window_start", "event_type"], "left").select(
        "window_start",
        "event_type",
        F.coalesce("n_stream", F.lit(0)).alias("n_stream"),
        "n_table",
        (F.col("n_table") - F.coalesce("n_stream", F.lit(0))).alias("n_late"),
    )
