"""Users who fall silent, as a stateful processor with event-time timers.

A spell is a run of a user's events with no gap above ``SILENCE_HOURS``.  It
ends, and the user is reported inactive, when that long has passed after its
last event.  Built in two chained stateful steps:

1. events are combined by user and hour (a windowed aggregate in append mode,
   combined map-side), so a user with a third of the stream reaches the next
   step as one row an hour, however many events those are;
2. ``transformWithState`` keeps one spell a user and one timer.  Rows extend
   the spell or, after a longer gap, end it; the timer ends it when nothing
   more came.  Ending a spell clears the user's state, so the state holds the
   users of the last ``SILENCE_HOURS`` only, not all users ever seen.

The timer stands at the end of the hour that holds the inactive moment: by then
every hour that could still extend the spell has been delivered, so no timer
fires before a row that it should have waited for.

Events without user or time take part in nothing.  Events at the same moment
count each; repeated rows are events of their own.  A gap of exactly
``SILENCE_HOURS`` continues the spell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.plans.catalog import job
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables
from tidewater.streaming.feed import day_slices, new_feed, run_slices, to_parquet

DELAY = "1 hour"
SILENCE_HOURS = 24
HOUR_MICROS = 3_600_000_000
_STORE = "spark.sql.streaming.stateStore.providerClass"
# timers and column families exist in this store only
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPELL = "user_id long, first_us long, last_us long, n_events long"


def _spells(silence_us: int):
    """The processor, defined here so that it travels to executors by value."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    def fires(last_us: int) -> int:
        """End, in milliseconds, of the hour that holds the inactive moment."""
        return ((last_us + silence_us) // HOUR_MICROS + 1) * (HOUR_MICROS // 1000)

    class Spells(StatefulProcessor):
        def init(self, handle):
            self.handle = handle
            self.spell = handle.getValueState("spell", "first_us long, last_us long, n_events long")

        def _out(self, key, spells):
            first, last, n = zip(*spells)
            return pd.DataFrame({"user_id": [key[0]] * len(spells), "first_us": first, "last_us": last, "n_events": n})

        def handleInputRows(self, key, rows, timerValues):
            # at most a row an hour of this batch's span
            hours = sorted((int(a), int(b), int(n)) for df in rows for a, b, n in zip(df["first_us"], df["last_us"], df["n_events"]))
            now = tuple(self.spell.get()) if self.spell.exists() else None
            if now:
                self.handle.deleteTimer(fires(now[1]))
            ended = []
            for first, last, n in hours:
                if now and first - now[1] > silence_us:
                    ended.append(now)
                    now = None
                now = (now[0], max(now[1], last), now[2] + n) if now else (first, last, n)
            self.spell.update(now)
            self.handle.registerTimer(fires(now[1]))
            if ended:
                yield self._out(key, ended)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            if self.spell.exists():
                yield self._out(key, [tuple(self.spell.get())])
                self.spell.clear()

        def close(self):
            pass

    return Spells()


def inactive_spells(stream: DataFrame, silence_hours: int = SILENCE_HOURS, delay: str = DELAY) -> DataFrame:
    """Ended spells of a stream with ``user_id`` and a TIMESTAMP ``ts``."""
    us = F.unix_micros("ts")
    hours = (
        stream.select("user_id", "ts").filter("user_id is not null and ts is not null")
        .withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 hour").alias("w"), F.col("user_id").cast("long").alias("user_id"))
        .agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.count(F.lit(1)).alias("n_events"))
        .select("user_id", F.window_time("w").alias("at"), "first_us", "last_us", "n_events")
    )
    return hours.groupBy("user_id").transformWithStateInPandas(_spells(silence_hours * HOUR_MICROS), SPELL, "append", "eventTime")


def replay_inactive(events: DataFrame, slices: list, silence_hours: int = SILENCE_HOURS) -> DataFrame:
    """``inactive_spells`` over ``events`` that arrive slice by slice."""
    spark = events.sparkSession
    feed = new_feed(spark, events.select("user_id", "ts"), "inactive_users")
    out = scratch_path(spark, "inactive_users-sink")
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        schema = run_slices(feed, events.select("user_id", "ts"), slices, to_parquet(out), lambda s: inactive_spells(s, silence_hours), "append", "inactive_users")
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)
    at = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return spark.read.schema(schema).parquet(out).select(
        "user_id", at(F.col("first_us")).alias("active_from"), at(F.col("last_us")).alias("last_ts"),
        at(F.col("last_us") + F.lit(silence_hours * HOUR_MICROS)).alias("inactive_at"), "n_events",
    )


@job(
    "stream_inactive_users",
    f"""
    WITH e AS (SELECT user_id, ts FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
    g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL {SILENCE_HOURS} HOUR
                                   THEN 0 ELSE 1 END AS new FROM e),
    s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS spell FROM g),
    a AS (SELECT user_id, min(ts) AS active_from, max(ts) AS last_ts, count(*) AS n_events FROM s GROUP BY user_id, spell)
    SELECT user_id, active_from, last_ts, last_ts + INTERVAL {SILENCE_HOURS} HOUR AS inactive_at, n_events FROM a
    WHERE date_trunc('hour', last_ts + INTERVAL {SILENCE_HOURS} HOUR) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM e)
    """,
    group="streaming",
)
def stream_inactive_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spells of activity whose users then stayed silent for a day."""
    from tidewater.streaming.jobs import _cuts

    events = Tables(spark, sf_dir).events
    return replay_inactive(events, day_slices("ts", _cuts(events)))
