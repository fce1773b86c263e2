"""Drive Structured Streaming queries from the events table.

A real deployment reads a message bus or a landing folder.  Here the events
table is replayed into a landing folder in time slices: slice ``i`` is
written, then the query runs with ``trigger(availableNow=True)`` on the same
checkpoint, so each slice is one or more micro-batches and state, offsets and
watermark carry over exactly as in a long-running query.  Everything lives in
the shared checkpoint folder, so a restarted driver resumes from the
checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidewater.session import prepare, scratch_path


@dataclass
class Feed:
    spark: SparkSession
    landing: str
    schema: object

    def stream(self) -> DataFrame:
        """The landing folder as a stream, ``ts`` as a TIMESTAMP (watermarks
        need TIMESTAMP, not TIMESTAMP_NTZ; the session runs in UTC)."""
        return (
            self.spark.readStream.schema(self.schema)
            .parquet(self.landing)
            .withColumn("ts", F.col("ts").cast("timestamp"))
        )


def new_feed(spark: SparkSession, source: DataFrame, name: str) -> Feed:
    prepare(spark)
    return Feed(spark, scratch_path(spark, f"{name}-landing"), source.schema)


def run_slices(
    feed: Feed,
    source: DataFrame,
    slices: Sequence[Column],
    start: Callable[[DataStreamWriter], object],
    build: Callable[[DataFrame], DataFrame],
    output_mode: str,
    name: str,
):
    """Land each slice of ``source`` (a filter per slice) and process it.

    ``build(stream)`` makes the streaming query from the landing stream (it is
    called once the first slice exists); ``start(writer)`` picks the sink and
    starts it; the checkpoint location is set here.  Returns the query's
    output schema.
    """
    ckpt = scratch_path(feed.spark, f"{name}-checkpoint")
    schema = None
    for cond in slices:
        source.filter(cond).write.mode("append").parquet(feed.landing)
        query = build(feed.stream())
        schema = query.schema
        writer = (
            query.writeStream.outputMode(output_mode)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True)
        )
        q = start(writer)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return schema


def to_parquet(path: str) -> Callable[[DataStreamWriter], object]:
    def start(writer: DataStreamWriter):
        return writer.format("parquet").option("path", path).start()

    return start


def day_slices(ts: str, cuts: Sequence) -> list[Column]:
    """Slices of the event log between the given day boundaries, in order."""
    t = F.col(ts)
    bounds = [None, *cuts, None]
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        c = F.lit(True)
        if lo is not None:
            c = c & (t >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            c = c & (t < F.lit(hi).cast("timestamp_ntz"))
        out.append(c)
    return out
