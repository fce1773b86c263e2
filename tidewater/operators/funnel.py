"""Funnels: how far a key's events get through ordered steps in time.

A chain begins with an event of step 1, goes on with the next event of step 2
after it, and so on; all within ``limit`` of its beginning.  What a run of
events does to a key's chains has a summary of fixed size:

* ``own[j]``: the latest beginning of a chain within the run that gets to
  step j in time;
* ``pass[i][j]``: the earliest time at which a chain that enters the run at
  step i gets to step j there.

Summaries of neighbouring runs compose (associatively) to that of both.  So
the events are range-partitioned in order, each task folds its rows to a
summary a key, and the few summaries of a key -- one for each task that holds
its events -- are composed: a key with a third of all events is as many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Summary:
    """The summary of a run of one key's events (times are integers)."""

    __slots__ = ("counts", "own", "passes")

    def __init__(self, steps: int):
        self.counts = [0] * steps
        self.own: list = [None] * steps
        self.passes: list = [[None] * steps for _ in range(steps)]

    def push(self, step: int, at: int, limit: int) -> None:
        """One more event of a step (from 0)."""
        self.counts[step] += 1
        if step == 0:
            self.own[0] = at
            return
        before = self.own[step - 1]
        if before is not None and at - before <= limit and (self.own[step] is None or before > self.own[step]):
            self.own[step] = before
        for i in range(step):
            if self.passes[i][step] is None and (i == step - 1 or self.passes[i][step - 1] is not None):
                self.passes[i][step] = at

    def then(self, b: Summary, limit: int) -> Summary:
        """The summary of this run followed by ``b``."""
        k = len(self.own)
        out = Summary(k)
        for j in range(k):
            out.counts[j] = self.counts[j] + b.counts[j]
            starts = [s for s in (self.own[j], b.own[j]) if s is not None]
            for i in range(j):
                if self.own[i] is not None and b.passes[i][j] is not None and b.passes[i][j] - self.own[i] <= limit:
                    starts.append(self.own[i])
            out.own[j] = max(starts, default=None)
            for i in range(j):
                # the chain leaves the first run at step i or at one it gets to there
                at = self.passes[i][j]
                if at is None:
                    left = [b.passes[m][j] for m in range(i, j) if m == i or self.passes[i][m] is not None]
                    at = min((t for t in left if t is not None), default=None)
                out.passes[i][j] = at
        return out

    def reached(self) -> int:
        """The furthest step (from 1) of any chain; 0 without a chain."""
        return max((j + 1 for j, s in enumerate(self.own) if s is not None), default=0)

    def row(self) -> tuple:
        return self.counts, self.own, [t for p in self.passes for t in p]

    @staticmethod
    def of(counts: list, own: list, passes: list) -> Summary:
        k = len(own)
        out = Summary(k)
        out.counts, out.own, out.passes = counts, own, [passes[i * k : (i + 1) * k] for i in range(k)]
        return out


def funnel(events: DataFrame, key: str, time: Column, order: Sequence[Column], step: Column, steps: int, limit: int, num_partitions: int | None = None) -> DataFrame:
    """``(key, counts, reached)`` for every key with an event: how many events
    of each step it has, and the furthest step its chains reach.

    ``time`` is an integer, ``order`` breaks ties, ``step`` is a number from 0
    (null or outside: ignored).  Events without a key or time are ignored."""
    rows = events.select(F.col(key).alias("key"), time.cast("long").alias("at"), *[c.alias(f"o{i}") for i, c in enumerate(order)], step.cast("int").alias("step"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("at").isNotNull() & F.col("step").between(0, steps - 1))
    by = [F.col(c) for c in ("key", "at", *[f"o{i}" for i in range(len(order))], "step")]
    ranged = (rows.repartitionByRange(num_partitions, *by) if num_partitions else rows.repartitionByRange(*by)).sortWithinPartitions(*by)
    kind = rows.schema["key"].dataType.simpleString()

    def emit(part, done):
        import pyarrow as pa

        keys, summaries = zip(*done, strict=True)
        counts, own, passes = zip(*(s.row() for s in summaries), strict=True)
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(keys, part.schema.field(0).type), pa.array(counts, longs), pa.array(own, longs), pa.array(passes, longs)], ["key", "counts", "own", "passes"])

    def folded(batches, fold):
        """Batches of a summary a key, of rows that come key by key."""
        current, summary, part = None, None, None
        for part in batches:
            done = []
            columns = [c.to_pylist() for c in part.columns]
            for k, *values in zip(*columns, strict=True):
                if summary is not None and k != current:
                    done.append((current, summary))
                    summary = None
                current, summary = k, fold(summary, values)
            if done:
                yield emit(part, done)
        if summary is not None:
            yield emit(part, [(current, summary)])

    def one_run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()

        def push(summary, event):
            summary = summary or Summary(steps)
            summary.push(event[1], event[0], limit)
            return summary

        for batch in folded((b.select(["key", "at", "step"]) for b in batches), push):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([pid] * batch.num_rows, pa.int64())], ["key", "counts", "own", "passes", "run"])

    def composed(batches):
        import pyarrow as pa

        def then(summary, row):
            after = Summary.of(*row)
            return summary.then(after, limit) if summary else after

        for batch in folded((b.select(["key", "counts", "own", "passes"]) for b in batches), then):
            reached = [Summary.of(*row).reached() for row in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(reached, pa.int32())], ["key", "counts", "reached"])

    runs = ranged.mapInArrow(one_run, f"key {kind}, counts array<long>, own array<long>, passes array<long>, run long")
    ordered = runs.repartition("key").sortWithinPartitions("key", "run")
    return ordered.mapInArrow(composed, f"key {kind}, counts array<long>, reached int").withColumnRenamed("key", key)
