"""Global order positions without a one-task window.

A window with no PARTITION BY (or one whose partition key is hot) funnels its
rows into a single task.  The operators here give every row its position in a
global order instead, using only:

1. ``repartitionByRange`` on the order key -- Spark samples the key and cuts it
   into ranges of about equal size, so one group holding a third of all rows
   is spread over a third of the partitions;
2. a sort inside each partition;
3. the row's index inside its partition (``monotonically_increasing_id`` keeps
   it in the low 33 bits), or a running sum of a weight column, written once
   to a parquet table in the shared checkpoint folder;
4. per-partition totals of that table -> offsets.  That table has one row per partition, a
   bound set by configuration, so broadcasting it is safe.

The callers then express ranks, quantiles and neighbour lookups as joins and
aggregates on these positions, none of which needs a whole group in one task.
Callers must order by a key that is unique, or accept that tied rows get
positions in arbitrary order (ranks and quantiles only look at tie groups).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tidewater.session import scratch_path

_LOW_BITS = (1 << 33) - 1


def _ranged(df: DataFrame, order, num_partitions: int | None) -> DataFrame:
    """Range-partition and sort.  Without an explicit count the cluster's
    shuffle settings decide, and AQE may merge adjacent small ranges (order
    is kept, since only neighbouring partitions are merged)."""
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def _offsets(totals: DataFrame, total_col: str) -> DataFrame:
    """Exclusive running total over partition ids (one row per partition)."""
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(
        totals.select("_pid", F.coalesce(F.sum(total_col).over(w), F.lit(0)).cast("long").alias("_off"))
    )


def _materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh parquet table in the shared checkpoint folder
    and read it back.

    The in-partition indices come from the task's partition id and row order,
    and ``repartitionByRange`` may draw its range bounds from a fresh sample
    every time the plan is executed.  Writing the indexed rows once makes
    every later branch (totals, joins, retries after a lost executor) see the
    same positions, and cuts the lineage.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def sequence_number(
    df: DataFrame,
    order: Sequence[str | Column],
    seq_col: str = "seq",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``seq_col``: the 0-based position of each row in ``order``."""
    ranged = _ranged(df, order, num_partitions).withColumn("_mid", F.monotonically_increasing_id())
    indexed = _materialize(
        ranged.select(
            "*",
            F.shiftright(F.col("_mid"), 33).alias("_pid"),
            F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_loc"),
        ).drop("_mid"),
        "seq",
    )
    totals = indexed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    out = indexed.join(_offsets(totals, "_n"), "_pid")
    return out.withColumn(seq_col, F.col("_off") + F.col("_loc")).drop("_pid", "_loc", "_off")


def weighted_prefix(
    df: DataFrame,
    order: Sequence[str | Column],
    weight: str | Sequence[str],
    before_col: str | Sequence[str] = "cum_before",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add, per weight column, the sum of that weight over all rows earlier
    in ``order`` (an exclusive prefix sum over the whole table).  With a
    weight of constant 1 this is the row's 0-based position.

    The running sums inside a partition are Arrow cumulative sums per batch,
    so no value of any other column is converted; they are written once (``_materialize``), and the partition
    totals are a JVM aggregate over that table.  Weights must be integral
    (counts, cents).
    """
    weights = [weight] if isinstance(weight, str) else list(weight)
    outs = [before_col] if isinstance(before_col, str) else list(before_col)
    ranged = _ranged(df, order, num_partitions)
    # StructType.add mutates, and DataFrame.schema is cached: build a copy.
    out_schema = StructType(list(ranged.schema.fields)).add("_pid", "long")
    for i in range(len(weights)):
        out_schema = out_schema.add(f"_cum{i}", "long")

    def local_prefix(batches):
        # Arrow keeps 64-bit integers and nulls of every column as they are
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        running = [0] * len(weights)
        for batch in batches:
            n = batch.num_rows
            arrays = [*batch.columns, pa.array([pid] * n, pa.int64())]
            for i, w in enumerate(weights):
                col = pc.fill_null(batch.column(batch.schema.get_field_index(w)).cast(pa.int64()), 0)
                cum = pc.add(pc.cumulative_sum(col), running[i])
                if n:
                    running[i] = cum[n - 1].as_py()
                arrays.append(pc.subtract(cum, col))
            yield pa.RecordBatch.from_arrays(arrays, names=out_schema.fieldNames())

    local = _materialize(ranged.mapInArrow(local_prefix, out_schema), "prefix")
    totals = local.groupBy("_pid").agg(
        *[F.coalesce(F.sum(w), F.lit(0)).cast("long").alias(f"_w{i}") for i, w in enumerate(weights)]
    )
    w_prev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(
        totals.select(
            "_pid",
            *[F.coalesce(F.sum(f"_w{i}").over(w_prev), F.lit(0)).cast("long").alias(f"_off{i}") for i in range(len(weights))],
        )
    )
    out = local.join(offsets, "_pid")
    for i, name in enumerate(outs):
        out = out.withColumn(name, F.col(f"_off{i}") + F.col(f"_cum{i}"))
    return out.drop("_pid", *[f"_cum{i}" for i in range(len(weights))], *[f"_off{i}" for i in range(len(weights))])
