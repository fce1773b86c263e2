"""Jobs over written layouts: bucketed tables joined without an exchange, and
a partitioned fact table pruned at run time.

Both write to the shared checkpoint folder; tables have names of their own, so
runs do not meet.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.exact import sum_units, units
from tidewater.plans.catalog import job
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables

BUCKETS = 32
STAR_REGION = 2


def bucketed(df: DataFrame, name: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """``df`` as a table of ``buckets`` files, hashed and sorted by ``key``:
    joins and aggregates on the key of tables with as many buckets need no
    exchange.  Rows are dealt by the key before, so a bucket is one file."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", scratch_path(spark, name))
        .saveAsTable(table)
    )
    return spark.table(table)


@job(
    "bucketed_orders_lines",
    """
    SELECT o.o_orderpriority, l.l_returnflag, count(*) AS n_lines,
           CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(6,2)))) AS DOUBLE) AS revenue
    FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    GROUP BY o.o_orderpriority, l.l_returnflag
    """,
)
def bucketed_orders_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue by order priority and return flag over two bucketed tables.

    Lines are added up by order and flag before they are written (combined
    map-side, so an order with a third of all lines is a few rows); the join
    and its aggregate by order read matching buckets side by side."""
    t = Tables(spark, sf_dir)
    worth = units("l_extendedprice") * (F.lit(100) - units("l_discount"))
    lines = t.lineitem.filter(F.col("l_orderkey").isNotNull()).groupBy("l_orderkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"), sum_units(worth).alias("worth"))
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    joined = bucketed(orders, "orders_by_key", "o_orderkey").join(bucketed(lines, "lines_by_key", "l_orderkey").hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    out = joined.groupBy("o_orderpriority", "l_returnflag").agg(F.sum("n").alias("n_lines"), F.sum("worth").alias("worth"))
    return out.select("o_orderpriority", "l_returnflag", "n_lines", (F.col("worth").cast("decimal(38,0)") / F.lit(10_000).cast("decimal(20,0)")).cast("double").alias("revenue"))


@job(
    "pruned_star",
    f"""
    SELECT n.n_name, count(*) AS n_lines, CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey
    WHERE n.n_regionkey = {STAR_REGION}
    GROUP BY n.n_name
    """,
)
def pruned_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by the supplier's nation, over a table partitioned by it.

    The filter is on the nations; the planner runs it first and lists only the
    folders of the nations found (dynamic partition pruning), so the other
    regions' lines are never read."""
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "lines_by_nation")
    lines = t.lineitem.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines.select("l_orderkey", "l_quantity", "s_nationkey").hint("rebalance", "s_nationkey").write.partitionBy("s_nationkey").parquet(path)
    fact = spark.read.parquet(path)
    nation = F.broadcast(t.nation.filter(F.col("n_regionkey") == STAR_REGION).select("n_nationkey", "n_name"))  # at most 25 rows
    joined = fact.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_lines"), (sum_units(units("l_quantity")) / F.lit(100).cast("decimal(20,0)")).cast("double").alias("quantity"))
