"""Connected components by alternating large-star and small-star rounds.

The rounds follow Kiveris et al., "Connected Components in MapReduce and
Beyond" (SoCC 2014).  Edges are kept normalised as ``(hi, lo)`` with
``hi > lo``:

* large-star: every node ``u`` finds ``m(u)``, the smallest of itself and its
  neighbours, and each larger neighbour ``v > u`` is re-linked to ``m(u)``;
* small-star: every node ``u`` finds the smallest of itself and its smaller
  neighbours, and links itself and those neighbours to it.

Both steps are one partial aggregate (``min`` per node, combined map-side, so
a hub with a third of all edges ships a few rows per task) and one join back
to the edges.  The edge count never grows beyond edges + nodes.  They converge
in O(log^2 n) rounds -- a chain of n versions takes a handful, where
propagating labels one hop per round would take n.  At the fixed point every
component is a star around its smallest node.

Edges are written to a table in the shared checkpoint folder after every
round: the lineage stays one round long, and a lost executor only repeats the
current round.  The driver reads two numbers per round to test convergence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import scratch_path

SAFETY_ROUNDS = 100


def _write(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _both_ways(e: DataFrame) -> DataFrame:
    return e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        e.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )


def _norm(a, b) -> list:
    return [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]


def _large_star(e: DataFrame) -> DataFrame:
    adj = _both_ways(e)
    m = adj.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        adj.filter(F.col("v") > F.col("u"))
        .join(m, "u")
        .select(*_norm(F.col("v"), F.col("m")))
        .filter(F.col("hi") != F.col("lo"))
        .distinct()
    )


def _small_star(e: DataFrame) -> DataFrame:
    # the smaller neighbours of u are exactly the ``lo`` of edges with hi = u
    m = e.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    linked = e.join(m, e.hi == m.u).select(*_norm(F.col("lo"), F.col("m")))
    own = m.select(*_norm(F.col("u"), F.col("m")))
    return linked.unionByName(own).filter(F.col("hi") != F.col("lo")).distinct()


def _is_star_forest(e: DataFrame) -> bool:
    """True when no node is both a leaf (``hi``) and a centre (``lo``) and
    every leaf has one centre -- one aggregate per node, one job."""
    roles = e.select(F.col("hi").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        e.select(F.col("lo").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    )
    per_node = roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    bad = per_node.filter((F.col("leaf") > 1) | ((F.col("leaf") > 0) & (F.col("centre") > 0)))
    return bad.limit(1).count() == 0


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, component)`` for every node on an edge; the component id is
    the smallest node id in it."""
    e = _write(
        edges.select(*_norm(F.col(src), F.col(dst))).filter(F.col("hi") != F.col("lo")).distinct(), "cc-edges"
    )
    for _ in range(SAFETY_ROUNDS):
        if _is_star_forest(e):
            leaves = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            centres = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            return leaves.unionByName(centres)
        e = _write(_small_star(_large_star(e)), "cc-edges")
    raise RuntimeError("connected components did not converge")
