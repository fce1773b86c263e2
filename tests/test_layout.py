"""Plans over written layouts: no exchange under the join, pruned folders."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.plans.layout import STAR_REGION, bucketed, bucketed_orders_lines, pruned_star
from tidewater.sources.tables import Tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan()


def test_bucketed_join_has_no_exchange(spark):
    df = bucketed_orders_lines(spark, SF_SMALL)
    below = plan_of(df).toString().split("SortMergeJoin", 1)
    assert len(below) == 2 and "Exchange" not in below[1] and "SelectedBucketsCount: 32 out of 32" in below[1]
    # and one for the report's groups above it
    assert below[0].count("Exchange") == 1
    df.collect()
    assert "Exchange" not in plan_of(df).toString().split("SortMergeJoin", 1)[1].split("== Initial Plan ==")[0]


@pytest.mark.parametrize("buckets", [4, 9])
def test_bucketed_table_keeps_all_rows(spark, buckets):
    """Null keys, repeated rows and a key with most rows; an empty table."""
    rows = [(None, i) for i in range(7)] + [(5, 1)] * 200 + [(i, i) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, v long")
    assert sorted(map(tuple, bucketed(df, "odd", "k", buckets).collect()), key=repr) == sorted(rows, key=repr)
    assert bucketed(df.limit(0), "none", "k", buckets).count() == 0


def test_star_reads_only_the_regions_folders(spark):
    df = pruned_star(spark, SF_SMALL)
    assert "dynamicpruning" in plan_of(df).toString()
    got = {r["n_name"]: r["n_lines"] for r in df.collect()}
    t = Tables(spark, SF_SMALL)
    lines = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    want = {r["n_name"]: r["count"] for r in lines.filter(f"n_regionkey = {STAR_REGION}").groupBy("n_name").count().collect()}
    assert got == want

    assert folders_read(plan_of(df).finalPhysicalPlan()) == len(want)


def folders_read(plan):
    """Folders that the scan of the partitioned table read, by its metric."""
    leaves, found = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            found += folders_read(leaf.plan())
        elif leaf.metrics().contains("numPartitions"):
            found += leaf.metrics().apply("numPartitions").value()
    return found
