"""Readers for the fourteen input tables.

Reads are lazy ``spark.read.parquet`` calls: Catalyst pushes filters into the
scan (``PushedFilters``) and prunes columns (``ReadSchema``), so jobs select
only what they use and never pre-filter by hand.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import prepare

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    single = os.path.join(sf_dir, f"{name}.parquet")
    # A table is either one parquet file or a folder of them; Spark reads both.
    return single if os.path.exists(single) or "://" in sf_dir else os.path.join(sf_dir, name)


# Tables whose jobs are CPU-heavy per row (tokenising, regex over whole
# texts and pages).
TEXT_TABLES = frozenset({"documents", "pages", "benchmark", "conversations"})


def ensure_parallel(df: DataFrame) -> DataFrame:
    """Spread ``df`` over the cluster's cores if its scan has fewer splits
    than that (a small file with one row group is one task).  Local sessions
    only: on a cluster the table is returned unchanged."""
    sc = df.sparkSession.sparkContext
    if not sc.master.startswith("local"):
        return df
    cores = sc.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    return ensure_parallel(df) if name in TEXT_TABLES else df


class Tables:
    """Attribute access to the tables of one folder: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every table as a temp view, for jobs written in SQL."""
    for name in TABLES:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
