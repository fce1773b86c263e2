"""Sharding: k-d tree partitioning by bytes, in DataFrame functions only.

Rows with equal texts form a group that is never split; a group weighs the
bytes of all its rows.  Starting from one node with all groups, every node
that stands for more than one shard is cut: along the dimension of the
metadata in which its groups spread widest (relative to all groups), at the
weighted median -- for an odd number of shards at the matching fraction --
until a leaf holds one shard's bytes.  Dimensions: size (logarithm), source and
language (ranks of their distinct values) and id; equal values are ordered by a
hash of the text.

The weighted quantile is found by distributed sums: a group's place in its
node is a 48-bit number (16 bits of the dimension, 32 bits of the hash);
three rounds sum the weights by the next 16 bits and keep the bin with the
quantile.  The driver sees one row a node (fewer than there are shards),
never groups.  All nodes of a level are cut together.

Slots: rows of a shard are dealt into hash buckets; a row's slot is the rows
of the buckets before plus its place in its bucket.  The buckets grow with
the square root of the table, so neither a bucket nor the list of buckets
gets large.

Nulls: a null text is a group of its own (size 1, no bytes, crc of the empty
text); null source, language and id come first in their dimensions.  Empty
tables give no rows.  Repeated rows stay together and get slots of their own.
A group heavier than a shard's share makes its shard that much larger.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import Written
from tidewater.operators.sequence import sequence_number

BITS = 16
DIMENSIONS = ("size", "source", "lang", "doc_id")
#: Distinct sources or languages that may be broadcast; beyond it the join is salted.
BROADCAST_VALUES, SALTS = 100_000, 32


def _key(value: Column) -> Column:
    """A non-null string that sorts like the value, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def _ranked(groups: DataFrame, key: str, rank: str) -> DataFrame:
    """``groups`` with the rank of ``key`` among its distinct values."""
    values = sequence_number(groups.select(key).distinct(), [key], rank)
    values = Written(values.withColumn(rank, F.col(rank).cast("double")), "kd-values").df
    if values.count() <= BROADCAST_VALUES:
        return groups.join(F.broadcast(values), key)
    salted = values.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = groups.withColumn("salt", F.pmod(F.xxhash64("group_key", F.lit(4)), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [key, "salt"]).drop("salt")


def grouped(docs: DataFrame) -> DataFrame:
    """One row a text: ``(group_key, weight, x0, x1, x2, x3, tie)``."""
    text = F.col("text")
    key = F.xxhash64(text, F.isnull(text))
    size = F.coalesce(F.octet_length(text), F.lit(0)) + 1
    rows = docs.select(
        key.alias("group_key"), size.cast("long").alias("size"), _key(F.col("source")).alias("k1"), _key(F.col("lang")).alias("k2"), F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("x3")
    )
    lowest = F.min(F.when(F.col("x3") > float("-inf"), F.col("x3")))
    groups = rows.groupBy("group_key").agg(
        F.sum("size").alias("weight"), F.log2(F.max("size").cast("double")).alias("x0"), F.min("k1").alias("k1"), F.min("k2").alias("k2"), lowest.alias("x3")
    )
    groups = Written(groups, "kd-texts").df
    for d in (1, 2):
        groups = _ranked(groups, f"k{d}", f"x{d}")
    return groups.drop("k1", "k2").withColumn("tie", F.pmod(F.xxhash64("group_key", F.lit(3)), F.lit(1 << 32)))


def _looked_up(values: dict, key: Column, kind: str) -> Column:
    """The value of each node as a literal map; a row a node at most."""
    entries = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast(kind))]
    return F.create_map(*entries)[key]


def _spread(groups: DataFrame) -> DataFrame:
    return groups.groupBy("node").agg(
        F.sum("weight").alias("w"), *[f(f"x{d}").alias(f"{n}{d}") for d in range(len(DIMENSIONS)) for n, f in (("lo", F.min), ("hi", F.max))]
    )


def tree(groups: DataFrame, shards: int) -> DataFrame:
    """``groups`` with ``shard``, from 0."""
    node = F.lit(0).cast("long")
    # a node is the first of the shards it stands for
    spans = {0: shards}
    whole: dict[int, float] = {}
    while any(n > 1 for n in spans.values()):
        at = groups.withColumn("node", node)
        open_ = {k: n for k, n in spans.items() if n > 1}
        stats = {r["node"]: r for r in _spread(at).filter(F.col("node").isin(list(open_))).collect()}
        dim, low, wide, want = {}, {}, {}, {}
        for k, n in open_.items():
            r = stats.get(k)
            widths = [(r[f"hi{d}"] - r[f"lo{d}"]) if r and r[f"lo{d}"] is not None else 0.0 for d in range(len(DIMENSIONS))]
            if not whole:
                whole = {d: w or 1.0 for d, w in enumerate(widths)}
            best = max(range(len(widths)), key=lambda d: (widths[d] / whole[d], -d))
            dim[k], low[k], wide[k] = best, float(r[f"lo{best}"] or 0.0) if r else 0.0, widths[best] or 1.0
            want[k] = (r["w"] if r else 0) * (n // 2) / n
        value = F.lit(0.0)
        for d in range(len(DIMENSIONS)):
            value = F.when(_looked_up(dim, node, "int") == d, F.coalesce(F.col(f"x{d}"), _looked_up(low, node, "double"))).otherwise(value)
        step = F.floor((value - _looked_up(low, node, "double")) / _looked_up(wide, node, "double") * (2**BITS - 1)).cast("long")
        place = F.least(F.greatest(step, F.lit(0)), F.lit(2**BITS - 1)) * F.lit(1 << 32) + F.col("tie")
        place = F.when(node.isin(list(open_)), place)
        placed = groups.withColumn("node", node).withColumn("place", place).filter(F.col("place").isNotNull())
        below, prefix = dict.fromkeys(open_, 0.0), dict.fromkeys(open_, 0)
        for shift in (32, 16, 0):
            inside = placed if shift == 32 else placed.filter(F.shiftright("place", shift + BITS) == _looked_up(prefix, F.col("node"), "long"))
            bins = inside.groupBy("node", F.shiftright("place", shift).alias("bin")).agg(F.sum("weight").alias("w"))
            before = F.sum("w").over(Window.partitionBy("node").orderBy("bin")) - F.col("w") + _looked_up(below, F.col("node"), "double")
            # the last bin that begins below the wanted weight
            found = bins.withColumn("before", before).filter(F.col("before") < _looked_up(want, F.col("node"), "double")).groupBy("node").agg(F.max_by("before", "bin").alias("before"), F.max_by("w", "bin").alias("w"), F.max("bin").alias("bin"))
            for r in found.collect():
                below[r["node"]], prefix[r["node"]] = float(r["before"]), r["bin"]
                last = float(r["w"])
                if shift == 0 and want[r["node"]] - float(r["before"]) < last / 2:
                    prefix[r["node"]] = r["bin"] - 1  # the group at the cut goes where more of it belongs
        # up to the cut stays, the rest takes the later shards
        half = {k: n // 2 for k, n in open_.items()}
        over = F.coalesce(place > _looked_up(prefix, node, "long"), F.lit(False))
        groups = Written(groups.withColumn("shard", F.when(over, node + _looked_up(half, node, "long")).otherwise(node)), "kd-level").df
        node = F.col("shard")
        for k, h in half.items():
            spans[k + h] = spans[k] - h
            spans[k] = h
    return groups if "shard" in groups.columns else groups.withColumn("shard", node)


def assign(docs: DataFrame, shards: int) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = Written(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.xxhash64(F.col("text"), F.isnull("text")).alias("group_key")
        ),
        "kd-rows",
    ).df
    groups = Written(grouped(docs), "kd-groups").df
    placed = rows.join(tree(groups, shards).select("group_key", "shard"), "group_key")
    n = rows.count()
    buckets = max(1, math.ceil(math.sqrt(n) / 4))
    bucket = F.pmod(F.xxhash64("doc_id", F.col("text_crc32"), F.lit(9)), F.lit(buckets)).cast("long")
    placed = placed.withColumn("bucket", bucket)
    counts = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "bucket", before.alias("start"))
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    return placed.withColumn("at", F.row_number().over(order)).join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), (F.col("start") + F.col("at") - 1).cast("long").alias("slot")
    )
