"""Mixing sources to target weights: pivotal dependent rounding.

Every row of a source wants target / source_size copies.  The whole part is
certain; the fraction is rounded dependently: two rows with fractions meet,
and words are moved from one to the other at random, up to where one of the
two becomes 0 or 1.  The expectation of every row and the words of the pair
are kept, so only the last fraction of a source is ever decided by a plain
draw, and a source's taken words miss its target by one row at most.

The meetings form a reduction tree.  Leaves are hash blocks of about
``BLOCK`` rows, so a hot source is many leaves; each leaves one fraction at
most to the next level, where ``FAN`` blocks meet, up to one for the source.
Only ids, sizes and fractions travel; no task holds more than a few blocks.
All draws are hashes of the row's key and the level: reruns agree.

Rows that are equal in id, source and text are weighed as one and get the
same number of copies.  Null texts have size 0; rows of size 0 are never
taken.  Null ids and sources are values like others.  Targets: sources in
order of code points, null last, weigh 3, 1, 2, repeating (or as given), and
share ``share`` times all words; none gets more than ``most`` times its own,
the excess is shared again by weight.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import Written, fresh, ship, text_digest

ship(__name__)

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (3.0, 1.0, 2.0), 1.5, 2.0
BLOCK, FAN = 4096, 256
#: Sources up to which their plan (24 bytes each) is broadcast.
BROADCAST_SOURCES = 100_000


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(docs: DataFrame) -> Column:
    """Equal for rows that are equal in id, source and text."""
    return F.xxhash64(F.col("doc_id"), F.col("source"), text_digest(F.col("text")), F.isnull("text"), F.isnull("source"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    The reshared targets are min(level * weight, most * size) for the one
    level at which they use up the shared words: sources by the ratio of cap
    to weight fill up first.  One row a source enters the windows."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # string order of Spark is by UTF-8 bytes, which is by code points
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    one = totals.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(most))
    every = Window.partitionBy()
    filled = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    one = (
        one.withColumn("_all", F.sum("source_size").over(every) * float(share))
        .withColumn("_left_w", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(filled), F.lit(0.0)))
        .withColumn("_left", F.col("_all") - F.coalesce(F.sum("_cap").over(filled), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.col("_left_w"))
    )
    # The level rises until the first source that does not fill up, then falls.
    # If all fill up there is none.
    highest = F.max("_level").over(every)
    level = F.when(F.max(F.col("_cap") / F.col("_w")).over(every) >= highest, highest)
    target = F.least(F.col("_cap"), F.coalesce(level, F.lit(float("inf"))) * F.col("_w"))
    return one.select("source", "source_size", target.alias("target"))


def _draws(keys: np.ndarray, level: int) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit keys."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53


def pivot(keys: np.ndarray, sizes: np.ndarray, parts: np.ndarray, level: int) -> np.ndarray:
    """Fractions after all meetings of a block: 0 and 1, but for one at most."""
    p, draw = parts.astype(float).tolist(), _draws(keys, level).tolist()
    size = sizes.astype(float).tolist()
    eps = 1e-9
    held = -1
    # Small rows last: what is left to a plain draw is then a small row.
    for i in np.lexsort((keys, -sizes)).tolist():
        if not eps < p[i] < 1 - eps:
            p[i] = round(p[i])
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        # words that can go from b to a, and from a to b
        up = min((1 - p[a]) * size[a], p[b] * size[b])
        down = min(p[a] * size[a], (1 - p[b]) * size[b])
        move = up if draw[i] < down / (up + down) else -down
        p[a] += move / size[a]
        p[b] -= move / size[b]
        held = -1
        for k in (a, b):
            if eps < p[k] < 1 - eps:
                held = k
            else:
                p[k] = float(round(p[k]))
    return np.array(p)


def _round_blocks(rows: DataFrame, level: int) -> DataFrame:
    def one(pdf):
        out = pdf[["_key", "_source", "_block", "_size"]].copy()
        out["_part"] = pivot(pdf["_key"].to_numpy(), pdf["_size"].to_numpy(), pdf["_part"].to_numpy(), level)
        return out

    # one key of both, or rows that come dealt by source would stay so
    cell = rows.withColumn("_cell", F.xxhash64("_source", "_block"))
    return cell.groupBy("_cell").applyInPandas(one, "_key long, _source long, _block long, _size double, _part double")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row a document: ``(doc_id, size, source_size, target, taken,
    copies, row_key)``; repeated rows repeat."""
    rows = Written(docs.select("doc_id", "source", row_key(docs).alias("row_key"), words(F.col("text")).alias("size")), "mix-rows").df
    shares = targets(rows, weights, share, most).withColumn("_source", F.xxhash64("source", F.isnull("source")))
    # one row a source; its rate and its number of blocks
    units = rows.groupBy("row_key", "source").agg(F.sum("size").cast("double").alias("_size"))
    units = units.withColumn("_source", F.xxhash64("source", F.isnull("source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_units") / BLOCK)).cast("long")
    counts = units.groupBy("_source").agg(F.count(F.lit(1)).alias("_units"))
    plan = shares.join(counts, "_source").select("_source", rate.alias("_rate"), blocks.alias("_blocks"))
    deepest, sources = counts.agg(F.max("_units"), F.count(F.lit(1))).first()
    if sources <= BROADCAST_SOURCES:  # three numbers a source; more are joined by a shuffle
        plan = F.broadcast(plan)
    parts = (
        units.join(plan, "_source")
        .withColumn("_whole", F.floor("_rate"))
        .withColumn("_part", F.when(F.col("_size") > 0, F.col("_rate") - F.col("_whole")).otherwise(F.lit(0.0)))
        .withColumn("_block", F.pmod(F.xxhash64("row_key", F.lit(1)), F.col("_blocks")))
        .withColumnRenamed("row_key", "_key")
    )
    level, open_, decided = 0, parts, []
    width = -(-(deepest or 1) // BLOCK)
    while True:
        out = Written(_round_blocks(open_.select("_key", "_source", "_block", "_size", "_part"), level), "mix-level").df
        decided.append(out.filter((F.col("_part") == 0) | (F.col("_part") == 1)).select("_key", "_part"))
        left = out.filter((F.col("_part") > 0) & (F.col("_part") < 1))
        if width <= 1:
            break
        width = -(-width // FAN)
        open_ = left.withColumn("_block", F.floor(F.col("_block") / FAN).cast("long"))
        level += 1
    # the last fraction of a source: a plain draw
    chance = (F.pmod(F.xxhash64("_key", F.lit(77)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    decided.append(left.select("_key", (chance < F.col("_part")).cast("double").alias("_part")))
    drawn = decided[0]
    for d in decided[1:]:
        drawn = drawn.unionByName(d)
    whole = shares.select("source", "source_size", "target", F.floor(rate).alias("_whole"))
    result = rows.join(drawn.withColumnRenamed("_key", "row_key"), "row_key").join(whole, rows["source"].eqNullSafe(whole["source"])).drop(whole["source"])
    copies = F.when(F.col("size") > 0, F.col("_whole") + F.col("_part")).otherwise(F.lit(0)).cast("int")
    return result.select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("size") * copies).cast("long").alias("taken"), copies.alias("copies"), "row_key"
    )


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: every row as often as it is taken, its columns
    unchanged."""
    mixed = mix(docs, **options)
    key, n = fresh("row_key", docs), fresh("copies", docs)
    copies = mixed.groupBy("row_key").agg(F.max("copies").alias(n)).withColumnRenamed("row_key", key).filter(F.col(n) > 0)
    kept = docs.withColumn(key, row_key(docs)).join(copies, key)
    return kept.withColumn(n, F.explode(F.array_repeat(F.lit(0), F.col(n)))).select(*docs.columns)
