"""Merkle manifest of a table with a proof for every row.

Leaves are rows' hashes; each group (a language) is a tree over its leaves in
order, and the trees' roots are the leaves of one more tree, whose root stands
for the table.  Every two consecutive nodes become the hash of their digests
as text; a last node without a neighbour is hashed alone.

Every node carries the interval of leaf ranks that it covers.

* Build.  Ranks come from a global sort (ranges and offsets, so a hot group is
  many tasks).  A block of ``2**TIER`` nodes is hashed up to its root in one
  task; the blocks' roots are the nodes of the next tier.  A tree of n leaves
  takes log(n)/TIER rounds; each tier is written.
* Siblings.  A node's parent interval less its own is its sibling's interval,
  or empty; one join on (tree, level, start) finds the sibling's hash.
* Ancestors.  A leaf has one ancestor a level: that whose interval contains
  its rank.  Both are bucketed by level, as rank divided by the nodes' width
  there, so containment is an equality of buckets and a check of bounds.
  Leaves meet only the nodes of their block (at most ``2**TIER`` rows a
  bucket, however hot the group); blocks, as the next tier's leaves, meet
  theirs; a leaf's path is its own followed by its block's.

Nulls: a null field is ``-``, a null group is a tree of its own and the first,
a null order column comes first.  Rows that tie in the order column follow
their leaves' hashes; equal rows are equal leaves, each with its own place.
Long texts are hashed whole.  An empty table gives no rows.  Of the input only
the named columns are used, other columns are free to clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Written, ship
from tidewater.operators.sequence import sequence_number

ship(__name__)

#: Levels that one block spans.
TIER = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Trees whose first positions may be broadcast; beyond it the join is salted.
BROADCAST_TREES, SALTS = 100_000, 64
STEP = "array<struct<level:int,left:boolean,hash:binary>>"


def field(value: Column) -> Column:
    """``-``, or the bytes' number, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    """A row's hash, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def digest(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def _tree(group: Column) -> Column:
    """A non-null key that sorts like the group, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _ranked(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with ``rank``, the place within their ``tree``."""
    placed = sequence_number(rows, [F.col("tree"), *order], "at")
    firsts = Written(placed.groupBy("tree").agg(F.min("at").alias("first")), "merkle-firsts").df
    if firsts.count() <= BROADCAST_TREES:
        out = placed.join(F.broadcast(firsts), "tree")
    else:
        salted = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        out = placed.withColumn("salt", (F.col("at") % SALTS).cast("int")).join(salted, ["tree", "salt"]).drop("salt")
    return out.withColumn("rank", F.col("at") - F.col("first")).drop("at", "first")


def _grown(units: DataFrame, tier: int) -> DataFrame:
    """The nodes above and including ``(tree, rank, lo, hi, hash)`` up to the
    blocks' roots, which have no parent interval."""
    most = TIER

    def grow(key, pdf):
        import hashlib

        import pandas as pd

        tree, block = key
        pdf = pdf.sort_values("rank")
        row = list(zip(pdf["lo"].tolist(), pdf["hi"].tolist(), [bytes(h).hex() for h in pdf["hash"]], strict=True))
        out, level = [], tier * most
        # only the last block is short; behind others it still rises to their height
        while len(row) > 1 or (block > 0 and level < (tier + 1) * most):
            above = []
            for i in range(0, len(row), 2):
                run = row[i : i + 2]
                lo, hi = run[0][0], run[-1][1]
                out += [(level, a, b, lo, hi, bytes.fromhex(h)) for a, b, h in run]
                above.append((lo, hi, hashlib.sha256("".join(h for _, _, h in run).encode()).hexdigest()))
            row, level = above, level + 1
        out.append((level, row[0][0], row[0][1], None, None, bytes.fromhex(row[0][2])))
        made = pd.DataFrame(out, columns=["level", "lo", "hi", "parent_lo", "parent_hi", "hash"])
        made = made.astype({"parent_lo": "Int64", "parent_hi": "Int64"})
        made.insert(0, "block", block)
        made.insert(0, "tree", tree)
        return made

    rows = units.withColumn("block", F.shiftright("rank", TIER))
    return rows.groupBy("tree", "block").applyInPandas(grow, "tree string, block long, level int, lo long, hi long, parent_lo long, parent_hi long, hash binary")


def _siblings(nodes: DataFrame) -> DataFrame:
    """``(tree, level, lo, hi, left, sibling)`` of the nodes with a parent:
    the interval difference within it, and the hash of the node there."""
    below = nodes.filter(F.col("parent_lo").isNotNull())
    left = F.col("lo") > F.col("parent_lo")
    other = F.when(left, F.struct(F.col("parent_lo").alias("lo"), F.col("lo").alias("hi")))
    other = other.when(F.col("hi") < F.col("parent_hi"), F.struct(F.col("hi").alias("lo"), F.col("parent_hi").alias("hi")))
    asked = below.select("tree", "level", "lo", "hi", left.alias("left"), other["lo"].alias("o_lo"), other["hi"].alias("o_hi"))
    there = below.select("tree", "level", F.col("lo").alias("o_lo"), F.col("hi").alias("o_hi"), F.col("hash").alias("sibling"))
    return asked.join(there, ["tree", "level", "o_lo", "o_hi"], "left").drop("o_lo", "o_hi")


def _paths(units: DataFrame, nodes: DataFrame, tier: int) -> DataFrame:
    """``(tree, rank, path)``: for every unit the siblings on its way to its
    block's root, by the containment join."""
    bucket = F.expr("shiftright(lo, level)")
    levels = F.explode(F.sequence(F.lit(tier * TIER), F.lit((tier + 1) * TIER - 1))).alias("level")
    asked = units.select("tree", "rank", F.col("lo").alias("u_lo"), F.col("hi").alias("u_hi"), F.col("lo"), levels).withColumn("bucket", bucket).drop("lo")
    found = asked.join(_siblings(nodes).withColumn("bucket", bucket), ["tree", "level", "bucket"])
    found = found.filter((F.col("lo") <= F.col("u_lo")) & (F.col("u_hi") <= F.col("hi")))
    step = F.struct("level", "left", F.col("sibling").alias("hash"))
    return found.groupBy("tree", "rank").agg(F.array_sort(F.collect_list(step)).alias("path"))


def _climb(units: DataFrame, name: str) -> tuple[list[tuple[DataFrame, DataFrame]], DataFrame]:
    """The tiers' units and nodes, and ``(tree, hash)`` of the trees' roots."""
    tiers = []
    while True:
        nodes = Written(_grown(units, len(tiers)), f"merkle-{name}").df
        tiers.append((units, nodes))
        roots = nodes.filter(F.col("parent_lo").isNull()).select("tree", F.col("block").alias("rank"), "lo", "hi", "hash")
        if roots.filter("rank > 0").isEmpty():
            return tiers, roots.select("tree", "hash")
        units = roots


def _descend(tiers: list[tuple[DataFrame, DataFrame]], above: DataFrame) -> DataFrame:
    """``(tree, rank, path, *extra)`` of the lowest units, from ``(tree, path,
    *extra)`` above the trees' roots."""
    extra = [c for c in above.columns if c not in ("tree", "path")]
    upper = above.withColumn("rank", F.lit(0).cast("long"))
    for k in range(len(tiers) - 1, -1, -1):
        units, nodes = tiers[k]
        own = units.select("tree", "rank").join(_paths(units, nodes, k), ["tree", "rank"], "left")
        blocks = upper.select("tree", F.col("rank").alias("block"), F.col("path").alias("rest"), *extra)
        joined = own.withColumn("block", F.shiftright("rank", TIER)).join(blocks, ["tree", "block"])
        path = F.concat(F.coalesce("path", F.array().cast(STEP)), "rest")
        upper = joined.select("tree", "rank", path.alias("path"), *extra)
        if k:  # blocks' paths are few; the leaves' go on as they are
            upper = Written(upper, "merkle-paths").df
    return upper


def manifest(docs: DataFrame, keep: dict[str, Column], fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """``(*keep, leaf, subroot, root, path)`` for every row: ``path`` holds the
    siblings from the leaf to the root, with a null hash where a node is
    hashed alone, ``left`` where the sibling comes first.  ``keep`` are
    expressions of the input's columns."""
    own = {f"k{i}": c for i, c in enumerate(keep.values())}
    rows = docs.select(_tree(F.col(group)).alias("tree"), F.col(order).alias("place"), leaf([F.col(f) for f in fields]).alias("hash"), *[c.alias(n) for n, c in own.items()])
    leaves = Written(_ranked(rows, [F.col("place"), F.col("hash")]), "merkle-leaves").df
    units = leaves.select("tree", "rank", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash")
    tiers, subroots = _climb(units, "nodes")
    forest = _ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("group"), "hash"), [F.col("group")])
    forest = Written(forest, "merkle-forest").df
    top, roots = _climb(forest.select("tree", "rank", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "hash"), "forest")
    above = _descend(top, roots.select("tree", F.array().cast(STEP).alias("path"), F.col("hash").alias("root")))
    above = above.join(forest.select("rank", "group", F.col("hash").alias("subroot")), "rank")
    above = Written(above.select(F.col("group").alias("tree"), "path", "subroot", "root"), "merkle-above").df
    paths = _descend(tiers, above)
    out = leaves.join(paths, ["tree", "rank"])
    return out.select(*[F.col(n).alias(k) for n, k in zip(own, keep, strict=True)], F.col("hash").alias("leaf"), "subroot", "root", "path")


def fold(start: Column, path: Column) -> Column:
    """The root (as text) that a leaf (as text) and its path lead to."""

    def up(own: Column, step: Column) -> Column:
        other = digest(step["hash"])
        return F.sha2(F.when(step["hash"].isNull(), own).when(step["left"], F.concat(other, own)).otherwise(F.concat(own, other)), 256)

    return F.aggregate(path, start, up)


def proof(path: Column) -> Column:
    """The hash of a path's siblings."""
    others = F.filter(path, lambda s: s["hash"].isNotNull())
    return F.sha2(F.array_join(F.transform(others, lambda s: digest(s["hash"])), ""), 256)


def tampered(docs: DataFrame) -> Column:
    """The leaf after tampering with every row whose id's checksum seven
    divides: its number of characters grows by one.  Null for other rows."""
    more = {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    values = [more.get(f, F.col(f)) for f in FIELDS]
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, leaf(values))


def checked(docs: DataFrame) -> DataFrame:
    """What ``op12`` returns."""
    rows = manifest(docs, {"doc_id": F.col("doc_id"), "changed": tampered(docs)})
    texts = {c: digest(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")}
    folded = fold(digest(F.coalesce("changed", "leaf")), F.col("path"))
    out = rows.select("doc_id", *texts.values(), proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
