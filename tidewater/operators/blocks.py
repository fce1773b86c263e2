"""Comparison of the members of buckets inside tasks.

Buckets may hold any number of members.  A bucket of m members is dealt by
hash into m / ``BLOCK_ROWS`` blocks, and every two blocks (and each block with
itself) meet in one task, which compares their sketches as arrays and puts out
only the pairs that agree: pairs are never rows before they are found alike.
A task holds two blocks, whatever the bucket's size; a bucket with a third of
all rows is many groups.  A bucket whose members are all of one group has
nothing to compare and is left out before its rows move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.joins import broadcast_if_small
from tidewater.session import scratch_path

BLOCK_ROWS = 512
#: Sketches of words are compared so many pairs at once.
PAIRS_AT_ONCE = 1 << 16
#: Hashes that a block holds; a longer member is a block of its own, about.
BLOCK_WEIGHT = 400_000
_KEY = ["k1", "k2", "i", "j"]


def alike_in_buckets(members: DataFrame, keys: list[str], node: str, group: str, sketch: str, least: int) -> DataFrame:
    """``(src, dst)`` of members of one bucket (two long ``keys``) whose
    ``sketch`` bytes, all of one length, agree in at least ``least`` places and
    whose ``group`` differs; a pair may come out once a bucket."""
    return _dealt(_named(members, keys, node, group, sketch)).mapInArrow(_comparer(least), "src long, dst long")


def alike_words_in_buckets(members: DataFrame, keys: list[str], node: str, group: str, words: str, least: int, block_rows: int) -> DataFrame:
    """Like ``alike_in_buckets``, but the sketches are ``words`` (arrays of
    longs, all of one length) that agree in at least ``least`` bits: a few words
    tell as much as many bytes, so rows are small and blocks may be large."""
    m = _named(members, keys, node, group, words)
    return _dealt(m, block_rows=block_rows).mapInArrow(_comparer(least, bits=True), "src long, dst long")


def groups_alike_in_buckets(members: DataFrame, keys: list[str], node: str, group: str, sketch: str, least: int) -> DataFrame:
    """Like ``alike_in_buckets``, but ``(src, dst)`` are groups, and of the
    pairs that meet in a task only those that join groups not yet joined there:
    fewer rows than members, however many pairs agree."""
    return _dealt(_named(members, keys, node, group, sketch)).mapInArrow(_comparer(least, forest=True), "src long, dst long")


def near_in_groups(members: DataFrame, key: str, node: str, group: str, sketch: str, least: int, hashes: str, threshold: float) -> DataFrame:
    """``(src, dst)`` of members with one long ``key``, of different groups,
    whose sketches agree and whose ``hashes`` (distinct longs) have a Jaccard
    similarity of at least ``threshold``, compared inside tasks.  Of the links
    found in a task only those that join groups not yet joined there come out:
    enough for components, and fewer than members."""
    m = _named(members.withColumn("_one", F.lit(0)), [key, "_one"], node, group, sketch, F.array_sort(hashes).alias("hashes"))
    return _dealt(m, F.size("hashes")).mapInArrow(_comparer(least, True, threshold), "src long, dst long")


def _named(members: DataFrame, keys: list[str], node: str, group: str, sketch: str, *more) -> DataFrame:
    return members.select(*[F.col(c).cast("long").alias(k) for c, k in zip(keys, ("k1", "k2"))], F.col(node).alias("node"), F.col(group).alias("grp"), F.col(sketch).alias("sketch"), *more)


def _dealt(m: DataFrame, weight=None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Members in order of their block pairs; blocks hold ``block_rows`` rows
    or ``BLOCK_WEIGHT`` of the weight, whichever is less, about."""
    n = F.ceil(F.count(F.lit(1)) / F.lit(block_rows))
    if weight is not None:
        n = F.greatest(n, F.ceil(F.sum(weight) / F.lit(BLOCK_WEIGHT)))
    path = scratch_path(m.sparkSession, "blocks")
    blocks = m.groupBy("k1", "k2").agg(n.cast("int").alias("n"), F.min("grp").alias("g1"), F.max("grp").alias("g2"))
    blocks.filter("g1 < g2").select("k1", "k2", "n").write.parquet(path)
    own = m.join(broadcast_if_small(m.sparkSession.read.parquet(path)), ["k1", "k2"]).withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("n")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    met = met.select("k1", "k2", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("second"), *m.columns[2:])
    return met.repartition(*_KEY).sortWithinPartitions(*_KEY)


def _comparer(least: int, forest: bool = False, threshold: float | None = None, bits: bool = False):
    key, at_once = list(_KEY), PAIRS_AT_ONCE

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        def pairs(t):
            """Alike pairs of the whole groups in ``t``, in order of the key."""
            cols = [t.column(c).to_numpy() for c in key]
            new = np.zeros(t.num_rows, dtype=bool)
            new[:1] = True
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            starts = np.append(np.flatnonzero(new), t.num_rows)
            node, grp = t.column("node").to_numpy(), t.column("grp").to_numpy()
            second = t.column("second").to_numpy(zero_copy_only=False)
            if bits:
                flat = t.column("sketch").combine_chunks().flatten()
                marks = flat.to_numpy().view(np.uint64).reshape(t.num_rows, -1).T
            else:
                marks = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype=np.uint8).reshape(t.num_rows, -1)
            sets = None if threshold is None else [v.values.to_numpy() for v in t.column("hashes")]
            src, dst = [], []
            for lo, hi in zip(starts[:-1], starts[1:]):
                whole = cols[2][lo] == cols[3][lo]
                side = second[lo:hi]
                left = np.arange(lo, hi) if whole else lo + np.flatnonzero(~side)
                right = left if whole else lo + np.flatnonzero(side)
                if bits:
                    for a, b in agreeing(marks, left, right, whole):
                        other = grp[a] != grp[b]
                        src.append(node[a[other]])
                        dst.append(node[b[other]])
                    continue
                joined = {}

                def root(g):
                    while joined.setdefault(g, g) != g:
                        joined[g] = g = joined[joined[g]]
                    return g

                for k, a in enumerate(left):
                    b = right[k + 1 :] if whole else right
                    b = b[grp[b] != grp[a]]
                    b = b[(marks[b] == marks[a]).sum(axis=1) >= least]
                    if forest:
                        for other in b.tolist():
                            ra, rb = root(grp[a]), root(grp[other])
                            if ra == rb or (sets is not None and not near(sets[a], sets[other])):
                                continue
                            joined[ra] = rb
                            named = grp if sets is None else node
                            src.append(named[a : a + 1])
                            dst.append(named[other : other + 1])
                        continue
                    src.append(np.full(len(b), node[a]))
                    dst.append(node[b])
            join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(join(src)), pa.array(join(dst))], names=["src", "dst"])

        def agreeing(marks, left, right, whole):
            """Rows of the pairs that agree in enough bits, some lines of the
            matrix of pairs at a time."""
            lines, most = max(1, at_once // max(1, len(right))), 64 * len(marks) - least
            for k in range(0, len(left), lines):
                a, b = left[k : k + lines], right[k + 1 :] if whole else right
                apart = np.zeros((len(a), len(b)), dtype=np.uint16)
                for word in marks:
                    apart += np.bitwise_count(word[a][:, None] ^ word[b])
                x, y = np.nonzero(apart <= most)
                after = y >= x if whole else slice(None)
                yield a[x[after]], b[y[after]]

        def near(x, y):
            least_set, most_set = sorted((len(x), len(y)))
            if least_set < threshold * most_set:
                return False
            both = len(np.intersect1d(x, y, assume_unique=True))
            union = len(x) + len(y) - both
            return union == 0 or both / union >= threshold

        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            if not t.num_rows:
                continue
            last = np.ones(t.num_rows, dtype=bool)
            for c in key:
                col = t.column(c).to_numpy()
                last &= col == col[-1]
            cut = t.num_rows - int(last.sum())  # the last group may go on
            if cut:
                yield pairs(t.slice(0, cut))
            rest = t.slice(cut)
        if rest is not None:
            yield pairs(rest)

    return compare
