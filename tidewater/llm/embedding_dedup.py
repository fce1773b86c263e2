"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to a code of ``BITS`` concatenated random signs
and sorts by the code; a vector is compared with the ``WINDOW`` vectors after
it, by cosine in double precision.  Verified pairs of all passes are united
into components.  The first number of passes follows from the table's size, as
if codes were spread evenly: for a pair at the threshold the chance to agree
in the leading log2(n / WINDOW) bits and a half is p, and passes are made until
(1 - p)^passes is below ``MISS``.

Whether that was enough is measured, vector by vector: a pass covers a vector
to the first bit that everything outside its window differs within, and the
chance that a pair at the threshold agrees so far is the pass's share.  A
vector whose shares do not bring the chance of a miss below ``MISS`` is open,
as all of a dense cone are, and those that often lie at a border of the range
partitions, where the windows stop and nothing beyond counts as covered.  Only pairs of two open vectors can be missing
(one covered end finds the pair), so further passes take the open ones only,
until none is left, or, where that is dearer, the open ones are all compared
with each other, in blocks of matrix products; members of a large component
already found are not compared among themselves again.

What the windows bound is made up for exactly: equal vectors are collapsed
first (a group of copies is one vector with a weight), and links are counted
within the found components over all members, not only over the windows.
Members of a large component that are nearer to its mean than half the
threshold's angle are all linked with each other (triangle inequality), so
only the outer ones are compared, in blocks of matrix products; a dense
component therefore costs in proportion to its size.  No pair leaves a task.

Range partitions of (pass, code, id) split any hot code; window scans stream
with a bounded buffer.

Vectors that are null, zero, or hold a null or non-finite component link with
nothing: n_links 0, component their own id.  Vectors of different length
never link.  Rows with a null id link with nothing either and have a null
component.  Repeated rows are vectors of their own that link.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Written, ship
from tidewater.operators.graph import connected_components

ship(__name__)

THRESHOLD, WINDOW, BITS, MISS, SEED = 0.9, 128, 48, 1e-4, 77
#: Members of a block, and of a component that is compared in one piece.
BLOCK = 1024
#: What a vector costs in a pass (hash, shuffle, sort, windows), in cosines.
PASS_COST = 2000


def usable(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def packed(vector: Column) -> list[Column]:
    """128 bits of the content, as two columns."""
    return [F.xxhash64(vector, F.lit(1)).alias("h1"), F.xxhash64(F.lit(2), vector).alias("h2")]


def unit(rows: list) -> np.ndarray:
    """Vectors of equal length as unit rows in double precision."""
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def agreement(threshold: float) -> float:
    """Chance that vectors of that cosine have the same random sign."""
    return 1 - math.acos(threshold) / math.pi


def passes_for(n: int, threshold: float, window: int, miss: float) -> int:
    p = agreement(threshold) ** max(0.0, math.log2(max(n, 1) / window) + 0.5)
    return 2 if p >= 1 - miss else max(2, math.ceil(math.log(miss) / math.log(1 - p)))


def _codes(vectors: DataFrame, passes: int, bits: int, seed: int, turn: int) -> DataFrame:
    """A row a pass and vector: ``(pass, dim, code, id, vec)``; every turn has
    its own random signs."""

    def run(batches):
        import pyarrow as pa

        planes: dict[int, np.ndarray] = {}
        shifts = (np.int64(1) << np.arange(bits - 1, -1, -1)).astype(np.float64)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, vecs = np.array(part.column(0).to_pylist(), np.int64), part.column(1).to_pylist()
                sizes = np.array([len(v) for v in vecs])
                for dim in np.unique(sizes).tolist():
                    own = np.flatnonzero(sizes == dim)
                    x = unit([vecs[i] for i in own])
                    if dim not in planes:
                        planes.clear()
                        planes[dim] = np.random.default_rng([seed, dim, turn] if turn else [seed, dim]).standard_normal((dim, passes * bits))
                    signs = (x @ planes[dim] >= 0).reshape(len(own), passes, bits)
                    codes = (signs @ shifts).astype(np.int64)
                    raw = [r.tobytes() for r in x]
                    for k in range(passes):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([k] * len(own), pa.int32()), pa.array([dim] * len(own), pa.int32()), pa.array(codes[:, k]), pa.array(ids[own]), pa.array(raw, pa.binary())], ["pass", "dim", "code", "id", "vec"]
                        )

    return vectors.select("rep", "vec").mapInArrow(run, "pass int, dim int, code long, id long, vec binary")


def _labels(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the first row it reaches."""
    n = len(linked)
    own = np.arange(n)
    while True:
        least = np.minimum(own, np.where(linked, own[None, :], n).min(axis=1))
        least = least[least]
        if (least == own).all():
            return own
        own = least


def _covered(codes: np.ndarray, lo: int, hi: int, window: int, bits: int, first: bool, last: bool) -> np.ndarray:
    """For the rows lo to hi of a sorted pass the leading bits shared with the
    nearest rows outside the window: -1 if all rows are within.  ``first`` and
    ``last``: the pass begins and ends with these codes; otherwise what lies
    beyond is unknown and may share as much as the outermost row."""
    at = np.arange(lo, hi)
    left, right = at - window - 1, at + window + 1

    def shared(other):
        return bits - np.frexp((codes[at] ^ codes[other]).astype(np.float64))[1]

    before = np.where((left < 0) & first, -1, shared(np.maximum(left, 0)))
    after = np.where((right >= len(codes)) & last, -1, shared(np.minimum(right, len(codes) - 1)))
    return np.maximum(before, after)


def _window_edges(ordered: DataFrame, threshold: float, window: int, bits: int) -> DataFrame:
    """Edges ``(src, dst)`` that connect what the windows link: at most one a
    row and block; and for every row ``(src, shared)``, as of ``_covered``.  A
    task does not see its neighbours' rows: near the borders less is covered."""

    def run(batches):
        import pyarrow as pa

        first, key, ids, x, codes, done = False, None, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0, np.int64), 0
        names, kinds = ["src", "dst", "shared"], [pa.int64(), pa.int64(), pa.int32()]

        def edges(ids, x):
            n = len(ids)
            near = np.abs(np.arange(n)[:, None] - np.arange(n)[None, :]) <= window
            linked = (x @ x.T >= threshold) & near
            label = _labels(linked)
            own = np.flatnonzero(label != np.arange(n))
            return pa.RecordBatch.from_arrays([pa.array(ids[own]), pa.array(ids[label[own]]), pa.nulls(len(own), kinds[2])], names)

        def rows(to, last):
            shared = _covered(codes, done, to, window, bits, first, last)
            return pa.RecordBatch.from_arrays([pa.array(ids[done:to]), pa.nulls(to - done, kinds[1]), pa.array(shared, kinds[2])], names)

        for batch in batches:
            heads = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            sorted_codes = np.array(batch.column(2).to_pylist(), np.int64)
            more, raw = np.array(batch.column(3).to_pylist(), np.int64), batch.column(4).to_pylist()
            at = 0
            while at < len(heads):
                if heads[at] != key:
                    if done < len(ids):
                        yield rows(len(ids), True)
                    first = key is not None  # not the task's first pass
                    key, ids, x, codes, done = heads[at], np.zeros(0, np.int64), np.zeros((0, heads[at][1])), np.zeros(0, np.int64), 0
                to = at
                while to < len(heads) and to - at < 512 and heads[to] == key:
                    to += 1
                ids, codes = np.concatenate([ids, more[at:to]]), np.concatenate([codes, sorted_codes[at:to]])
                x = np.concatenate([x[-window:], np.frombuffer(b"".join(raw[at:to])).reshape(to - at, -1)])
                at = to
                found = edges(ids[-len(x) :], x)
                if found.num_rows:
                    yield found
                # a row waits for the first one after its window
                ready = len(ids) - window - 1
                if ready > done:
                    yield rows(ready, False)
                    done = ready
                old = max(0, done - window - 1)
                ids, codes, done = ids[old:], codes[old:], done - old
        if done < len(ids):
            yield rows(len(ids), False)

    return ordered.mapInArrow(run, "src long, dst long, shared int")


def _turn(vectors: DataFrame, passes: int, turn: int, threshold: float, window: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The edges of some passes over ``(node, vec)``, and ``(node, chance)``:
    the logarithm of the chance that they miss a pair at the threshold."""
    coded = _codes(vectors.select(F.col("node").alias("rep"), "vec"), passes, BITS, seed, turn)
    ordered = coded.repartitionByRange("pass", "dim", "code", "id").sortWithinPartitions("pass", "dim", "code", "id")
    found = Written(_window_edges(ordered, threshold, window, BITS), "vector-windows").df
    share = F.pow(F.lit(agreement(threshold)), F.col("shared") + 1)
    chance = F.when(F.col("shared") < 0, F.lit(-1e9)).when(F.col("shared") >= BITS, F.lit(0.0)).otherwise(F.log1p(-share))
    missed = found.filter("shared is not null").groupBy(F.col("src").alias("node")).agg(F.sum(chance).alias("chance"))
    return found.filter("dst is not null").select("src", "dst"), missed


def _all_pairs(spark, vectors: DataFrame, threshold: float) -> DataFrame:
    """Edges ``(src, dst)`` that connect all links among ``(component, node,
    vec)``; pairs within a component of several blocks are left out."""
    vectors = Written(vectors.withColumn("dim", F.size("vec")), "vector-open").df
    counts = vectors.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    total = vectors.count()
    large = F.col("size") > BLOCK
    dealt = vectors.join(counts, "component").select(
        "dim", F.when(large, F.col("component")).alias("own"), F.pmod(F.xxhash64("node", F.lit(5)), F.ceil(F.when(large, F.col("size")).otherwise(F.lit(total)) / BLOCK)).cast("long").alias("cell"), "node", "vec"
    )

    def pack(key, pdf):
        import pandas as pd

        x = unit(pdf["vec"].tolist())
        own = None if pd.isna(key[1]) else int(key[1])
        return pd.DataFrame({"dim": [int(key[0])], "own": pd.array([own], "Int64"), "cell": [int(key[2])], "ids": [pdf["node"].to_numpy(np.int64).tobytes()], "x": [x.tobytes()]})

    packed_ = dealt.groupBy("dim", "own", "cell").applyInPandas(pack, "dim int, own long, cell long, ids binary, x binary")
    blocks = Written(packed_.withColumn("block", F.xxhash64("dim", F.coalesce("own", F.lit(0)), F.col("own").isNull(), "cell")), "vector-open-blocks").df
    keys = blocks.select("dim", "own", "block")
    a_keys = keys.select("dim", F.col("own").alias("a_own"), F.col("block").alias("a_block"))
    which = a_keys.join(keys, "dim").filter((F.col("a_block") <= F.col("block")) & F.coalesce(F.col("a_own") != F.col("own"), F.lit(True))).select("a_block", "block")
    left = blocks.select(F.col("block").alias("a_block"), F.col("ids").alias("a_ids"), F.col("x").alias("a_x"))
    pairs = which.join(blocks.select("block", "dim", "ids", "x"), "block").join(left, "a_block")

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                a, b = (np.frombuffer(r[c]).reshape(-1, r["dim"]) for c in ("a_x", "x"))
                linked = a @ b.T >= threshold
                if r["a_block"] == r["block"]:
                    np.fill_diagonal(linked, False)
                own, other = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
                if not len(own):
                    continue
                ids = np.concatenate([np.frombuffer(r["a_ids"], np.int64)[own], np.frombuffer(r["ids"], np.int64)[other]])
                both = np.zeros((len(ids), len(ids)), bool)
                both[: len(own), len(own) :] = linked[np.ix_(own, other)]
                label = _labels(both | both.T | np.eye(len(ids), dtype=bool))
                child = np.flatnonzero(label != np.arange(len(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[child]), pa.array(ids[label[child]])], ["src", "dst"])

    return pairs.mapInArrow(compare, "src long, dst long").filter("src != dst")


def _components(vectors: DataFrame, n: int, threshold: float, window: int, miss: float, seed: int) -> DataFrame:
    """``(node, component)`` of the ``n`` rows ``(node, vec)`` that link."""
    spark = vectors.sparkSession
    turn, made = 0, passes_for(n, threshold, window, miss)
    edges, missed = _turn(vectors, made, turn, threshold, window, seed)
    while True:
        # the open vectors, with the passes that each would still need
        left = F.lit(math.log(miss)) / F.col("chance") * made - made
        open_ = missed.filter(F.col("chance") > math.log(miss)).withColumn("need", F.when(F.col("chance") < 0, F.ceil(left)).otherwise(F.lit(float("inf"))))
        open_ = Written(open_, "vector-uncovered").df
        count, need = open_.agg(F.count(F.lit(1)), F.percentile_approx("need", 0.5)).first()
        if not count:
            return connected_components(edges)
        rest = vectors.join(open_.select("node", "chance"), "node")
        if not need * PASS_COST <= count / 2:
            break
        turn, more = turn + 1, max(1, math.ceil(need))
        found, again = _turn(rest, more, turn, threshold, window, seed)
        edges = edges.unionByName(found)
        missed = open_.select("node", "chance").join(again.withColumnRenamed("chance", "further"), "node").select("node", (F.col("chance") + F.col("further")).alias("chance"))
        made += more
    comps = Written(connected_components(edges), "vector-found").df
    rest = rest.join(comps, "node", "left").select(F.coalesce("component", "node").alias("component"), "node", "vec")
    links = Written(_all_pairs(spark, rest, threshold), "vector-links").df
    return connected_components(links.unionByName(comps.select(F.col("node").alias("src"), F.col("component").alias("dst")).filter("src != dst")))


def _small_links(members: DataFrame, threshold: float) -> DataFrame:
    """``(id, links)`` of members of components that fit a block."""

    def one(pdf):
        import pandas as pd

        out = []
        for _, c in pdf.groupby("component"):
            for _, own in c.groupby(c["vec"].map(len)):
                x = unit(own["vec"].tolist())
                links = (x @ x.T >= threshold) @ own["n"].to_numpy() - own["n"].to_numpy()
                out.append(pd.DataFrame({"id": own["id"].to_numpy(), "links": links}))
        return pd.concat(out)

    return members.groupBy("cell").applyInPandas(one, "id long, links long")


def _large_links(spark, members: DataFrame, threshold: float) -> DataFrame:
    """``(id, links)`` of members of components of any size."""

    def sums(batches):
        import pyarrow as pa

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            comps = np.array(batch.column(0).to_pylist(), np.int64)
            x = unit(batch.column(1).to_pylist()) if batch.num_rows else None
            for c in np.unique(comps).tolist():
                held[c] = held.get(c, 0) + x[comps == c].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([v.tolist() for v in held.values()], pa.list_(pa.float64()))], ["component", "total"])

    partial = members.select("component", "vec").mapInArrow(sums, "component long, total array<double>")
    by_dim = partial.select("component", F.posexplode("total").alias("at", "v")).groupBy("component", "at").agg(F.sum("v").alias("v"))
    centre = by_dim.groupBy("component").agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("c")).select("component", F.col("c.v").alias("centre"))
    near = math.sqrt((1 + threshold) / 2) + 1e-9  # cosine of half the threshold's angle

    def pack(pdf):
        import pandas as pd

        x = unit(pdf["vec"].tolist())
        inner = (x * unit(pdf["centre"].tolist())).sum(axis=1) >= near
        n = pdf["n"].to_numpy(np.int64)
        return pd.DataFrame(
            [[int(pdf["component"].iloc[0]), int(pdf["block"].iloc[0]), x.shape[1], int((~inner).sum()), pdf["id"].to_numpy(np.int64).tobytes(), n.tobytes(), inner.tobytes(), x.tobytes(), int(n[inner].sum())]],
            columns=["component", "block", "dim", "outer", "ids", "n", "inner", "x", "inner_n"],
        )

    schema = "component long, block long, dim int, outer int, ids binary, n binary, inner binary, x binary, inner_n long"
    cells = Written(members.join(centre, "component"), "vector-large").df.groupBy("component", "block")
    blocks = Written(cells.applyInPandas(pack, schema), "vector-blocks").df
    left = blocks.filter("outer > 0").select("component", F.col("block").alias("a_block"), *[F.col(c).alias(f"a_{c}") for c in ("ids", "n", "inner", "x")])
    # pairs of keys first; the last join deals them out by the first block
    keys = left.select("component", "a_block").join(blocks.select("component", "block"), "component")
    right = blocks.select("component", "block", "dim", "ids", "n", "inner", "x")
    pairs = keys.join(right, ["component", "block"]).join(left, ["component", "a_block"])

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                a_in, b_in = np.frombuffer(r["a_inner"], bool), np.frombuffer(r["inner"], bool)
                a = np.frombuffer(r["a_x"]).reshape(-1, r["dim"])[~a_in]
                b = np.frombuffer(r["x"]).reshape(-1, r["dim"])
                a_ids, b_ids = np.frombuffer(r["a_ids"], np.int64)[~a_in], np.frombuffer(r["ids"], np.int64)
                linked = (a @ b.T >= threshold) & (a_ids[:, None] != b_ids[None, :])
                ids = np.concatenate([a_ids, b_ids[b_in]])
                links = np.concatenate([linked @ np.frombuffer(r["n"], np.int64), linked[:, b_in].T @ np.frombuffer(r["a_n"], np.int64)[~a_in]])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(links.astype(np.int64))], ["id", "links"])

    def inner(batches):
        import pyarrow as pa

        for batch in batches:
            for r in batch.to_pylist():
                own = np.frombuffer(r["inner"], bool)
                n = np.frombuffer(r["n"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["ids"], np.int64)), pa.array(np.where(own, r["total"] - n, 0))], ["id", "links"])

    totals = blocks.groupBy("component").agg(F.sum("inner_n").alias("total"))
    base = blocks.select("component", "ids", "n", "inner").join(totals, "component").mapInArrow(inner, "id long, links long")
    found = pairs.mapInArrow(compare, "id long, links long")
    return found.unionByName(base)


def link(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS, seed: int = SEED) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row a vector."""
    spark = vectors.sparkSession
    vec = F.col(vec_col)
    rows = vectors.select(F.col(id_col).alias("vec_id"), (usable(vec) & F.col(id_col).isNotNull()).alias("ok"), *packed(vec), vec.alias("vec"))
    reps = Written(rows.filter("ok").groupBy("h1", "h2").agg(F.min("vec_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec")), "vectors").df
    # an id with several vectors: each is linked on its own, under a node of its own
    reps = reps.withColumn("node", F.xxhash64("h1", "h2"))
    n = reps.count()
    comps = _components(reps.select("node", "vec"), n, threshold, window, miss, seed)
    members = Written(reps.join(comps, "node").select("component", F.col("node").alias("id"), "rep", "n", "vec"), "vector-members").df
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("component_id"))
    sized = members.join(sizes, "component")
    cells = F.greatest(F.lit(1), F.lit(n // BLOCK))
    small = sized.filter(F.col("size") <= BLOCK).withColumn("cell", F.pmod(F.xxhash64("component"), cells))
    large = sized.filter(F.col("size") > BLOCK).withColumn("block", F.pmod(F.xxhash64("id", F.lit(4)), F.ceil(F.col("size") / BLOCK)).cast("long"))
    links = _small_links(small.select("cell", "component", "id", "n", "vec"), threshold)
    links = links.unionByName(_large_links(spark, large.select("component", "block", "id", "n", "vec"), threshold))
    links = links.groupBy("id").agg(F.sum("links").alias("links"))
    found = sized.select("id", "component_id").join(links, "id", "left")
    by_copy = reps.select("h1", "h2", "rep", "n", "node").join(found, F.col("node") == F.col("id"), "left")
    by_copy = by_copy.select("h1", "h2", F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    good = rows.filter("ok").select("vec_id", "h1", "h2").join(by_copy, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    rest = rows.filter("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    out = good.unionByName(rest)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
