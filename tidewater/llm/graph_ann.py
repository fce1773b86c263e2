"""Approximate nearest neighbours on robust-pruned directed graphs.

Vectors are dealt into shards of about ``SHARD`` by a hash of their content.
Every shard gets a graph: vectors are inserted in batches; a greedy search
from the entry point proposes candidates, robust pruning keeps a candidate
only if no kept neighbour is ``ALPHA`` times nearer to it than the new vector
is, reverse edges are added and pruned alike; a second round over all vectors
follows.  Graphs are built on vectors less the shard's median, in units of the
median distance from it and in double precision, so that neither a common
offset nor a few huge vectors hide the differences of the others.  Graphs are
written to the shared folder, a row a shard.  Queries are
packed into blocks, every block visits every shard, a beam search of width
``BEAM`` answers it there, and the best of all shards are kept by (distance,
id).  Distances of results are Euclidean, in double precision, on the
original vectors.

Equal vectors are one node that lists its smallest ids, ``TOP + 1`` of them,
which is all that any query's answer can use, so groups of copies stay small
(exactly, ties go to smaller ids).

Vectors that are null, zero or hold null or non-finite components, and rows
with a null id, take no part, neither as candidates nor as queries.  Vectors
are compared with vectors of their own length.  Rows that repeat an id and
vector count once; rows with the query's id are not its candidates.  Fewer
candidates than ``TOP`` give fewer rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import Written, ship
from tidewater.llm.embedding_dedup import packed, usable

ship(__name__)

TOP, SHARD, DEGREE, ALPHA, BUILD_BEAM, BEAM, WIDTH, QUERIES = 10, 4096, 24, 1.2, 48, 96, 4, 512
#: Shards whose graphs a worker holds at a time, at most.
TOGETHER = 8
#: A row group of stored graphs; the writer looks at its size after every row,
#: not after the first hundred.
GROUP_BYTES = 16 << 20


def search(x: np.ndarray, norms: np.ndarray, adj: np.ndarray, entry: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy searches of many queries side by side: the ``beam`` nearest
    nodes met by each (-1 where there are fewer), and their squared distances."""
    b, n = len(q), len(x)
    qn = (q * q).sum(axis=1)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # stands for "no neighbour"
    ids = np.full((b, beam), n, np.int64)
    dist = np.full((b, beam), np.inf)
    k = min(beam, len(entry))
    ids[:, :k] = entry[:k]
    dist[:, :k] = norms[entry[:k]] + qn[:, None] - 2 * (q @ x[entry[:k]].T)
    seen[:, entry[:k]] = True
    order = np.argsort(dist, axis=1, kind="stable")
    ids, dist = np.take_along_axis(ids, order, 1), np.take_along_axis(dist, order, 1)
    done = ids == n
    rows = np.arange(b)[:, None]
    padded = np.vstack([x, np.zeros((1, x.shape[1]), x.dtype)])
    pnorms = np.append(norms, np.inf)
    while not done.all():
        # the nearest nodes that have not been expanded
        pick = np.argsort(done, axis=1, kind="stable")[:, :WIDTH]
        nodes = np.where(np.take_along_axis(done, pick, 1), n, np.take_along_axis(ids, pick, 1))
        np.put_along_axis(done, pick, True, 1)
        near = adj[nodes].reshape(b, -1)
        near = np.where(seen[rows, near], n, near)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        seen[rows, near] = True
        d = pnorms[near] + qn[:, None] - 2 * np.einsum("brd,bd->br", padded[near], q)
        ids, dist = np.concatenate([ids, near], 1), np.concatenate([dist, d], 1)
        done = np.concatenate([done, near == n], 1)
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist, done = (np.take_along_axis(v, order, 1) for v in (ids, dist, done))
    return np.where(ids == n, -1, ids), dist


def prune(x: np.ndarray, own: np.ndarray, cand: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Robust pruning of the candidates (-1: none) of many nodes at once."""
    b, c = cand.shape
    cand = np.where(cand == own[:, None], -1, cand)
    vec = x[np.maximum(cand, 0)]
    dist = ((vec - x[own][:, None, :]) ** 2).sum(axis=2)
    dist[cand < 0] = np.inf
    order = np.argsort(dist, axis=1, kind="stable")
    cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
    vec = np.take_along_axis(vec, order[:, :, None], 1)
    sq = (vec * vec).sum(axis=2)
    between = sq[:, :, None] + sq[:, None, :] - 2 * (vec @ vec.transpose(0, 2, 1))
    alive = np.isfinite(dist)
    out = np.full((b, degree), -1, np.int64)
    rows = np.arange(b)
    for k in range(degree):
        has = alive.any(axis=1)
        if not has.any():
            break
        first = alive.argmax(axis=1)
        out[has, k] = cand[rows, first][has]
        # candidates much nearer to the kept one than to the node are covered
        alive &= ~((alpha * alpha * between[rows, first] <= dist) & has[:, None])
        alive[rows, first] = False
    return out


def build(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``(adjacency, entry points)`` of the graph over the rows of ``x``;
    absent neighbours are ``len(x)``."""
    n = len(x)
    norms = (x * x).sum(axis=1)
    slack = degree * 2
    adj = np.full((n + 1, slack), n, np.int64)
    size = np.zeros(n, np.int64)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n)
    entry = np.array([int(norms.argmin())])  # vectors come centred

    def insert(own: np.ndarray, a: float) -> None:
        found, _ = search(x, norms, adj, entry, x[own], beam)
        old = np.where(adj[own] == n, -1, adj[own])
        # members of a batch see each other: nearest ones join the candidates
        mates = own[np.argsort(norms[own][None, :] - 2 * (x[own] @ x[own].T), axis=1)[:, : min(8, len(own))]]
        cand = np.concatenate([found, old, mates], axis=1)
        cand.sort(axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        kept = prune(x, own, cand, a, degree)
        adj[own] = n
        adj[own, :degree] = np.where(kept < 0, n, kept)
        size[own] = (kept >= 0).sum(axis=1)
        src, dst = np.repeat(own, degree), kept.ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        targets, starts, counts = np.unique(dst, return_index=True, return_counts=True)
        for t, s, c in zip(targets.tolist(), starts.tolist(), counts.tolist(), strict=True):
            have = adj[t, : size[t]].tolist()
            known = set(have)
            both = have + [v for v in src[s : s + c].tolist() if v not in known]
            if len(both) <= slack:
                adj[t, : len(both)] = both
                size[t] = len(both)
            else:
                slim = prune(x, np.array([t]), np.array([both]), a, degree)[0]
                slim = slim[slim >= 0]
                adj[t] = n
                adj[t, : len(slim)] = slim
                size[t] = len(slim)

    for a in (1.0, alpha):
        at, batch = 0, 8
        while at < n:
            insert(order[at : at + batch], a)
            at += batch
            batch = min(256, max(8, at // 4)) if a == 1.0 else 256
    return adj, entry


def centred(x: np.ndarray) -> tuple[np.ndarray, float]:
    """What ``placed`` takes: the median and the median distance from it."""
    centre = np.median(x, axis=0)
    far = np.abs(x - centre).max(axis=1)
    far = far[far > 0]
    return centre, float(np.median(far)) if len(far) else 1.0


def placed(x: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    """Coordinates for the graph; their squares are finite."""
    return np.clip((x - centre) / scale, -1e120, 1e120)


def _nodes(rows: DataFrame, top: int) -> DataFrame:
    """Rows that any answer can use: of equal vectors the smallest ids.  The
    limit is applied before the shuffle too."""
    once = rows.select("dim", "h1", "h2", "vec_id", "vec").dropDuplicates(["h1", "h2", "vec_id"])
    order = Window.partitionBy("h1", "h2").orderBy("vec_id")
    return once.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= top + 1).drop("at")


def _graphs(nodes: DataFrame, degree: int, alpha: float, beam: int) -> DataFrame:
    def one(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["h1", "h2", "vec_id"])
        new = ((pdf["h1"] != pdf["h1"].shift()) | (pdf["h2"] != pdf["h2"].shift())).to_numpy()
        new[0] = True
        x = np.array(pdf["vec"].to_numpy()[new].tolist(), np.float64)
        centre, scale = centred(x)
        adj, entry = build(placed(x, centre, scale), degree, alpha, beam)
        starts = np.append(np.flatnonzero(new), len(pdf))
        ids = pdf["vec_id"].to_numpy(np.int64)
        return pd.DataFrame(
            [[int(pdf["dim"].iloc[0]), int(pdf["shard"].iloc[0]), scale, centre.tobytes(), x.tobytes(), adj.astype(np.int32).tobytes(), entry.astype(np.int32).tobytes(), ids.tobytes(), starts.astype(np.int64).tobytes()]],
            columns=["dim", "shard", "scale", "centre", "x", "adj", "entry", "ids", "starts"],
        )

    return nodes.groupBy("dim", "shard").applyInPandas(one, "dim int, shard long, scale double, centre binary, x binary, adj binary, entry binary, ids binary, starts binary")


def _graph_files() -> dict[str, str]:
    """Options of the writer of graphs."""
    return {"parquet.block.size": str(GROUP_BYTES), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def _answers(graphs: DataFrame, visits: DataFrame, parts: int, top: int, beam: int) -> DataFrame:
    """The ``top`` nearest in each group of shards of the queries that visit it.
    Both frames have ``dim`` and ``group``; a worker holds the graphs of one
    group and one block of queries."""

    def graph(r: dict) -> tuple:
        x = np.frombuffer(r["x"]).reshape(-1, r["dim"])
        centre = np.frombuffer(r["centre"])
        small = placed(x, centre, r["scale"])
        adj = np.frombuffer(r["adj"], np.int32).reshape(len(x) + 1, -1).astype(np.int64)
        ids, starts = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["starts"], np.int64)
        return x, centre, r["scale"], small, (small * small).sum(axis=1), adj, np.frombuffer(r["entry"], np.int32).astype(np.int64), ids, starts

    def answer(held: tuple, qid: np.ndarray, part: np.ndarray) -> list[tuple]:
        x, centre, scale, small, norms, adj, entry, ids, starts = held
        out = []
        for i, own in enumerate(search(small, norms, adj, entry, placed(part, centre, scale), beam)[0]):
            own = own[own >= 0]
            d = np.sqrt(((x[own] - part[i]) ** 2).sum(axis=1))
            v = np.concatenate([ids[starts[j] : starts[j + 1]] for j in own.tolist()])
            d = np.repeat(d, starts[own + 1] - starts[own])
            keep = v != qid[i]
            out.append((v[keep], d[keep]))
        return out

    def run(batches):
        import pyarrow as pa

        key, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                if key != (r["dim"], r["group"]):
                    key, held = (r["dim"], r["group"]), []
                if r["q_ids"] is None:
                    held.append(graph(r))
                    continue
                qid, q = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["q_x"]).reshape(-1, r["dim"])
                out_q, out_v, out_d = [], [], []
                for at in range(0, len(q) if held else 0, 128):
                    own, part = qid[at : at + 128], q[at : at + 128]
                    for i, met in enumerate(zip(*[answer(g, own, part) for g in held], strict=True)):
                        v, d = (np.concatenate(c) for c in zip(*met, strict=True))
                        best = np.lexsort((v, d))[:top]
                        out_q += [own[i]] * len(best)
                        out_v += v[best].tolist()
                        out_d += d[best].tolist()
                yield pa.RecordBatch.from_arrays([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array(out_d, pa.float64())], ["query_id", "vec_id", "score"])

    rows = graphs.drop("shard").unionByName(visits, allowMissingColumns=True)
    # groups are numbered in a row, so partitions get equally many
    rows = rows.repartitionById(parts, F.pmod(F.col("group") + F.xxhash64("dim"), F.lit(parts)).cast("int"))
    rows = rows.sortWithinPartitions("dim", "group", F.col("q_ids").isNotNull())
    return rows.mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP, shard: int = SHARD, degree: int = DEGREE, alpha: float = ALPHA, build_beam: int = BUILD_BEAM, beam: int = BEAM) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` nearest found of every
    row for which ``is_query`` holds, among all other rows."""
    vec = F.col(vec_col)
    rows = vectors.filter(usable(vec) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.size(vec).alias("dim"), *packed(vec), vec.cast("array<double>").alias("vec"), F.coalesce(is_query, F.lit(False)).alias("q"))
    nodes = Written(_nodes(rows, top), "ann-nodes").df
    total = nodes.select("h1", "h2").distinct().count()
    shards = max(1, -(-total // shard))
    # a shard is long work on few bytes: partitions stay as many as the session has
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("h1", "h2", F.lit(6)), F.lit(shards))).repartition(parts, "dim", "shard")
    graphs = Written(_graphs(dealt, degree, alpha, build_beam), "ann-graphs", options=_graph_files()).df

    def pack(pdf):
        import pandas as pd

        x = np.array(pdf["vec"].tolist(), np.float64)
        return pd.DataFrame([[int(pdf["dim"].iloc[0]), pdf["vec_id"].to_numpy(np.int64).tobytes(), x.tobytes()]], columns=["dim", "q_ids", "q_x"])

    asked = rows.filter("q").select("dim", "vec_id", "h1", "h2", "vec").dropDuplicates(["vec_id", "h1", "h2"])
    blocks = max(1, -(-asked.count() // QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(8)), F.lit(blocks)))
    asked = asked.groupBy("dim", "block").applyInPandas(pack, "dim int, q_ids binary, q_x binary")
    # every block of queries visits every shard
    together = max(1, min(TOGETHER, shards // (2 * parts)))
    groups = -(-shards // together)
    visits = asked.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = _answers(graphs.withColumn("group", F.floor(F.col("shard") / together).cast("long")), visits, parts, top, beam)
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
