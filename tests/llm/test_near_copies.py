import hashlib
import math
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bagminhash, embedding_dedup, graph_ann
from tidewater.llm.common import table

from .conftest import SF_CHECK


def classes(ids, pairs):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def bag(text):
    ws = text.lower().split()
    return Counter(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4)))


def true_classes(texts, least=0.8):
    bags, seen, pairs = {i: bag(t) for i, t in texts.items()}, defaultdict(list), set()
    for i, b in bags.items():
        for s in b:
            pairs |= {(j, i) for j in seen[s]}
            seen[s].append(i)
    linked = [(a, b) for a, b in pairs if sum((bags[a] & bags[b]).values()) >= least * sum((bags[a] | bags[b]).values()) - 1e-9]
    return classes(texts, linked)


def test_signatures_estimate_the_weighted_similarity():
    hasher = bagminhash.Hasher()
    base = [f"w{i}" for i in range(300)] + ["a", "b", "c", "d", "e"] * 12
    for cut in (10, 40, 120):
        other = base[cut:] + [f"z{i}" for i in range(cut // 2)]
        x, y = bag(" ".join(base)), bag(" ".join(other))
        true = sum((x & y).values()) / sum((x | y).values())
        a, b = bagminhash.signatures([bagminhash.shingles(base, hasher), bagminhash.shingles(other, hasher)], 4096)
        assert (a == b).mean() == pytest.approx(true, abs=0.04)


def test_classes_equal_brute_force(spark):
    docs = table(spark, SF_CHECK, "documents")
    want = true_classes({r["doc_id"]: r["text"] for r in docs.collect()})
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.cluster(docs).collect()}
    assert got == want


def test_large_group_of_near_copies(spark, monkeypatch):
    """More near copies than a block; links run through several blocks."""
    monkeypatch.setattr(bagminhash, "BLOCK", 16)
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        own = words.copy()
        for at in rng.choice(120, rng.integers(1, 5), replace=False):
            own[at] = f"v{rng.integers(10**6)}"
        texts[i] = " ".join(own)
    texts |= {i: " ".join(f"u{i}_{k}" for k in range(60)) for i in range(150, 170)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in bagminhash.cluster(docs).collect()}
    assert got == true_classes(texts)


def test_documents_of_odd_rows(spark, odd_docs, no_docs):
    out = bagminhash.cluster(odd_docs).collect()
    assert len(out) == odd_docs.count()
    by = defaultdict(set)
    for r in out:
        by[r["doc_id"]].add(r["class_id"])
    assert by[3] == by[4] == by[5] and 1 in by[2] and by[1] == {1}
    stay = bagminhash.deduplicate(odd_docs)
    assert stay.columns == odd_docs.columns
    ids = [r["doc_id"] for r in stay.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 6, 7] or ids.count(1) == 1
    assert ids.count(1) == 1
    assert bagminhash.cluster(no_docs).count() == 0 and bagminhash.deduplicate(no_docs).count() == 0


def test_an_id_with_unlike_texts_loses_none(spark):
    """Two unlike texts under one id, twice, one of them with a near copy."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (1, b), (5, a), (6, b + " more"), (7, c + " more"), (7, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["text"] for r in bagminhash.deduplicate(docs).collect()) == [a, b, c]
    out = bagminhash.cluster(docs).collect()
    by = defaultdict(set)
    for r, (_, text) in zip(sorted(out, key=lambda r: (r["doc_id"], r["same"])), sorted(rows, key=lambda r: (r[0], hashlib.md5(r[1].encode()).digest())), strict=True):
        by[text[0]].add(r["class_id"])
    assert all(len(ids) == 1 for ids in by.values()) and len(set.union(*by.values())) == 3
    assert by["c"] == {2} and 1 in by["a"] | by["b"]
    # the two texts under one id are alike: one stays
    near = spark.createDataFrame([(1, a), (1, a + " more"), (2, b)], "doc_id long, text string")
    assert bagminhash.deduplicate(near).count() == 2


def test_signing_long_texts_in_bounded_memory():
    """384 texts of 20,000 words in one batch; and one text in segments."""
    rng = np.random.default_rng(2)
    texts = [" ".join(map(str, rng.integers(0, 50_000, 20_000))) for _ in range(384)]
    part = pa.RecordBatch.from_arrays([pa.array(range(384)), pa.array([b"x"] * 384), pa.array(texts)], ["doc_id", "same", "text"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in bagminhash.signed_rows(part, bagminhash.Hasher()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 384 and peak < 80e6
    hasher = bagminhash.Hasher()
    whole = bagminhash.shingles(texts[0].split(" "), hasher)
    for size in (1, 37, 10_000):
        bagminhash.CHARACTERS, before = size, bagminhash.CHARACTERS
        cut = bagminhash.text_shingles(texts[0], hasher)
        bagminhash.CHARACTERS = before
        assert all((x == y).all() for x, y in zip(whole, cut, strict=True))
    step, bagminhash.STEP = bagminhash.STEP, 1000
    small = bagminhash.signatures([whole])
    bagminhash.STEP = step
    assert (small == bagminhash.signatures([whole])).all()


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def planted(n_far, sizes, seed=0, noise=0.03):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(32) for _ in range(n_far)]
    for size in sizes:
        centre = rng.standard_normal(32)
        rows += [centre + noise * rng.standard_normal(32) * np.sqrt(32) * rng.uniform(0, 1.5) for _ in range(size)]
    rows += rows[-3:]
    return np.array(rows, np.float32)


@pytest.mark.parametrize("block", [1024, 24])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    x = planted(200, [2, 3, 5, 90])
    out = embedding_dedup.link(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])).toPandas().set_index("vec_id").sort_index()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    want = classes(range(len(x)), zip(*np.nonzero(linked), strict=True))
    assert out["n_links"].tolist() == linked.sum(axis=1).tolist()
    assert out["component_id"].to_dict() == want
    assert (out["kept"] == (out.index == out["component_id"])).all()


def unit_rows(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def dense_cone(n_cone, n_far, pairs, seed=1):
    """A cone of mutual cosine about 0.78 with hardly any links, some planted
    pairs at about 0.91 in it, and random vectors."""
    rng = np.random.default_rng(seed)
    axis = np.eye(64)[0]

    def around(r):
        return math.sqrt(0.78) * axis + math.sqrt(0.22) * r

    residual = rng.standard_normal((n_cone, 64))
    residual[:, 0] = 0
    residual = unit_rows(residual)
    other = rng.standard_normal((pairs, 64))
    other[:, 0] = 0
    near = 0.59 * residual[:pairs] + math.sqrt(1 - 0.59**2) * unit_rows(other)
    x = np.concatenate([around(residual), around(unit_rows(near)), rng.standard_normal((n_far, 64))])
    return rng.permutation(x).astype(np.float32)


def assert_all_pairs(out, x):
    out = out.toPandas().set_index("vec_id").sort_index()
    u = unit_rows(x.astype(float))
    linked = u @ u.T >= 0.9
    np.fill_diagonal(linked, False)
    assert linked.any()
    assert (out["n_links"].to_numpy() != linked.sum(axis=1)).sum() == 0
    assert out["component_id"].to_dict() == classes(range(len(x)), zip(*np.nonzero(linked), strict=True))


@pytest.mark.parametrize("pass_cost", [embedding_dedup.PASS_COST, 0])
def test_links_in_a_dense_cone(spark, monkeypatch, pass_cost):
    """More vectors under a prefix than a window holds: compared exactly, or
    (cost 0) in further passes until each is covered."""
    monkeypatch.setattr(embedding_dedup, "PASS_COST", pass_cost)
    x = dense_cone(3000, 500, 250)
    assert_all_pairs(embedding_dedup.link(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])), x)


def test_links_across_partition_borders(spark, monkeypatch):
    """Two vectors a partition: most pairs lie on both sides of a border."""
    frame = type(spark.range(0))
    rows = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda df, *cols: rows(df, 40, *cols))
    x = unit_rows(np.random.default_rng(2).standard_normal((30, 16)))
    x = np.concatenate([x, x + 0.02 * np.random.default_rng(3).standard_normal(x.shape)]).astype(np.float32)
    assert_all_pairs(embedding_dedup.link(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])), x)


ODD = [
    (1, [1.0, 0.0, 0.0], 0),
    (2, [2.0, 0.0, 0.0], None),
    (3, [1.0, 0.0], 0),
    (4, None, 0),
    (5, [0.0, 0.0, 0.0], 0),
    (6, [1.0, None, 0.0], 0),
    (7, [1.0, float("nan"), 0.0], 0),
    (8, [1.0, float("inf"), 0.0], 0),
    (None, [1.0, 0.0, 0.0], 0),
    (9, [], 0),
    (10, [1.0, 0.0, 0.0], 0),
    (11, [3e38, 0.0, 0.0], 0),
    (12, [0.0, 1.0, 0.0], 0),
]


def test_links_of_odd_rows(spark):
    out = {r["vec_id"]: r for r in embedding_dedup.link(vectors(spark, ODD)).collect()}
    assert len(out) == len(ODD)
    assert {i for i, r in out.items() if r["component_id"] == 1} == {1, 2, 10, 11}
    assert all(out[i]["n_links"] == 3 for i in (1, 2, 10, 11))
    assert all(out[i]["n_links"] == 0 and out[i]["kept"] for i in (3, 4, 5, 6, 7, 8, 9, 12))
    assert out[None]["component_id"] is None
    assert embedding_dedup.link(vectors(spark, [])).count() == 0


def brute(x, ids, queries, top):
    for q in queries:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = math.inf
        best = np.lexsort((ids, d))[: min(top, len(ids) - 1)]
        yield ids[q], ids[best], d[best]


def test_neighbours_against_brute_force(spark):
    x = planted(1500, [30, 300], seed=3)
    ids = np.arange(len(x)) * 5
    df = vectors(spark, [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)])
    out = graph_ann.nearest(df, F.col("vec_id") % 100 == 0, shard=600).toPandas()
    got = {q: g.sort_values("rank") for q, g in out.groupby("query_id")}
    queries = np.flatnonzero(ids % 100 == 0)
    assert set(got) == set(ids[queries])
    hit = 0
    for q, want, _ in brute(x.astype(float), ids, queries, 10):
        one = got[q]
        assert one["rank"].tolist() == list(range(1, 11)) and q not in set(one["vec_id"])
        assert (np.diff(one["score"]) >= 0).all()
        assert one["score"].tolist() == pytest.approx([np.linalg.norm(x[v // 5].astype(float) - x[q // 5]) for v in one["vec_id"]], abs=1e-12)
        hit += len(set(one["vec_id"]) & set(want))
    assert hit / (10 * len(queries)) > 0.95


def test_many_copies_go_to_smaller_ids(spark):
    df = vectors(spark, [(i, [1.0, 2.0, float(i // 50)], 0) for i in range(200)])
    out = graph_ann.nearest(df, F.col("vec_id") == 100, top=10).orderBy("rank").collect()
    assert [r["vec_id"] for r in out] == list(range(101, 111)) and all(r["score"] == 0 for r in out)


def test_graphs_are_stored_in_small_row_groups(spark, monkeypatch):
    """However many shards a task builds, its reader holds few; each graph goes
    to one task, once, whatever the number of query blocks."""
    monkeypatch.setattr(graph_ann, "GROUP_BYTES", 64 << 10)
    monkeypatch.setattr(graph_ann, "QUERIES", 16)
    written = []
    made = graph_ann.Written.__init__
    monkeypatch.setattr(graph_ann.Written, "__init__", lambda self, *a, **k: (made(self, *a, **k), written.append(self.path))[0])
    x = np.random.default_rng(4).standard_normal((1200, 16)).astype(np.float32)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        out = graph_ann.nearest(vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]), F.col("vec_id") % 10 == 0, shard=50)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {q: g.sort_values("rank")["vec_id"].tolist() for q, g in out.toPandas().groupby("query_id")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "Join" not in plan
    files = list(Path(next(p for p in written if "ann-graphs" in p).removeprefix("file:")).glob("*.parquet"))
    footers = [pq.read_metadata(f) for f in files]
    groups = [(g.num_rows, g.total_byte_size) for m in footers for g in map(m.row_group, range(m.num_row_groups))]
    assert sum(n for n, _ in groups) == 24
    assert all(n == 1 or size < 128 << 10 for n, size in groups)
    # the beam is wider than a shard: all pairs
    assert got == {q: v.tolist() for q, v, _ in brute(x.astype(float), np.arange(1200), range(0, 1200, 10), 10)}


def test_neighbours_of_odd_rows(spark):
    out = graph_ann.nearest(vectors(spark, ODD), F.col("vec_id") % 2 == 0).collect()
    assert {r["query_id"] for r in out} == {2, 10, 12}
    assert {r["vec_id"] for r in out} <= {1, 2, 10, 11, 12}
    assert sum(r["query_id"] == 2 for r in out) == 4
    assert graph_ann.nearest(vectors(spark, []), F.lit(True)).count() == 0


@pytest.mark.parametrize("case", ["plain", "one of length 1e25", "shifted", "two far clusters", "beyond squares"])
def test_graph_recall_at_odd_magnitudes(case):
    x = unit_rows(np.random.default_rng(7).standard_normal((1500, 32)))
    if case == "one of length 1e25":
        x[77] *= 1e25
    elif case == "shifted":
        x = x + 3000 * x.std()
    elif case == "two far clusters":
        x[::2] += 1e5
    elif case == "beyond squares":
        x[5] *= 1e200
    y = graph_ann.placed(x, *graph_ann.centred(x))
    adj, entry = graph_ann.build(y)
    asked = np.arange(0, 1500, 30)
    found, _ = graph_ann.search(y, (y * y).sum(axis=1), adj, entry, y[asked], graph_ann.BEAM)
    with np.errstate(over="ignore"):
        exact = np.argsort(((x[asked][:, None, :] - x[None]) ** 2).sum(axis=2), axis=1, kind="stable")[:, :10]
    hit = sum(len(set(f.tolist()) & set(e.tolist())) for f, e in zip(found, exact, strict=True))
    assert hit / exact.size >= 0.95
