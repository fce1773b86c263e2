"""Vector clusters: equal to comparing all pairs, planted duplicates found, a
hot bucket handled without pairs, odd rows left out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidewater.plans import vectors as V


def all_pairs(ids, x, cosine):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    cluster = dict.fromkeys(ids)
    for k in np.argsort(ids):
        if cluster[ids[k]] is None:
            todo = [k]
            while todo:
                at = todo.pop()
                if cluster[ids[at]] is None:
                    cluster[ids[at]] = ids[k]
                    todo += np.flatnonzero(near[at]).tolist()
    return cluster


def clusters(df, cosine):
    rows = V.similar_vectors_df(df, cosine).collect()
    assert len({r.vec_id for r in rows}) == len(rows)
    return {r.vec_id: r.cluster_id for r in rows}


@pytest.mark.parametrize("cosine", [0.45, 0.8])
def test_equals_all_pairs_on_the_table(spark, cosine):
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    local = emb.orderBy("vec_id").collect()
    x = np.array([r.embedding for r in local], dtype=np.float64)
    assert clusters(emb, cosine) == all_pairs([r.vec_id for r in local], x, cosine)


def test_equals_all_pairs_in_cones(spark):
    """Cones whose members are just above and just below the threshold: stars
    alone leave most of them apart."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((30, 24))
    x = np.repeat(centres, 60, axis=0) + rng.normal(0, 0.55, (1800, 24)) * np.tile(rng.uniform(0.6, 1.2, 1800), (24, 1)).T
    ids = rng.permutation(1800).tolist()
    want = all_pairs(ids, x, 0.8)
    assert 30 < len(set(want.values())) < 1500
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, label int")
    assert clusters(df, 0.8) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], "a"), (2, [1e300, 1e299, 0.0], "b"), (3, [1e-300, 0.0, 0.0], None), (4, [-1.0, 0.0, 0.0], "a"),
        (5, None, "a"), (6, [0.0, 0.0, 0.0], "a"), (7, [1.0, None, 0.0], "a"), (8, [1.0, nan, 0.0], "a"), (9, [1.0, inf, 0.0], "a"),
        (10, [1.0, 0.0], "a"), (11, [], "a"), (None, [1.0, 0.0, 0.0], "a"), (12, [1.0, 0.0, 0.0], "c"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    # columns named like the operator's own
    clash = df.select("*", F.lit(1).alias("v"), F.lit(2).alias("node"), F.lit(3).alias("h1"), F.lit(4).alias("band"), F.lit(5).alias("top"))
    got = V.similar_vectors_df(clash, 0.8)
    assert got.columns == ["vec_id", "cluster_id", "label"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, "a"), (2, 1, "b"), (3, 1, None), (4, 4, "a"), (12, 1, "c")]
    assert V.similar_vectors_df(df.limit(0)).count() == 0


def test_repeated_ids(spark):
    """An id with two vectors links as both of them."""
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.1], 0), (3, [0.1, 1.0], 0), (4, [-1.0, 0.0], 0), (4, [-1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((r.vec_id, r.cluster_id) for r in V.similar_vectors_df(df, 0.9).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4)]


def test_bands_keep_the_stated_probability():
    for n in (0, 1, 500, 51_000, 10**9):
        for cosine in (0.45, 0.8, 0.95):
            bands, bits = V.bands_for(n, cosine)
            assert (1 - (1 - math.acos(cosine) / math.pi) ** bits) ** bands <= V.SIMILAR_MISS * 1.0001
            assert bits == V.LEAST_BITS or n / 2**bits <= V.BUCKET_ROWS


def test_planted_duplicates_and_hot_bucket(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((200, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [(i, base[i].tolist(), 0) for i in range(200)]
    # near copies of the first 20 vectors
    for i in range(20):
        rows.append((1000 + i, (base[i] + rng.normal(0, 0.01, 16)).tolist(), 1))
    # one hot group: 300 identical vectors (a bucket with a third of the rows)
    hot = rng.standard_normal(16)
    rows += [(5000 + i, hot.tolist(), 2) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.cluster_id for r in V.similar_vectors_df(df, cosine=0.95).collect()}
    for i in range(20):
        assert got[1000 + i] == got[i]
    assert {got[5000 + i] for i in range(300)} == {5000}


def test_rows_that_move_grow_with_the_vectors():
    """Bands, rows a vector that are shuffled, stay the same over sizes."""
    assert len({V.bands_for(n, V.SIMILAR_COSINE) for n in (500, 10_000, 100_000, 1_000_000)}) == 1
