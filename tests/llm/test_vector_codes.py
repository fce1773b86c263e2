import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import vector_codes as V
from tidewater.llm.common import table

from .conftest import CLASHES, SF_CHECK

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, entries=V.ENTRIES):
    """All distances, in Python's integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not rows:
        return []
    length = len(rows[0][1])
    rows = [r for r in rows if len(r[1]) == length]
    x = [[math.floor(1024 * max(-(2.0**50), min(2.0**50, float(v)))) for v in r[1]] for r in rows]
    edges = V.cuts(length)
    parts = [[v[a:b] for v in x] for a, b in zip(edges, edges[1:], strict=False)]
    books = [[list(v) for v in p[:entries]] for p in parts]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))

    for r in range(V.ROUNDS + 1):
        best = [[nearest(v, book) for v in p] for p, book in zip(parts, books, strict=True)]
        if r < V.ROUNDS:
            for p, book, own in zip(parts, books, best, strict=True):
                for k in range(len(book)):
                    mine = [v for v, (_, b) in zip(p, own, strict=True) if b == k]
                    if mine:
                        book[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    error = [min(sum(best[p][i][0] for p in range(4)), V.LONG) for i in range(len(rows))]
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    labels = {}
    for r, e in zip(rows, error, strict=True):
        labels[r[2]] = labels.get(r[2], 0) + e
    return sorted(((r[0], "".join(f"{best[p][i][1]:02x}" for p in range(4)), error[i], min(labels[r[2]], V.LONG), digest) for i, r in enumerate(rows)), key=repr)


def got(df):
    return sorted(map(tuple, V.compress(df).collect()), key=repr)


def plain(df):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in df.select("vec_id", "embedding", "label").collect()]


def test_embeddings(spark):
    df = table(spark, SF_CHECK, "embeddings")
    assert got(df) == brute(plain(df))


@pytest.mark.parametrize("scale", [1.0, 1e4, 1e30])
def test_magnitudes(spark, monkeypatch, scale):
    """Small integers in 32 bits, then 64, then Python's."""
    monkeypatch.setattr(V, "BLOCK", 16)
    x = np.random.default_rng(3).normal(size=(70, 6)) * scale
    df = spark.createDataFrame([(i, v.tolist(), i % 3 or None) for i, v in enumerate(x)], SCHEMA)
    monkeypatch.setattr(V, "ENTRIES", 20)
    out = V.Coded(df, entries=20)
    codes = V.with_label_errors(out.codes()).select("vec_id", F.lower(F.hex("code")), "error", "label_error", F.lit(out.books.sha256()))
    assert sorted(map(tuple, codes.collect()), key=repr) == brute(plain(df), 20)


def test_odd_rows(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = [
        (3, [0.5, 0.25, -0.5, 1.0], 1),
        (3, [0.5, 0.25, -0.5, 1.0], 1),
        (3, [0.1, 0.2, 0.3, 0.4], None),
        (None, [0.9, 0.2, 0.3, 0.4], None),
        (4, None, 1),
        (1, [nan, 0.0, 0.0, 0.0], 1),
        (0, [inf, 0.0, 0.0, 0.0], 1),
        (2, [None, 0.0, 0.0, 0.0], 1),
        (5, [0.0, 0.0, 0.0, 0.0], 2),
        (6, [0.0, 0.0], 2),
        (7, [], 2),
        (8, [-0.0001, -1.0, 1e300, 2.0], 3),
    ]
    df = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in CLASHES if c not in ("label",)])
    assert got(df) == brute(rows)
    monkeypatch.setattr(V, "BROADCAST_LABELS", 0)
    assert got(df) == brute(rows)
    assert got(df.limit(0)) == []
    empties = [(2, [], 1), (1, [], None)]
    assert [r[:4] for r in got(spark.createDataFrame(empties, SCHEMA))] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]
    two = [(i, [i / 7.0, -i / 3.0], i % 2) for i in range(9)]
    assert got(spark.createDataFrame(two, SCHEMA)) == brute(two)


def test_codes_stand_for_vectors(spark):
    """Decoding gives vectors nearer than any other entry's by the error."""
    coded = V.Coded(table(spark, SF_CHECK, "embeddings"))
    rows = coded.codes().join(table(spark, SF_CHECK, "embeddings").select("vec_id", "embedding"), "vec_id").collect()
    for r in rows[::25]:
        back = coded.books.vector(bytes(r["code"])) * V.SCALE
        assert ((V.integers(np.array(r["embedding"])) - back) ** 2).sum() == r["error"]
