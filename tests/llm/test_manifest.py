import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidewater.llm import merkle
from tidewater.llm.common import table

from .conftest import DOCS, SF_CHECK, SF_SMALL


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in merkle.FIELDS))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def steps(tree, at):
    for row in tree[:-1]:
        other = at ^ 1
        yield other < at, row[other] if other < len(row) else None
        at //= 2


def brute(rows):
    groups, out = {}, []
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r), r))
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda x: x[:3])
    trees = {g: levels([x[2] for x in groups[g]]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    for k, g in enumerate(langs):
        for i, (known, doc_id, own, r) in enumerate(groups[g]):
            path = [*steps(trees[g], i), *steps(top, k)]
            changed = dict(r)
            if known and zlib.crc32(str(doc_id).encode()) % 7 == 0 and r["n_chars"] is not None:
                changed["n_chars"] += 1
            h = leaf(changed)
            for left, s in path:
                h = sha(h) if s is None else sha(s, h) if left else sha(h, s)
            out.append((r["doc_id"], own, trees[g][-1][0], top[-1][0], sha(*(s for _, s in path if s)), h, h == top[-1][0]))
    return sorted(out, key=repr)


def got(docs):
    return sorted(map(tuple, merkle.checked(docs).collect()), key=repr)


@pytest.mark.parametrize(("folder", "tier"), [(SF_CHECK, merkle.TIER), (SF_SMALL, 3)])
def test_documents(spark, monkeypatch, folder, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    docs = table(spark, folder, "documents")
    rows = got(docs)
    assert rows == brute([r.asDict() for r in docs.collect()])
    assert len({r[3] for r in rows}) == 1 and not all(r[6] for r in rows)


@pytest.mark.parametrize("tier", [2, 10])
def test_odd_rows(spark, monkeypatch, odd_docs, no_docs, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    assert got(odd_docs) == brute([r.asDict() for r in odd_docs.collect()])
    assert got(no_docs) == []


def test_largest_count_tampered(spark):
    """Adding one to the largest long does not overflow."""
    ids = [i for i in range(30) if zlib.crc32(str(i).encode()) % 7 == 0][:2]
    docs = spark.createDataFrame([(i, "t", "en", "a", 2**63 - 1) for i in ids], DOCS)
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("sizes", [[1], [9, 8, 1], [65, 64, 17, 3]])
def test_block_borders(spark, monkeypatch, sizes):
    """Trees that fill blocks, overflow them by one, and lone leaves."""
    monkeypatch.setattr(merkle, "TIER", 3)
    rows = [(1000 * k + i, "t", f"l{k}", "a", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


def test_many_trees_salted(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_TREES", 1)
    docs = table(spark, SF_SMALL, "documents")
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


def test_manifest_paths(spark):
    """The operator's own result: paths fold to the root, and any change of a
    leaf is seen."""
    rows = merkle.manifest(table(spark, SF_SMALL, "documents"), {"id": F.col("doc_id")})
    other = F.sha2(F.lit("other"), 256)
    up = rows.select(merkle.fold(merkle.digest(F.col("leaf")), F.col("path")).alias("a"), merkle.fold(other, F.col("path")).alias("b"), merkle.digest(F.col("root")).alias("r"))
    assert up.filter("a = r and b != r").count() == rows.count() == 200
