import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import kdshards, mixing
from tidewater.llm.common import table

from .conftest import DOCS, SF_CHECK


def filled(sizes, weights, share, most):
    """Targets by sharing the excess again until none is above its cap."""
    total, target, open_ = share * sum(sizes), [0.0] * len(sizes), list(range(len(sizes)))
    while open_:
        w = sum(weights[i] for i in open_)
        over = [i for i in open_ if total * weights[i] / w > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = total * weights[i] / w
            break
        for i in over:
            target[i] = most * sizes[i]
            total -= target[i]
            open_.remove(i)
    return target


@pytest.mark.parametrize("sizes", [[5, 900, 20, 30, 10], [1, 1, 1], [0, 0, 7], [0, 0], [1000, 1, 2, 3, 4, 5, 6, 7]])
@pytest.mark.parametrize("share", [1.5, 0.3, 2.0])
def test_targets(spark, sizes, share):
    names = [None if i == len(sizes) - 1 else chr(97 + i) for i in range(len(sizes))]
    df = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, share=share).collect()}
    want = filled(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], share, 2.0)
    assert [got[n] for n in names] == pytest.approx(want)


def test_pivot_keeps_words_and_expectation():
    keys, sizes = np.arange(400), np.random.default_rng(1).integers(1, 50, 400)
    means = np.zeros(400)
    for level in range(300):
        p = mixing.pivot(keys, sizes, np.full(400, 0.3), level)
        assert ((p > 0) & (p < 1)).sum() <= 1
        assert (p * sizes).sum() == pytest.approx(0.3 * sizes.sum())
        means += p / 300
    assert abs(means.mean() - 0.3) < 0.01 and np.abs(means - 0.3).max() < 0.15


def test_mix_reaches_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 20)
    monkeypatch.setattr(mixing, "FAN", 2)
    docs = table(spark, SF_CHECK, "documents")
    out = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (out["taken"] <= 2 * out["size"]).all()
    for _, own in out.groupby("source"):
        assert own["size"].sum() == own["source_size"].iloc[0]
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= own["size"].max()
    again = mixing.mix(docs.repartition(7)).toPandas()
    assert again.set_index("doc_id")["taken"].to_dict() == out.set_index("doc_id")["taken"].to_dict()
    taken = mixing.take(docs)
    assert taken.columns == docs.columns
    assert taken.agg(F.sum(mixing.words(F.col("text")))).first()[0] == out["taken"].sum()


def test_mix_of_odd_rows(odd_docs, no_docs):
    out = mixing.mix(odd_docs).collect()
    assert len(out) == odd_docs.count()
    assert all(r["taken"] == 0 for r in out if r["size"] == 0)
    assert len({r["taken"] for r in out if r["doc_id"] == 1}) == 1
    assert mixing.take(odd_docs).columns == odd_docs.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.take(no_docs).count() == 0


def check_shards(rows, docs, shards):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (d["doc_id"] is None, d["doc_id"] or 0, len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs
    )
    slots, where = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        where[(r["text_crc32"], r["size"])].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    return where


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_are_near_equal(spark, shards):
    docs = table(spark, SF_CHECK, "documents")
    rows = kdshards.assign(docs, shards).collect()
    assert all(len(s) == 1 for s in check_shards(rows, docs.collect(), shards).values())
    total = defaultdict(int)
    for r in rows:
        total[r["shard"]] += r["size"]
    largest = max(r["size"] for r in rows)
    assert len(total) == shards and max(total.values()) - min(total.values()) <= 2 * largest


def test_cuts_are_weighted_medians(spark):
    """One cut, against a sort of all groups."""
    docs = table(spark, SF_CHECK, "documents")
    groups = kdshards.grouped(docs).toPandas()
    widths = [(groups[f"x{d}"].max() - groups[f"x{d}"].min()) for d in range(4)]
    assert all(w > 0 for w in widths)  # all equally wide at the root: the first is cut
    low, wide = groups["x0"].min(), widths[0]
    step = np.floor((groups["x0"] - low) / wide * 65535)
    order = groups.assign(step=step).sort_values(["step", "tie"])
    before = order["weight"].cumsum() - order["weight"]
    left = set(order["group_key"][before + order["weight"] / 2 <= order["weight"].sum() / 2])
    got = kdshards.tree(kdshards.grouped(docs), 2).filter("shard = 0").toPandas()
    assert len(left ^ set(got["group_key"])) <= 1


def test_shards_of_odd_rows(odd_docs, no_docs):
    rows = kdshards.assign(odd_docs, 8).collect()
    where = check_shards(rows, odd_docs.collect(), 8)
    assert all(len(s) == 1 for (crc, size), s in where.items() if size > 1)
    assert kdshards.assign(no_docs, 8).count() == 0


@pytest.mark.parametrize("most", [kdshards.BROADCAST_VALUES, 0])
def test_sources_with_a_common_beginning(spark, monkeypatch, most):
    """Ranks tell values apart wherever they differ; null comes first."""
    monkeypatch.setattr(kdshards, "BROADCAST_VALUES", most)
    names = [None, "", "crawl-2019", "crawl-2020", "crawl-2020-a-long-name-1", "crawl-2020-a-long-name-2"]
    rows = [(i, f"text {i:04d}", "en", names[i % 6], 9) for i in range(240)]
    docs = spark.createDataFrame(rows, DOCS)
    key = F.xxhash64("text", F.isnull("text"))
    got = kdshards.grouped(docs).join(docs.select(key.alias("group_key"), "source"), "group_key")
    assert {(r["source"], r["x1"]) for r in got.collect()} == {(n, float(i)) for i, n in enumerate(names)}
    # the widest dimension (none but source and id vary) is cut
    out = kdshards.assign(docs, 2).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in out) == [120, 120]
