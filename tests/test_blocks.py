"""Bucket members compared in blocks, against all pairs."""

import itertools
import random

from pyspark.sql import functions as F

from tidewater.operators import blocks
from tidewater.operators.blocks import BLOCK_ROWS, alike_in_buckets
from tidewater.plans.documents import near_duplicates_df

SCHEMA = "band int, bucket long, node long, grp long, sketch binary"


def _alike(spark, members, least):
    df = spark.createDataFrame(members, SCHEMA)
    return {tuple(sorted(r)) for r in alike_in_buckets(df, ["band", "bucket"], "node", "grp", "sketch", least).collect()}


def test_blocks_equal_all_pairs_in_a_hot_bucket(spark):
    rng = random.Random(5)
    base = [rng.randrange(256) for _ in range(16)]
    sketch = {n: bytes(v if rng.random() < 0.6 else rng.randrange(256) for v in base) for n in range(2 * BLOCK_ROWS + 300)}
    members = [(0, 9, n, n // 3, s) for n, s in sketch.items()]  # one bucket over several blocks
    members += [(1, n % 40, n, n // 3, s) for n, s in sketch.items() if n < 400] + [(2, -5, 1, 0, sketch[1])]
    want = {
        (a, b) for a, b in itertools.combinations(sketch, 2)
        if a // 3 != b // 3 and sum(x == y for x, y in zip(sketch[a], sketch[b])) >= 11
    }
    assert want and _alike(spark, members, 11) == want


def test_no_members_no_pairs(spark):
    assert _alike(spark, [], 1) == set()
    none = spark.createDataFrame([], SCHEMA + ", sh array<long>")
    assert blocks.groups_alike_in_buckets(none, ["band", "bucket"], "node", "grp", "sketch", 1).count() == 0
    assert blocks.near_in_groups(none, "bucket", "node", "grp", "sketch", 1, "sh", 0.5).count() == 0


def parts(nodes, links):
    """Components as sets of nodes."""
    of = {n: {n} for n in nodes}
    for a, b in links:
        if of[a] is not of[b]:
            of[a] |= of[b]
            for n in of[b]:
                of[n] = of[a]
    return {frozenset(p) for p in of.values()}


def test_groups_that_meet_are_a_forest_a_task(spark):
    """As connected as all pairs are, in far fewer rows."""
    rng = random.Random(6)
    sketch = {n: bytes(rng.choice((1, 2)) if n % 3 else 7 for _ in range(16)) for n in range(900)}
    df = spark.createDataFrame([(0, 9, n, n // 2, s) for n, s in sketch.items()], SCHEMA)
    got = [tuple(r) for r in blocks.groups_alike_in_buckets(df, ["band", "bucket"], "node", "grp", "sketch", 13).collect()]
    want = [(a // 2, b // 2) for a, b in itertools.combinations(sketch, 2) if a // 2 != b // 2 and sum(x == y for x, y in zip(sketch[a], sketch[b])) >= 13]
    groups = {n // 2 for n in sketch}
    assert parts(groups, got) == parts(groups, want)
    # two blocks meet in three tasks
    assert len(want) > 40_000 and len(got) < 3 * len(groups)


def test_near_members_equal_all_pairs(spark, monkeypatch):
    """Sets just below and above the threshold, very long and empty ones, in
    blocks by weight; a hot key and small ones."""
    monkeypatch.setattr(blocks, "BLOCK_WEIGHT", 5000)
    rng = random.Random(7)
    base = [rng.getrandbits(62) for _ in range(60)]
    sets = {n: {h if rng.random() < 0.83 else rng.getrandbits(62) for h in base} for n in range(500)}
    sets |= {500: set(range(9000)), 501: set(range(500, 9000)), 502: set(), 503: set()}
    key = {n: 1 if n < 400 or n >= 500 else n for n in sets}
    df = spark.createDataFrame([(0, key[n], n, n, b"same", list(v)) for n, v in sets.items()], SCHEMA + ", sh array<long>")
    got = [tuple(r) for r in blocks.near_in_groups(df, "bucket", "node", "grp", "sketch", 4, "sh", 0.6).collect()]
    near = lambda x, y: not (x | y) or len(x & y) / len(x | y) >= 0.6
    want = [(a, b) for a, b in itertools.combinations(sets, 2) if key[a] == key[b] and near(sets[a], sets[b])]
    assert parts(sets, got) == parts(sets, want)
    assert all(near(sets[a], sets[b]) for a, b in got)
    assert 1000 < len(want) < 70_000 and (500, 501) in want and (502, 503) in want


def test_copies_alike_below_the_threshold_make_no_pair_rows(spark):
    """Edited copies that are near their source but not each other, and groups
    of them that only meet below a bucket's head."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(250):
        words = list(base)
        for at in rng.sample(range(200), rng.choice((5, 9, 10))):
            words[at] = f"x{rng.getrandbits(40)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    grams = [{tuple(w[i : i + 5]) for i in range(196)} for w in (t.split() for t in texts)]
    links = [(a, b) for a, b in itertools.combinations(range(250), 2) if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.7]
    want = {p for p in parts(range(250), links) if len(p) > 1}
    found = {}
    for r in near_duplicates_df(docs).collect():
        found.setdefault(r.cluster_id, set()).add(r.doc_id)
    assert {frozenset(v) for v in found.values()} == want and len(want) < 10


def test_near_duplicates_of_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, None, 0), (None, "a b c", 0), (2, "", 0), (3, "?!", 0), (4, "one two", 0), (5, "ONE, two", 0), (6, "one", 0), (7, long, 0), (8, long + " end", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long")
    got = {(r.doc_id, r.cluster_id) for r in near_duplicates_df(docs).collect()}
    assert got == {(2, 2), (3, 2), (4, 4), (5, 4), (7, 7), (8, 7)}
    assert near_duplicates_df(docs.filter(F.lit(False))).count() == 0


def test_words_agree_in_bits_as_in_all_pairs(spark, monkeypatch):
    """Blocks of words, groups left out, a bucket of one group."""
    monkeypatch.setattr(blocks, "PAIRS_AT_ONCE", 1000)
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(2)]
    near = lambda: [b ^ (rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)) for b in base]
    words = {n: near() if n % 2 else [rng.getrandbits(64) for _ in range(2)] for n in range(300)}
    signed = lambda v: [w - (1 << 64) if w >> 63 else w for w in v]
    rows = [(0, 9, n, n // 4, signed(v)) for n, v in words.items()] + [(1, 3, n, 0, signed(words[n])) for n in range(50)]
    df = spark.createDataFrame(rows, "band int, bucket long, node long, grp long, words array<long>")
    got = blocks.alike_words_in_buckets(df, ["band", "bucket"], "node", "grp", "words", 100, 70).collect()
    alike = lambda x, y: 128 - sum((p ^ q).bit_count() for p, q in zip(x, y)) >= 100
    want = {(a, b) for a, b in itertools.combinations(words, 2) if a // 4 != b // 4 and alike(words[a], words[b])}
    assert len(want) > 500 and len(got) == len(want) and {tuple(sorted(r)) for r in got} == want
    assert blocks.alike_words_in_buckets(df.limit(0), ["band", "bucket"], "node", "grp", "words", 100, 70).count() == 0
