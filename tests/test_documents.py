"""Document jobs: brute-force checks on small inputs and made-up edge rows."""

import itertools
import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidewater.functions import patterns as P
from tidewater.functions.text import minhash, minhash_udf, mix64, set_signatures, shingle_sets
from tidewater.plans.documents import decontaminate_df, near_duplicates_df, quality_rules_df, redact_df


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def _tok(text):
    return [t for t in re.split(r"[^\w]+|_", text.lower()) if t]


def test_minhash_udf_equals_sql_expression(spark):
    df = spark.createDataFrame(
        [(1, [5, 17, 2**31 - 2]), (2, []), (3, [0]), (4, list(range(1000)))], "id long, h array<long>"
    )
    got = df.select("id", minhash_udf(16)(F.col("h")).alias("s"))
    want = df.select("id", F.coalesce(minhash(F.col("h"), 16), F.lit(None)).alias("s"))
    g = {r.id: list(r.s) for r in got.collect()}
    w = {r.id: r.s for r in want.collect()}
    for i in (1, 3, 4):
        assert g[i] == list(w[i])
    assert g[2] == [P.MERSENNE_31] * 16  # empty set: sentinel signature


def test_near_duplicates_against_exact_jaccard(spark):
    docs = _docs(spark)
    local = [(r.doc_id, r.text) for r in docs.collect()]
    sh = {}
    for i, text in local:
        t = _tok(text)
        sh[i] = {" ".join(t[j:j + 5]) for j in range(len(t) - 4)} if len(t) >= 5 else {" ".join(t)}
    true_pairs = set()
    for (a, sa), (b, sb) in itertools.combinations(sh.items(), 2):
        if len(sa | sb) and len(sa & sb) / len(sa | sb) >= 0.85:
            true_pairs.add((min(a, b), max(a, b)))
    clusters = {r.doc_id: r.cluster_id for r in near_duplicates_df(docs).collect()}
    # every pair well above the threshold must land in one cluster
    missed = [p for p in true_pairs if clusters.get(p[0], p[0]) != clusters.get(p[1], p[1])]
    assert len(missed) <= max(1, len(true_pairs) // 20), missed
    # cluster ids are the smallest member
    for d, c in clusters.items():
        assert c <= d
    # edges are checked with the exact Jaccard: every clustered document has
    # a partner in its cluster at or above the threshold
    def jac(a, b):
        return len(sh[a] & sh[b]) / len(sh[a] | sh[b])

    members = {}
    for d, c in clusters.items():
        members.setdefault(c, []).append(d)
    for group in members.values():
        for d in group:
            assert any(jac(d, e) >= P.NEAR_DUP_JACCARD for e in group if e != d), d


def test_decontaminate_matches_python(spark):
    docs = _docs(spark)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    n = P.DECONTAMINATION_NGRAM

    def grams(text):
        t = _tok(text)
        return {" ".join(t[i:i + n]) for i in range(len(t) - n + 1)}

    bg = {r.item_id: grams(r.text) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        g = grams(r.text)
        for item, b in bg.items():
            if g & b:
                want.add((r.doc_id, item, len(g & b)))
    got = {(r.doc_id, r.item_id, r.n_shared) for r in decontaminate_df(docs, bench).collect()}
    assert got == want


def test_redaction_leaves_no_match(spark):
    made = spark.createDataFrame(
        [
            (1, 'mail a.b@x.example.com, call +1 (555) 555-1234, card 4111 1111 1111 1111, ip 10.0.0.1, token = "abc"'),
            (2, ""),
            (3, "nothing to see"),
        ],
        "doc_id long, text string",
    )
    out = {r.doc_id: r for r in redact_df(made).collect()}
    r = out[1]
    assert (r.n_email, r.n_phone, r.n_card, r.n_ip, r.n_secret) == (1, 1, 1, 1, 1)
    for _, pattern, _ in P.REDACTIONS:
        assert not re.search(pattern, r.redacted)
    assert out[2].redacted == "" and out[3].redacted == "nothing to see"


def test_quality_rules_edge_rows(spark):
    made = spark.createDataFrame(
        [
            (1, "en", ""),
            (2, "en", "### %%% *** &&& " * 30),
            (3, "en", ("the cat sat on the mat and it was happy with the day\n" * 10)),
            (4, "xx", " ".join(["word"] * 60)),
        ],
        "doc_id long, lang string, text string",
    )
    got = {r.doc_id: r.reason for r in quality_rules_df(made).collect()}
    assert got[1] == "too_short"
    assert got[2] == "too_short"  # symbols are not tokens
    assert got[3] == "repetition"
    assert got[4] == "no_stop_words"


def test_quality_classifier_ranks_held_out_rows(spark):
    from pyspark.sql import functions as F
    from tidewater.plans.documents import quality_classifier_df

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    scored = quality_classifier_df(docs, labels.filter(~held)).join(labels.filter(held), "doc_id")
    got = scored.select("p_good", "quality").collect()
    good, bad = ([r.p_good for r in got if r.quality == q] for q in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert len(good) > 500 and len(bad) > 50 and auc >= 0.8, auc


def test_near_duplicates_lose_no_pair_to_other_heads(spark):
    """Pairs at 0.73 whose buckets also hold less similar documents of smaller
    ids, against all pairs."""
    rng = random.Random(4)
    texts = {}
    for g in range(300):
        base = [f"g{g}w{i}" for i in range(100)]
        for n in (4, 4, 4, 4, 3, 0):
            words = list(base)
            for slot in rng.sample(range(12), n):
                words[8 * slot + 5] = f"x{rng.randrange(10**9)}"
            texts[len(texts)] = " ".join(words)
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.cluster_id for r in near_duplicates_df(docs).collect()}
    pairs = [(a, b) for a in texts for b in range(a + 1, a - a % 6 + 6) if len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b])]
    lost = [(a, b) for a, b in pairs if a not in got or got.get(a) != got.get(b)]
    assert len(pairs) >= 300 and not lost, (len(lost), len(pairs))
    assert set(got) == {i for p in pairs for i in p}


def test_shingle_sets_and_signatures_equal_plain_python():
    """Empty and short texts, repeated runs, a set over several pieces."""
    rng = random.Random(11)
    texts = [[], [5], [], [5, 6], [rng.getrandbits(64) for _ in range(70_000)], [1, 2, 3, 4, 5], [7] * 50, [1, 2, 3, 4], [1, 2, 3, 4, 5, 6], []]
    texts += [[rng.randrange(3) for _ in range(rng.randrange(40))] for _ in range(300)]
    rest = 2**64 - 1

    def mixed(x):
        for _ in range(2):
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 & rest
        return x ^ x >> 32

    def run(words):
        h = len(words)
        for w in words:
            h = mixed(h ^ w)
        return h

    want = [sorted({run(t[i : i + 5]) for i in range(len(t) - 4)} if len(t) >= 5 else {run(t)}) for t in texts]
    assert mix64(np.array([3, rest], dtype=np.uint64)).tolist() == [mixed(3), mixed(rest)]
    for some in (range(len(texts)), [4], [0], [1, 3], []):
        flat = np.array([w for i in some for w in texts[i]], dtype=np.uint64)
        hashes, lens = shingle_sets(flat, np.array([len(texts[i]) for i in some], dtype=np.int32), 5)
        assert hashes.tolist() == [h for i in some for h in want[i]]
        assert lens.tolist() == [len(want[i]) for i in some]
        odd = random.Random(7)
        got = set_signatures(hashes, lens, 8)
        for j in range(8):
            a = odd.getrandbits(64) | 1
            assert got[j].tolist() == [min(a * h & rest for h in want[i]) for i in some]


def test_a_signature_costs_less_than_a_remainder_a_value():
    hashes = np.random.default_rng(3).integers(0, 2**63, 1_000_000).astype(np.uint64)
    lens = np.full(2500, 400)
    low = (hashes & np.uint64(P.MERSENNE_31)).astype(np.int64)

    def remainders():
        for j in range(16):
            np.minimum.reduceat((low * (2 * j + 3) + j) % P.MERSENNE_31, np.arange(0, len(low), 400))

    def took(f):
        t = time.process_time()
        f()
        return time.process_time() - t

    assert min(took(lambda: set_signatures(hashes, lens, 16)) for _ in range(5)) < min(took(remainders) for _ in range(5)) / 2
