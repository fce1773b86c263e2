import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import piece_bpe, training_order
from tidewater.llm.common import table

from .conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def library(model_path):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path)


@pytest.fixture(scope="module")
def coder(model_path):
    return piece_bpe.Vocabulary(model_path).coder()


def test_encoding_equals_the_library(coder, library):
    random.seed(3)
    parts = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "▁", "ß", "漢字", "ｱ", "\t", "́", "😀", "\x00", "!!", "http://", "1234", "x" * 7, " " * 37]
    for _ in range(1500):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 25)))
        ids = np.frombuffer(coder.encode(text), "<u4").tolist()
        assert ids == library.encode(text, add_bos=True, add_eos=True), repr(text)
        assert coder.decode(ids) == library.decode(ids), repr(text)


def test_pairs_are_remerged_by_their_edges(coder):
    """As merging all their characters would."""
    random.seed(6)
    v = coder.v
    pairs = [random.sample(v.whole, 2) for _ in range(6000)]
    pairs += [(w[:k], w[k:]) for w in random.sample(v.whole, 2500) for k in range(1, len(w)) if w[:k] in v.sole and w[k:] in v.sole]
    for a, b in pairs:
        assert coder.compatible(v.ids[a], v.ids[b]) == (piece_bpe.merged(list(a + b), v.rank) == [a, b]), (a, b)


def test_word_memory_is_bounded(coder, library, monkeypatch):
    """Words are forgotten and met again, also within runs of blanks."""
    monkeypatch.setattr(piece_bpe, "MEMORY", 2000)
    packer = piece_bpe.Packer(coder.v, "I", coder.packer.words.cold)
    random.seed(8)
    texts = ["  ".join(str(random.randrange(400)) for _ in range(30)) + " " * (i % 3) + "a b" for i in range(40)]
    for at in range(0, 40, 8):
        got = [np.frombuffer(b, "<u4").tolist() for b in packer.encode_all(texts[at : at + 8])]
        assert got == library.encode(texts[at : at + 8], add_bos=True, add_eos=True)
        assert packer.words.known.nbytes < 20_000


def test_any_ids_decode_like_the_library(coder, library):
    random.seed(4)
    for _ in range(1000):
        ids = [random.randrange(0, 32000 if random.random() < 0.6 else 259) for _ in range(random.randint(0, 12))]
        assert coder.decode(ids) == library.decode(ids)


def test_query_digests(spark, model_path, library):
    docs = table(spark, SF_SMALL, "documents")
    got = {r["doc_id"]: r for r in piece_bpe.digests(piece_bpe.encode(docs, model_path, decoded=True)).collect()}
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        one = got[r["doc_id"]]
        assert one["n_tokens"] == len(ids)
        assert one["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert one["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_odd_rows_round_trip(odd_docs, no_docs, model_path, library):
    out = piece_bpe.encode(odd_docs, model_path, decoded=True).collect()
    texts = [r["text"] or "" for r in odd_docs.collect()]
    assert sorted(r["decoded"] for r in out) == sorted(library.decode(library.encode(t)) for t in texts)
    back = piece_bpe.decode(piece_bpe.encode(odd_docs, model_path), model_path)
    assert sorted(r["text"] for r in back.collect()) == sorted(r["decoded"] for r in out)
    assert piece_bpe.encode(no_docs, model_path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    assert sorted(training_order.feistel(np.arange(n), n).tolist()) == list(range(n))


def test_training_order_holds_every_sequence(spark, model_path, library):
    docs = table(spark, SF_CHECK, "documents")
    shards = training_order.materialise(docs, model_path, stride=64, per_shard=100)
    index = shards.index().toPandas()
    assert sorted(index["slot"]) == list(range(shards.total))
    assert (index["shard"] == index["slot"] // 100).all() and (index["record"] == index["slot"] % 100).all()
    want = set()
    for r in docs.collect():
        ids = np.array(library.encode(r["text"] or "", add_bos=True, add_eos=True), "<u2")
        want |= {(r["doc_id"], k, hashlib.sha256(ids[at : at + 64].tobytes()).hexdigest()) for k, at in enumerate(range(0, len(ids), 64))}
    assert set(zip(index["doc_id"], index["part"], index["tokens_sha256"], strict=True)) == want
    rest = shards.read_from(shards.total - 130).toPandas()
    assert rest["slot"].tolist() == list(range(shards.total - 130, shards.total))
    by_slot = index.set_index("slot")["tokens_sha256"]
    assert all(hashlib.sha256(t).hexdigest() == by_slot[s] for s, t in zip(rest["slot"], rest["tokens"], strict=True))


def test_training_order_of_odd_rows(odd_docs, no_docs, model_path):
    shards = training_order.materialise(odd_docs, model_path)
    out = shards.index()
    assert sorted(r["slot"] for r in out.collect()) == list(range(shards.total))
    assert out.filter("part = 0").count() == odd_docs.count()
    assert out.filter("part = 0").filter(F.col("doc_id").isNull()).count() == 2
    empty = training_order.materialise(no_docs, model_path)
    assert empty.total == 0 and empty.index().count() == 0
