import pytest
from pyspark.sql import functions as F

from tidewater.llm import compression_quality, langid, toxicity
from tidewater.llm.common import hashed_ngrams, table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


def test_segments_give_the_ngrams_of_the_whole(monkeypatch):
    text = "".join(chr(97 + i * i % 26) for i in range(500))
    whole = sorted(x for b in hashed_ngrams(text, (1, 3, 5), 20) for x in b.tolist())
    monkeypatch.setattr("tidewater.llm.common.SEGMENT", 37)
    assert sorted(x for b in hashed_ngrams(text, (1, 3, 5), 20) for x in b.tolist()) == whole


def test_toxicity_on_held_out_rows(docs, labels):
    out = toxicity.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert out["score"].between(0, 1).all()
    assert (out["predicted"] == (out["score"] >= 0.7)).all()
    assert out.loc[out["toxic"] == 1, "predicted"].mean() > 0.6
    assert out.loc[out["toxic"] == 0, "predicted"].mean() < 0.01


def test_quality_on_held_out_rows(docs, labels):
    out = compression_quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert out["score"].between(0, 1).all()
    assert (out["predicted"] == (out["score"] >= 0.3)).all()
    assert out.loc[out["quality"] == 1, "predicted"].mean() > 0.98
    assert out.loc[out["quality"] == 0, "predicted"].mean() < 0.35


def test_language_on_held_out_rows(docs):
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.97


def test_labels_of_held_out_rows_are_never_learned(spark, docs, labels):
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.fit_allowed(docs, x) for x in (labels, flipped))
    assert a.intercept == b.intercept and (a.weights == b.weights).all()


def test_odd_rows(odd_docs, no_docs, no_labels, spark):
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    n = odd_docs.count()
    for labels in (no_labels, some):
        for module in (toxicity, compression_quality):
            rows = module.classify(odd_docs, labels).collect()
            assert len(rows) == n and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
            assert module.classify(no_docs, labels).count() == 0
    out = langid.identify(odd_docs).collect()
    assert len(out) == n
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in out if r["doc_id"] in (3, 4, 5))
    assert langid.identify(no_docs).count() == 0


def test_long_texts_are_compressed_whole(monkeypatch):
    sizes = compression_quality.Sizes(b"good words " * 20, b"bad words " * 20)
    text = "some words and more of them " * 500
    whole = sizes(text)
    monkeypatch.setattr(compression_quality, "PIECE", 1000)
    assert sizes(text)[0] == whole[0] and abs(sizes(text)[1] - whole[1]) < 64
