import corpus_pipeline
from tidewater.llm import bagminhash, langid, mixing, toxicity
from tidewater.llm.common import table

from .conftest import SF_CHECK


def test_stages_follow_from_their_operators(spark):
    sf = SF_CHECK
    docs = table(spark, sf, "documents")
    out = corpus_pipeline.without_toxic(spark, docs, sf)
    assert out.columns == docs.columns
    bad = {r["doc_id"] for r in toxicity.classify(docs, table(spark, sf, "labels")).filter("predicted = 1").collect()}
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()} - bad
    known = corpus_pipeline.with_language(spark, docs, sf)
    names = {r["doc_id"] for r in langid.identify(docs).filter("lang_pred != 'und' and score >= 0.5").collect()}
    assert {r["doc_id"] for r in known.collect()} == names
    one = corpus_pipeline.without_copies(spark, docs, sf)
    kept = {r["doc_id"] for r in bagminhash.cluster(docs).filter("kept").collect()}
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(kept)
    mix = corpus_pipeline.mixed(spark, docs, sf)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    assert mix.count() == sum(copies.values())


def test_run_gives_ids_of_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_CHECK)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mixing", "tokens"]
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in out.collect())
