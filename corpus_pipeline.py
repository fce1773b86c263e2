"""A corpus pipeline: five operators of ``tidewater.llm`` in a row.

Toxic documents go, then documents without a known language, then all but one
of each near-duplicate class; the rest is mixed to the target weights (a
document may then occur twice), encoded to token ids and decoded again.
Every stage reads what its predecessor kept from Parquet and returns the
columns of ``documents``; the last returns ids and digests.

Models are learned from the labelled rows among the stage's own documents;
null texts count as empty throughout (and go with the language stage, as they
have no letter).  Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bagminhash, langid, mixing, piece_bpe, toxicity
from tidewater.llm.common import Sent, Written, map_flags, table
from tidewater.llm.queries import piece_model

#: A language is known if its posterior is at least this.
LEAST_LANGUAGE = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    model = Sent(spark, toxicity.fit_allowed(docs, table(spark, sf_dir, "labels")))
    least = toxicity.THRESHOLD
    return map_flags(docs, "text", lambda: lambda texts: [model.value.score(t) < least for t in texts])


def with_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    learn = docs.filter(F.col("doc_id").isNotNull() & ~langid.held_out(F.col("doc_id")))
    model = Sent(spark, langid.fit(learn))

    def make():
        def known(texts):
            return [name != "und" and score >= LEAST_LANGUAGE for name, score in zip(*model.value.predict(texts), strict=True)]

        return known

    return map_flags(docs, "text", make)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return bagminhash.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256, decoded_sha256)``."""
    out = piece_bpe.encode(docs, piece_model(), decoded=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", without_toxic),
    ("language", with_language),
    ("near_duplicates", without_copies),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: Trained models, signatures and draws: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Written(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return STAGES[-1][1](spark, docs, sf_dir)
