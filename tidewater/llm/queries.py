"""The operators' queries: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    bagminhash,
    compression_quality,
    embedding_dedup,
    graph_ann,
    kdshards,
    langid,
    merkle,
    mixing,
    piece_bpe,
    secret_scan,
    toxicity,
    training_order,
    vector_codes,
)
from tidewater.llm.common import table
from tidewater.llm.oracles import SORTED_PROJECTIONS, merkle_sql, secret_scan_sql, vector_code_sql

SHARDS = 8


def piece_model() -> str:
    """Place of the vocabulary file, read by the driver only."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_bagminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bagminhash.cluster(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "class_id", "texts", "kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = kdshards.assign(table(spark, sf_dir, "documents"), SHARDS)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sorted_projection_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link(table(spark, sf_dir, "embeddings"))


def op7_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(piece_bpe.encode(table(spark, sf_dir, "documents"), piece_model(), decoded=True))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.materialise(table(spark, sf_dir, "documents"), piece_model()).index()


def op10_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.checked(table(spark, sf_dir, "documents"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bagminhash_near_dedup,
        op2_mix_sources,
        op3_kd_shards,
        op4_toxicity,
        op5_compression_quality,
        op6_sorted_projection_dedup,
        op7_piece_bpe,
        op8_language_id,
        op9_training_order,
        op10_graph_neighbours,
        op11_vector_codes,
        op12_merkle_manifest,
        op13_secret_scan,
    )
}

#: Exact in SQL; the others are trained, drawn, hashed or need a library, and
#: are tested against brute force.
ORACLES = {
    "op6_sorted_projection_dedup": SORTED_PROJECTIONS,
    "op11_vector_codes": vector_code_sql(),
    "op12_merkle_manifest": merkle_sql(),
    "op13_secret_scan": secret_scan_sql(),
}
