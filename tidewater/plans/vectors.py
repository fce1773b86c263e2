"""Embeddings: per-label centroids and clusters of similar vectors."""

from __future__ import annotations

from math import acos, ceil, comb, log, log1p, log2, pi

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.arrays import posexplode_rows
from tidewater.functions.vectors import bits_alike, cosine_of, sign_words_udf, simhash_bands_udf
from tidewater.operators.blocks import alike_words_in_buckets
from tidewater.operators.graph import connected_components
from tidewater.operators.joins import broadcast_if_small
from tidewater.plans.catalog import job
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables

SIMILAR_COSINE = 0.8
#: A pair at the threshold shares no bucket, or too little of its sketch, with
#: at most this probability (each).
SIMILAR_MISS = 1e-6
#: Unlike vectors that a bucket holds, at most about; its bits follow from it.
#: Bits make bands, and every band is a row a vector that moves; comparing more
#: vectors inside a task is cheaper, so bits and bands stay the same up to
#: ``BUCKET_ROWS * 2**LEAST_BITS`` vectors.
BUCKET_ROWS = 4096
LEAST_BITS = 8
SKETCH_WORDS = 8
SIMHASH_SEED = 11


@job(
    "label_centroids",
    """
    SELECT label, CAST(i - 1 AS BIGINT) AS dim, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS mean, COUNT(*) AS n
    FROM embeddings, range(1, 65) r(i)
    GROUP BY label, i
    """,
    group="vectors",
)
def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector per label, one row per (label, dimension): a partial
    aggregate per (label, dim), so a label with most vectors is combined
    map-side."""
    e = Tables(spark, sf_dir).embeddings
    x = e.select("label", F.posexplode("embedding").alias("dim", "x"))
    return x.groupBy("label", F.col("dim").cast("bigint").alias("dim")).agg(
        F.round(F.avg(F.col("x").cast("double")), 6).alias("mean"), F.count(F.lit(1)).alias("n")
    )


def usable(emb: DataFrame) -> DataFrame:
    """``(vec_id, label, v)``: rows with an id and a vector of finite
    components, not all zero, scaled by its largest component (so that no square
    overflows), in double precision.  Vectors of a length other than most
    rows' (the longer of two) are left out."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    v = emb.filter("vec_id is not null and embedding is not null").select("vec_id", "label", x.alias("v"))
    top = F.array_max(F.transform("v", lambda e: F.abs(e)))
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = v.filter(F.coalesce(finite, F.lit(False))).withColumn("top", top).filter("top > 0")
    v = v.select("vec_id", "label", F.transform("v", lambda e: e / F.col("top")).alias("v"))
    size = v.groupBy(F.size("v").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return v.filter(F.size("v") == size["d"]) if size else v


def bands_for(n: int, cosine: float) -> tuple[int, int]:
    """Bands and bits for ``n`` vectors: enough bits that unlike vectors (which
    agree on a bit half the time) leave about ``BUCKET_ROWS`` in a bucket, and
    enough bands that a pair at ``cosine`` is missed with ``SIMILAR_MISS``."""
    bits = max(LEAST_BITS, ceil(log2(max(n, 1) / BUCKET_ROWS)))
    share = (1 - acos(cosine) / pi) ** bits
    return ceil(log(SIMILAR_MISS) / log1p(-share)), bits


def least_alike(cosine: float) -> int:
    """Bits of the sketch in which a pair at ``cosine`` agrees but with
    probability ``SIMILAR_MISS``."""
    n, share, below = 64 * SKETCH_WORDS, 1 - acos(cosine) / pi, 0.0
    for k in range(n + 1):
        below += comb(n, k) * share**k * (1 - share) ** (n - k)
        if below > SIMILAR_MISS:
            return k
    return n


def similar_vectors_df(emb: DataFrame, cosine: float = SIMILAR_COSINE) -> DataFrame:
    """``(vec_id, cluster_id, label)`` of every usable row: vectors linked
    directly or through others by a cosine of at least ``cosine`` share a
    cluster, named by its smallest id; others are clusters of their own.

    1. equal vectors (by two hashes) are one node, the smallest id;
    2. per node, band codes of sign bits (random hyperplanes; one matrix
       product per Arrow batch) and a sketch of 512 more sign bits; bits and
       bands follow the number of nodes and the threshold (``bands_for``);
    3. each (band, code) bucket links its members to its smallest node -- a
       star, never all pairs.  The heads, few as buckets are, go to the members,
       and an edge whose sketches agree is kept by its exact cosine: vectors
       move only for these;
    4. members of a bucket that the stars left in different components are
       compared by sketches, block by block inside tasks
       (``alike_words_in_buckets``); pairs that agree in enough bits are
       checked like edges;
    5. connected components over the kept edges.

    A linked pair is lost with probability 2e-6 at the threshold, less above
    it, and only if nothing else joins its ends.  Null ids, and vectors that are
    null, zero, of another length or hold null or non-finite components, give
    no rows; an id with several vectors is one node linked as any of them.
    """
    spark = emb.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = written(usable(emb).withColumn("h1", F.xxhash64("v")).withColumn("h2", F.xxhash64("v", F.lit(1))), "vectors")
    nodes = written(rows.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.first("v").alias("v")), "vector-nodes")
    copies = rows.join(nodes.select("h1", "h2", "node"), ["h1", "h2"]).filter("vec_id <> node").select(F.col("vec_id").alias("src"), F.col("node").alias("dst"))

    bands, bits = bands_for(nodes.count(), cosine)
    sketch, codes = sign_words_udf(SKETCH_WORDS, SIMHASH_SEED + 1)("v"), simhash_bands_udf(bands, bits, SIMHASH_SEED)("v")
    marks = written(nodes.select("node", sketch.alias("sketch"), codes.alias("codes")), "vector-codes")
    keyed = posexplode_rows(marks, ["node", "sketch"], "codes", "band", "code")
    heads = keyed.groupBy("band", "code").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    heads = written(heads.join(marks.select(F.col("node").alias("head"), F.col("sketch").alias("mark")), "head"), "vector-heads")

    def kept(pairs: DataFrame) -> DataFrame:
        a, b = nodes.select(F.col("node").alias("src"), F.col("v").alias("va")), nodes.select(F.col("node").alias("dst"), F.col("v").alias("vb"))
        near = cosine_of(F.col("va"), F.col("vb")) >= F.lit(cosine)
        return pairs.filter("src <> dst").distinct().join(a, "src").join(b, "dst").filter(near).select("src", "dst").distinct()

    least = least_alike(cosine)
    agree = bits_alike(F.col("sketch"), F.col("mark"), SKETCH_WORDS) >= F.lit(least)
    met = keyed.join(broadcast_if_small(heads), ["band", "code"]).filter(agree)
    stars = written(kept(met.select(F.col("node").alias("src"), F.col("head").alias("dst"))), "vector-stars")
    found = marks.join(broadcast_if_small(connected_components(stars)), "node", "left")
    found = found.select("node", "sketch", "codes", F.coalesce("component", "node").alias("component"))
    member = posexplode_rows(found, ["node", "component", "sketch"], "codes", "band", "code")
    alike = alike_words_in_buckets(member, ["band", "code"], "node", "component", "sketch", least, BUCKET_ROWS)
    near = kept(alike.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")))
    clusters = connected_components(stars.unionByName(near).unionByName(copies))
    return rows.join(clusters, rows["vec_id"] == clusters["node"], "left").select("vec_id", F.coalesce("component", "vec_id").alias("cluster_id"), "label")


@job(
    "similar_vectors",
    f"""
    WITH RECURSIVE v AS (
      SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    ), u AS (
      SELECT vec_id, label, v FROM v
      WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
    ), e AS (
      SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b
      ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {SIMILAR_COSINE}
    ), r(node, root) AS (
      SELECT vec_id, vec_id FROM u UNION SELECT e.x, r.root FROM r JOIN e ON e.y = r.node AND r.root < e.x
    ), c AS (SELECT node, min(root) AS cluster_id FROM r GROUP BY node)
    SELECT u.vec_id, c.cluster_id, u.label FROM u JOIN c ON c.node = u.vec_id
    """,
    group="vectors",
)
def similar_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of vectors with a cosine of at least ``SIMILAR_COSINE``."""
    return similar_vectors_df(Tables(spark, sf_dir).embeddings)
