"""Toxicity: a linear classifier over character n-grams, with features scaled
by naive Bayes log-count ratios.

Features are the hashed character n-grams (3 to 5 characters, lower case)
that a text has, each counted once.  Over a bounded sample of the labelled
rows (``per_class`` rows of each label, chosen by a hash of the id):

1. Spark sums, by n-gram, the texts of either label that have it;
2. of the n-grams that tell the labels apart significantly (chi-square) the
   best ``FEATURES`` get their log-count ratio r = log((p/|p|) / (q/|q|));
3. a ridge logistic regression is fitted on x * r; its intercept is moved to
   the label rates of all labelled rows, so scores stay probabilities.

Scoring looks every n-gram of the whole text up in a fixed table (broadcast,
``2**BITS`` entries), in segments, so long texts need no more memory.

Defined results: null and empty texts have no n-gram and get the intercept's
probability; without labelled rows of both labels every text gets the
smoothed rate.  Null ids are never learned from.  Repeated labels of an id
count as often as they occur.  Of the inputs only the named columns are used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Sent, Written, class_sample, fit_logistic, hashed_ngrams, map_texts, remainder, ship, sigmoid, slices

ship(__name__)

ORDERS, BITS, FEATURES, SMOOTH, RIDGE = (3, 4, 5), 20, 2048, 1.0, 1e-4
#: Bound of the fitting sample: rows of each label.
PER_CLASS = 4000
THRESHOLD = 0.7
#: Least chi-square of a feature: one chance pick among all buckets is then unlikely.
SIGNIFICANT = 28.0


class Model:
    """``table`` gives the feature (from 1) of a bucket, or 0."""

    def __init__(self, table: np.ndarray, weights: np.ndarray, intercept: float):
        self.table, self.weights, self.intercept = table, weights, intercept

    def features(self, text: str | None) -> np.ndarray:
        seen = np.zeros(len(self.weights) + 1, bool)
        if text:
            for b in hashed_ngrams(text.lower(), ORDERS, BITS):
                seen[self.table[b]] = True
        return seen[1:]

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.intercept + self.weights[self.features(text)].sum()))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_class: int) -> tuple[DataFrame, dict]:
    """``(doc_id, y, text)`` of a bounded sample, and the label counts.  The
    ids are at most about ``per_class`` for each label, so they are broadcast
    and the texts stay where they are."""
    rows = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & allowed)
    chosen, counts = class_sample(rows, "y", F.col("doc_id"), per_class)
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    return texts.join(F.broadcast(chosen), "doc_id"), counts


def text_counts(sample: DataFrame) -> DataFrame:
    """``(bucket, n1, n0)``: texts of either label that have the n-gram."""

    def count(batches):
        import pyarrow as pa

        n = np.zeros((2, 1 << BITS), np.int32)
        for part in slices(batches):
            for y, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                found = list(hashed_ngrams(text.lower(), ORDERS, BITS))
                if found:
                    n[y][np.unique(np.concatenate(found))] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[1][at]), pa.array(n[0][at])], ["bucket", "n1", "n0"])

    counted = sample.select("y", "text").mapInArrow(count, "bucket int, n1 int, n0 int")
    return counted.groupBy("bucket").agg(F.sum("n1").cast("double").alias("n1"), F.sum("n0").cast("double").alias("n0"))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", allowed: Column | None = None, per_class: int = PER_CLASS, features: int = FEATURES) -> Model:
    """Learn ``labels.<label>`` from the labelled rows that ``allowed`` admits."""
    chosen, counts = labelled_sample(docs, labels, label, F.lit(True) if allowed is None else allowed, per_class)
    written = Written(chosen, "toxicity-sample")
    sample = written.df
    have = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    m1, m0 = have.get(1, 0), have.get(0, 0)
    if not m1 or not m0:
        written.delete()
        rate = (counts.get(1, 0) + 0.5) / (counts.get(1, 0) + counts.get(0, 0) + 1)
        return Model(np.zeros(1 << BITS, np.uint16), np.zeros(0), float(np.log(rate / (1 - rate))))
    n, n1, n0 = F.lit(float(m1 + m0)), F.col("n1"), F.col("n0")
    both = n1 + n0
    chi = n * (n1 * m0 - n0 * m1) ** 2 / (both * F.greatest(n - both, F.lit(1.0)) * float(m1) * float(m0))
    best = text_counts(sample).filter(both >= 3).withColumn("chi", chi).filter(F.col("chi") >= SIGNIFICANT).orderBy(F.desc("chi"), "bucket").limit(features).toArrow()
    buckets = best.column("bucket").to_numpy()
    p, q = (best.column(c).to_numpy() + SMOOTH for c in ("n1", "n0"))
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    table = np.zeros(1 << BITS, np.uint16)
    table[buckets] = np.arange(1, len(buckets) + 1)
    bare = Sent(sample.sparkSession, Model(table, np.zeros(len(buckets)), 0.0))

    def make():
        return lambda rows: {"y": rows["y"], "bits": [np.packbits(bare.value.features(t)).tobytes() for t in rows["text"]]}

    got = map_texts(sample.select("y", "text"), "y int, bits binary", make, ["y", "text"]).toArrow()  # bounded by the sample
    written.delete()
    y = got.column("y").to_numpy().astype(float)
    bits = np.frombuffer(b"".join(got.column("bits").to_pylist()), np.uint8).reshape(len(y), -1)
    x = np.unpackbits(bits, axis=1)[:, : len(buckets)].astype(np.float32)
    x *= ratio.astype(np.float32)
    weights, intercept = fit_logistic(x, y, RIDGE)
    shift = np.log(counts[1] / counts[0]) - np.log(m1 / m0)
    return Model(table, weights * ratio, intercept + float(shift))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row's whole text."""
    sent = Sent(docs.sparkSession, model)

    def make():
        return lambda rows: {"doc_id": rows["doc_id"], "score": [sent.value.score(t) for t in rows["text"]]}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, f"doc_id {kind}, score double", make, ["doc_id", "text"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 3) == 1, F.lit(False))


def fit_allowed(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(docs, labels, "toxic", ~held_out(F.col("doc_id")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows that aren't held out, score every row."""
    out = score(docs, fit_allowed(docs, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
