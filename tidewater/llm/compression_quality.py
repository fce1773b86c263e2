"""Quality: a compression classifier.

Two zstandard dictionaries are trained, one on texts labelled good, one on
texts labelled bad.  Every whole text is compressed with either; the
difference of the two sizes, normalised by the text's length and by the larger
size, together with the two compression rates it comes from, goes through a
logistic calibration into a score (probability of label 1).

Dictionaries and calibration come from disjoint halves (by a hash of the id)
of a bounded sample of the labelled rows: ``PER_CLASS`` rows of each label,
``DICT_TEXTS`` texts and ``DICT_BYTES`` bytes a dictionary.  The bounds are
for fitting only; scoring compresses whole texts, in a stream, so a long text
needs no buffer of its size.

Defined results: null counts as empty, and empty texts get a score like
others; if a label is missing, every text gets the smoothed label rate.  Null
ids are never learned from.  Of the inputs only the named columns are used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Sent, fit_logistic, map_texts, remainder, ship, sigmoid
from tidewater.llm.toxicity import labelled_sample

ship(__name__)

LEVEL, DICTIONARY = 3, 112_640
#: Bounds of the fitting sample.
PER_CLASS, DICT_TEXTS, DICT_BYTES = 6000, 600, 8_000_000
THRESHOLD = 0.3
PIECE = 1 << 20


def dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; the texts themselves if they are too few to train."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:DICTIONARY] or b"\n" * 8


class Sizes:
    """Compressed sizes of a text under the two dictionaries, for one task."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.tools = []
        for raw in (good, bad):
            data = zstandard.ZstdCompressionDict(raw)
            data.precompute_compress(level=LEVEL)
            self.tools.append(zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> list[float]:
        """Length, size with the good and with the bad dictionary, in bytes."""
        raw = (text or "").encode("utf-8", "replace")
        if len(raw) <= PIECE:
            return [float(len(raw)), *(float(len(t.compress(raw))) for t in self.tools)]
        out = [float(len(raw))]
        for tool in self.tools:
            stream, size = tool.compressobj(), 0
            for at in range(0, len(raw), PIECE):
                size += len(stream.compress(raw[at : at + PIECE]))
            out.append(float(size + len(stream.flush())))
        return out


def features(sizes: np.ndarray) -> np.ndarray:
    """Normalised size differences, and the rates they come from."""
    n, good, bad = sizes[:, 0] + 1, sizes[:, 1], sizes[:, 2]
    return np.column_stack([(bad - good) / n, (bad - good) / np.maximum(good, bad), good / n, bad / n, 1 / np.sqrt(n)])


class Model:
    def __init__(self, good: bytes, bad: bytes, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, intercept: float):
        self.good, self.bad, self.mean, self.scale, self.weights, self.intercept = good, bad, mean, scale, weights, intercept

    def calibrated(self, sizes: list[list[float]]) -> list[float]:
        x = (features(np.array(sizes, float).reshape(-1, 3)) - self.mean) / self.scale
        return sigmoid(x @ self.weights + self.intercept).tolist()


def _sizes(rows: DataFrame, schema: str, keep: str, sent) -> DataFrame:
    def make():
        sizes = Sizes(sent.value.good, sent.value.bad)
        return lambda rows: {keep: rows[keep], "sizes": [sizes(t) for t in rows["text"]]}

    return map_texts(rows, schema, make, [keep, "text"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", allowed: Column | None = None, per_class: int = PER_CLASS) -> Model:
    """Learn ``labels.<label>`` from the labelled rows that ``allowed`` admits."""
    sample, counts = labelled_sample(docs, labels, label, F.lit(True) if allowed is None else allowed, per_class)
    half = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2))
    order = F.xxhash64("doc_id", F.lit(7))
    texts = {}
    for y in (1, 0):
        rows = sample.filter((half == 0) & (F.col("y") == y) & (F.octet_length("text").between(8, DICT_BYTES // 8)))
        got, size, texts[y] = rows.orderBy(order, "doc_id", "text").limit(DICT_TEXTS).select("text").toArrow().column(0).to_pylist(), 0, []
        for t in got:
            raw = t.encode("utf-8", "replace")
            size += len(raw)
            if size <= DICT_BYTES:
                texts[y].append(raw)
    rate = (counts.get(1, 0) + 0.5) / (counts.get(1, 0) + counts.get(0, 0) + 1)
    model = Model(dictionary(texts[1]), dictionary(texts[0]), np.zeros(5), np.ones(5), np.zeros(5), float(np.log(rate / (1 - rate))))
    sent = Sent(sample.sparkSession, model)
    got = _sizes(sample.filter(half == 1).select("y", "text"), "y int, sizes array<double>", "y", sent).toArrow()  # bounded by the sample
    y = got.column("y").to_numpy().astype(float)
    if len(y) and 0 < y.sum() < len(y) and texts[1] and texts[0]:
        x = features(np.array(got.column("sizes").to_pylist(), float))
        model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        model.weights, intercept = fit_logistic((x - model.mean) / model.scale, y, 1e-4, 1000)
        shift = np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum()))
        model.intercept = intercept + float(shift)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row's whole text."""
    sent = Sent(docs.sparkSession, model)

    def make():
        sizes = Sizes(sent.value.good, sent.value.bad)
        return lambda rows: {"doc_id": rows["doc_id"], "score": sent.value.calibrated([sizes(t) for t in rows["text"]])}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, f"doc_id {kind}, score double", make, ["doc_id", "text"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 5) == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows that aren't held out, score every row."""
    out = score(docs, fit(docs, labels, "quality", ~held_out(F.col("doc_id"))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
