"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Counts of the n-grams (1 to 3 characters, lower case) are summed by language
as ordinary Spark aggregates over a bounded sample of the labelled rows
(``per_language`` rows of each language at most, chosen by a hash of the id;
rarer languages keep all rows).  The smoothed log-probability matrix has one
row a bucket and one column a language -- its size is fixed by the vocabulary
of labels and ``2**BITS``, not by the data -- and is broadcast.  Documents are
scored in numpy: the sparse counts of a slice times the matrix.

Defined results: a null text, or one without a letter, gives ``und`` with
score 0; so does every text if there is no labelled row.  The score is the
posterior probability of the language.  Null ids are never learned from and
are not held out.  Repeated rows count as often as they occur.  Of the
input only the named columns are used, whatever others there are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Sent, class_sample, hashed_ngrams, map_texts, remainder, ship, slices

ship(__name__)

ORDERS, BITS, SMOOTH = (1, 2, 3), 16, 0.5
#: Bound of the fitting sample: rows of each language.
PER_LANGUAGE = 10_000
#: Languages whose counts a task holds at once; more are sent on and begun anew.
HELD = 48


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def sparse_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that occur, and how often."""
    total = np.zeros(1 << BITS, np.int64)
    for b in hashed_ngrams(text.lower(), ORDERS, BITS):
        total += np.bincount(b, minlength=1 << BITS)
    at = np.flatnonzero(total)
    return at, total[at]


def ngram_totals(rows: DataFrame) -> DataFrame:
    """``(lang, bucket, n)`` over rows of ``(lang, text)``: summed in each
    task first, then by Spark."""

    def count(batches):
        import pyarrow as pa

        held: dict[str, np.ndarray] = {}

        def sent():
            for lang, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], ["lang", "bucket", "n"])
            held.clear()

        for part in slices(batches):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if lang not in held and len(held) >= HELD:
                    yield from sent()
                n = held.setdefault(lang, np.zeros(1 << BITS, np.int64))
                for b in hashed_ngrams((text or "").lower(), ORDERS, BITS):
                    n += np.bincount(b, minlength=1 << BITS)
        yield from sent()

    counted = rows.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages, log priors and the matrix of log probabilities."""

    def __init__(self, languages: list[str], prior: np.ndarray, matrix: np.ndarray):
        self.languages, self.prior, self.matrix = languages, prior, matrix

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        rows = [i for i, t in enumerate(texts) if has_letter(t)]
        at = 0
        while at < len(rows):  # as many texts as make a product of bounded size
            group, size = [], 0
            while at < len(rows) and (not group or size < 2_000_000):
                b, n = sparse_counts(texts[rows[at]])
                group.append((rows[at], b, n))
                size += len(b) * len(self.languages)
                at += 1
            starts = np.cumsum([0, *(len(b) for _, b, _ in group[:-1])])
            buckets, counts = (np.concatenate([g[k] for g in group]) for k in (1, 2))
            z = np.add.reduceat(self.matrix[buckets] * counts[:, None], starts, axis=0) + self.prior
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            for (i, _, _), k, row in zip(group, p.argmax(axis=1), p, strict=True):
                names[i], scores[i] = self.languages[k], float(row[k])
        return names, scores


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Learn from all rows given with a non-null language (within the bound)."""
    labelled = rows.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sample, docs = class_sample(labelled.filter(F.col("lang").isNotNull()), "lang", F.col("doc_id"), per_language)
    languages = sorted(docs)
    if not languages:
        return Model([], np.zeros(0), np.zeros((1 << BITS, 0)))
    totals = ngram_totals(sample).toArrow()  # languages x buckets at most
    column = {lang: k for k, lang in enumerate(languages)}
    n = np.full((1 << BITS, len(languages)), SMOOTH)
    where = np.array([column[x] for x in totals.column("lang").to_pylist()], np.int64)
    n[totals.column("bucket").to_numpy(), where] += totals.column("n").to_numpy()
    prior = np.log(np.array([docs[x] for x in languages], float) / sum(docs.values()))
    return Model(languages, prior, np.log(n / n.sum(axis=0)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row."""
    sent = Sent(docs.sparkSession, model)

    def make():
        def work(rows):
            names, scores = sent.value.predict(rows["text"])
            return {"doc_id": rows["doc_id"], "lang_pred": names, "score": scores}

        return work

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(rows, f"doc_id {kind}, lang_pred string, score double", make, ["doc_id", "text"])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(remainder(doc_id, 4) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that aren't held out, predict every row."""
    learn = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    out = predict(docs, fit(learn))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
