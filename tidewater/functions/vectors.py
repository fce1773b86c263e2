"""Vector expressions: exact cosine and sign-random-projection band codes."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Functions of this module travel by value: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIGNS_AT_ONCE = 2_000_000


def cosine_of(a: Column, b: Column) -> Column:
    """Exact cosine of two equal-length numeric arrays (a JVM expression)."""

    def dot(x: Column, y: Column) -> Column:
        prods = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(prods, F.lit(0.0), lambda acc, t: acc + t)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def hyperplanes(dim: int, n: int, seed: int) -> np.ndarray:
    """``n`` random hyperplane normals in ``dim`` dimensions (seeded, so every
    task and every run draws the same ones)."""
    return np.random.default_rng(seed).standard_normal((dim, n))


def simhash_bands(x: np.ndarray, bands: int, bits: int, seed: int) -> np.ndarray:
    """Band codes of the rows of ``x``: for band ``j``, the ``bits`` signs of
    the projections on hyperplanes ``j*bits .. j*bits+bits-1`` read as an
    integer.  Two vectors at angle ``t`` agree on a bit with probability
    ``1 - t / pi``."""
    planes = hyperplanes(x.shape[1], bands * bits, seed)
    signs = (x @ planes) > 0
    weights = np.left_shift(1, np.arange(bits, dtype=np.int64))
    return signs.reshape(len(x), bands, bits).astype(np.int64) @ weights


def simhash_bands_udf(bands: int, bits: int, seed: int = 11):
    """``simhash_bands`` as an Arrow-batched pandas UDF over an array column:
    one matrix product per ``SIGNS_AT_ONCE`` signs."""

    @F.pandas_udf("array<long>")
    def _bands(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
        # many bands: a slice of rows at a time, so that its signs stay small
        step = max(1, SIGNS_AT_ONCE // (bands * bits))
        return pd.Series([c for i in range(0, len(x), step) for c in simhash_bands(x[i : i + step], bands, bits, seed)])

    return _bands


def sign_words_udf(n: int, seed: int):
    """A sketch of ``n`` longs, the signs of 64 projections each: two vectors
    at angle ``t`` agree on a bit with probability ``1 - t / pi``."""

    @F.pandas_udf("array<long>")
    def _sketch(vectors: pd.Series) -> pd.Series:
        if len(vectors) == 0:
            return pd.Series([], dtype=object)
        x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
        marks = np.packbits((x @ hyperplanes(x.shape[1], 64 * n, seed)) > 0, axis=1)
        return pd.Series(list(marks.view(np.int64)))

    return _sketch


def bits_alike(a: Column, b: Column, n: int) -> Column:
    """Bits in which two sketches of ``n`` longs agree."""
    apart = [F.bit_count(a[i].bitwiseXOR(b[i])) for i in range(n)]
    return F.lit(64 * n) - sum(apart[1:], apart[0])
