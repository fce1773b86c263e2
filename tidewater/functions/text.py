"""Column expressions for text: tokens, n-grams, MinHash signatures.

All of these are built-in SQL expressions (higher-order functions over
arrays), so they run inside whole-stage code generation with no Python
worker.  Whole texts are processed; nothing is truncated.
"""

from __future__ import annotations

import random
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.patterns import MERSENNE_31, TOKEN_SPLIT

# executors need not have this package: tasks carry the functions they call
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def tokens(text: str | Column) -> Column:
    """Lower-cased runs of letters and digits."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(c), TOKEN_SPLIT), lambda t: t != F.lit(""))


def minhash_coefficients(k: int, seed: int = 7) -> list[tuple[int, int]]:
    """``k`` universal-hash coefficient pairs (a, b) from a seeded generator."""
    rng = random.Random(seed)
    return [(rng.randrange(1, MERSENNE_31), rng.randrange(0, MERSENNE_31)) for _ in range(k)]


def minhash(hashes: str | Column, k: int, seed: int = 7) -> Column:
    """MinHash signature of length ``k``: for each (a, b), the minimum of
    ``(a * h + b) mod p`` over the shingle hashes (p = 2^31 - 1, so the
    product fits in a long)."""
    h = F.col(hashes) if isinstance(hashes, str) else hashes
    coeffs = F.array(
        *[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in minhash_coefficients(k, seed)]
    )
    return F.transform(
        coeffs,
        lambda c: F.array_min(F.transform(h, lambda x: (c["a"] * x + c["b"]) % F.lit(MERSENNE_31))),
    )


def jaccard(a: Column, b: Column) -> Column:
    """Exact Jaccard similarity of two arrays read as sets."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)).cast("double") / union.cast("double")).otherwise(
        F.lit(1.0)
    )


def with_ngrams(df, text: str, n: int, out: str, tokens_col: str | None = None):
    """Add ``out``: the word n-grams of ``text`` (``tokens`` rules), via the
    JVM ``RegexTokenizer`` and ``NGram`` transformers.

    Building n-grams with ``transform(sequence(...), slice(tokens(text)))``
    lets the optimizer inline the tokenizer into the lambda, re-splitting the
    whole text at every position; the transformers split once per text.
    """
    from pyspark.ml.feature import NGram, RegexTokenizer

    tok = tokens_col or f"_{out}_tokens"
    toks = RegexTokenizer(inputCol=text, outputCol=tok, pattern=TOKEN_SPLIT, gaps=True, toLowercase=True, minTokenLength=1)
    res = NGram(n=n, inputCol=tok, outputCol=out).transform(toks.transform(df))
    return res if tokens_col else res.drop(tok)


def minhash_udf(k: int, seed: int = 7):
    """The same signature as ``minhash`` as an Arrow-batched pandas UDF.

    Higher-order SQL functions are interpreted per element; for k = 128 that
    is ~1 microsecond per shingle and coefficient.  Here each batch's hashes
    are flattened once and every coefficient is one vectorised numpy pass
    (``np.minimum.reduceat`` per document)."""
    coeffs = minhash_coefficients(k, seed)
    a = np.array([c[0] for c in coeffs], dtype=np.int64)
    b = np.array([c[1] for c in coeffs], dtype=np.int64)

    @F.pandas_udf("array<long>")
    def _minhash(hashes: pd.Series) -> pd.Series:
        arrays = [np.asarray(h, dtype=np.int64) for h in hashes]
        lens = np.array([len(h) for h in arrays], dtype=np.int64)
        out = np.full((len(arrays), k), MERSENNE_31, dtype=np.int64)
        filled = lens > 0
        if filled.any():
            flat = np.concatenate([h for h in arrays if len(h)])
            starts = np.concatenate([[0], np.cumsum(lens[filled])[:-1]])
            for j in range(k):
                out[filled, j] = np.minimum.reduceat((a[j] * flat + b[j]) % MERSENNE_31, starts)
        return pd.Series(list(out))

    return _minhash


def mix64(x: np.ndarray) -> np.ndarray:
    """Bits of ``uint64`` values mixed one to one (xor-shift-multiply)."""
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(words: np.ndarray, lens: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts given by the hashes of their words, one text after the other:
    the distinct hashes of each text's runs of ``n`` words, ascending, and their
    numbers.  A text of fewer words is one run, an empty one too."""
    lens = lens.astype(np.int64)
    starts, count = np.cumsum(lens) - lens, np.maximum(lens - n + 1, 1)
    runs = np.full(max(len(words) - n + 1, 1), n, dtype=np.uint64)
    for k in range(n if len(words) >= n else 0):
        runs = mix64(runs ^ words[k : k + len(runs)])
    begin = np.cumsum(count) - count
    at = np.arange(count.sum()) + np.repeat(starts - begin, count)
    out = runs[np.minimum(at, len(runs) - 1)]
    for size in range(n):
        short = np.flatnonzero(lens == size)
        h = np.full(len(short), size, dtype=np.uint64)
        for k in range(size):
            h = mix64(h ^ words[starts[short] + k])
        out[begin[short]] = h
    for lo, many in zip(begin.tolist(), count.tolist()):
        if many > 1:
            out[lo : lo + many].sort()
    first = np.ones(len(out), dtype=bool)
    first[1:] = out[1:] != out[:-1]
    first[begin] = True
    return out[first], np.add.reduceat(first.astype(np.int64), begin) if len(begin) else count


def set_signatures(hashes: np.ndarray, lens: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """MinHash signatures, ``k`` lines of one value a set, of non-empty sets of
    well mixed ``uint64`` hashes given one after the other.

    A permutation is a product with an odd number modulo 2^64: one pass to
    multiply and one for the minimum, over pieces that stay in the cache
    (``minhash_udf`` needs a product, a sum and a remainder)."""
    rng, piece = random.Random(seed), 1 << 15
    odd = np.array([rng.getrandbits(64) | 1 for _ in range(k)], dtype=np.uint64)
    starts = np.cumsum(lens) - lens
    out = np.full((k, len(lens)), np.iinfo(np.uint64).max, dtype=np.uint64)
    buffer = np.empty(piece, dtype=np.uint64)
    for lo in range(0, len(hashes), piece):
        part = hashes[lo : lo + piece]
        product = buffer[: len(part)]
        a, b = np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, lo + len(part))
        cuts = np.maximum(starts[a:b] - lo, 0)  # the first set may have begun before
        for j in range(k):
            np.multiply(part, odd[j], out=product)
            least = out[j, a:b]
            np.minimum(least, np.minimum.reduceat(product, cuts), out=least)
    return out


def long_lists(values: np.ndarray, lens: np.ndarray):
    """Arrow lists of ``lens`` of the ``uint64`` values, as longs."""
    import pyarrow as pa

    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)).astype(np.int32)), pa.array(values.view(np.int64)))
