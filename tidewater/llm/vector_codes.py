"""Vectors as short codes: an integer codebook a part, by dictionaries a
dimension.

A component x becomes the integer ``floor(1024 * x)``; vectors are cut into
four parts, and each part is replaced by the number of its nearest entry in
that part's codebook (squared distance, ties to the lower number).  Codebooks
start as the parts of the 256 smallest ids and are trained by rounds of
assigning all vectors and taking the floored means; unused entries stay.

Vectors are kept in blocks, dictionary-coded by dimension: the distinct
integers of a dimension in ascending order, and each vector's places in them.
For a block the squared differences of every distinct integer to that
dimension's component of all entries are tabulated once; the distances of all
the block's parts to all entries are then rows gathered from these tables by
the codes and added up, with no multiplication a vector.  Blocks are written
once to the shared folder and read in every round; a round sends a row an
entry and task to the sums, and only codebooks (256 vectors) to the driver.

All arithmetic is on integers, so results do not depend on order or layout:
32 or 64 bits where the largest difference allows it, Python's integers for
larger values.  Components beyond ``LARGEST`` count as that; an error beyond a
long is the largest long.

Vectors that are null or hold null or non-finite components take no part,
nor do those of another length than the vector of the smallest id.  A
length that four does not divide makes the first parts longer by one; empty
vectors have four empty parts, code 0 and error 0.  Null ids come last, tied
ids follow their vectors.  Repeated rows all count and all come back.  An
empty table gives no rows and empty codebooks.  Of the input only the named
columns are used.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Sent, Written, ship, slices

ship(__name__)

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Vectors of a block.
BLOCK = 1024
LARGEST = 1 << 60
LONG = (1 << 63) - 1
#: Labels whose sums may be broadcast; beyond it the join is salted.
BROADCAST_LABELS, SALTS = 100_000, 64


def cuts(length: int, parts: int = PARTS) -> list[int]:
    """Where parts begin and the last one ends."""
    size, more = divmod(length, parts)
    return [0, *np.cumsum([size + (i < more) for i in range(parts)]).tolist()]


def integers(x: np.ndarray) -> np.ndarray:
    """``floor(SCALE * x)``, exact: scaling by a power of two rounds nothing."""
    return np.floor(np.clip(x.astype(np.float64), -LARGEST / SCALE, LARGEST / SCALE) * SCALE).astype(np.int64)


def whole(vector: Column, kind: str) -> Column:
    """Whether a vector is there and all its components are finite (checks
    that need no lambda: a search in an array with nulls is null)."""
    nan, most = (F.lit(float(v)).cast(kind) for v in ("nan", "inf"))
    finite = F.coalesce((F.array_max(vector) < most) & (F.array_min(vector) > -most), F.lit(True))
    return F.coalesce(~F.array_contains(vector, nan) & finite, F.lit(False))


class Block:
    """Vectors by dictionaries: ``values`` a dimension, ``places`` in them."""

    def __init__(self, values: list[np.ndarray], places: np.ndarray):
        self.values, self.places = values, places

    @staticmethod
    def of(vectors: np.ndarray) -> Block:
        pairs = [np.unique(column, return_inverse=True) for column in vectors.T]
        places = np.stack([p for _, p in pairs]) if pairs else np.zeros((0, len(vectors)))
        return Block([v for v, _ in pairs], places.astype(np.uint16))

    def packed(self) -> tuple[list[int], bytes, bytes]:
        flat = np.concatenate([np.zeros(0, np.int64), *self.values])
        return [len(v) for v in self.values], flat.tobytes(), self.places.tobytes()

    @staticmethod
    def unpacked(sizes: list[int], flat: bytes, places: bytes, n: int) -> Block:
        values = np.split(np.frombuffer(flat, np.int64), np.cumsum(sizes)[:-1]) if sizes else []
        return Block(values, np.frombuffer(places, np.uint16).reshape(len(sizes), n))

    def component(self, d: int) -> np.ndarray:
        return self.values[d][self.places[d]]

    def nearest(self, entries: np.ndarray, first: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector's part that begins at dimension ``first`` the number
        of the nearest entry (rows of an object array) and its distance."""
        width = entries.shape[1]
        own = self.values[first : first + width]
        most = max([1, *(int(np.abs(v).max()) for v in own), *(abs(int(e)) for e in entries.flat)])
        bound = width * (2 * most) ** 2
        kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object
        best, least = np.zeros(n, np.int64), np.zeros(n, kind)
        if not width:
            return best, least
        tables = [(v.astype(kind)[:, None] - entries[:, k].astype(kind)[None, :]) ** 2 for k, v in enumerate(own)]
        step = 512  # the sums of so many vectors stay in the cache
        for at in range(0, n, step):
            total = tables[0][self.places[first, at : at + step]]
            for k in range(1, width):
                total += tables[k][self.places[first + k, at : at + step]]
            best[at : at + step] = total.argmin(axis=1)
            least[at : at + step] = total.min(axis=1)
        return best, least


class Codebooks:
    """Entries (Python integers) a part."""

    def __init__(self, entries: list[np.ndarray]):
        self.entries = entries
        self.starts = [0, *np.cumsum([e.shape[1] for e in entries]).tolist()]

    @property
    def length(self) -> int:
        return self.starts[-1]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for e in self.entries for x in e.flat).encode()).hexdigest()

    def vector(self, code: bytes) -> np.ndarray:
        """What a code stands for."""
        return np.concatenate([e[c] for e, c in zip(self.entries, code, strict=True)]).astype(np.float64) / SCALE


def _firsts(rows: DataFrame, entries: int) -> list[np.ndarray]:
    """The vectors of the smallest ids, at most ``entries`` of them, all of
    the first one's length."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    found = rows.orderBy(*order).limit(entries).collect()
    if len({len(r["vector"]) for r in found}) > 1:
        found = rows.filter(F.size("vector") == len(found[0]["vector"])).orderBy(*order).limit(entries).collect()
    return [integers(np.array(r["vector"], np.float64)) for r in found]


def _blocks(rows: DataFrame, length: int, id_kind: str, label_kind: str) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for part in slices(batches, BLOCK):
            flat = part.column(2).flatten().to_numpy(zero_copy_only=False)
            block = Block.of(integers(flat.reshape(part.num_rows, length)))
            sizes, values, places = block.packed()
            lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(i)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*lists, pa.array([part.num_rows], pa.int32()), pa.array([sizes], pa.list_(pa.int32())), pa.array([values], pa.binary()), pa.array([places], pa.binary())],
                ["ids", "labels", "n", "sizes", "values", "places"],
            )

    return rows.filter(F.size("vector") == length).mapInArrow(run, f"ids array<{id_kind}>, labels array<{label_kind}>, n int, sizes array<int>, values binary, places binary")


def _opened(batches, columns: int = 0):
    """``(leading columns, block, n)`` of written blocks."""
    for part in batches:
        for k in range(part.num_rows):
            lead = [part.column(i)[k].values for i in range(columns)]
            n, sizes, values, places = (part.column(columns + i)[k].as_py() for i in range(4))
            yield lead, Block.unpacked(sizes, values, places, n), n


def _sums(blocks: DataFrame, sent: Sent) -> DataFrame:
    """``(part, entry, place, n, hi, lo)``: the number of parts assigned to an
    entry, and the sum of their components as ``hi * 2**32 + lo``."""

    def run(batches):
        import pyarrow as pa

        books = sent.value
        shape = [e.shape for e in books.entries]
        count = [np.zeros(m, np.int64) for m, _ in shape]
        hi, lo = ([np.zeros((w, m), np.int64) for m, w in shape] for _ in range(2))
        for _, block, n in _opened(batches):
            for p, entries in enumerate(books.entries):
                best, _ = block.nearest(entries, books.starts[p], n)
                m = len(entries)
                count[p] += np.bincount(best, minlength=m)
                for k in range(entries.shape[1]):
                    x = block.component(books.starts[p] + k)
                    # halves of a component: their sums over a block are exact
                    for half, into in ((x >> 32, hi), (x & 0xFFFFFFFF, lo)):
                        if half.any():
                            into[p][k] += np.bincount(best, weights=half, minlength=m).astype(np.int64)
        for p, (_, w) in enumerate(shape):
            used = np.flatnonzero(count[p])
            if len(used) and w:
                columns = [np.full(len(used) * w, p), np.repeat(used, w), np.tile(np.arange(w), len(used)), np.repeat(count[p][used], w), hi[p][:, used].T.ravel(), lo[p][:, used].T.ravel()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32()] * 3 + [pa.int64()] * 3, strict=True)], ["part", "entry", "place", "n", "hi", "lo"])

    rows = blocks.select("n", "sizes", "values", "places").mapInArrow(run, "part int, entry int, place int, n long, hi long, lo long")
    return rows.groupBy("part", "entry", "place").agg(*[F.sum(c).alias(c) for c in ("n", "hi", "lo")])


class Coded:
    """Trained codebooks and the blocks that they were trained on."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", entries: int = ENTRIES, rounds: int = ROUNDS):
        self.spark = vectors.sparkSession
        kinds = {f.name: f.dataType for f in vectors.schema}
        self.id_kind, self.label_kind = kinds[id_col].simpleString(), kinds[label_col].simpleString()
        kind = kinds[vector_col].elementType.simpleString()
        rows = vectors.filter(whole(F.col(vector_col), kind))
        rows = rows.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
        firsts = _firsts(rows, entries)
        length = len(firsts[0]) if firsts else 0
        start = np.array(firsts, object).reshape(len(firsts), length)
        self.books = Codebooks([start[:, a:b] for a, b in pairwise(cuts(length))])
        self.blocks = Written(_blocks(rows, length, self.id_kind, self.label_kind), "vector-blocks").df
        for _ in range(rounds if length else 0):
            self._train()

    def _train(self) -> None:
        entries = [e.copy() for e in self.books.entries]
        for r in _sums(self.blocks, Sent(self.spark, self.books)).collect():  # a codebook's size
            entries[r["part"]][r["entry"], r["place"]] = ((r["hi"] << 32) + r["lo"]) // r["n"]
        self.books = Codebooks(entries)

    def codes(self) -> DataFrame:
        """``(vec_id, label, code, error)``: a byte a part, and the squared
        distances summed."""
        sent = Sent(self.spark, self.books)

        def run(batches):
            import pyarrow as pa

            books = sent.value
            for (ids, labels), block, n in _opened(batches, 2):
                code, error = np.zeros((n, len(books.entries)), np.uint8), 0
                for p, entries in enumerate(books.entries):
                    best, least = block.nearest(entries, books.starts[p], n)
                    code[:, p] = best
                    error = error + least.astype(object if least.dtype == object else np.int64)
                if error.dtype == object or (error < 0).any():
                    error = np.minimum(error.astype(object), LONG)
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error.tolist(), pa.int64())], ["vec_id", "label", "code", "error"])

        return self.blocks.select("ids", "labels", "n", "sizes", "values", "places").mapInArrow(run, f"vec_id {self.id_kind}, label {self.label_kind}, code binary, error long")


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the errors summed over equal labels."""
    sums = codes.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG)).cast("long").alias("label_error"))
    sums = Written(sums, "label-errors").df.withColumnRenamed("label", "of_label")
    same = F.col("label").eqNullSafe(F.col("of_label"))
    if sums.count() <= BROADCAST_LABELS:
        return codes.join(F.broadcast(sums), same).drop("of_label")
    salted = sums.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, same & (F.col("salt") == F.col("of_salt"))).drop("of_label", "of_salt", "salt")


def compress(vectors: DataFrame) -> DataFrame:
    """What ``op11`` returns."""
    coded = Coded(vectors)
    out = with_label_errors(Written(coded.codes(), "vector-codes").df)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(coded.books.sha256()).alias("codebooks_sha256"))
