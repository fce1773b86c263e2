"""Training-order materialisation of token ids.

Documents are encoded (in the tasks; a word that a worker has not met before
goes to the sentencepiece library, a batch at a time, and its ids are
remembered), cut into sequences of ``stride`` ids, and every sequence gets a global slot: its index goes through a keyed Feistel
permutation of the next larger power of four, walked on until it falls below
the number of sequences (cycle-walking), which is a permutation of
0 .. n-1 without any sort or state.  Sequences are range-partitioned by slot
and written as shards of ``per_shard`` slots: a row per shard, whose payload
holds the records at a fixed stride, so slot s begins at byte
``(s % per_shard) * stride * width`` of shard ``s // per_shard`` and reading
can go on from any slot (``read_from``).

The index of a sequence is the number of sequences before it in the table of
encoded documents, which is written once to the shared folder: the only thing
gathered is a row a partition.  Retries and later reads see the same order;
the order itself follows from the input's layout and the seed.

A null text counts as empty; empty texts are one sequence of begin and end.
Long texts are cut like others.  Records shorter than the stride are filled
with the pad id; ``n_tokens`` tells how many ids count.  Repeated rows get
slots of their own; null ids stay null.  An empty table writes no shard.
"""

from __future__ import annotations

from array import array

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import Sent, Written, ship, slices
from tidewater.llm.piece_bpe import ROWS, Packer, Vocabulary
from tidewater.session import scratch_path

ship(__name__)

STRIDE, PER_SHARD, SEED, PAD, ROUNDS = 512, 1024, 2024, 0, 6


def feistel(index: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The slots of indices below ``n``: a keyed permutation of 0 .. n-1."""
    index = np.asarray(index, np.uint64)
    if n <= 1:
        return index.astype(np.int64)
    half = np.uint64(max(1, ((n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = np.random.default_rng(seed).integers(0, 2**63, ROUNDS).astype(np.uint64)

    def once(x):
        left, right = x >> half, x & mask
        for key in keys:
            f = (right ^ key) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & mask)
        return left << half | right

    out = once(index)
    while (outside := np.flatnonzero(out >= np.uint64(n))).size:
        out[outside] = once(out[outside])
    return out.astype(np.int64)


class Encoder:
    """Encodes texts with the library: word by word if the vocabulary allows it
    (words are remembered), else whole."""

    def __init__(self, model: str):
        with open(model, "rb") as file:
            self.model = file.read()
        import sentencepiece

        self.kind = "H" if sentencepiece.SentencePieceProcessor(model_proto=self.model).get_piece_size() <= 1 << 16 else "I"
        try:
            self.vocabulary = Vocabulary(model)
        except ValueError:
            self.vocabulary = None
        self.live = None

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if self.live is None:  # once a worker
            import sentencepiece

            lib, kind = sentencepiece.SentencePieceProcessor(model_proto=self.model), self.kind

            def packed(words, **ends):
                return [array(kind, ids).tobytes() for ids in lib.encode(words, num_threads=1, **ends)]

            if self.vocabulary:
                self.live = Packer(self.vocabulary, kind, packed).encode_all
            else:
                self.live = lambda rows: packed([t or "" for t in rows], add_bos=True, add_eos=True)
        return self.live(texts)


def _encoded(docs: DataFrame, sent: Sent, kind: str, stride: int, width: int) -> DataFrame:
    """A row a document, with the number of sequences before it in its task."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        pid, before = TaskContext.get().partitionId(), 0
        for part in slices(batches, ROWS):
            ids, n, first = sent.value(part.column(1).to_pylist()), [], []
            for own in ids:
                n.append(len(own) // width)
                first.append(before)
                before += -(-n[-1] // stride)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.binary()), pa.array(n, pa.int32()), pa.array([pid] * len(n), pa.int32()), pa.array(first, pa.int64())], ["doc_id", "ids", "n", "pid", "first"]
            )

    return docs.mapInArrow(run, f"doc_id {kind}, ids binary, n int, pid int, first long")


def _sequences(placed: DataFrame, total: int, stride: int, width: int, per_shard: int, seed: int, kind: str) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for part in slices(batches, 64):
            doc, piece, size, index, data = [], [], [], [], []
            for d, raw, n, start in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                for k in range(-(-n // stride)):
                    doc.append(d)
                    piece.append(k)
                    index.append(start + k)
                    data.append(raw[k * stride * width : (k + 1) * stride * width])
                    size.append(len(data[-1]) // width)
            slot = feistel(np.array(index, np.int64), total, seed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot // per_shard), pa.array(slot), pa.array(doc, part.schema.field(0).type), pa.array(piece, pa.int32()), pa.array(size, pa.int32()), pa.array(data, pa.binary())],
                ["shard", "slot", "doc_id", "part", "n_tokens", "data"],
            )

    return placed.mapInArrow(run, f"shard long, slot long, doc_id {kind}, part int, n_tokens int, data binary")


def _shards(ordered: DataFrame, stride: int, width: int, pad: bytes, kind: str) -> DataFrame:
    """Rows in slot order to a row a shard."""

    def run(batches):
        import pyarrow as pa

        held: list[tuple] = []

        def shard():
            shards, slots, docs, parts, sizes, data = zip(*held, strict=True)
            payload = b"".join(x + pad * (stride - n) for x, n in zip(data, sizes, strict=True))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([shards[0]]), pa.array([slots[0]]), pa.array([list(docs)], pa.list_(doc_type)), pa.array([list(parts)], pa.list_(pa.int32())), pa.array([list(sizes)], pa.list_(pa.int32())), pa.array([payload], pa.binary())],
                ["shard", "first_slot", "doc_ids", "parts", "n_tokens", "payload"],
            )

        doc_type = pa.int64()
        for part in slices(batches):
            doc_type = part.schema.field(2).type
            for row in zip(*(part.column(i).to_pylist() for i in range(6)), strict=True):
                if held and held[0][0] != row[0]:
                    yield shard()
                held.append(row)
        if held:
            yield shard()

    return ordered.mapInArrow(run, f"shard long, first_slot long, doc_ids array<{kind}>, parts array<int>, n_tokens array<int>, payload binary")


class Shards:
    """A written training order."""

    def __init__(self, spark: SparkSession, path: str, total: int, stride: int, width: int, per_shard: int):
        self.spark, self.path, self.total, self.stride, self.width, self.per_shard = spark, path, total, stride, width, per_shard

    @property
    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read_from(self, slot: int) -> DataFrame:
        """``(slot, doc_id, part, n_tokens, tokens)`` in order from a slot on;
        shards before it are not read."""
        size = self.stride * self.width
        rows = self.table.filter(F.col("shard") >= slot // self.per_shard).select(
            "first_slot", F.posexplode(F.arrays_zip("doc_ids", "parts", "n_tokens", F.transform(F.sequence(F.lit(0), F.size("doc_ids") - 1), lambda i: F.substring("payload", i * size + 1, F.lit(size))).alias("tokens"))).alias("at", "r")
        )
        out = rows.select((F.col("first_slot") + F.col("at")).alias("slot"), F.col("r.doc_ids").alias("doc_id"), F.col("r.parts").alias("part"), "r.n_tokens", F.expr(f"substring(r.tokens, 1, r.n_tokens * {self.width})").alias("tokens"))
        return out.filter(F.col("slot") >= slot).orderBy("slot")

    def index(self) -> DataFrame:
        """A row a sequence: where it is, and the SHA-256 of its ids as they
        were written."""
        stride, width, per_shard = self.stride, self.width, self.per_shard

        def run(batches):
            import hashlib

            import pyarrow as pa

            for part in slices(batches, 4):
                for k in range(part.num_rows):
                    shard, slot, docs, parts, sizes = (part.column(i)[k].as_py() for i in range(5))
                    payload = part.column(5)[k].as_buffer()
                    n = len(docs)
                    digest = [hashlib.sha256(payload[i * stride * width : (i * stride + m) * width]).hexdigest() for i, m in enumerate(sizes)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs, part.schema.field(2).type.value_type), pa.array(parts, pa.int32()), pa.array(range(slot, slot + n), pa.int64()), pa.array([shard] * n, pa.int64()), pa.array(range(slot - shard * per_shard, slot - shard * per_shard + n), pa.int32()), pa.array(sizes, pa.int32()), pa.array(digest)],
                        ["doc_id", "part", "slot", "shard", "record", "n_tokens", "tokens_sha256"],
                    )

        rows = self.table.select("shard", "first_slot", "doc_ids", "parts", "n_tokens", "payload")
        kind = rows.schema["doc_ids"].dataType.elementType.simpleString()
        return rows.mapInArrow(run, f"doc_id {kind}, part int, slot long, shard long, record int, n_tokens int, tokens_sha256 string")


def materialise(docs: DataFrame, model: str, stride: int = STRIDE, per_shard: int = PER_SHARD, seed: int = SEED) -> Shards:
    """Encode, permute and write all documents (columns doc_id and text)."""
    spark = docs.sparkSession
    encoder = Encoder(model)
    width = array(encoder.kind).itemsize
    kind = docs.schema["doc_id"].dataType.simpleString()
    tokens = Written(_encoded(docs.select("doc_id", "text"), Sent(spark, encoder), kind, stride, width), "tokens", "zstd")
    sums = tokens.df.groupBy("pid").agg(F.sum(F.ceil(F.col("n") / stride)).alias("m"))
    # a row a partition of the scan, however much each holds
    offsets = sums.select("pid", F.coalesce(F.sum("m").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("offset"))
    total = int(sums.agg(F.sum("m")).first()[0] or 0)
    placed = tokens.df.join(F.broadcast(offsets), "pid").select("doc_id", "ids", "n", (F.col("offset") + F.col("first")).alias("start"))
    sequences = _sequences(placed, total, stride, width, per_shard, seed, kind)
    ordered = sequences.repartitionByRange("shard").sortWithinPartitions("shard", "slot")
    path = scratch_path(spark, "training-order")
    pad = PAD.to_bytes(width, "little")
    _shards(ordered, stride, width, pad, kind).write.option("compression", "zstd").parquet(path)
    tokens.delete()
    return Shards(spark, path, total, stride, width, per_shard)
