"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_dir, scratch_path

#: Texts are cut into overlapping segments of this many characters while their
#: n-grams are hashed, so one very long text needs no more memory than this.
SEGMENT = 1 << 20
#: Rows taken from an Arrow batch at a time by the text operators.
SLICE = 256
#: Bytes of an Arrow batch, where the session names no other bound: a batch is
#: held by the executor and by its Python worker, for every running task.
BATCH_BYTES = "16m"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(module: str) -> None:
    """Pickle the functions of ``module`` by value, so executors need not have
    this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


class Sent:
    """An object of this package broadcast to the tasks, again by value; each
    Python worker unpickles it once and keeps it for its next tasks."""

    def __init__(self, spark: SparkSession, value: object):
        self.cell = spark.sparkContext.broadcast({"raw": cloudpickle.dumps(value)})

    @property
    def value(self):
        import pickle

        cell = self.cell.value
        if "live" not in cell:
            cell["live"] = pickle.loads(cell["raw"])
        return cell["live"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table.  The path goes to Spark's reader only: it may lie in a
    store that nothing else can open."""
    checkpoint_dir(spark)
    if BATCH_CONF not in spark.conf.getAll:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Written:
    """A table written to the shared checkpoint folder: a stable result for
    every later reader and for retries after a lost executor."""

    def __init__(self, df: DataFrame, name: str, compression: str = "snappy", options: dict[str, str] | None = None):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.option("compression", compression).options(**(options or {})).parquet(self.path)
        self.df = self.spark.read.parquet(self.path)

    def delete(self) -> None:
        """Remove the files; only when nothing lazy reads them any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, or ``name`` with underscores, that no frame has (case-insensitively)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % m


#: Bits of a sieve: 8 MB when full, whatever the number of keys.
SIEVE_BITS = 26


def _sieve_place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << SIEVE_BITS)) + 1


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of hashed keys, in rows of 4 KB.  Its size has a fixed bound, so
    it may be broadcast; the fuller it is, the more rows it lets through."""
    place = _sieve_place(F.col(key))
    rows = keys.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("bit"))
    return rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def sieved(df: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: false for rows whose key is certainly not among
    the sieve's."""
    place, own = _sieve_place(F.col(key)), [fresh(c, df) for c in ("bucket", "bits")]
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col(own[1]), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = df.withColumn(own[0], F.bitmap_bucket_number(place)).join(F.broadcast(keys.toDF(*own)), own[0], "left")
    return joined.withColumn(flag, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop(*own)


def text_digest(text: Column) -> Column:
    """128 bits of a text (null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def slices(batches: Iterator, rows: int = SLICE) -> Iterator:
    """Arrow batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def hashed_ngrams(text: str, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers (below ``2**bits``) of every character n-gram of the
    orders; one array per order and segment."""
    longest = max(orders)
    for at in range(0, max(len(text), 1), SEGMENT):
        part = text[at : at + SEGMENT + longest - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        owned = min(SEGMENT, len(part))
        h = codes
        for n in range(1, longest + 1):
            if n > 1:
                if len(h) < 2:
                    break
                h = h[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
            if n in orders:
                own = h[:owned] + np.uint32((n * 0x9E3779B9) & 0xFFFFFFFF)
                own = (own ^ (own >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                own = (own ^ (own >> np.uint32(13))) * np.uint32(0xC2B2AE35)
                yield own >> np.uint32(32 - bits)


def class_sample(
    rows: DataFrame, label: str, key: Column, per_class: int
) -> tuple[DataFrame, dict]:
    """A bounded sample with about ``per_class`` rows of each label, chosen by
    a hash of ``key``; labels with fewer rows keep all.  Also the row count of
    every label.  The bound is for fitting only."""
    counts = {r[0]: r[1] for r in rows.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    keep = F.lit(False)
    draw = F.pmod(F.xxhash64(key, F.lit(20011)), F.lit(1 << 30))
    for value, n in counts.items():
        limit = int(min(1.0, per_class / n) * (1 << 30))
        keep = keep | ((F.col(label) == F.lit(value)) & (draw < limit))
    return rows.filter(keep), counts


def fit_logistic(
    x: np.ndarray, y: np.ndarray, l2: float, rounds: int = 300
) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge-penalised logistic regression by
    accelerated gradient steps; the caller bounds the rows and columns."""
    n, k = x.shape
    if n == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (n + 1.0)
        return np.zeros(k), float(np.log(rate / (1 - rate)))
    v = np.ones(k, x.dtype)
    for _ in range(20):  # largest eigenvalue of x'x
        v = x.T @ (x @ v)
        size = float(np.linalg.norm(v))
        v /= max(size, 1e-12)
    step = 1.0 / (0.25 * (size / n + 1.0) + l2)
    w = np.zeros(k + 1)
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        z = x @ ahead[:k].astype(x.dtype) + ahead[k]
        err = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        grad = np.append(x.T @ err.astype(x.dtype) / n + l2 * ahead[:k], err.mean())
        new = ahead - step * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:k], float(w[k])


def sigmoid(z: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def released(rows: Iterator) -> Iterator:
    """``rows``, after which the task's worker gives back the Arrow memory that
    it has no use for: it is kept for other stages."""
    import pyarrow as pa

    yield from rows
    pa.default_memory_pool().release_unused()


def map_texts(
    df: DataFrame, schema: str, make: Callable[[], Callable[[list], dict]], columns: list[str], rows: int = SLICE
) -> DataFrame:
    """Run a function over slices of ``columns`` in Arrow batches.  ``make`` is
    called once a task and gives the function: lists by column in, lists by
    column out."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        work = make()
        for part in slices(batches, rows):
            out = work({c: part.column(i).to_pylist() for i, c in enumerate(columns)})
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.select(*columns).mapInArrow(lambda batches: released(run(batches)), schema)


def map_flags(df: DataFrame, column: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows for which a function of one column's values is true, with all
    columns unchanged; rows don't move."""

    def run(batches):
        import pyarrow as pa

        flags, at = make(), names.index(column)
        for part in slices(batches):
            yield part.filter(pa.array(flags(part.column(at).to_pylist()), pa.bool_()))

    names = df.columns
    return df.mapInArrow(lambda batches: released(run(batches)), df.schema)
