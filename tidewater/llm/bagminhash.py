"""Near-duplicate documents by BagMinHash signatures.

A document is the multiset of its word five-grams (fewer words: one shingle
of them all; words are runs of non-blanks, lower case).  The similarity is
the weighted Jaccard one, sum of minima over sum of maxima of the counts.

Signature.  Every shingle has a Poisson process over its count axis, cut into
levels 1, 2, 3-4, 5-8, ...; each level is split in halves down to single
counts only while a count cuts through it, so a shingle that occurs w times
costs log w draws a point, not w.  A point has a time and a component; the
component keeps the earliest point of all shingles within their counts.  Two
signatures agree in a component with probability equal to the similarity.
Points are made up to a time by which all components are usually met; where
one is not, the time is doubled.  Documents are signed in flat arrays, cut by
shingles and not by rows, so memory does not follow the texts' length.

Candidates share a band of ``ROWS`` components.  The smallest document (by a
hash) of each bucket links to the others -- stars, not pairs -- and the
connected candidates form regions.  Within a region the multiset overlap is
checked exactly, in blocks of matrix products: regions of one block wholly;
larger ones first against one pivot block, then every document that the
pivots did not bring into the region's main class against all blocks.  Pairs
within that class need no check, they are connected; all others are compared,
so no link between different texts of a region is lost, and no pair leaves a
task.  Classes are the components of the verified links.

Equal word sequences are collapsed before, so groups of copies are one
document.  A null text counts as empty; all empty texts are one class.  A
null id takes part under a number made from its text.  An id may have several
texts: each is a document, and a class whose smallest id names another class's
text too (of smaller digest) is numbered from its own text.  Long texts have
more shingles, nothing is cut.  Of the input only the named columns are used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import Written, fresh, released, ship, sieve, sieved, slices
from tidewater.operators.graph import connected_components

ship(__name__)

SHINGLE, SIMILAR, COMPONENTS, ROWS = 5, 0.8, 128, 4
#: Documents of a block, and shingles of a block at most (by average).
BLOCK, BLOCK_SHINGLES = 256, 400_000
#: Shingles that are signed together (one longer text alone), and at a time;
#: characters of a text that are cut into words at a time.
SIGNED, STEP, CHARACTERS = 200_000, 100_000, 1 << 20
#: Candidates whose signatures agree in a smaller part are dropped: more than
#: five standard deviations below the similarity asked for.
SKETCH = 0.62
BLANKS = r"[\x20\x09-\x0D]+"


def normal(text: Column) -> Column:
    """Lower case, words apart by one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), BLANKS, " "))


def digest(text: Column) -> Column:
    """128 bits of a text's words."""
    return F.unhex(F.md5(normal(text)))


def words(normal_text: str) -> list[str]:
    return normal_text.split(" ") if normal_text else []


def pieces(normal_text: str):
    """The words in lists of about ``CHARACTERS``."""
    at = 0
    while at < len(normal_text):
        cut = normal_text.find(" ", at + CHARACTERS)
        cut = len(normal_text) if cut < 0 else cut
        yield words(normal_text[at:cut])
        at = cut + 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53


class Hasher:
    """64-bit hashes of words, remembered (bounded) by a worker."""

    def __init__(self, most: int = 150_000):
        self.known, self.most = {}, most

    def __call__(self, ws: list[str]) -> np.ndarray:
        import xxhash

        known, out = self.known, []
        for w in ws:
            h = known.get(w)
            if h is None:
                if len(known) >= self.most:
                    known.clear()
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, np.uint64)


def shingles(ws: list[str], hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their counts."""
    return _shingled(hasher(ws))


def text_shingles(normal_text: str, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of a text's words, of which few are in a list at a time."""
    return _shingled(np.concatenate([np.zeros(0, np.uint64), *map(hasher, pieces(normal_text))]))


def _shingled(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = min(SHINGLE, len(h))
    out = np.zeros(len(h) - size + 1 if size else 1, np.uint64)
    for k in range(size):
        out = _mix((out + h[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size))
    return np.unique(out, return_counts=True)


def _points(key: np.ndarray, doc: np.ndarray, weight: np.ndarray, limit: np.ndarray, best: np.ndarray, time: np.ndarray) -> None:
    """Adds every point before ``limit`` of each document to the signatures.

    A level is (low, high] with a process of rate high - low.  Points of a
    level that the count passes in full count at once; in the one level that
    a count cuts, a point's half is drawn again and again until it is clearly
    within or beyond the count."""
    m = best.shape[1]
    low, high = np.zeros(len(key)), np.ones(len(key))
    level = 0
    while len(key):
        rate = high - low
        state = _mix(key + np.uint64((0xA0761D6478BD642F * (level + 1)) & (2**64 - 1)))
        at = np.arange(len(key))
        now = np.zeros(len(key))
        while len(at):
            state = _mix(state + np.uint64(0x9E3779B97F4A7C15))
            now = now - np.log(_uniform(state)) / rate[at]
            keep = now <= limit[doc[at]]
            at, state, now = at[keep], state[keep], now[keep]
            if not len(at):
                break
            point = _mix(state ^ np.uint64(0xE7037ED1A0B428DB))
            ok = weight[at] >= high[at]
            cut = np.flatnonzero(~ok)
            if len(cut):
                lo, hi, w, s = low[at[cut]].copy(), high[at[cut]].copy(), weight[at[cut]], point[cut]
                unclear = np.ones(len(cut), bool)
                while unclear.any():
                    s = _mix(s + np.uint64(0x8EBC6AF09C88C6E3))
                    middle = (lo + hi) / 2
                    up = (s >> np.uint64(63)).astype(bool)
                    lo, hi = np.where(unclear & up, middle, lo), np.where(unclear & ~up, middle, hi)
                    unclear &= ~((hi <= w) | (lo >= w))
                ok[cut] = hi <= w
            cell = doc[at[ok]] * m + (point[ok] % np.uint64(m)).astype(np.int64)
            t, p = now[ok], point[ok]
            np.minimum.at(time.reshape(-1), cell, t)
            won = t == time.flat[cell]
            best.flat[cell[won]] = p[won]
        more = weight > high
        key, doc, weight, high = key[more], doc[more], weight[more], high[more]
        low, high = high, high * 2
        level += 1


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = COMPONENTS) -> np.ndarray:
    """One row of ``m`` 64-bit components for each (hashes, counts)."""
    total = np.array([float(c.sum()) for _, c in bags])
    sizes = np.array([len(h) for h, _ in bags])
    key, weight = np.concatenate([h for h, _ in bags]), np.concatenate([c for _, c in bags]).astype(float)
    doc = np.repeat(np.arange(len(bags)), sizes)
    best, time = np.zeros((len(bags), m), np.uint64), np.full((len(bags), m), np.inf)
    limit = m * (np.log(m) + 3) / total
    open_ = np.ones(len(bags), bool)
    while open_.any():
        own = np.flatnonzero(open_[doc])
        for at in range(0, len(own), STEP):
            some = own[at : at + STEP]
            _points(key[some], doc[some], weight[some], limit, best, time)
        open_ = ~np.isfinite(time).all(axis=1)
        limit = limit * 2
        best[open_], time[open_] = 0, np.inf
    return best


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit bucket for each band."""
    n, m = signature.shape
    parts = signature.reshape(n, m // rows, rows)
    out = np.broadcast_to(np.arange(m // rows, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93), (n, m // rows)).copy()
    for k in range(rows):
        out = _mix((out ^ parts[:, :, k]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return out.view(np.int64)


def signed_rows(part, hasher: Hasher):
    """Arrow batches ``(doc_id, same, n, bands, sketch)`` for one of ``(doc_id,
    same, normal text)``, cut by the texts' shingles."""
    import pyarrow as pa

    def signed(rows, bags):
        signature = signatures(bags)
        keys = band_keys(signature)
        n = [int(c.sum()) for _, c in bags]
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.ravel()))
        sketch = (signature >> np.uint64(40)).astype(np.uint8)
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(n, pa.int64()), bands, pa.array([r.tobytes() for r in sketch], pa.binary())], ["doc_id", "same", "n", "bands", "sketch"])

    first, bags, total = 0, [], 0
    for k in range(part.num_rows):
        bags.append(text_shingles(part.column(2)[k].as_py(), hasher))
        total += len(bags[-1][0])
        if total >= SIGNED or k + 1 == part.num_rows:
            yield signed(part.slice(first, len(bags)), bags)
            first, bags, total = k + 1, [], 0


def _signed(docs: DataFrame) -> DataFrame:
    """``(doc_id, same, n, bands, sketch)``; ``same`` is 128 bits of the
    words, ``sketch`` eight bits of every component."""

    def run(batches):
        hasher = Hasher()
        for part in slices(batches, 384):
            yield from signed_rows(part, hasher)

    def released_run(batches):
        return released(run(batches))

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", digest(F.col("text")).alias("same"), normal(F.col("text")).alias("text"))
    return rows.mapInArrow(released_run, f"doc_id {kind}, same binary, n long, bands array<long>, sketch binary")


def _agreeing(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """``(node, head, near)`` for different pairs ``(node, head)``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array((a == b).mean(axis=1) >= SKETCH)], ["node", "head", "near"])

    other = sketches.select(F.col("node").alias("head"), F.col("sketch").alias("head_sketch"))
    return pairs.distinct().join(sketches, "node").join(other, "head").select("node", "head", "sketch", "head_sketch").mapInArrow(run, "node long, head long, near boolean")


def candidates(texts: DataFrame) -> DataFrame:
    """``(node, head)`` edges from ``(node, bands, sketch)``: in every bucket
    the first document by a hash (one of four orders) against the others;
    those that it is not near to once more among themselves."""
    sketches = texts.select("node", "sketch")
    banded = texts.select("node", F.posexplode("bands").alias("band", "bucket")).select("node", "bucket", F.pmod("band", F.lit(4)).alias("turn"))
    order = F.struct(F.xxhash64("node", "turn"), "node")

    def stars(rows: DataFrame) -> DataFrame:
        heads = rows.groupBy("bucket").agg(F.min(order).getField("node").alias("head"), F.count(F.lit(1)).alias("m")).filter("m > 1")
        return rows.join(heads.select("bucket", "head"), "bucket").filter(F.col("node") != F.col("head"))

    first = Written(stars(banded), "dedup-stars").df
    judged = Written(_agreeing(first.select("node", "head"), sketches), "dedup-judged").df
    again = stars(first.join(judged.filter("not near"), ["node", "head"]).select("node", "bucket", "turn"))
    second = _agreeing(again.select("node", "head"), sketches)
    return judged.unionByName(second).filter("near").select("node", "head")


class Bags:
    """Multisets as sets of (shingle, k-th occurrence): overlaps of multisets
    are overlaps of these sets."""

    def __init__(self, ids: np.ndarray, parts: list[np.ndarray]):
        self.ids = ids
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def only(self, keep: np.ndarray) -> Bags:
        out = Bags.__new__(Bags)
        out.ids, out.sizes, out.flat = self.ids[keep], self.sizes[keep], self.flat[np.repeat(keep, self.sizes)]
        return out

    def packed(self) -> tuple[list[int], bytes, bytes]:
        return self.ids.tolist(), self.sizes.tobytes(), self.flat.tobytes()

    @staticmethod
    def unpacked(ids: list[int], sizes: bytes, flat: bytes) -> Bags:
        out = Bags.__new__(Bags)
        out.ids, out.sizes, out.flat = np.array(ids, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(flat, np.uint64)
        return out


def occurrences(text: str, hasher: Hasher) -> np.ndarray:
    """One 64-bit number for each k-th occurrence of a shingle."""
    h, c = text_shingles(text, hasher)
    if c.max() == 1:
        return h
    k = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c)
    h = np.repeat(h, c)
    return np.where(k == 0, h, _mix(h + k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def similar(a: Bags, b: Bags, least: float) -> np.ndarray:
    """Which documents of two blocks are at least that similar."""
    both = np.zeros((len(a.ids), len(b.ids)), np.float32)
    common = np.intersect1d(a.flat, b.flat)
    rows = []
    for bags in (a, b):
        at = np.searchsorted(common, bags.flat)
        at[at == len(common)] = 0
        hit = common[at] == bags.flat if len(common) else np.zeros(len(bags.flat), bool)
        doc, col = np.repeat(np.arange(len(bags.ids)), bags.sizes)[hit], at[hit]
        order = np.argsort(col, kind="stable")
        rows.append((doc[order], col[order]))
    for start in range(0, len(common), 4096):
        ms = []
        for (doc, col), n in zip(rows, both.shape, strict=True):
            lo, hi = np.searchsorted(col, [start, start + 4096])
            m = np.zeros((n, min(4096, len(common) - start)), np.float32)
            m[doc[lo:hi], col[lo:hi] - start] = 1
            ms.append(m)
        both += ms[0] @ ms[1].T
    union = a.sizes[:, None] + b.sizes[None, :] - both
    return both >= least * union - 1e-6


def _forest(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a symmetric link matrix links."""
    n = len(ids)
    own = np.arange(n)
    while True:
        least = np.minimum(own, np.where(linked, own[None, :], n).min(axis=1))
        least = least[least]
        if (least == own).all():
            break
        own = least
    child = np.flatnonzero(own != np.arange(n))
    return ids[child], ids[own[child]]


def _cross(a: Bags, b: Bags, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked between two blocks."""
    hit = similar(a, b, least)
    n, m = hit.shape
    linked = np.zeros((n + m, n + m), bool)
    linked[:n, n:], linked[n:, :n] = hit, hit.T
    return _forest(np.concatenate([a.ids, b.ids]), linked)


def _edges(pairs):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["src", "dst"])


def _small_regions(rows: DataFrame, least: float) -> DataFrame:
    """Links within regions of one block; rows come sorted by region."""

    def run(batches):
        hasher, region, ids, parts = Hasher(), None, [], []

        def done():
            bags = Bags(np.array(ids, np.int64), parts)
            return _edges(_forest(bags.ids, similar(bags, bags, least)))

        for part in slices(batches, 64):
            for r, node, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                if r != region and ids:
                    yield done()
                    ids, parts = [], []
                region = r
                ids.append(node)
                parts.append(occurrences(text, hasher))
        if ids:
            yield done()

    return rows.select("region", "node", "text").mapInArrow(run, "src long, dst long")


def _blocks(rows: DataFrame) -> DataFrame:
    def pack(pdf):
        import pandas as pd

        hasher = Hasher()
        bags = Bags(pdf["node"].to_numpy(np.int64), [occurrences(t, hasher) for t in pdf["text"]])
        return pd.DataFrame([[int(pdf["region"].iloc[0]), int(pdf["block"].iloc[0]), *bags.packed()]], columns=["region", "block", "ids", "sizes", "flat"])

    return rows.groupBy("region", "block").applyInPandas(pack, "region long, block long, ids array<long>, sizes binary, flat binary")


def _pair_edges(pairs: DataFrame, least: float) -> DataFrame:
    """Links between two blocks a row; ``only`` (null: all) are the documents
    of the first to compare."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                a = Bags.unpacked(r["a_ids"], r["a_sizes"], r["a_flat"])
                if r["only"] is not None:
                    a = a.only(np.isin(a.ids, np.array(r["only"], np.int64)))
                yield _edges(_cross(a, Bags.unpacked(r["ids"], r["sizes"], r["flat"]), least))

    return pairs.mapInArrow(run, "src long, dst long")


def _large_regions(blocks: DataFrame, least: float) -> DataFrame:
    """Links of regions of many blocks (see the module's text)."""
    blocks = Written(blocks, "dedup-blocks").df
    left = blocks.select("region", F.col("block").alias("a_block"), *[F.col(c).alias(f"a_{c}") for c in ("ids", "sizes", "flat")])
    keys = blocks.select("region", "block")
    a_keys = keys.withColumnRenamed("block", "a_block")

    def pairs(which: DataFrame, first: DataFrame) -> DataFrame:
        """The blocks of key pairs (region, a_block, block).  The last join
        deals them out by the first block, so a large region is many tasks."""
        return _pair_edges(which.join(blocks, ["region", "block"]).join(first, ["region", "a_block"]), least)

    everything = left.withColumn("only", F.lit(None).cast("array<long>"))
    pivots = keys.groupBy("region").agg(F.min("block").alias("block"))
    found = Written(pairs(a_keys.join(pivots, "region"), everything), "dedup-links").df
    # the class of the pivots in each region that holds most documents
    nodes = blocks.select("region", "block", F.explode("ids").alias("node"))
    classes = nodes.join(connected_components(found), "node", "left").withColumn("class", F.coalesce("component", "node"))
    main = classes.groupBy("region", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("region").agg(F.max_by("class", F.struct("n", "class")).alias("main"))
    rest = classes.join(main, "region").filter(F.col("class") != F.col("main"))
    # at most a block's documents in a list
    cell = rest.groupBy(F.xxhash64("region", "block").alias("cell"))
    only = cell.agg(F.first("region").alias("region"), F.first("block").alias("a_block"), F.collect_list("node").alias("only")).drop("cell")
    only = Written(only, "dedup-rest").df
    again = pairs(only.select("region", "a_block").join(keys, "region"), left.join(only, ["region", "a_block"]))
    return found.unionByName(again)


def identity(docs: DataFrame) -> Column:
    """The id, or for a null id a number made from the text."""
    made = -(F.lit(1 << 62) + F.pmod(F.xxhash64(digest(F.col("text"))), F.lit(1 << 61)))
    return F.coalesce(F.col("doc_id").cast("long"), made)


def cluster(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """``(doc_id, same, class_id, texts, kept)``, one row a document: the
    smallest id of its class, the class's number of different texts, and
    whether the document has that id.  The ids of ``same`` and ``identity``
    lead back to the rows."""
    signed = Written(_signed(docs), "signed").df
    made = -(F.lit(1 << 62) + F.pmod(F.xxhash64("same"), F.lit(1 << 61)))
    rows = signed.withColumn("id", F.coalesce(F.col("doc_id").cast("long"), made))
    texts = rows.groupBy("same").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("n", "bands", "sketch")])
    texts = Written(texts.withColumn("node", F.xxhash64("same")), "texts").df
    regions = connected_components(candidates(texts), "node", "head").withColumnRenamed("component", "region")
    member = Written(texts.join(regions, "node").select("node", "region", "same", "rep", "n"), "regions").df
    sizes = member.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    wanted = member.join(sizes, "region").select("node", "region", "same", F.col("rep").alias("id"), blocks.alias("blocks"))
    # most texts are in no region: a sieve keeps them out of the shuffle
    source = sieved(docs.select(identity(docs).alias("id"), "text"), "id", sieve(member, "rep"), "wanted").filter("wanted")
    source = source.select("id", digest(F.col("text")).alias("same"), normal(F.col("text")).alias("text"))
    # one row a text, whatever rows repeat
    found = wanted.join(source, ["id", "same"]).groupBy("node", "region", "blocks").agg(F.first("text").alias("text"))
    found = Written(found, "region-texts").df
    small = found.filter("blocks = 1").repartition("region").sortWithinPartitions("region", "node")
    large = found.filter("blocks > 1").withColumn("block", F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")))
    links = _small_regions(small, least).unionByName(_large_regions(_blocks(large), least))
    classes = connected_components(links)
    named = Written(member.select("node", "rep", "same").join(classes, "node").select("node", "component", "rep", "same"), "classes").df
    first = F.min(F.struct(F.col("rep").alias("class_id"), F.col("same").alias("class_same")))
    smallest = named.groupBy("component").agg(first.alias("first"), F.count(F.lit(1)).alias("texts")).select("component", "first.*", "texts")
    of_text = texts.select("same", "node", "rep").join(named.join(smallest, "component").select("node", "class_id", "class_same", "texts"), "node", "left")
    of_text = of_text.select("same", F.coalesce("class_id", "rep").alias("first_id"), F.coalesce("class_same", "same").alias("class_same"), F.coalesce("texts", F.lit(1)).cast("long").alias("texts"))
    out = rows.select("id", "doc_id", "same").join(_numbered(of_text, texts), "same")
    kept = (F.col("id") == F.col("first_id")) & (F.col("same") == F.col("class_same"))
    return out.select("doc_id", "same", "class_id", "texts", kept.alias("kept"), "id")


def _numbered(of_text: DataFrame, texts: DataFrame) -> DataFrame:
    """``class_id``: the smallest id of the class, unless another class has
    it too, as a text of smaller digest has that id."""
    shared = Written(texts.groupBy("rep").agg(F.count(F.lit(1)).alias("m"), F.min("same").alias("owner")).filter("m > 1"), "shared-ids").df
    if shared.isEmpty():
        return of_text.withColumn("class_id", F.col("first_id"))
    made = -(F.lit(1 << 62) + F.pmod(F.xxhash64("class_same"), F.lit(1 << 61)))
    joined = of_text.join(shared.select(F.col("rep").alias("first_id"), "owner"), "first_id", "left")
    return joined.withColumn("class_id", F.when(F.col("class_same") != F.col("owner"), made).otherwise(F.col("first_id"))).drop("owner")


def deduplicate(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The rows that stay, one of each class, with their columns unchanged.
    Of rows that repeat the id and words of the one that stays the least (by
    all columns) does."""
    named = Written(cluster(docs, least), "dedup-classes").df
    key, own, flag = fresh("id", docs), fresh("same", docs), fresh("flag", docs)
    gone = named.filter("not kept").select(F.col("id").alias(key), F.col("same").alias(own))
    repeated = named.filter("kept").groupBy("id", "same").count().filter("count > 1").select(F.col("id").alias(key), F.col("same").alias(own))
    # only rows that a sieve of the dropped ids lets through are shuffled
    marked = sieved(docs.withColumn(key, identity(docs)), key, sieve(gone, key), flag)
    maybe = marked.filter(flag).withColumn(own, digest(F.col("text"))).join(gone, [key, own], "left_anti")
    stay = marked.filter(~F.col(flag)).select(key, *docs.columns).unionByName(maybe.select(key, *docs.columns))
    if repeated.isEmpty():
        return stay.select(*docs.columns)
    stay = stay.withColumn(own, digest(F.col("text")))
    single = stay.join(repeated, [key, own], "left_anti").select(*docs.columns)
    once = stay.join(repeated, [key, own], "left_semi").groupBy(key, own).agg(F.min(F.struct(*docs.columns)).alias("row"))
    return single.unionByName(once.select("row.*"))
