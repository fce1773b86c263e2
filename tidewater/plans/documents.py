"""Document preparation: duplicates, repeated lines, personal data, licence
lines, quality rules and a quality classifier, decontamination against the
benchmark, and a language-balanced sample.

Every job reads whole texts; tokens, n-grams and signatures are SQL
expressions over arrays, evaluated inside generated code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import patterns as P
from tidewater.functions.arrays import explode_rows, posexplode_rows
from tidewater.functions.text import long_lists, mix64, set_signatures, shingle_sets, tokens, with_ngrams
from tidewater.operators.blocks import groups_alike_in_buckets, near_in_groups
from tidewater.operators.graph import connected_components
from tidewater.operators.heavy import heavy_hitters
from tidewater.operators.joins import broadcast_if_small
from tidewater.plans.catalog import job
from tidewater.session import scratch_path
from tidewater.sources.tables import Tables

_TOKENS_SQL = r"list_filter(regexp_split_to_array(lower({c}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def _sql_tokens(c: str) -> str:
    return _TOKENS_SQL.format(c=c)


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------------------
# exact duplicates and repeated lines
# --------------------------------------------------------------------------


@job(
    "exact_duplicates",
    """
    SELECT sha256(text) AS content_hash, MIN(doc_id) AS keep_doc_id, COUNT(*) AS n_docs
    FROM documents GROUP BY sha256(text) HAVING COUNT(*) > 1
    """,
    group="documents",
)
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of identical texts and the id kept for each (the smallest).
    A partial aggregate per content hash: a group holding a third of the
    corpus is combined map-side, never gathered."""
    d = Tables(spark, sf_dir).documents
    return (
        d.groupBy(F.sha2("text", 256).alias("content_hash"))
        .agg(F.min("doc_id").alias("keep_doc_id"), F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") > 1)
    )


@job(
    "repeated_lines",
    """
    SELECT line, COUNT(DISTINCT doc_id) AS n_docs
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE length(line) > 20
    GROUP BY line HAVING COUNT(DISTINCT doc_id) >= 3
    """,
    group="documents",
)
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines longer than 20 characters found in three or more documents
    (boilerplate candidates)."""
    return repeated_lines_df(Tables(spark, sf_dir).documents)


def repeated_lines_df(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """Documents are counted by 128-bit digests of the lines, so no text is
    shuffled; the found digests are written, and the lines they stand for are
    combined map-side (one row a line and task)."""
    spark = docs.sparkSession
    lines = explode_rows(docs, ["doc_id"], F.split("text", "\n"), "line").filter(F.length("line") > 20)
    lines = lines.withColumn("h", F.unhex(F.md5("line")))
    counts = lines.groupBy("h").agg(F.countDistinct("doc_id").alias("n_docs")).filter(F.col("n_docs") >= min_docs)
    path = scratch_path(spark, "repeated-lines")
    counts.write.parquet(path)
    found = broadcast_if_small(spark.read.parquet(path))
    return lines.join(found, "h").groupBy("h").agg(F.min("line").alias("line"), F.min("n_docs").alias("n_docs")).drop("h")


@job(
    "label_profile",
    """
    SELECT d.lang, l.quality, COUNT(*) AS n_docs, CAST(SUM(l.toxic) AS BIGINT) AS n_toxic,
           CAST(SUM(d.n_chars) AS BIGINT) AS total_chars
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    GROUP BY d.lang, l.quality
    """,
    group="documents",
)
def label_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    d = t.documents.select("doc_id", "lang", "n_chars")
    return (
        d.join(t.labels, "doc_id")
        .groupBy("lang", "quality")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            F.sum("toxic").cast("bigint").alias("n_toxic"),
            F.sum("n_chars").cast("bigint").alias("total_chars"),
        )
    )


# --------------------------------------------------------------------------
# personal data and licence lines
# --------------------------------------------------------------------------


def _redaction_sql() -> str:
    cur = "text"
    counts = []
    for kind, pattern, repl in P.REDACTIONS:
        counts.append(f"CAST(len(regexp_extract_all({cur}, {_sql_str(pattern)})) AS BIGINT) AS n_{kind}")
        cur = f"regexp_replace({cur}, {_sql_str(pattern)}, {_sql_str(repl)}, 'g')"
    return f"SELECT doc_id, {', '.join(counts)}, {cur} AS redacted FROM documents"


def redact_df(docs: DataFrame) -> DataFrame:
    out = docs.select("doc_id", F.col("text").alias("_r"))
    for kind, pattern, repl in P.REDACTIONS:
        out = out.withColumn(f"n_{kind}", F.regexp_count("_r", F.lit(pattern)).cast("bigint")).withColumn(
            "_r", F.regexp_replace("_r", pattern, repl)
        )
    return out.withColumnRenamed("_r", "redacted")


@job("redact_personal_data", _redaction_sql(), group="documents")
def redact_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask secrets, e-mail addresses, card numbers, phone numbers and IPv4
    addresses (in that order) and count each kind per document."""
    return redact_df(Tables(spark, sf_dir).documents)


@job(
    "license_lines",
    f"""
    SELECT doc_id, line_no, line FROM (
      SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS line_no
      FROM documents)
    WHERE regexp_matches(line, {_sql_str(P.LICENSE_LINE)})
    """,
    group="documents",
)
def license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = Tables(spark, sf_dir).documents
    lines = posexplode_rows(d, ["doc_id"], F.split("text", "\n"), "line_no", "line")
    return lines.filter(F.col("line").rlike(P.LICENSE_LINE)).select(
        "doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line"
    )


# --------------------------------------------------------------------------
# tokens
# --------------------------------------------------------------------------


@job(
    "frequent_tokens",
    f"""
    SELECT token, COUNT(*) AS n
    FROM (SELECT unnest({_sql_tokens('text')}) AS token FROM documents)
    GROUP BY token ORDER BY n DESC, token LIMIT 20
    """,
    group="documents",
)
def frequent_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most frequent tokens of the corpus (a top-k report).  Counts
    are combined map-side, so even 'the' ships one row per task."""
    d = Tables(spark, sf_dir).documents
    return (
        explode_rows(d, [], tokens("text"), "token")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("token"))
        .limit(20)
    )


#: A token is heavy if it is more than one in so many tokens.
HEAVY_PARTS = 1000


@job(
    "heavy_tokens",
    f"""
    WITH t AS (SELECT unnest({_sql_tokens('text')}) AS token FROM documents)
    SELECT token, COUNT(*) AS n FROM t GROUP BY token HAVING COUNT(*) * {HEAVY_PARTS} > (SELECT COUNT(*) FROM t)
    """,
    group="documents",
)
def heavy_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens that are more than a thousandth of all tokens, with exact counts:
    candidates from a bounded summary, then only those are counted, so the rare
    tokens that make up a corpus's vocabulary are never shuffled."""
    d = Tables(spark, sf_dir).documents
    return heavy_hitters(explode_rows(d, [], tokens("text"), "token"), "token", HEAVY_PARTS)


# --------------------------------------------------------------------------
# quality rules
# --------------------------------------------------------------------------


def _stop_map():
    return F.create_map(
        *[x for lang, words in P.STOP_WORDS.items() for x in (F.lit(lang), F.array(*[F.lit(w) for w in words]))]
    )


def quality_rules_df(docs: DataFrame) -> DataFrame:
    t = docs.select("doc_id", "lang", "text", tokens("text").alias("_t"), F.split("text", "\n").alias("_lines"))
    n = F.size("_t")
    word_chars = F.aggregate(F.transform("_t", lambda x: F.length(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    stop = F.coalesce(_stop_map()[F.col("lang")], F.array().cast("array<string>"))
    sig = t.select(
        "doc_id",
        "lang",
        n.cast("bigint").alias("n_words"),
        F.when(n > 0, word_chars.cast("double") / n.cast("double")).alias("mean_word_len"),
        F.when(n > 0, F.regexp_count("text", F.lit(P.SYMBOLS)).cast("double") / n.cast("double")).alias("symbol_ratio"),
        (F.lit(1.0) - F.size(F.array_distinct("_lines")).cast("double") / F.size("_lines").cast("double")).alias(
            "dup_line_frac"
        ),
        F.size(F.filter("_t", lambda x: F.array_contains(stop, x))).cast("bigint").alias("n_stop"),
    )
    reason = (
        F.when(F.col("n_words") < P.MIN_WORDS, "too_short")
        .when(F.col("n_words") > P.MAX_WORDS, "too_long")
        .when(
            (F.col("mean_word_len") < P.MIN_MEAN_WORD_LEN) | (F.col("mean_word_len") > P.MAX_MEAN_WORD_LEN), "word_length"
        )
        .when(F.col("symbol_ratio") > P.MAX_SYMBOL_RATIO, "symbols")
        .when(F.col("dup_line_frac") > P.MAX_DUP_LINE_FRACTION, "repetition")
        .when(F.col("n_stop") < P.MIN_STOP_WORDS, "no_stop_words")
    )
    return sig.withColumn("reason", reason).withColumn("keep", F.col("reason").isNull())


def _quality_sql() -> str:
    stop_cases = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(_sql_str(w) for w in words)}]" for lang, words in P.STOP_WORDS.items()
    )
    return f"""
    SELECT doc_id, lang, n_words, mean_word_len, symbol_ratio, dup_line_frac, n_stop, reason, reason IS NULL AS keep
    FROM (
      SELECT *, CASE
          WHEN n_words < {P.MIN_WORDS} THEN 'too_short'
          WHEN n_words > {P.MAX_WORDS} THEN 'too_long'
          WHEN mean_word_len < {P.MIN_MEAN_WORD_LEN} OR mean_word_len > {P.MAX_MEAN_WORD_LEN} THEN 'word_length'
          WHEN symbol_ratio > {P.MAX_SYMBOL_RATIO} THEN 'symbols'
          WHEN dup_line_frac > {P.MAX_DUP_LINE_FRACTION} THEN 'repetition'
          WHEN n_stop < {P.MIN_STOP_WORDS} THEN 'no_stop_words'
        END AS reason
      FROM (
        SELECT doc_id, lang,
               CAST(len(t) AS BIGINT) AS n_words,
               CASE WHEN len(t) > 0 THEN CAST(list_sum(list_transform(t, lambda x: length(x))) AS DOUBLE) / CAST(len(t) AS DOUBLE) END AS mean_word_len,
               CASE WHEN len(t) > 0 THEN CAST(len(regexp_extract_all(text, {_sql_str(P.SYMBOLS)})) AS DOUBLE) / CAST(len(t) AS DOUBLE) END AS symbol_ratio,
               1.0 - CAST(len(list_distinct(lines)) AS DOUBLE) / CAST(len(lines) AS DOUBLE) AS dup_line_frac,
               CAST(len(list_filter(t, lambda x: list_contains(COALESCE(CASE lang {stop_cases} END, []), x))) AS BIGINT) AS n_stop
        FROM (SELECT doc_id, lang, text, {_sql_tokens('text')} AS t, string_split(text, chr(10)) AS lines FROM documents)
      )
    )
    """


@job("quality_rules", _quality_sql(), group="documents")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heuristic quality signals per document and the first rule it fails
    (length, word length, symbols, repeated lines, stop words)."""
    return quality_rules_df(Tables(spark, sf_dir).documents)


@job(
    "quality_vs_labels",
    f"""
    SELECT q.keep, l.quality, COUNT(*) AS n_docs
    FROM ({_quality_sql()}) q JOIN labels l ON q.doc_id = l.doc_id
    GROUP BY q.keep, l.quality
    """,
    group="documents",
)
def quality_vs_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the rules' keep/drop decision lines up with the human labels."""
    t = Tables(spark, sf_dir)
    q = quality_rules_df(t.documents).select("doc_id", "keep")
    return q.join(t.labels, "doc_id").groupBy("keep", "quality").agg(F.count(F.lit(1)).alias("n_docs"))


@job("quality_classifier", group="documents")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train a logistic regression on the labelled documents (hashed
    frequencies of words and of runs of signs, IDF weights, unit length, so a
    long text weighs no more than a short one) and score every document.  Fitting is a few
    distributed passes (IDF counts, then L-BFGS tree aggregates); scoring is
    map-only."""
    t = Tables(spark, sf_dir)
    return quality_classifier_df(t.documents, t.labels)


def quality_classifier_df(documents: DataFrame, labels: DataFrame) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
    from pyspark.ml.functions import vector_to_array

    docs = documents.select("doc_id", "text")
    # the narrow labels are broadcast if they are few, so the texts stay put
    marks = broadcast_if_small(labels.select("doc_id", F.col("quality").cast("double").alias("label")))
    train = docs.join(marks, "doc_id")
    pipe = Pipeline(
        stages=[
            RegexTokenizer(inputCol="text", outputCol="words", pattern=P.WORD_OR_SIGNS, gaps=False, toLowercase=True),
            HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 18),
            IDF(inputCol="tf", outputCol="weights", minDocFreq=2),
            Normalizer(inputCol="weights", outputCol="features"),
            LogisticRegression(maxIter=50, regParam=0.01, elasticNetParam=0.0),
        ]
    )
    model = pipe.fit(train)
    scored = model.transform(docs)
    return scored.select(
        "doc_id",
        vector_to_array("probability")[1].alias("p_good"),
        F.col("prediction").cast("int").alias("predicted_quality"),
    )


# --------------------------------------------------------------------------
# sampling
# --------------------------------------------------------------------------


def _sample_rates_sql() -> str:
    return " ".join(f"WHEN '{lang}' THEN {float(r)}" for lang, r in P.LANGUAGE_RATES.items())


@job(
    "language_mix_sample",
    f"""
    SELECT doc_id, lang, n_chars FROM documents
    WHERE CAST(CAST(('0x' || substr(sha256(CAST(doc_id AS VARCHAR) || ':{P.SAMPLE_SEED}'), 1, 8)) AS BIGINT) % 1000000 AS DOUBLE)
          / 1000000.0 < COALESCE(CASE lang {_sample_rates_sql()} END, 0.0)
    """,
    group="documents",
)
def language_mix_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep a fixed share of each language, chosen by a hash of the id (the
    first 32 bits of SHA-256 of ``id:seed``), so the sample is the same on
    every run, for every partitioning, and in any engine with SHA-256."""
    rates = F.create_map(*[x for lang, r in P.LANGUAGE_RATES.items() for x in (F.lit(lang), F.lit(float(r)))])
    d = Tables(spark, sf_dir).documents.select("doc_id", "lang", "n_chars")
    key = F.concat(F.col("doc_id").cast("string"), F.lit(f":{P.SAMPLE_SEED}"))
    bits = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    u = (bits % F.lit(1_000_000)).cast("double") / F.lit(1_000_000.0)
    return d.filter(u < F.coalesce(rates[F.col("lang")], F.lit(0.0)))


# --------------------------------------------------------------------------
# decontamination
# --------------------------------------------------------------------------


def decontaminate_df(docs: DataFrame, bench: DataFrame, n: int = P.DECONTAMINATION_NGRAM) -> DataFrame:
    """Pairs (document, benchmark item) sharing word n-grams, with the number
    of distinct shared n-grams.

    1. benchmark n-grams with a 64-bit hash -- an evaluation set, broadcast
       only if the count check passes (else a shuffle join on the hash);
    2. document n-gram hashes are generated and probed in one pipelined stage
       (generate -> hash join); rows are longs, not 13-word strings;
    3. the matches are written once; they are confirmed by comparing the
       n-gram text itself at the matched position, re-tokenising only the
       matched documents, so a hash collision cannot add a pair.
    """
    grams = (
        explode_rows(with_ngrams(bench.select("item_id", "text"), "text", n, "_g"), ["item_id"], "_g", "gram")
        .distinct()
        .withColumn("h", F.xxhash64("gram"))
    )
    grams = broadcast_if_small(grams)
    doc_hashes = posexplode_rows(
        with_ngrams(docs.select("doc_id", "text"), "text", n, "_g"),
        ["doc_id"],
        F.transform("_g", lambda g: F.xxhash64(g)),
        "pos",
        "h",
    )
    cand = doc_hashes.join(grams, "h").select("doc_id", "pos", "item_id", "gram")
    # the matches are few: write them once, so checking their size does not
    # run the document pass again
    path = scratch_path(docs.sparkSession, "decontamination-candidates")
    cand.write.parquet(path)
    cand = docs.sparkSession.read.parquet(path)

    hit_ids = broadcast_if_small(cand.select("doc_id").distinct())
    hit_docs = with_ngrams(docs.select("doc_id", "text").join(hit_ids, "doc_id", "left_semi"), "text", n, "_g")
    # one row per n-gram of a hit document, joined on (doc_id, pos): linear in
    # the hit documents, and a long document is spread over its positions
    hit_grams = posexplode_rows(hit_docs, ["doc_id"], "_g", "pos", "doc_gram")
    confirmed = cand.join(hit_grams, ["doc_id", "pos"]).filter(F.col("doc_gram") == F.col("gram"))
    return confirmed.groupBy("doc_id", "item_id").agg(F.countDistinct("gram").alias("n_shared"))


@job(
    "decontaminate",
    f"""
    WITH bt AS (SELECT item_id, {_sql_tokens('text')} AS t FROM benchmark),
    bg AS (SELECT DISTINCT item_id, array_to_string(t[i:i + {P.DECONTAMINATION_NGRAM - 1}], ' ') AS gram
           FROM bt, range(1, len(t) - {P.DECONTAMINATION_NGRAM - 2}) r(i)),
    dt AS (SELECT doc_id, {_sql_tokens('text')} AS t FROM documents),
    dg AS (SELECT doc_id, array_to_string(t[i:i + {P.DECONTAMINATION_NGRAM - 1}], ' ') AS gram
           FROM dt, range(1, len(t) - {P.DECONTAMINATION_NGRAM - 2}) r(i))
    SELECT dg.doc_id, bg.item_id, COUNT(DISTINCT dg.gram) AS n_shared
    FROM dg JOIN bg ON dg.gram = bg.gram GROUP BY dg.doc_id, bg.item_id
    """,
    group="documents",
)
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents sharing a 13-word n-gram with a benchmark item, with the
    number of shared n-grams."""
    t = Tables(spark, sf_dir)
    return decontaminate_df(t.documents, t.benchmark)


# --------------------------------------------------------------------------
# near duplicates
# --------------------------------------------------------------------------


#: Texts are cut into shingles so many words at a time, about.
WORDS_AT_ONCE = 1 << 17


def _word_hashes(docs: DataFrame) -> DataFrame:
    """``(doc_id, words)``: the 64-bit hashes of a text's words, in order."""
    from pyspark.ml.feature import RegexTokenizer

    split = RegexTokenizer(inputCol="text", outputCol="_t", pattern=P.TOKEN_SPLIT, gaps=True, toLowercase=True, minTokenLength=1)
    words = split.transform(docs.select("doc_id", "text").filter("doc_id is not null and text is not null"))
    return words.select("doc_id", F.transform("_t", lambda w: F.xxhash64(w)).alias("words"))


def _in_batches(docs: DataFrame, columns: dict, made) -> DataFrame:
    """``doc_id`` and ``columns``: what ``made`` returns for the shingle sets
    (see ``shingle_sets``) of an Arrow batch of texts."""
    n, at_once = P.SHINGLE_WORDS, WORDS_AT_ONCE

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lens = batch.column("words").value_lengths().to_numpy()
            # some texts at a time: arrays are small beside a batch
            part = (np.cumsum(lens, dtype=np.int64) - lens) // at_once
            for rows in np.split(np.arange(len(lens)), np.flatnonzero(np.diff(part)) + 1) if len(lens) else []:
                some = batch.slice(int(rows[0]), len(rows))
                words = some.column("words").flatten().to_numpy().view(np.uint64)
                sets = shingle_sets(words, lens[rows], n)
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *made(*sets)], names=["doc_id", *columns])

    words = _word_hashes(docs)
    schema = ", ".join(f"{c} {kind}" for c, kind in {"doc_id": words.schema["doc_id"].dataType.simpleString(), **columns}.items())
    return words.mapInArrow(run, schema)


def _shingled(docs: DataFrame) -> DataFrame:
    """``(doc_id, sh)``: the distinct 64-bit hashes of a text's shingles,
    ascending."""
    return _in_batches(docs, {"sh": "array<bigint>"}, lambda hashes, lens: [long_lists(hashes, lens)])


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``(doc_id, same1, same2, keys, sketch)``: two hashes of a text's shingle
    set, a key for each band of its MinHash signature, and a byte of each value
    of the signature."""

    def made(hashes, lens):
        import numpy as np
        import pyarrow as pa

        begin = np.cumsum(lens) - lens
        same = [np.add.reduceat(mix64(hashes ^ np.uint64(k)), begin) if len(lens) else hashes for k in (1, 2)]
        sig = set_signatures(hashes, lens, bands * rows)
        keys = np.zeros((bands, len(lens)), dtype=np.uint64)
        for r in range(rows):
            keys = mix64(keys ^ sig[r::rows])
        # a minimum is small, so its bits are mixed before a byte is taken
        sketch = np.ascontiguousarray(mix64(sig).astype(np.uint8).T)
        return [
            *[pa.array(v.view(np.int64)) for v in same],
            long_lists(np.ascontiguousarray(keys.T).reshape(-1), np.full(len(lens), bands)),
            pa.array([line.tobytes() for line in sketch], pa.binary()),
        ]

    return _in_batches(docs, {"same1": "bigint", "same2": "bigint", "keys": "array<bigint>", "sketch": "binary"}, made)


def near_duplicates_df(
    docs: DataFrame,
    bands: int = P.MINHASH_BANDS,
    rows: int = P.MINHASH_ROWS,
    threshold: float = P.NEAR_DUP_JACCARD,
) -> DataFrame:
    """Clusters of documents whose word 5-gram sets have Jaccard similarity
    of at least ``threshold`` (MinHash LSH).

    1. per document: the hashes of its words (SQL), of its shingles and a
       MinHash signature (vectorised numpy over Arrow batches);
    2. band keys: ``bands`` hashes of ``rows`` signature values each;
    3. documents with equal shingle sets are one node from here on;
    4. each band bucket links its members to a head (the first by one of four
       hash orders) -- a star, so a bucket of m documents gives m - 1 edges;
    5. an edge is kept if the exact Jaccard similarity of the two shingle
       hash sets is at least ``threshold`` (``array_intersect`` /
       ``array_union``: hash-set work linear in the two texts, per edge);
    6. members of a bucket that the stars left in different components are
       compared by one byte a signature value, block by block inside tasks;
       components whose members agree in ``P.SKETCH_SHARE`` of the bytes form
       a region (a task puts out only what joins them: fewer rows than
       members), and within regions documents of different components are
       compared, by bytes and then by exact Jaccard, again in blocks: no pair
       is a row before it is a link, and no task puts out more than a forest;
    7. connected components over the kept edges.

    A pair at the threshold shares no bucket with probability
    (1 - threshold^rows)^bands, 9e-5 for 34 bands of 4; its bytes agree in too
    few values with 4e-7.  Null ids and texts take no part; empty texts (no
    letter or digit) are copies of each other; an id given twice counts as
    similar to all its texts' partners.
    """
    spark = docs.sparkSession
    # what the buckets need of a document; its shingles are not kept
    path = scratch_path(spark, "minhash")
    _signed(docs, bands, rows).write.parquet(path)
    sig = spark.read.parquet(path)
    nodes = sig.groupBy("same1", "same2").agg(F.min("doc_id").alias("node"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    path = scratch_path(spark, "minhash-nodes")
    nodes.write.parquet(path)
    nodes = spark.read.parquet(path)
    copies = sig.join(nodes.select("same1", "same2", "node"), ["same1", "same2"]).filter(F.col("doc_id") != F.col("node"))
    copies = copies.select(F.col("doc_id").alias("src"), F.col("node").alias("dst"))

    keyed = nodes.select("node", F.posexplode("keys").alias("band", "bucket"))
    # two longs a bucket: combined by hash; an order between structs would sort
    order = F.xxhash64("node", F.pmod("band", F.lit(4)))
    heads = keyed.groupBy("band", "bucket").agg(F.min_by("node", order).alias("head"), F.count(F.lit(1)).alias("m"))
    path = scratch_path(spark, "minhash-buckets")
    keyed.join(heads.filter("m > 1").select("band", "bucket", "head"), ["band", "bucket"]).write.parquet(path)
    buckets = spark.read.parquet(path).filter(F.col("node") != F.col("head"))

    def sets_of(ids: DataFrame) -> DataFrame:
        """Shingle sets cut again from the texts of the few ``doc_id``."""
        path = scratch_path(spark, "minhash-shingles")
        sets = _shingled(docs.join(broadcast_if_small(ids.distinct()), "doc_id", "left_semi"))
        sets.withColumn("h", F.xxhash64("sh")).dropDuplicates(["doc_id", "h"]).drop("h").write.parquet(path)
        return spark.read.parquet(path)

    def kept(pairs: DataFrame) -> DataFrame:
        """Pairs whose shingle sets are near."""
        path = scratch_path(spark, "minhash-pairs")
        pairs.distinct().write.parquet(path)
        pairs = spark.read.parquet(path)
        sets = sets_of(pairs.select(F.col("src").alias("doc_id")).unionByName(pairs.select(F.col("dst").alias("doc_id"))))
        a = sets.select(F.col("doc_id").alias("src"), F.col("sh").alias("sa"))
        b = sets.select(F.col("doc_id").alias("dst"), F.col("sh").alias("sb"))
        # distinct hashes, so the union needs no set of its own
        both = pairs.join(a, "src").join(b, "dst").select("src", "dst", (F.size("sa") + F.size("sb")).alias("sizes"), F.size(F.array_intersect("sa", "sb")).alias("both"))
        return both.filter(F.col("both") / (F.col("sizes") - F.col("both")) >= F.lit(threshold)).select("src", "dst").distinct()

    path = scratch_path(spark, "minhash-stars")
    kept(buckets.select(F.col("node").alias("src"), F.col("head").alias("dst"))).write.parquet(path)
    stars = spark.read.parquet(path)
    # components that meet in a bucket below its head
    found = connected_components(stars)
    member = buckets.join(found, "node", "left").select("band", "bucket", "node", F.coalesce("component", "node").alias("component"))
    mixed = member.groupBy("band", "bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).filter("c1 < c2")
    member = member.join(mixed.select("band", "bucket"), ["band", "bucket"])
    path = scratch_path(spark, "minhash-mixed")
    member.join(nodes.select("node", "sketch"), "node").write.parquet(path)
    member = spark.read.parquet(path)
    least = int(P.SKETCH_SHARE * bands * rows)
    # star components with members whose sketches agree make a region
    regions = connected_components(groups_alike_in_buckets(member, ["band", "bucket"], "node", "component", "sketch", least))
    regions = regions.select(F.col("node").alias("component"), F.col("component").alias("region"))
    path = scratch_path(spark, "minhash-regions")
    member.select("node", "component").distinct().join(regions, "component").write.parquet(path)
    region = spark.read.parquet(path)
    sets = sets_of(region.select(F.col("node").alias("doc_id"))).withColumnRenamed("doc_id", "node")
    full = region.join(sets, "node").join(nodes.select("node", "sketch"), "node")
    edges = stars.unionByName(near_in_groups(full, "region", "node", "component", "sketch", least, "sh", threshold)).unionByName(copies)
    comps = connected_components(edges)
    return comps.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster_id"))


@job(
    "near_duplicates",
    f"""
    WITH RECURSIVE t AS (SELECT doc_id, {_sql_tokens('text')} AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {P.SHINGLE_WORDS}
            THEN list_transform(range(1, len(w) - {P.SHINGLE_WORDS - 2}), lambda i: array_to_string(w[i:i + {P.SHINGLE_WORDS - 1}], ' '))
            ELSE [array_to_string(w, ' ')] END) AS g FROM t),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
    e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE c::DOUBLE / (nx.n + ny.n - c) >= {P.NEAR_DUP_JACCARD}),
    r(node, root) AS (SELECT x, least(x, min(y)) FROM e GROUP BY x UNION SELECT e.x, r.root FROM r JOIN e ON e.y = r.node)
    SELECT node AS doc_id, min(root) AS cluster_id FROM r GROUP BY node
    """,
    group="documents",
)
def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates_df(Tables(spark, sf_dir).documents)
