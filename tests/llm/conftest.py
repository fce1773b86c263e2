import pytest
from pyspark.sql import types as T

from tidewater.llm.queries import piece_model

SF_SMALL, SF_CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside or return.
CLASHES = ("id", "same", "size", "score", "copies", "row_key", "flag", "bucket", "bits", "shard", "node", "text_", "_key")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    ids with two texts, and extra columns with clashing names."""
    from pyspark.sql import functions as F

    long_text = "The long and winding words of the text go on and on. " * 8000
    rows = [
        (1, "plain words of a text that is long enough for shingles", "en", "a", 1),
        (1, "plain words of a text that is long enough for shingles", "en", "a", 1),
        (2, "plain words of a text that is long enough for shingles", None, None, None),
        (2, "another text under the same id", "en", "a", 2),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \t\n ", "de", "b", 3),
        (6, long_text, "en", "a", len(long_text)),
        (None, "a text without an id", "fr", None, 5),
        (None, None, None, None, None),
        (7, "1234 !! \x00 \U0001f600 ▁▁ é", "es", "\U0001f600", 9),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def model_path():
    return piece_model()
