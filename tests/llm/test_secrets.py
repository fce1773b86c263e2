import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.llm import secret_scan as S
from tidewater.llm.common import table

from .conftest import SF_CHECK

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    """(start, rank, kind, end) by Python's patterns and counted windows."""
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    base = list(out)
    for rank, (kind, characters, window, bits) in enumerate(S.CLASSES, 3):
        for m in re.finditer(S.char_class(characters) + "+", text):
            run, spans = m.group(), []
            if any(re.search(p, run) for p in S.ALLOW):
                continue
            for at in range(len(run) - window + 1):
                counts = Counter(run[at : at + window]).values()
                if -sum(c / window * math.log2(c / window) for c in counts) >= bits:
                    if spans and spans[-1][1] >= at:
                        spans[-1][1] = at + window
                    else:
                        spans.append([at, at + window])
            spans = [(a + m.start(), b + m.start()) for a, b in spans]
            out += [(a, rank, kind, b) for a, b in spans if not any(x[0] <= a and b <= x[3] for x in base)]
    return sorted(out)


def wanted(text):
    spans = [(k, f"{k}:{a}:{b}") for a, _, k, b in brute(text)]
    counts = Counter(k for k, _ in spans)
    base = ",".join(s for k, s in spans if k in S.KINDS)
    return *(counts[k] for k in S.KINDS), hashlib.sha256(base.encode()).hexdigest(), ",".join(s for _, s in spans)


def found(docs):
    return [tuple(r)[1:] for r in S.digests(S.scan(docs)).orderBy("doc_id").collect()]


random.seed(5)
BASE64 = S.CLASSES[1][1]
ROWS = [
    "",
    None,
    "token=api_key=abcdefgh secret=token:abcdefgh passwd='abc'secret=\"abcdefgh",
    "x" * 30 + "AKIA" + "A1" * 10 + " é\U0001f600 AKIA123 PassWord : hunter22 TOKEN=ſecret",
    "ſecret=abcdefgh toKen=abcdefgh",  # letters that only a Unicode fold takes for s and k
    "aB3dE5gH7jK9mN1pQ3sT5vW7xY9z " * 3,
    "".join(random.choices(BASE64, k=3000)),
    "".join(random.choices(BASE64[:40], k=300)) + " " + "ab12" * 30 + "".join(random.choices(BASE64, k=50)),
    "token=abcdefg " * 700,
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 d41d8cd98f00b204e9800998ecf8427e",
    "deadbeef" * 5 + " " + "0123456789" * 4 + " 9233A8ECF7C5B09FE5949719B6B82BC439E9329B",
    "/usr/local/share/documentation/handbook/chapter/introduction Donaudampfschifffahrtsgesellschaft",
]


def test_made_up_texts(spark):
    assert found(spark.createDataFrame(list(enumerate(ROWS)), "doc_id long, text string")) == [wanted(t) for t in ROWS]


def test_entropy_beyond_shapes(spark):
    spans = [w[4] for w in map(wanted, ROWS)]
    assert spans[5] and spans[6] and "entropy_hex" in spans[10]
    assert spans[11] == "" and "entropy" not in spans[9]


def test_documents(spark):
    docs = table(spark, SF_CHECK, "documents")
    assert found(docs) == [wanted(r["text"]) for r in docs.orderBy("doc_id").select("text").collect()]


def test_odd_rows(spark, odd_docs, no_docs):
    got = sorted(map(tuple, S.digests(S.scan(odd_docs)).collect()), key=repr)
    assert got == sorted(((r["doc_id"], *wanted(r["text"])) for r in odd_docs.collect()), key=repr)
    assert S.digests(S.scan(no_docs)).count() == 0


def test_long_text(spark):
    """Many matches and a long candidate in one text."""
    text = "secret=abcdef, " * 60_000 + "".join(random.choices(BASE64, k=50_000))
    (row,) = S.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    shapes = [s for s in row["found"] if s["kind"] == "assign"]
    assert [s["start"] for s in shapes] == list(range(0, 15 * 60_000, 15))
    assert row["found"][-1]["kind"] == "entropy_base64" and row["found"][-1]["end"] <= len(text)


def test_native_plan(spark):
    plan = S.digests(S.scan(table(spark, SF_CHECK, "documents")))._jdf.queryExecution().executedPlan().toString()
    assert not any(name in plan for name in ("Python", "Pandas", "Arrow", "Exchange"))


@pytest.mark.parametrize("sizes", [[], [5], [1, 2, 3], list(range(1, 1000))])
def test_running_sums(spark, sizes):
    df = spark.createDataFrame([(sizes,)], "s array<int>").select(F.when(F.size("s") > 0, S._running(F.col("s"))).otherwise(F.array()).alias("r"))
    assert list(df.first()["r"]) == [sum(sizes[:i]) for i in range(len(sizes))]
