"""Exact money sums in integer units against Python decimals."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tidewater.functions.exact import sum_units, sum_units_cents, units


def test_units_sums_are_exact(spark):
    rng = random.Random(9)
    vals = [round(rng.uniform(-99_999, 99_999), 2) for _ in range(5000)]
    vals += [-0.01, 0.01, 99_999.99, -99_999.99]
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(vals)], "g int, v double").repartition(7)
    # products of cents and hundredths: values up to ~1e11 units of 1e-6
    u = units("v") * F.lit(93) * F.lit(107)
    got = {r.g: (r.s, r.c) for r in df.groupBy("g").agg(sum_units(u).alias("s"), sum_units_cents(u, 6).alias("c")).collect()}
    for g in range(3):
        exact = sum(Decimal(str(v)) * 100 * 93 * 107 for i, v in enumerate(vals) if i % 3 == g)
        assert got[g][0] == exact
        want = (exact / Decimal(10**6)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
        assert got[g][1] == float(want)


def test_split_sum_survives_many_large_rows(spark):
    # 2^40 - 1 per row, 3 million rows: far past a long's range as one sum
    n = 3_000_000
    big = (1 << 40) - 1
    df = spark.range(0, n, 1, 8).select(F.lit(big).cast("long").alias("u"))
    assert df.agg(sum_units(F.col("u")).alias("s")).first().s == Decimal(big) * n
