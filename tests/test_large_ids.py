"""64-bit ids beyond 2**53 and null keys pass through the prefix operators."""

from tidewater.operators.quantiles import exact_percentiles
from tidewater.operators.ranking import group_ranks
from tidewater.operators.sequence import weighted_prefix

BIG = 1 << 60


def test_prefix_changes_no_value(spark):
    rows = [(BIG + i, None if i % 3 == 0 else BIG + i, i) for i in range(9)]
    df = spark.createDataFrame(rows, "id long, key long, w long")
    out = {r["w"]: r for r in weighted_prefix(df, ["w"], "w", "before", 3).collect()}
    for i in range(9):
        assert (out[i]["id"], out[i]["key"], out[i]["before"]) == (rows[i][0], rows[i][1], sum(range(i)))


def test_ranks_keep_large_ids(spark):
    rows = [(BIG + i, None if i < 3 else BIG, float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "id long, g long, v double")
    out = group_ranks(df, ["g"], "v", "id").collect()
    assert sorted(r["id"] for r in out) == [BIG + i for i in range(7)]
    assert sorted((r["g"] is None) for r in out) == [False] * 4 + [True] * 3


def test_percentiles_of_a_null_group(spark):
    rows = [(None if i % 2 else BIG + 1, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "g long, v double")
    out = {r["g"]: r["p50"] for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5}).collect()}
    assert out == {BIG + 1: 4.0, None: 5.0}
