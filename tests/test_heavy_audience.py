"""Heavy hitters against a plain count, audiences against sets."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewater.operators import heavy
from tidewater.plans.audience import audience_overlap_df, daily_sketches, stored


def found(df, parts):
    return {r["item"]: r["n"] for r in heavy.heavy_hitters(df, "item", parts).collect()}


def want(items, parts):
    known = Counter(i for i in items if i is not None)
    return {i: n for i, n in known.items() if n * parts > sum(known.values())}


@pytest.mark.parametrize("parts", [1, 3, 20, 100])
def test_heavy_items_are_exact(spark, parts):
    """A hot item, many items just above and below the share, many more items
    than the sketch tracks, nulls, empty and long items; many partitions."""
    rng = random.Random(5)
    items = ["hot"] * 6000 + [f"rare{i}" for i in range(9000)] + [None] * 500 + [""] * 300 + ["x" * 20_000] * 250
    items += [f"edge{i}" for i in range(60) for _ in range(150 + i)]
    rng.shuffle(items)
    df = spark.createDataFrame([(i,) for i in items], "item string").repartition(40)
    assert len(set(items)) > heavy.tracked_for(parts)
    assert found(df, parts) == want(items, parts)


def test_heavy_items_at_the_share_are_not_above_it(spark):
    df = spark.createDataFrame([(i % 10,) for i in range(1000)], "item long")
    assert found(df, 10) == {}
    assert found(df, 11) == {i: 100 for i in range(10)}


def test_heavy_items_of_nothing(spark):
    df = spark.createDataFrame([(None,)] * 3, "item string")
    assert found(df, 10) == {} and found(df.limit(0), 10) == {}
    with pytest.raises(ValueError):
        heavy.heavy_hitters(df, "item", 10**6)


def test_sketches_meet_by_groups_of_tasks(spark):
    """More tasks than groups: no group reads all sketches."""
    items = [i % 7 if i % 2 else i for i in range(20_000)]
    df = spark.createDataFrame([(i,) for i in items], "item long").repartition(2 * heavy.SKETCH_GROUPS + 3)
    total, hashes = heavy.candidates(df, F.col("item"), 50)
    assert total == len(items) and len(hashes) <= 67
    assert found(df, 50) == want(items, 50)


T0 = datetime(2024, 1, 1)  # a Monday


def made_events():
    """Three weeks; user 0 has a third of all events."""
    rng = random.Random(9)
    events = [(T0 + timedelta(hours=rng.randrange(21 * 24)), rng.choice(["view", "click", "purchase"]), rng.randrange(4000)) for _ in range(20_000)]
    events += [(T0 + timedelta(hours=i % 500), "view", 0) for i in range(10_000)]
    return events + [(None, "view", 1), (T0, None, 1), (T0, "view", None), (T0, "other", 5)]


def exact(events, types):
    who = {}
    for ts, kind, user in events:
        if ts and kind in types and user is not None:
            who.setdefault(((ts - T0).days // 7, kind), set()).add(user)
    out = {}
    for (week, a), ua in who.items():
        for b in types:
            if ub := who.get((week, b)):
                out[week, a, b] = (len(ua), len(ub), len(ua & ub), len(ua | ub), len(who.get((week - 1, a), set()) & ub))
    return out


def reported(daily, types, lg):
    return {
        ((r["week"] - T0.date()).days // 7, r["event_a"], r["event_b"]): tuple(r[c] for c in ("n_a", "n_b", "n_both", "n_either", "n_from_week_before"))
        for r in audience_overlap_df(daily, types, lg).collect()
    }


def test_audiences_equal_sets_below_the_sketch_size(spark):
    types = ["view", "click", "purchase"]
    events = made_events()
    daily = stored(daily_sketches(spark.createDataFrame(events, "ts timestamp_ntz, event_type string, user_id long")))
    assert reported(daily, types, 14) == exact(events, types)
    assert reported(daily.limit(0), types, 14) == {}


def test_audiences_beyond_the_sketch_size_are_within_the_bound(spark):
    types, lg = ["view", "click", "purchase"], 9
    events = made_events()
    daily = stored(daily_sketches(spark.createDataFrame(events, "ts timestamp_ntz, event_type string, user_id long"), lg))
    got, true = reported(daily, types, lg), exact(events, types)
    assert got.keys() == true.keys()
    assert any(g != t for g, t in zip(got.values(), (true[k] for k in got)))
    for key, counts in got.items():
        # five standard errors of the union's count; of two weeks' for the last
        bound = 5 / 2 ** (lg / 2)
        week, a, b = key
        either = [true[key][0], true[key][1], true[key][3], true[key][3], true[key][1] + true.get((week - 1, a, a), (0,))[0]]
        for estimate, truth, of in zip(counts, true[key], either):
            assert abs(estimate - truth) <= bound * of, (key, counts, true[key])


def test_audiences_read_no_events_after_the_sketches(spark):
    events = spark.createDataFrame(made_events(), "ts timestamp_ntz, event_type string, user_id long")
    plan = audience_overlap_df(stored(daily_sketches(events)), ["view", "click"])._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and "distinct" not in plan.lower() and "NestedLoop" not in plan
