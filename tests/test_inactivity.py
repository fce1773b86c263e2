"""Silent users: the stream against a loop over each user's events."""

import math
from collections import defaultdict
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import rows
from tidewater.streaming.feed import day_slices
from tidewater.streaming.inactivity import SILENCE_HOURS, replay_inactive

T0 = datetime(2024, 3, 1)
GAP = timedelta(hours=SILENCE_HOURS)


def _loop(events):
    by_user, clock = defaultdict(list), max(t for u, t in events if u is not None and t is not None)
    for u, t in events:
        if u is not None and t is not None:
            by_user[u].append(t)
    out = []
    for u, times in by_user.items():
        times.sort()
        spells = [[times[0]]]
        for t in times[1:]:
            spells.append([t]) if t - spells[-1][-1] > GAP else spells[-1].append(t)
        for s in spells:
            end = s[-1] + GAP
            hour = end.replace(minute=0, second=0, microsecond=0) + timedelta(hours=1)
            if hour <= clock - timedelta(hours=1):
                out.append((s[0], end, s[-1], len(s), u))
    return sorted(out, key=repr)


def test_inactive_users_equal_a_loop(spark):
    h = lambda x: T0 + timedelta(hours=x)
    events = [(7, h(math.sin(k) ** 2 * 190)) for k in range(1500)]  # hot user
    events += [(1, h(0)), (1, h(24)), (1, h(48.0001)), (1, h(80))]  # exactly the gap, just above it
    events += [(2, h(70.5)), (2, h(70.5)), (2, h(94.6)), (3, h(191.9)), (4, h(166.99)), (4, h(165.1))]  # repeats; still open
    events += [(5, h(10)), (5, h(100)), (5, h(130)), (None, h(5)), (6, None)]
    df = spark.createDataFrame(events, "user_id long, ts timestamp_ntz")
    got = replay_inactive(df, day_slices("ts", [h(72), h(120)]))
    assert rows(got) == _loop(events)


def test_no_events_no_spells(spark):
    df = spark.createDataFrame([], "user_id long, ts timestamp_ntz")
    assert replay_inactive(df, day_slices("ts", [])).count() == 0
