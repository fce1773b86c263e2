"""Time the headline jobs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each job once on the smallest fixture to warm up (untimed), then once
on ``BENCH_SF_DIR`` to completion (results written to a no-op sink, so the
whole plan executes without pulling rows to the driver) and prints one JSON
line: total seconds, per-job seconds, the scale factor.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans.catalog import load_all  # noqa: E402
from tidewater.session import local_session  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"

HEADLINE = [
    "pricing_summary",
    "region_revenue",
    "orders_with_returns",
    "top_customers_by_nation",
    "supplier_ranks",
    "value_percentiles",
    "last_click_before_purchase",
    "events_last_day",
    "event_sequences",
    "signup_to_purchase",
    "customers_rollup",
    "event_pivot",
    "exact_duplicates",
    "repeated_lines",
    "redact_personal_data",
    "quality_rules",
    "decontaminate",
    "near_duplicates",
    "page_text",
    "similar_vectors",
    "conversation_check",
    "stream_daily",
    "stream_user_totals",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="tidewater-bench")
    jobs = load_all()
    # Warm-up outside the timings, on a different folder (the smallest
    # fixture): every selected job runs once, so class loading, code
    # generation, ML transformers and the Python workers of each UDF kind are
    # started -- as in a long-running service -- and nothing of the timed
    # folder is read or cached beforehand.
    if sf_dir.rstrip("/") != WARMUP_DIR:
        for name in names:
            jobs[name].build(spark, WARMUP_DIR).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        jobs[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_job_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
