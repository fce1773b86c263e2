"""Plan shape guards: pushdown, pruning, map-side top-k, no cartesian
products, nested-loop joins only against the fixed band table, and single-
partition exchanges only for bounded inputs."""

import pytest

from conftest import SF_SMALL
from tidewater.plans.catalog import load_all

# single-partition exchanges allowed: the per-partition offset table of the
# global-position operators (one row per partition) and global aggregates
# after partial aggregation (one row per task)
SINGLE_PARTITION_OK = {
    "conversation_check", "event_sequences", "events_last_day", "last_click_before_purchase",
    "overlapping_activity", "supplier_ranks", "table_contract", "value_percentiles",
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, j in load_all().items():
        if j.group != "streaming":
            out[name] = _plan(j.build(spark, SF_SMALL))
    return out


def test_no_cartesian_products(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p] == []


def test_nested_loop_only_for_band_table(plans):
    assert {n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p} <= {"price_bands"}


def test_single_partition_only_where_bounded(plans):
    assert {n for n, p in plans.items() if "SinglePartition" in p} <= SINGLE_PARTITION_OK


def test_single_partition_of_sessions_is_the_offsets(plans):
    lines = plans["overlapping_activity"].splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert below and all("HashAggregate(keys=[_pid" in line for line in below)


def test_scan_pushdown_and_pruning(spark):
    j = load_all()["scan_pruned"]
    text = j.build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_returnflag), GreaterThan(l_quantity,45.0), EqualTo(l_returnfl" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_returnflag:string>" in text


def test_topk_is_map_side(plans):
    assert plans["top_customers_by_nation"].count("WindowGroupLimit") >= 2
    assert "TakeOrderedAndProject" in plans["largest_orders"]


def test_aggregates_are_partial(plans):
    for name in ("pricing_summary", "exact_duplicates", "frequent_tokens", "users_per_event"):
        assert "partial_" in plans[name], name


def test_no_text_work_pushed_into_scans(plans):
    # an inner explode of a computed array would push size(...) > 0 into the
    # scan, tokenising every text once more before any join cut the rows
    bad = []
    for name, p in plans.items():
        for line in p.splitlines():
            if "FileScan" in line and "DataFilters" in line:
                filters = line.split("DataFilters:", 1)[1].split("], ", 1)[0]
                # a size check on a stored array column is cheap; on a
                # computed one (tokeniser UDF, split, regex) it is not
                if any(f in filters for f in ("UDF", "split(", "lower(", "regexp")):
                    bad.append((name, filters[:120]))
    assert bad == []
