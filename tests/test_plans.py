"""Physical plan shape: the properties the scale design relies on."""

import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

QUERIES = entry.queries()
TOP_K = ["top_pairs", "top_products", "recent_recalls", "list_products", "search_recalls",
         "search_recalls_like", "search_products", "search_products_like", "top_products_share",
         "top_pairs_share"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan(q(spark, SF_SMALL)) for k, q in QUERIES.items()}


def test_no_cross_joins_no_python_no_collect_to_one_task(plans):
    for key, p in plans.items():
        assert "CartesianProduct" not in p, key
        assert "BroadcastNestedLoopJoin" not in p, key
        assert "EvalPython" not in p and "PythonUDF" not in p, key
        assert "InMemoryTableScan" not in p, key


def test_top_k_is_take_ordered(plans):
    for key in TOP_K:
        assert "TakeOrderedAndProject" in plans[key], key


def test_unpartitioned_windows_only_over_top_k(plans):
    for key, p in plans.items():
        for m in re.finditer(r"Window \[[^\n]*\], \[\]", p):
            assert key in ("top_products_share", "top_pairs_share"), (key, m.group(0))


def test_flagship_exchanges_and_partials(plans):
    p = plans["gold_adverse_events_summary"]
    keys = [e.split("#")[0] for e in re.findall(r"Exchange hashpartitioning\(([^,]+)", p)]
    # Line items by order key, orders by order key, the tile spread, the gold aggregate.
    assert keys == ["product_name", "xxhash64(report_id", "o_orderkey", "l_orderkey"]
    assert "Union" not in p
    assert p.count("partial_sum(") >= 2 and "partial_min" in p and "partial_max" in p
    scan = re.search(r"FileScan parquet \[(l_[^\]]*)\]", p).group(1)
    assert sorted(c.split("#")[0] for c in scan.split(",")) == ["l_linenumber", "l_orderkey", "l_partkey",
                                                                "l_suppkey"]


def test_dedupe_has_map_side_partials(plans):
    for key in ("clean_products", "clean_enforcement"):
        assert "partial_min(" in plans[key], key


def test_change_feed_is_one_full_outer_join(plans):
    for key in ("change_feed_products", "change_feed_enforcement", "change_feed_adverse"):
        p = plans[key]
        assert len(re.findall(r"SortMergeJoin .*FullOuter", p)) == 1, key
