"""Physical plans of the registered queries."""

import pytest

from runweave.plans import QUERIES

STREAMS = {n for n in QUERIES if n.endswith("_stream")} | {"stream_logs", "guard_completed", "tail_logs"}


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS - {"tree_paths", "merge_on_read"}))
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(spark, sf_dir, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_last_n_is_cut_before_the_shuffle(spark, sf_dir):
    assert "Partial, " in plan(spark, sf_dir, "last_n_runs") or "WindowGroupLimit" in plan(spark, sf_dir, "last_n_runs")


def test_pages_are_top_k(spark, sf_dir):
    for name in ("page_offset", "page_after"):
        assert "TakeOrderedAndProject" in plan(spark, sf_dir, name)


def test_filters_reach_the_scan(spark, sf_dir):
    assert "GreaterThan(ts" in plan(spark, sf_dir, "log_query")
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan(spark, sf_dir, "page_after")


def test_tracker_table_shuffles_once(spark, sf_dir):
    assert plan(spark, sf_dir, "tracker_table").count("Exchange hashpartitioning") == 1


def test_route_match_and_ignore_files_have_no_shuffle(spark, sf_dir):
    for name in ("route_match", "ignore_files", "append_logs", "flatten_log", "field_mask"):
        assert "Exchange" not in plan(spark, sf_dir, name)


def test_checked_records_take_one_scan(spark, sf_dir):
    from runweave.operators import logs as L
    from runweave.plans.log_queries import payloads

    checked = L.append_logs(payloads(spark, sf_dir))
    for text in (checked._jdf.queryExecution().executedPlan().toString(), plan(spark, sf_dir, "validate_keys")):
        assert text.count("FileScan parquet") == (1 if "__entries" in text or "entries" in text else 2)
        assert "Exchange" not in text
    late = plan(spark, sf_dir, "reject_after_completed")
    assert late.count("FileScan parquet") == 2


def test_ordinals_without_hot_keys_shuffle_once(spark, sf_dir):
    assert plan(spark, sf_dir, "series_x").count("Exchange hashpartitioning") == 1
