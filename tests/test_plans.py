"""What the physical plans have to look like."""

from __future__ import annotations

import pytest

from eventloom.plans.queries import QUERIES


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


# These run a write or a stream while they are built.
BUILT_BY_RUNNING = {
    "read_jsonl", "write_jsonl", "route_sink", "error_log_sink", "stream_route", "stream_error_counts", "loss_weights", "weight_stats",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - BUILT_BY_RUNNING))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct"):
        assert bad not in text
    if name != "compare_runs":  # two tables with one row per run
        assert "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["check_file_read", "topk_metric", "sample_jobs"])
def test_top_n_needs_no_full_sort(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, sf_dir))


@pytest.mark.parametrize("name", ["check_all", "conversation_verdict"])
def test_rank_filter_reaches_the_map_side(spark, sf_dir, name):
    assert plan(QUERIES[name](spark, sf_dir)).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["filter_event", "route_answers", "lint_sql", "flatten_meta", "train_test_split"])
def test_row_wise_jobs_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(QUERIES[name](spark, sf_dir))


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(QUERIES["train_test_split"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint>" in text


@pytest.mark.parametrize("name,most", [("label_mask", 6), ("mask_ratio", 7), ("masked_view", 6)])
def test_masks_arrange_messages_once(spark, sf_dir, name, most):
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES[name](spark, sf_dir)).split("Initial Plan")[-1]
        assert text.count("Exchange hashpartitioning") <= most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


@pytest.mark.parametrize("name", ["find_spans", "json_extract_spans", "token_offsets"])
def test_spans_need_no_window(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Window" not in text or name == "token_offsets"
    if name != "token_offsets":
        assert "Exchange" not in text
