"""Appends that are repeated or cut off."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventloom.operators import evaluation
from eventloom.sources import appends, sinks

SCHEMA = "id int, route string, text string"


def rows(spark, *ids):
    return spark.createDataFrame([(i, "ab"[i % 2], "é" if i else None) for i in ids], SCHEMA)


def stored(spark, path):
    return sorted((r.id, r.route, r.text, r.run_id) for r in appends.read_appended(spark, path, SCHEMA).collect())


def test_same_run_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "log")
    assert stored(spark, path) == []
    assert sinks.write_split(rows(spark, 0, 1, 2), path, "one") is True
    assert sinks.write_split(rows(spark, 0, 1, 2), path, "one") is False
    assert sinks.write_split(rows(spark, 3), path, "two") is True
    assert stored(spark, path) == [(0, "a", None, "one"), (1, "b", "é", "one"), (2, "a", "é", "one"), (3, "b", "é", "two")]


def test_killed_run_is_not_seen_and_can_be_made_again(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.write_split(rows(spark, 0), path, "one")
    # What a run leaves that wrote rows and was killed before its entry.
    rows(spark, 1, 2).write.partitionBy("route").json(f"{path}/rows/run_id=two")
    assert [r[0] for r in stored(spark, path)] == [0]

    def fails(i):
        raise RuntimeError("lost")

    broken = rows(spark, 1).withColumn("text", F.udf(fails)("id"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_split(broken, path, "two")
    assert appends.finished_runs(spark, path) == ["one"]
    sinks.write_split(rows(spark, 1), path, "two")
    assert [r[0] for r in stored(spark, path)] == [0, 1]


def test_only_finished_runs_are_listed(spark, tmp_path):
    path = str(tmp_path / "log")
    for run in ("b", "a", "2026-01-01.x"):
        appends.append_once(rows(spark, 0).limit(0), path, run)
    assert appends.finished_runs(spark, path) == ["2026-01-01.x", "a", "b"]
    assert stored(spark, path) == []
    with pytest.raises(ValueError):
        appends.append_once(rows(spark, 0), path, "../x")


STEP = "conv_id int, step int, elapsed double, finish_reason string, call_status string, tool_status string, tool_result string, gen_text string"


def test_first_stored_row_of_a_step_stays(spark):
    given = [(1, 0, e, "stop", "http_error", "ok", None, said) for e, said in ((3.0, "z"), (1.0, "m"), (2.0, "a"), (None, "b"))]
    steps = spark.createDataFrame(given, STEP)
    record = evaluation.error_records(steps, 4).first()
    assert record.n_repeated == 3 and record.extra == {"call_status": "http_error", "finish_reason": "stop", "tool_status": "ok"}
    bad = F.concat("gen_text", F.lit(' <TOOLCALL>[{"name": }]</TOOLCALL>'))
    said = evaluation.error_records(steps.withColumn("call_status", F.lit("ok")).withColumn("gen_text", bad), 4).first()
    assert said.last_model_output.startswith("m ")


def test_report_with_headings(spark, tmp_path):
    timed = evaluation.timed_verdicts(spark.createDataFrame([(1, 0, 1.0, "stop", "ok", "ok", None, " ")], STEP))
    path = str(tmp_path / "report")
    sinks.write_report(evaluation.benchmark_summary(timed), evaluation.error_breakdown(timed), path, "cases.jsonl", "errors.jsonl")
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[:2] == ["BENCHMARK SUMMARY", "Test cases: cases.jsonl"]
    assert lines[-3:] == ["Errors by class:", "  EMPTY_FINAL_ANSWER: 1", "Errors written to: errors.jsonl"]
