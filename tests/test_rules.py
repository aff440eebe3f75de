"""Rules that an ordinary table does not reach: failed calls, used-up rounds, short sentences, odd results."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventloom.operators import audits, evaluation, inspection, quality
from eventloom.plans.queries import QUERIES

STEP = "conv_id int, step int, gen_text string, call_status string, finish_reason string, tool_status string, tool_result string, elapsed double"
CALL = '<TOOLCALL>[{"name": "check_All", "arguments": {"input": "%s"}}]</TOOLCALL>'


def steps(spark, *rows):
    return spark.createDataFrame([(*r[:4], "stop", "ok", f"result {r[1]}", 1.0) for r in rows], STEP)


def test_messages_end_before_a_failed_call(spark):
    rows = steps(spark, (1, 0, "lost", "http_error"), (2, 0, CALL % 0, "ok"), (2, 1, "lost", "http_error"), (2, 1, "lost", "http_error"))
    got = {r.conv_id: r for r in evaluation.error_records(rows, 4).collect()}
    assert got[1].error_type == got[2].error_type == "HTTP_ERROR"
    assert [m.role for m in got[1].messages] == ["system", "user"] and got[1].last_model_output is None
    assert [(m.role, m.content) for m in got[2].messages[2:]] == [("assistant", CALL % 0), ("tool", "result 0")]
    assert got[2].last_model_output == CALL % 0 and (got[1].n_repeated, got[2].n_repeated) == (0, 1)


def test_an_unexpected_tool_name_keeps_its_message(spark):
    odd = '<TOOLCALL>[{"name": 5}]</TOOLCALL>'
    got = evaluation.error_records(steps(spark, (1, 0, odd, "ok")), 3).first()
    assert got.error_type == "UNEXPECTED_ERROR" and got.last_model_output == odd and len(got.messages) == 3


def test_messages_of_used_up_rounds_end_with_the_tool(spark):
    rows = steps(spark, *[(1, i, CALL % i, "ok") for i in range(3)])
    asked = spark.createDataFrame([(1, "what?")], "conv_id int, user_request string")
    got = evaluation.error_records(rows, 3, asked).first()
    assert got.user_request == got.messages[1].content == "what?" and "rounds" in got.error_message
    assert got.error_type == "MAX_ROUNDS_EXCEEDED"
    assert [m.role for m in got.messages[2:]] == ["assistant", "tool"] * 3 and got.last_model_output == CALL % 2


def test_short_test_sentences_leak_too(spark):
    train = spark.createDataFrame([(1, "Some text. Where is job 7?"), (2, "Nothing. ")], "doc_id int, text string")
    test = spark.createDataFrame([(1, "where is  job 7"), (2, ""), (3, None)], "item_id int, text string")
    assert [tuple(r) for r in audits.leakage(train, test).collect()] == [(1, 1)]


@pytest.mark.parametrize(
    "text, empty",
    [
        (None, True), ("", True), (" ", True), ("null", True), ("[]", True), ("{}", True), ('" "', True), ('{"rows": []}', True),
        ('{"rows": "[]"}', False), ('{"rows": [1]}', False), ("[0]", False), ("0", False), ("text", False), ('{"other": []}', False),
    ],
)
def test_empty_results(spark, text, empty):
    row = spark.createDataFrame([(text,)], "t string").select(quality.is_empty_result("t").alias("e")).first()
    assert row.e is empty


def test_paths_without_root_are_refused(spark):
    events = spark.createDataFrame([(1, '{"site": "x"}')], "_ID int, METADATA string")
    with pytest.raises(ValueError):
        inspection.execute_sql(events, "SELECT json_extract(METADATA, 'site') AS s FROM EVENTS")
    with pytest.raises(Exception, match="starts with"):
        inspection.execute_sql(events, "SELECT json_extract(METADATA, concat('si', 'te')) AS s FROM EVENTS").collect()
    assert inspection.execute_sql(events, "SELECT json_extract(METADATA, '$.site') AS s FROM EVENTS").first().s == "x"


def test_routing_words_are_whole_words(spark):
    asked = ["Is everything ready?", "Which file transfers failed?", "What was read?", "read and write", "resource assignment"]
    rows = spark.createDataFrame([(q,) for q in asked], "q string").select(audits.routed_tool(F.col("q")).alias("tool")).collect()
    assert [r.tool for r in rows] == ["check_All", "check_FileTransfer", "check_FileRead", "check_All", "check_JobAllocation"]


def test_gold_without_transcript_scores_nothing(spark):
    gold = spark.createDataFrame([(1, "check_All", "SELECT 1", "It is 'x'.")], "conv_id int, gold_tool string, gold_sql string, gold_answer string")
    none = spark.createDataFrame([], "conv_id int, check_text string, sql_text string, answer_text string")
    assert [tuple(r) for r in evaluation.score_transcripts(none, gold).collect()] == [(1, 0.0, 0.0)]


def test_every_run_is_compared_with_one_base(spark):
    verdicts = [(c, f"run_{c % 4}", c % 3 > 0, None if c % 3 == 0 else 1.0) for c in range(60)]
    frame = spark.createDataFrame(verdicts, "conv_id int, run string, success boolean, elapsed double")
    rows = evaluation.compare_runs(frame).collect()
    assert sorted((r.run, r.other_run) for r in rows) == [("run_0", f"run_{i}") for i in (1, 2, 3)]
    assert {r.run for r in evaluation.compare_runs(frame, "run_2").collect()} == {"run_2"}


def test_semi_join_fixture_holds_rows(spark):
    assert QUERIES["semi_jobs"](spark, "/root/testdata/sf0.01").count() > 0


def test_cells_keep_their_kind(spark):
    events = spark.createDataFrame([(i, "x" if i % 2 else None) for i in range(40)], "_ID int, STATE string").repartition(4)
    result = inspection.execute_sql(events, "SELECT _ID, CAST(_ID AS STRING) AS t, _ID > 3 AS b, STATE FROM EVENTS ORDER BY _ID DESC")
    cells = quality.result_cells(result, 7).collect()
    assert sorted({(r.col_no, r.kind) for r in cells}) == [(0, "number"), (1, "text"), (2, "boolean"), (3, "null"), (3, "text")]
    assert {r.row_no: r.cell for r in cells if r.col_no == 0} == {i: str(39 - i) for i in range(40)}
    shown = quality.with_result_text(spark.createDataFrame([(7,)], "qa_id int"), quality.result_cells(result.limit(1), 7)).first()
    assert shown.result_text == '[[39, "39", true, "x"]]'


@pytest.mark.parametrize(
    "select, reason",
    [("0", "zero"), ("0.0", "zero"), ("CAST(0 AS DOUBLE)", "zero"), ("'0'", None), ("'00'", None), ("'0e3'", None), ("false", None), ("NULL", "all_null"), ("1", None)],
)
def test_only_the_number_zero_is_rejected(spark, select, reason):
    events = spark.createDataFrame([(1,)], "_ID int")
    cells = quality.result_cells(inspection.execute_sql(events, f"SELECT {select} AS x FROM EVENTS"), 1)
    questions = spark.createDataFrame([(1,)], "qa_id int")
    assert quality.result_quality(questions, cells).first().reject_reason == reason
    assert quality.flag_zero_results(questions, cells).first().flagged is (reason == "zero")


def test_both_zeros_are_in_the_fixture(spark, sf_dir):
    verdicts = QUERIES["result_quality"](spark, sf_dir).where("qa_id % 6 = 1 AND qa_id % 17 <> 3").select(F.col("qa_id") % 12, "accepted").distinct()
    assert sorted(map(tuple, verdicts.collect())) == [(1, False), (7, True)]


def test_only_fields_asked_for_become_rows(spark, sf_dir):
    plan = QUERIES["answer_batch"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    generated = next(i for i, line in enumerate(lines) if "Generate explode" in line and "key" in line)
    assert any("map_filter(" in line for line in lines[generated : generated + 3])
    assert any("LeftSemi" in line for line in lines[:generated])
