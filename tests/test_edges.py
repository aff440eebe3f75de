"""Hand-written edge rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions import sampling
from eventloom.functions.metadata import meta_like, meta_named, meta_number, successful
from eventloom.functions.text import is_json_object
from eventloom.operators import audits, evaluation, filters, generation, inspection, quality
from eventloom.sources import events as event_source
from eventloom.sources import jsonl, sinks, tools
from eventloom.streaming import jobs


def column(spark, texts, expression, schema="t string"):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {schema}")
    return [r.v for r in frame.select("i", expression.alias("v")).orderBy("i").collect()]


def test_empty_results(spark):
    cases = {
        '{"rows": []}': True, "  ": True, "{}": True, "null": True, "[]": True, '""': True, '{"rows": [1]}': False,
        '{"data": 5, "results": []}': True, "0": False, "[[]]": False, "plain": False, '{"rows": [1], "data": []}': False,
    }
    assert column(spark, [*cases, None], quality.is_empty_result("t")) == [*cases.values(), True]


def test_error_texts(spark):
    texts = ["Near the END", "no such COLUMN: x", "fine", "misuse of aggregate: sum()"]
    assert column(spark, texts, quality.error_text_found("t")) == ["near ", "no such column", None, "misuse of aggregate"]


def test_clean_sql(spark):
    cases = {
        "```sql\nSELECT 1\n```": "SELECT 1",
        "Sure:\nselect a from b<eot_id>junk": "select a from b",
        "```\nHere SELECT 2;\r\nFROM x\n```<|eot_id|>": "SELECT 2;\nFROM x",
        " nothing here ": "nothing here",
        "<eot_id>SELECT 1": "",
        "```sql SELECT 3```": "",
        "```sql\n```": "",
        "```\nSELECT 1\n``` trailing\nmore": "SELECT 1\n``` trailing\nmore",
    }
    assert column(spark, list(cases), quality.clean_sql("t")) == list(cases.values())


def test_json_object_is_whole_text(spark):
    texts = ['{"a": 1}', '{"a": 1} x', "{bad", "[1]", '{"a": 1}, {"b": 2}', '{"a": 1}}', "", ' {"a": {"b": 1}} ', '"x"', None]
    assert column(spark, texts, is_json_object("t")) == [True, False, False, False, False, False, False, True, False, False]


def test_routes(spark):
    texts = {
        "__SQL_ERROR__": "sql_error", "__SQL_ERROR__ x": "incomplete", " __ANSWER__ x": "incomplete", "__ANSWER__ x": "ready",
        "__NULL_RESULT__ y": "null_answer", "": "incomplete",
    }
    rows = spark.createDataFrame([(k,) for k in texts], "raw_answer string")
    routed = quality.route_answers(rows).collect()
    assert {r.raw_answer: r.route for r in routed} == texts
    assert {r.answer for r in routed if r.route == "ready"} == {"x"}
    assert all((r.raw_answer_output is not None) == (r.answer == vocab.UNRECOGNISED) for r in routed)


def test_result_rules(spark):
    questions = spark.createDataFrame([(i,) for i in range(6)], "qa_id int")
    cells = [
        (0, 0, 0, None), (0, 1, 0, None), (1, 0, 0, "0"), (1, 0, 1, "0"), (2, 0, 0, "0.0"), (3, 0, 0, "x"), (3, 1, 0, None),
        (4, 0, 0, "None"),
    ]
    results = spark.createDataFrame(cells, "qa_id int, row_no int, col_no int, cell string")
    verdict = {r.qa_id: r.reject_reason for r in quality.result_quality(questions, results).collect()}
    assert verdict == {0: "all_null", 1: None, 2: "zero", 3: None, 4: None, 5: "empty"}
    flagged = {r.qa_id for r in quality.flag_zero_results(questions, results).collect() if r.flagged}
    assert flagged == {1, 2}
    marker = {r.qa_id: r.expected_marker for r in quality.expected_marker(questions, results).collect()}
    assert [i for i, m in sorted(marker.items()) if m == vocab.ANSWER] == [1, 2]


def test_long_results_come_in_parts(spark):
    cells = [(1, i, c, f"v{i}.{c}") for i in range(7) for c in range(2)] + [(2, 0, 0, None)]
    results = spark.createDataFrame(cells, "qa_id int, row_no int, col_no int, cell string")
    records = spark.createDataFrame([(1,), (2,), (3,)], "qa_id int")
    parts = quality.with_result_text(records, results, 3).orderBy("qa_id", "part").collect()
    assert [(r.qa_id, r.part, r.n_parts) for r in parts] == [(1, 0, 3), (1, 1, 3), (1, 2, 3), (2, 0, 1), (3, 0, 1)]
    assert json.loads("".join(r.result_text for r in parts if r.qa_id == 1)) == [[f"v{i}.0", f"v{i}.1"] for i in range(7)]
    assert [r.result_text for r in parts[-2:]] == ["[[null]]", "[]"]


def step(conv, number, text, finish="stop", call="ok", tool="ok", result='[["1"]]'):
    return (conv, number, 1.5, finish, call, tool, result, text)


STEPS = "conv_id int, step int, elapsed double, finish_reason string, call_status string, tool_status string, tool_result string, gen_text string"
CHECK = 'x <TOOLCALL>[{"name": "check_All", "arguments": {"input": "NO_INPUT"}}]</TOOLCALL>'


def verdicts(spark, rows, rounds=6):
    frame = spark.createDataFrame(rows, STEPS)
    return {r.conv_id: r.error_type for r in evaluation.conversation_verdict(frame, rounds).collect()}


def sql_call(sql):
    return "x <TOOLCALL>" + json.dumps([{"name": "execute_sql", "arguments": {"sql": sql}}]) + "</TOOLCALL>"


def test_verdicts(spark):
    reordered = 'y <TOOLCALL>[{"arguments": {"input": "NO_INPUT"}, "name": "check_All"}]</TOOLCALL>'
    rows = [
        step(1, 0, CHECK), step(1, 1, sql_call("a")), step(1, 2, "Done.<eot_id>"),
        step(2, 0, CHECK, call="parse_error"), step(3, 0, CHECK, call="unexpected_error"),
        step(4, 0, sql_call("a"), tool="runtime_error"), step(5, 0, CHECK), step(5, 1, reordered), step(5, 2, "ok"),
        step(6, 0, CHECK, finish="length"), step(7, 0, " <eot_id>late"), step(8, 0, sql_call("a"), result="[]"),
        step(9, 0, 'x <TOOLCALL>[{"name": 5}]</TOOLCALL>'), step(10, 0, 'x <TOOLCALL>[{"name": "check_All"}] y]</TOOLCALL>'),
        step(11, 0, "x <TOOLCALL>[{}]</TOOLCALL>"), step(12, 0, CHECK), step(12, 1, sql_call("a"), result='[["go near me"]]'),
        step(13, 0, CHECK), step(14, 0, "x <TOOLCALL>[1"), step(15, 0, sql_call("b")), step(15, 1, CHECK),
        step(15, 2, sql_call("c")), step(15, 3, sql_call("d")), step(15, 4, sql_call("e")), step(15, 5, sql_call("f")),
    ]
    assert verdicts(spark, rows) == {
        1: None, 2: "VLLM_RESPONSE_PARSE_ERROR", 3: "UNEXPECTED_ERROR", 4: "SQL_TOOL_RUNTIME_ERROR", 5: "REPEATED_TOOLCALL_LOOP",
        6: "GENERATION_LENGTH_CUTOFF", 7: "EMPTY_FINAL_ANSWER", 8: "SQL_EMPTY_RESULT", 9: "UNEXPECTED_ERROR",
        10: "TOOLCALL_JSON_ERROR", 11: "TOOLCALL_MISSING_NAME", 12: "SQL_HALLUCINATION_OR_EXECUTION_ERROR",
        13: evaluation.UNFINISHED, 14: "TOOLCALL_TAG_UNCLOSED", 15: "MAX_ROUNDS_EXCEEDED",
    }


def test_no_success_gives_null_mean(spark):
    steps = spark.createDataFrame([step(1, 0, " ")], STEPS)
    row = evaluation.benchmark_summary(evaluation.timed_verdicts(steps)).first()
    assert (row.n_total, row.n_success, row.success_rate, row.mean_seconds) == (1, 0, 0.0, None)


def test_report(spark, tmp_path):
    steps = spark.createDataFrame([step(1, 0, " "), step(2, 0, "yes"), step(3, 0, CHECK, call="http_error")], STEPS)
    timed = evaluation.timed_verdicts(steps)
    path = str(tmp_path / "report")
    sinks.write_report(evaluation.benchmark_summary(timed), evaluation.error_breakdown(timed), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines[0] == "Total: 3" and lines[2] == "Success rate: (33.33 ± 27.22)%"
    assert lines[-2:] == ["  EMPTY_FINAL_ANSWER: 1", "  HTTP_ERROR: 1"]


EVENT_ROWS = [
    (1, "FileRead", "Finished", "finished", "11", 0.0, '{"site": "A_B", "size": 2.5, "flag": true}'),
    (2, "FileRead", "Started", "running", "11", 1.0, '{"site": "AxB", "size": "big", "gone": null}'),
    (3, "JobAllocation", "Started", "assigned", "12", 2.0, "not json"),
    (4, "JobExecution", "Finished", "running", "12", 3.0, '{"site": "a_b"}'),
    (5, "Other", "Finished", "finished", "13", 4.0, "{}"),
]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENT_ROWS, event_source.EVENTS_SCHEMA)


def ids(frame):
    return sorted(r._ID for r in frame.collect())


def test_metadata_matching(events):
    assert ids(events.where(meta_named("site", "A_b"))) == [1, 4]
    assert ids(events.where(meta_like("site", "_"))) == [1, 4]
    assert ids(events.where(meta_number("size") > 0)) == [1]
    assert ids(events.where(successful())) == [1, 3]
    assert ids(filters.scalar_equals(events, JOB_ID=11)) == [1, 2]
    assert ids(audits.malformed(events, "METADATA")) == [3]


def test_unpivot_keeps_json_form(events):
    rows = {(r._ID, r.key): r.json_value for r in filters.unpivot_json(events).where("key is not null").collect()}
    assert rows[(1, "size")] == "2.5" and rows[(1, "site")] == '"A_B"' and rows[(1, "flag")] == "true" and rows[(2, "gone")] == "null"
    assert rows[(2, "size")] == '"big"' and not any(k[0] == 3 for k in rows)


def test_layout_prunes_and_pushes(spark, events, tmp_path):
    path = str(tmp_path / "events")
    event_source.write_events(events, path)
    table = event_source.read_events(spark, path)
    assert ids(table) == [1, 2, 3, 4, 5]
    plan = filters.of_event(table, "FileRead").where("STATE = 'Finished'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(EVENT" in plan and "EqualTo(STATE,Finished)" in plan


def test_execute_sql_runs_template_statements(events):
    sql = "SELECT DISTINCT json_extract(METADATA, '$.site') AS site FROM EVENTS WHERE EVENT = 'FileRead' AND JOB_ID = 11 AND json_extract(METADATA, '$.site') IS NOT NULL;"
    assert sorted(r.site for r in inspection.execute_sql(events, sql).collect()) == ["A_B", "AxB"]
    with pytest.raises(ValueError):
        inspection.execute_sql(events, "DROP TABLE EVENTS")
    with pytest.raises(ValueError):
        inspection.dispatch(events, "check_Nothing")


def test_check_results_are_json(events):
    texts = {r.tool_name: json.loads(r.check_result) for r in inspection.check_results(events, 5).collect()}
    assert texts["check_JobAllocation"]["Example"] == [[3, "JobAllocation", "Started", "assigned", "12", 2.0, "not json"]]
    assert [f["Field"] for f in texts["check_All"]] == ["FileRead", "JobAllocation", "JobExecution"]


def test_numbered_lines_over_several_splits(spark, tmp_path):
    path = tmp_path / "lines.txt"
    wanted = [f"line {i} " + "x" * (i % 50) for i in range(1, 3001)]
    path.write_text("\n".join(wanted) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        numbered = jsonl.numbered_lines(spark, str(path))
        got = {r.line_no: r.line for r in numbered.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == dict(enumerate(wanted, start=1))


def test_tool_file(spark, tmp_path):
    path = tmp_path / "tools.jsonl"
    path.write_text(json.dumps({"tools": tools.default_tools()}) + "\n")
    names = [r.tool_name for r in tools.read_tools(spark, str(path)).collect()]
    assert names == vocab.TOOL_NAMES == [r.tool_name for r in tools.tool_catalog(spark).collect()]


def test_draws(spark):
    rows = spark.range(1000).withColumnRenamed("id", "qa_id")
    index = sorted(r.row_index for r in sampling.dense_index(rows, "qa_id").collect())
    assert index == list(range(1000))
    assert sampling.draw_with_replacement(rows, "qa_id", 77).count() == 77
    assert sampling.draw_with_replacement(rows.where("qa_id < 0"), "qa_id", 5).count() == 0


def test_amount_draws_records(spark, events):
    drawn = generation.lookup_questions(events, ["FileRead", "JobExecution"], amount=9)
    assert drawn.count() == 9
    assert generation.site_questions(events.withColumn("METADATA", F.lit('{"site": "S"}')), amount=4).count() == 4


def test_many_values_come_in_parts(spark):
    rows = [(i, "FileRead", "Finished", "finished", "7", 0.0, json.dumps({"file": f"f{i:03d}"})) for i in range(200)]
    frame = spark.createDataFrame(rows, event_source.EVENTS_SCHEMA)
    parts = generation.value_parts(frame, 20).orderBy("part").collect()
    assert len(parts) > 1
    values = json.loads("".join(p.text for p in parts))
    assert sorted(v[0] for v in values) == [f"f{i:03d}" for i in range(200)]


def test_streams_equal_batch(spark, tmp_path):
    schema = "qa_id int, raw_answer string"
    first = spark.createDataFrame([(1, "__ANSWER__ a"), (2, "no")], schema)
    second = spark.createDataFrame([(3, "__NULL_RESULT__"), (4, "__SQL_ERROR__")], schema)
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for rows in (first, second):
        jsonl.write_jsonl(rows, source)
        records = jobs.stream_jsonl(spark, source, first.schema)
        jobs.route_stream(records, out, state).awaitTermination()
    got = {r.qa_id: (r.route, r.answer) for r in spark.read.parquet(out).collect()}
    batch = {r.qa_id: (r.route, r.answer) for r in quality.route_answers(first.unionByName(second)).collect()}
    assert got == batch


def test_stream_counts_go_on_after_restart(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for errors in (["A", "B"], ["A", "A"]):
        rows = spark.createDataFrame([(e,) for e in errors], "error_type string")
        jsonl.write_jsonl(rows, source)
        jobs.count_errors_stream(jobs.stream_jsonl(spark, source, rows.schema), out, state).awaitTermination()
    assert {r.error_type: r.n for r in jobs.latest_counts(spark, out).collect()} == {"A": 3, "B": 1}


def test_asked_values_parse_metadata_once(spark):
    """Answers and results made from the values asked for equal those made from all events; each reads them from files."""
    texts = [
        '{"duration": 1.50, "disk": "d\\"1", "host": "x"}', '{"duration": "1.50", "disk": null}', '{"duration": 1.50}', "{bad",
        '{"duration": 2} tail', '{"duration": 1, "duration": 2}', '{"duration": "null", "disk": "null"}', '{"duration": [1, "a"]}', "[1]", None,
    ]
    jobs = ["7", "7", "7", "7", "8", "9", "9", "10", "10", None]
    rows = [(i, "FileRead", job, text) for i, (job, text) in enumerate(zip(jobs, texts))] * 2
    frame = spark.createDataFrame([*rows, (99, "Other", "7", '{"duration": 3}')], "_ID bigint, EVENT string, JOB_ID string, METADATA string")
    pairs = [("FileRead", job, key) for job in ("7", "8", "9", "10", "11") for key in ("duration", "disk")]
    asked = spark.createDataFrame([*pairs, pairs[0]], "EVENT string, JOB_ID string, key string")
    values = generation.asked_values(frame, asked, generation.ASKABLE)
    assert values.inputFiles()
    for one, other in (
        (generation.field_answers(frame, asked, generation.ASKABLE), generation.field_answers(frame, asked, values=values)),
        (generation.value_parts(frame, 2, asked), generation.value_parts(frame, 2, asked, values)),
    ):
        found = sorted(map(tuple, other.select(*one.columns).collect()))
        assert found == sorted(map(tuple, one.collect())) and found
