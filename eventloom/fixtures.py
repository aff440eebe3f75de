"""Views of the driver's tables in the shape the jobs expect.

One SQL text per view serves Spark and the DuckDB oracle; only the spelling of the
text type and of the JSON access differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPELLING = {
    "spark": {"@STR": "STRING", "@K": "get_json_object(props, '$.k')", "@EVENTS": "eventloom_events", "@LABELS": "eventloom_labels"},
    "duckdb": {"@STR": "VARCHAR", "@K": "json_extract_string(props, '$.k')", "@EVENTS": "events", "@LABELS": "labels"},
}

VIEWS = {
    "grid_events": """
SELECT event_id AS _ID,
 CASE event_type WHEN 'signup' THEN 'JobAllocation' WHEN 'error' THEN 'JobExecution' WHEN 'click' THEN 'FileRead'
  WHEN 'purchase' THEN 'FileWrite' ELSE 'FileTransfer' END AS EVENT,
 CASE WHEN event_id % 4 = 0 THEN 'Started' ELSE 'Finished' END AS STATE,
 CASE WHEN event_type = 'signup' THEN 'assigned' WHEN event_id % 4 = 0 THEN 'running' ELSE 'finished' END AS STATUS,
 CAST(2700000000 + user_id AS @STR) AS JOB_ID,
 CAST(event_id AS DOUBLE) * 60 AS TIME,
 CASE event_type
  WHEN 'signup' THEN '{"grid_cpu_util": ' || CAST(value AS @STR) || ', "host": "SITE_' || CAST(user_id % 20 AS @STR)
   || '_cpu-0", "site": "SITE_' || CAST(user_id % 20 AS @STR) || '"}'
  WHEN 'error' THEN '{"cores": ' || CAST(1 + user_id % 8 AS @STR) || ', "duration": ' || CAST(value AS @STR)
   || ', "total_queue_time": ' || json_k || ', "site": "SITE_' || CAST(user_id % 20 AS @STR) || '"}'
  WHEN 'view' THEN '{"bandwidth": ' || json_k || ', "duration": ' || CAST(value AS @STR) || ', "size": '
   || CAST(CAST(json_k AS BIGINT) * 1048576 AS @STR) || ', "source_site": "SITE_' || CAST(user_id % 20 AS @STR)
   || '", "destination_site": "SITE_' || CAST(event_id % 20 AS @STR) || '"}'
  ELSE '{"disk": "disk-' || CAST(user_id % 3 AS @STR) || '", ' || CASE WHEN event_id % 50 = 1 THEN ''
   ELSE '"duration": ' || CAST(value AS @STR) || ', ' END || '"site": "SITE_' || CAST(user_id % 20 AS @STR)
   || '", "size": ' || CAST(CAST(json_k AS BIGINT) * 1048576 AS @STR) || '}'
 END AS METADATA
FROM (SELECT *, @K AS json_k FROM @EVENTS) e""",
    "raw_lines": """
SELECT event_id AS line_no, CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN '{bad' WHEN 2 THEN '{"other": 1}'
 WHEN 3 THEN '{"user_question": ""}' ELSE '{"user_question": "q' || CAST(event_id AS @STR)
 || '", "reason_check": "r", "check_tool": "check_All"}' END AS line FROM @EVENTS""",
    "qa_records": """
SELECT event_id AS qa_id, event_id + 1 AS line_no,
 CASE WHEN event_id % 10 = 3 THEN 'For job ' || CAST(2700000000 + user_id AS @STR) || ', what happened?'
  WHEN event_type = 'signup' THEN 'Where was the allocation of job ' || CAST(2700000000 + user_id AS @STR) || ' placed?'
  WHEN event_type = 'error' THEN 'What was the execution time of job ' || CAST(2700000000 + user_id AS @STR) || '?'
  WHEN event_type = 'view' THEN 'Which transfer of job ' || CAST(2700000000 + user_id AS @STR) || ' was largest?'
  WHEN event_type = 'click' THEN 'How much did job ' || CAST(2700000000 + user_id AS @STR) || ' read?'
  ELSE 'Show the duration of write for job ' || CAST(2700000000 + user_id % 7 AS @STR) || '.' END AS user_question,
 CASE WHEN event_id % 10 = 3 THEN 'check_All' WHEN event_type = 'signup' THEN 'check_JobAllocation'
  WHEN event_type = 'error' THEN 'check_JobExecution' WHEN event_type = 'view' THEN 'check_FileTransfer'
  WHEN event_type = 'click' THEN 'check_FileRead' ELSE 'check_FileWrite' END AS check_tool,
 CASE WHEN event_id % 10 = 3 THEN 'The event type is not clear, so check_All should be used.'
  ELSE 'According to the question, this tool should be used.' END AS reason_check,
 CASE event_id % 3 WHEN 0 THEN 'Need filters and json_extract.' WHEN 1 THEN 'Need filters, grouping, and aggregation.'
  ELSE 'Need filters, sorting, and LIMIT. Need DISTINCT.' END AS reason_sql,
 CASE event_id % 5
  WHEN 0 THEN 'SELECT DISTINCT json_extract(METADATA, ''$.site'') AS site FROM EVENTS WHERE EVENT = ''FileRead'';'
  WHEN 1 THEN 'SELECT EVENT, COUNT(*) FROM EVENTS WHERE STATE = ''Finished'' GROUP BY EVENT ORDER BY COUNT(*) DESC LIMIT 3;'
  WHEN 2 THEN 'SELECT AVG(json_extract(METADATA, ''$.duration'')) FROM EVENTS WHERE json_extract(METADATA, ''$.site'') LIKE ''%site_4%'';'
  WHEN 3 THEN 'SELECT json_extract(METADATA, ''site'') FROM EVENTS WHERE json_extract(METADATA, ''$.nope'') = ''x'';'
  ELSE 'SELECT * FROM JOBS WHERE JOB_ID LIKE ''%27%'';' END AS sql,
 CASE event_id % 8 WHEN 0 THEN '__SQL_ERROR__' WHEN 1 THEN '__NULL_RESULT__' WHEN 2 THEN '__INCOMPLETE_RESULT__ site missing'
  WHEN 3 THEN 'no marker' WHEN 4 THEN ' __ANSWER__ leading blank'
  ELSE '__ANSWER__ The value is ''' || CAST(value AS @STR) || '''. ' END AS raw_answer
FROM @EVENTS""",
    "sql_results": """
SELECT qa_id, row_no, col_no, cell, CASE WHEN cell IS NULL THEN 'null' WHEN is_text THEN 'text' ELSE 'number' END AS kind FROM (
 SELECT event_id AS qa_id, 0 AS row_no, 0 AS col_no, CASE WHEN event_id % 6 = 1 THEN '0' WHEN event_id % 6 = 2 THEN NULL
  ELSE CAST(value AS @STR) END AS cell, event_id % 12 = 7 AS is_text FROM @EVENTS WHERE event_id % 6 <> 0
 UNION ALL SELECT event_id, 1, 0, CASE WHEN event_id % 6 = 4 THEN NULL ELSE '0' END, event_id % 12 = 11 FROM @EVENTS WHERE event_id % 6 >= 4) t""",
    "curation_decisions": """
SELECT doc_id + 1 AS line_no, CASE WHEN toxic = 1 THEN 'badquality' WHEN quality = 1 THEN 'ready2train'
 ELSE 'doublecheck' END AS decision FROM @LABELS""",
    "transcript_steps": """
SELECT CAST(floor(event_id / 4) AS BIGINT) AS conv_id, event_id % 4 AS step, value / 100 AS elapsed,
 CASE WHEN event_id % 41 = 5 THEN 'length' ELSE 'stop' END AS finish_reason,
 CASE WHEN event_id % 97 = 3 THEN 'http_error' ELSE 'ok' END AS call_status,
 CASE WHEN event_id % 43 = 7 THEN 'sql_error' ELSE 'ok' END AS tool_status,
 CASE WHEN event_id % 37 = 4 THEN '[]' WHEN event_id % 59 = 6 THEN '[["near miss"]]'
  ELSE '[["' || CAST(user_id AS @STR) || '"]]' END AS tool_result,
 CASE WHEN event_id % 53 = 9 THEN '<eot_id>'
  WHEN event_id % 4 = 3 AND event_id % 29 <> 0 THEN 'The answer is ''' || CAST(value AS @STR) || '''<eot_id>'
  WHEN event_id % 31 = 1 THEN 'think <TOOLCALL>[{"name": "check_All"}'
  WHEN event_id % 31 = 2 THEN 'think <TOOLCALL>[{"name": }]</TOOLCALL>'
  WHEN event_id % 31 = 3 THEN 'think <TOOLCALL>[]</TOOLCALL>'
  WHEN event_id % 31 = 4 THEN 'think <TOOLCALL>["check_All"]</TOOLCALL>'
  WHEN event_id % 31 = 5 THEN 'think <TOOLCALL>[{"arguments": {}}]</TOOLCALL>'
  WHEN event_id % 31 = 6 THEN 'think <TOOLCALL>[{"name": "check_Nothing", "arguments": {}}]</TOOLCALL>'
  WHEN event_id % 31 = 7 THEN 'think <TOOLCALL>[{"name": "drop_all", "arguments": {}}]</TOOLCALL>'
  WHEN event_id % 31 = 8 THEN 'think <TOOLCALL>[{"name": "execute_sql", "arguments": {}}]</TOOLCALL>'
  WHEN event_id % 4 = 2 THEN 'think <TOOLCALL>[{"arguments": {"sql": "SELECT 1"}, "name": "execute_sql"}]</TOOLCALL>'
  WHEN event_id % 4 = 1 AND event_id % 17 <> 0 THEN 'think <TOOLCALL>[{"name": "execute_sql", "arguments": {"sql": "SELECT '
   || CAST(user_id AS @STR) || '"}}]</TOOLCALL>'
  WHEN event_id % 4 = 3 THEN 'think <TOOLCALL>[{"name": "check_FileRead", "arguments": {"input": "NO_INPUT"}}]</TOOLCALL>'
  ELSE 'think <TOOLCALL>[{"name": "check_All", "arguments": {"input": "NO_INPUT"}}]</TOOLCALL>' END AS gen_text
FROM @EVENTS""",
    "only_sql_steps": """
SELECT CAST(floor(event_id / 2) AS BIGINT) AS conv_id, event_id % 2 AS step, value / 100 AS elapsed,
 CASE WHEN event_id % 41 < 2 THEN 'length' ELSE 'stop' END AS finish_reason,
 CASE WHEN event_id % 97 = 3 THEN 'http_error' WHEN event_id % 89 = 5 THEN 'parse_error' ELSE 'ok' END AS call_status,
 CASE WHEN event_id % 43 = 6 THEN 'sql_error' WHEN event_id % 47 = 6 THEN 'runtime_error' ELSE 'ok' END AS tool_status,
 CASE WHEN event_id % 37 = 4 THEN '[]' WHEN event_id % 59 = 6 THEN '[["near miss"]]'
  ELSE '[["' || CAST(user_id AS @STR) || '"]]' END AS tool_result,
 CASE WHEN event_id % 2 = 1 THEN CASE WHEN event_id % 53 = 9 THEN ' <eot_id>' ELSE 'It is ''' || CAST(value AS @STR) || '''.<eot_id>' END
  WHEN event_id % 53 = 10 THEN '<eot_id>SELECT 9'
  WHEN event_id % 6 = 0 THEN '```sql' || chr(10) || 'SELECT ' || CAST(user_id AS @STR) || ';' || chr(10) || '```<|eot_id|>'
  WHEN event_id % 6 = 2 THEN 'Here it is: select ' || CAST(user_id AS @STR) || ' <eot_id> tail'
  ELSE 'SELECT ' || CAST(user_id AS @STR) || ';' END AS gen_text
FROM @EVENTS""",
    "gold_records": """
SELECT CAST(floor(event_id / 4) AS BIGINT) AS conv_id,
 max(CASE WHEN event_id % 4 = 0 THEN CASE event_type WHEN 'click' THEN 'check_FileRead' ELSE 'check_All' END END) AS gold_tool,
 max(CASE WHEN event_id % 4 = 1 THEN 'SELECT ' || CAST(user_id AS @STR) END) AS gold_sql,
 max(CASE WHEN event_id % 4 = 3 THEN 'The answer is ''' || CAST(value AS @STR) || '''.' END) AS gold_answer
FROM @EVENTS GROUP BY CAST(floor(event_id / 4) AS BIGINT)""",
    "train_log": """
SELECT CAST(event_id * 10 AS BIGINT) AS step, CASE WHEN event_id % 2 = 0 THEN value END AS loss,
 CASE WHEN event_id % 2 = 1 THEN value END AS eval_loss FROM @EVENTS""",
}


def view_sql(name: str, dialect: str) -> str:
    text = VIEWS[name]
    for mark, spelling in _SPELLING[dialect].items():
        text = text.replace(mark, spelling)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it is."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the driver's tables."""
    source = "labels" if "@LABELS" in VIEWS[name] else "events"
    table(spark, sf_dir, source).createOrReplaceTempView(f"eventloom_{source}")
    return spark.sql(view_sql(name, "spark"))
