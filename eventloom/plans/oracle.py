"""The same results as plain SQL for DuckDB, written apart from the Spark jobs.

The fixture views become CTEs of each statement; the driver's tables are views there.
"""

from __future__ import annotations

from eventloom import vocab
from eventloom.fixtures import view_sql
from eventloom.functions.metadata import ALL_KEYS
from eventloom.operators import generation
from eventloom.sources.tools import tools_json

ORACLE: dict[str, str] = {}


def _with(views, body: str) -> str:
    parts = [f"{v} AS ({view_sql(v, 'duckdb')})" if isinstance(v, str) else f"{v[0]} AS ({v[1]})" for v in views]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def add(name: str, views, body: str) -> None:
    ORACLE[name] = _with(views, body)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def many(texts) -> str:
    return "[" + ", ".join(lit(t) for t in texts) + "]"


def index_of(seed: str, part: str, n) -> str:
    """A number in [0, n) from the first 60 bits of an md5."""
    return f"(('0x' || substr(md5({lit(seed + ':')} || {part}), 1, 15))::BIGINT % {n})"


def m(key: str, column: str = "METADATA") -> str:
    return f"json_extract_string({column}, '$.{key}')"


def num(key: str) -> str:
    return f"TRY_CAST({m(key)} AS DOUBLE)"


GE, QA, TS, OS, RAW, SR = "grid_events", "qa_records", "transcript_steps", "only_sql_steps", "raw_lines", "sql_results"
SUCCESSFUL = (
    "CASE WHEN EVENT IN ('FileRead','FileWrite','FileTransfer') THEN STATE = 'Finished' "
    "WHEN EVENT = 'JobExecution' THEN STATUS = 'finished' WHEN EVENT = 'JobAllocation' THEN STATUS = 'assigned' ELSE false END"
)
IS_OBJECT = "(json_valid({0}) AND TRY(json_type({0})) = 'OBJECT')"

# --- scans, sources, sinks --------------------------------------------------------
add("scan_events", [GE], "SELECT _ID, EVENT, STATE, STATUS, JOB_ID, TIME, METADATA FROM grid_events")
add(
    "table_columns", [GE],
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, count({c}) AS n_filled FROM grid_events"
        for i, c in enumerate(vocab.EVENT_COLUMNS)
    ),
)
_raw = [RAW, ("lines", f"SELECT line_no, line, {IS_OBJECT.format('line')} AS ok FROM raw_lines")]


def _guarded(key: str, text: str = "line", ok: str = "ok") -> str:
    return f"CASE WHEN {ok} THEN json_extract_string(CASE WHEN {ok} THEN {text} ELSE '{{}}' END, '$.{key}') END"


add(
    "read_jsonl", _raw,
    f"SELECT {_guarded('user_question')} AS user_question, {_guarded('reason_check')} AS reason_check, "
    f"{_guarded('check_tool')} AS check_tool, CASE WHEN NOT ok THEN line END AS corrupt_line FROM lines WHERE line <> ''",
)
add(
    "load_testcases", [*_raw, ("t", f"SELECT line_no, line, ok, {_guarded('user_question')} AS q FROM lines WHERE trim(line) <> ''")],
    "SELECT line_no, CASE WHEN ok AND coalesce(q, '') <> '' THEN q END AS user_question, line AS record, "
    "CASE WHEN NOT ok THEN 'bad_json' WHEN coalesce(q, '') = '' THEN 'missing_question' END AS reject_reason FROM t",
)
add(
    "tool_catalog", [QA],
    f"SELECT t.tool_name, CASE WHEN t.tool_name = 'execute_sql' THEN 'sql' ELSE 'input' END AS arguments, "
    f"count(q.qa_id) AS n_records FROM (SELECT unnest({many(vocab.TOOL_NAMES)}) AS tool_name) t "
    "LEFT JOIN qa_records q ON q.check_tool = t.tool_name GROUP BY 1, 2",
)
_QA_COLUMNS = "qa_id, line_no, user_question, check_tool, reason_check, reason_sql, sql, raw_answer"
add("write_jsonl", [QA], f"SELECT {_QA_COLUMNS} FROM qa_records")
add(
    "resume_from", [QA],
    "SELECT qa_id, line_no, user_question FROM qa_records WHERE line_no >= 499 AND NOT starts_with(raw_answer, '__ANSWER__')",
)
ROUTE = (
    "CASE WHEN raw_answer = '__SQL_ERROR__' THEN 'sql_error' WHEN starts_with(raw_answer, '__ANSWER__') THEN 'ready' "
    "WHEN starts_with(raw_answer, '__NULL_RESULT__') THEN 'null_answer' ELSE 'incomplete' END"
)
_ROUTED = (
    "routed",
    f"SELECT *, CASE route WHEN 'ready' THEN trim(substr(raw_answer, 11)) WHEN 'null_answer' THEN '__NULL_RESULT__' "
    "WHEN 'incomplete' THEN CASE WHEN starts_with(raw_answer, '__INCOMPLETE_RESULT__') THEN trim(raw_answer) "
    "ELSE '__INCOMPLETE_RESULT__ Answer format is not recognized.' END END AS answer, "
    "CASE WHEN route = 'incomplete' AND NOT starts_with(raw_answer, '__INCOMPLETE_RESULT__') THEN raw_answer END AS raw_answer_output "
    f"FROM (SELECT *, {ROUTE} AS route FROM qa_records)",
)
add("route_sink", [QA, _ROUTED], "SELECT qa_id, route, answer FROM routed")

# --- filters and projections ------------------------------------------------------
_ALL = "_ID, EVENT, STATE, STATUS, JOB_ID, TIME, METADATA"
add("filter_event", [GE], f"SELECT {_ALL} FROM grid_events WHERE EVENT = 'FileTransfer'")
add(
    "filter_scalar_eq", [GE],
    f"SELECT {_ALL} FROM grid_events WHERE JOB_ID = '2700000007' AND EVENT = 'FileRead' AND STATE = 'Finished' AND STATUS = 'finished'",
)
add("filter_meta_eq", [GE], f"SELECT _ID, EVENT, METADATA FROM grid_events WHERE {m('site')} = 'SITE_4'")
add("filter_meta_like", [GE], f"SELECT _ID, EVENT, METADATA FROM grid_events WHERE contains(lower({m('site')}), 'site_1')")
add("filter_meta_name", [GE], f"SELECT _ID, EVENT, METADATA FROM grid_events WHERE lower({m('site')}) = 'site_4'")
add("filter_meta_num_eq", [GE], f"SELECT _ID, JOB_ID, METADATA FROM grid_events WHERE {num('cores')} = 4")
add("filter_meta_present", [GE], f"SELECT _ID, EVENT FROM grid_events WHERE {m('duration')} IS NOT NULL")
add("filter_jobid_affinity", [GE], "SELECT _ID, JOB_ID FROM grid_events WHERE CAST(JOB_ID AS BIGINT) = 2700000007")
add("filter_success", [GE], f"SELECT _ID, EVENT, {SUCCESSFUL} AS is_success FROM grid_events")
add("filter_source_site", [GE], f"SELECT _ID, JOB_ID, STATE FROM grid_events WHERE EVENT = 'FileTransfer' AND {m('source_site')} = 'SITE_4'")
add("project_meta", [GE], f"SELECT _ID, JOB_ID, {m('total_queue_time')} AS total_queue_time FROM grid_events WHERE EVENT = 'JobExecution'")
add(
    "flatten_meta", [GE],
    "SELECT _ID, EVENT, JOB_ID, "
    + ", ".join(f"{m(k) if k in vocab.TEXT_KEYS else num(k)} AS {k}" for k in ALL_KEYS)
    + " FROM grid_events",
)
_LONG = (
    "long",
    "SELECT _ID, EVENT, JOB_ID, key, json_extract_string(METADATA, '$.' || key) AS value, "
    "CAST(json_extract(METADATA, '$.' || key) AS VARCHAR) AS json_value "
    "FROM (SELECT *, unnest(json_keys(METADATA)) AS key FROM grid_events)",
)
add("meta_unpivot", [GE, _LONG], "SELECT _ID, EVENT, JOB_ID, key, value FROM long")

# --- joins ------------------------------------------------------------------------
add(
    "semi_jobs", [GE],
    "SELECT _ID, JOB_ID FROM grid_events WHERE EVENT = 'JobExecution' AND JOB_ID IN "
    f"(SELECT JOB_ID FROM grid_events WHERE EVENT = 'FileTransfer' AND {num('size')} > 90 * 1048576.0)",
)
_PROFILE = (
    "profile",
    "SELECT JOB_ID, row_number() OVER (PARTITION BY JOB_ID ORDER BY EVENT, _ID) - 1 AS position, "
    "'''EVENT'': ' || EVENT AS event_text, '''STATE'': ' || STATE AS state_text, '''STATUS: ' || STATUS AS status_text, "
    "'''JOB_ID'': ' || JOB_ID AS job_text, '''TIME'': ' || CAST(TIME AS VARCHAR) AS time_text, "
    "'''META'': ' || METADATA AS meta_text FROM grid_events",
)
add("job_profile", [GE, _PROFILE], "SELECT * FROM profile")
add(
    "curate_by_decision", [QA, "curation_decisions"],
    "SELECT q.qa_id, q.line_no, d.decision, q.user_question FROM qa_records q JOIN curation_decisions d USING (line_no)",
)
_RANKED = (
    "ranked",
    f"SELECT *, list_position({many(vocab.SAMPLE_ORDER)}, EVENT) AS field_no, "
    "row_number() OVER (PARTITION BY EVENT ORDER BY md5('42:' || CAST(_ID AS VARCHAR)), _ID) AS sample_no FROM grid_events",
)


def _checks(n: int):
    columns = "[" + ", ".join(f'"{c}"' for c in vocab.EVENT_COLUMNS) + "]"
    example = (
        "'[' || CAST(_ID AS VARCHAR) || ', \"' || EVENT || '\", \"' || STATE || '\", \"' || STATUS || '\", \"' || JOB_ID || '\", ' "
        "|| CAST(TIME AS VARCHAR) || ', ' || METADATA || ']'"
    )
    one = (
        f"SELECT field_no, 'check_' || EVENT AS tool_name, '{{\"Field\": \"' || EVENT || '\", \"Columns\": {columns}, \"Example\": [' "
        f"|| string_agg({example}, ', ' ORDER BY sample_no) || ']}}' AS check_result FROM ranked WHERE sample_no <= {n} GROUP BY field_no, EVENT"
    )
    return [
        _RANKED,
        ("one_check", one),
        (
            "check_results",
            "SELECT tool_name, check_result FROM one_check UNION ALL "
            "SELECT 'check_All', '[' || string_agg(check_result, ', ' ORDER BY field_no) || ']' FROM one_check",
        ),
    ]


add(
    "attach_check_result", [GE, QA, *_checks(2)],
    "SELECT q.qa_id, q.check_tool, c.check_result FROM qa_records q LEFT JOIN check_results c ON c.tool_name = q.check_tool",
)
add(
    "attach_sql_result", [QA, SR],
    "SELECT q.qa_id, q.check_tool, r.row_no, r.col_no, r.cell, r.kind FROM qa_records q LEFT JOIN sql_results r USING (qa_id)",
)
add("attach_tools", [QA], "SELECT qa_id, 7 AS n_tools, 'execute_sql' AS last_tool FROM qa_records")

# --- aggregations -----------------------------------------------------------------
add(
    "group_stats", [GE],
    f"SELECT EVENT, STATE, count(*) AS n_events, count({num('duration')}) AS n_values, round(avg({num('duration')}), 6) AS avg_value, "
    f"min({num('duration')}) AS min_value, max({num('duration')}) AS max_value FROM grid_events GROUP BY EVENT, STATE",
)
add(
    "distinct_meta", [GE],
    f"SELECT DISTINCT JOB_ID, {m('destination_site')} AS value FROM grid_events WHERE EVENT = 'FileTransfer' AND {m('destination_site')} IS NOT NULL",
)
add("distinct_jobs", [GE], f"SELECT DISTINCT {m('site')} AS site, JOB_ID FROM grid_events WHERE EVENT = 'JobAllocation'")
add(
    "conditional_agg", [GE],
    "SELECT EVENT, count(*) AS n_events, count(*) FILTER (STATE = 'Finished') AS n_finished, count(*) FILTER (STATE = 'Started') AS n_started, "
    f"count(*) FILTER ({SUCCESSFUL}) AS n_successful, count(*) FILTER ({num('duration')} > 10) AS n_long FROM grid_events GROUP BY EVENT",
)
add(
    "avg_transfer_rate", [GE],
    f"SELECT JOB_ID, count(*) AS n_transfers, round(avg({num('size')} / nullif({num('duration')}, 0)), 3) AS mean_rate, "
    f"round(sum({num('size')}) / nullif(sum({num('duration')}), 0), 3) AS overall_rate FROM grid_events "
    f"WHERE EVENT = 'FileTransfer' AND STATE = 'Finished' AND {m('source_site')} = 'SITE_4' GROUP BY JOB_ID",
)
add(
    "rank_sites_read", [GE],
    f"SELECT {m('site')} AS site, sum({num('size')}) AS total_size, count(*) AS n_reads FROM grid_events "
    "WHERE EVENT = 'FileRead' AND STATE = 'Finished' GROUP BY 1 ORDER BY total_size DESC, site",
)
add(
    "job_queue_time", [GE],
    f"SELECT JOB_ID, sum({num('total_queue_time')}) AS total_queue_time, max({num('total_queue_time')}) AS longest_queue_time "
    "FROM grid_events WHERE EVENT = 'JobExecution' GROUP BY JOB_ID",
)


def _spent(event: str, key: str = "duration") -> str:
    return f"round(coalesce(sum(CASE WHEN EVENT = '{event}' THEN {num(key)} END), 0.0), 6)"


add(
    "job_time_breakdown",
    [
        GE,
        (
            "times",
            f"SELECT JOB_ID, {_spent('JobExecution')} AS execution_time, {_spent('JobExecution', 'total_queue_time')} AS queue_time, "
            f"{_spent('FileRead')} AS read_time, {_spent('FileWrite')} AS write_time, {_spent('FileTransfer')} AS transfer_time "
            "FROM grid_events GROUP BY JOB_ID",
        ),
    ],
    "SELECT *, CASE greatest(execution_time, queue_time, read_time, write_time, transfer_time) WHEN execution_time THEN 'execution' "
    "WHEN queue_time THEN 'queue' WHEN read_time THEN 'read' WHEN write_time THEN 'write' ELSE 'transfer' END AS dominant_stage FROM times",
)
add("site_frequencies", [GE], f"SELECT {m('site')} AS site, count(*) AS n_events FROM grid_events WHERE EVENT = 'JobAllocation' GROUP BY 1")
add(
    "curation_counts", [QA, "curation_decisions"],
    "SELECT 'total' AS list_name, count(*) AS n FROM qa_records UNION ALL SELECT decision, count(*) FROM curation_decisions GROUP BY 1",
)

# --- samples and draws ------------------------------------------------------------
for _key, _event in {
    "check_job_allocation": "JobAllocation", "check_file_transfer": "FileTransfer", "check_file_read": "FileRead",
    "check_file_write": "FileWrite", "check_job_execution": "JobExecution",
}.items():
    add(
        _key, [GE],
        f"SELECT EVENT AS Field, {_ALL} FROM grid_events WHERE EVENT = '{_event}' ORDER BY md5('42:' || CAST(_ID AS VARCHAR)), _ID LIMIT 5",
    )
add("check_all", [GE, _RANKED], f"SELECT field_no, EVENT AS Field, sample_no, {_ALL} FROM ranked WHERE sample_no <= 5")
add("union_checks", [GE, _RANKED], f"SELECT EVENT AS Field, {_ALL} FROM ranked WHERE sample_no <= 5")
add(
    "dispatch_tool", [GE, _RANKED],
    f"SELECT EVENT AS Field, {_ALL}, 'check_' || EVENT AS tool_name FROM ranked WHERE sample_no <= 3 UNION ALL "
    f"SELECT EVENT AS Field, {_ALL}, 'check_All' AS tool_name FROM ranked WHERE sample_no <= 3",
)
add("sample_jobs", [GE], "SELECT JOB_ID FROM (SELECT DISTINCT JOB_ID FROM grid_events) ORDER BY md5('42:' || JOB_ID), JOB_ID LIMIT 5")
add(
    "topk_metric", [GE],
    f"SELECT _ID, JOB_ID, {num('duration')} AS duration FROM grid_events WHERE EVENT = 'FileRead' AND STATE = 'Finished' "
    f"AND {num('duration')} IS NOT NULL ORDER BY duration DESC, _ID LIMIT 10",
)


def _draws(source: str, id_column: str, n: int):
    return [
        ("indexed", f"SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST({id_column} AS VARCHAR)), {id_column}) - 1 AS row_index FROM {source}"),
        (
            "draws",
            f"SELECT d AS draw_no, {index_of('42:draw', 'CAST(d AS VARCHAR)', f'(SELECT count(*) FROM {source})')} AS row_index "
            f"FROM range({n}) t(d)",
        ),
    ]


add("sample_with_replacement", [QA, *_draws("qa_records", "qa_id", 50)], "SELECT qa_id, draw_no FROM draws JOIN indexed USING (row_index)")
_BELOW = "CASE WHEN substr(md5('{0}:' || CAST(qa_id AS VARCHAR)), 1, 8) < '{1}' THEN '{2}' ELSE '{3}' END"
add("bernoulli_branch", [QA], f"SELECT qa_id, {_BELOW.format('42:vague', '19999999', 'vague', 'clear')} AS branch FROM qa_records")
add("train_test_split", [QA], f"SELECT qa_id, {_BELOW.format('42', '19999999', 'test', 'train')} AS split FROM qa_records")
add(
    "draw_event_type", [QA],
    f"SELECT qa_id, {many(vocab.EVENT_CHOICES)}[1 + {index_of('42:check', 'CAST(qa_id AS VARCHAR)', 6)}] AS check_tool, "
    f"1 + {index_of('42:rows', 'CAST(qa_id AS VARCHAR)', 3)} AS n_rows FROM qa_records",
)

# --- set operations ---------------------------------------------------------------
add(
    "partition_check", ["curation_decisions"],
    "SELECT d.doc_id + 1 AS line_no, count(c.line_no) AS n_lists FROM documents d LEFT JOIN curation_decisions c ON c.line_no = d.doc_id + 1 "
    "GROUP BY 1 HAVING count(c.line_no) <> 1",
)

# --- generation -------------------------------------------------------------------
_TEMPLATE_ROWS = []
for _event, _templates in vocab.LOOKUP_TEMPLATES.items():
    for _i, (_question, _clear, _alias) in enumerate(_templates):
        _reason = (
            f"According to '{vocab.EVENT_WORD[_event]}' in the question, check_{_event} should be used.\n"
            if _clear else "The event type is not clear, so check_All should be used.\n"
        )
        _not_null = "" if _event == "JobAllocation" else " AND json_extract(METADATA, '$.{field2}') IS NOT NULL"
        _statement = (
            "SELECT DISTINCT json_extract(METADATA, '$.{field2}') AS " + (_alias or "{field2}")
            + f" FROM EVENTS WHERE EVENT = '{_event}' AND JOB_ID = {{jobid}}{_not_null};"
        )
        _TEMPLATE_ROWS.append(
            f"({lit(_event)}, {_i}, {lit(_question)}, {lit(_statement)}, {lit(_reason)}, {lit('check_' + _event if _clear else 'check_All')})"
        )
_FIELD_ROWS = [
    f"({lit(e)}, {i}, {len(fields)}, {lit(f)}, {many(fields[f])})"
    for e, fields in vocab.SYNONYMS.items() for i, f in enumerate(fields)
]
_TEMPLATES = ("templates", f"SELECT * FROM (VALUES {', '.join(_TEMPLATE_ROWS)}) t(EVENT, template_no, question, statement, think1, tool1)")
_FIELDS = ("fields", f"SELECT * FROM (VALUES {', '.join(_FIELD_ROWS)}) t(EVENT, field_no, n_fields, field, phrases)")


def _lookups(kinds, per_job: int):
    where = "" if kinds is None else f" WHERE EVENT = '{kinds}'"
    return [
        _TEMPLATES,
        _FIELDS,
        (
            "asked",
            f"SELECT EVENT || ':' || JOB_ID || ':' || CAST(k AS VARCHAR) AS qa_id, EVENT, JOB_ID FROM "
            f"(SELECT DISTINCT EVENT, JOB_ID FROM grid_events{where}) p, range(1, {per_job + 1}) r(k)",
        ),
        (
            "chosen",
            "SELECT a.qa_id, a.EVENT, a.JOB_ID, f.field, "
            f"f.phrases[1 + {index_of('42:phrase', 'a.qa_id', 'len(f.phrases)')}] AS phrase, "
            "t.question AS question_template, t.statement AS sql_template, t.think1, t.tool1 FROM asked a "
            f"JOIN templates t ON t.EVENT = a.EVENT AND t.template_no = {index_of('42:template', 'a.qa_id', 3)} "
            f"JOIN fields f ON f.EVENT = a.EVENT AND f.field_no = {index_of('42:field', 'a.qa_id', 'f.n_fields')}",
        ),
        (
            "filled",
            "SELECT *, replace(replace(replace(question_template, '{field1}', phrase), '{field2}', field), '{jobid}', JOB_ID) AS question, "
            "replace(replace(replace(sql_template, '{field1}', phrase), '{field2}', field), '{jobid}', JOB_ID) AS sql FROM chosen",
        ),
        _LONG,
        (
            "answers",
            "SELECT EVENT, JOB_ID, key AS field, min(value) AS answer_value, count(DISTINCT value) AS n_values FROM long "
            "WHERE value IS NOT NULL GROUP BY ALL",
        ),
        (
            "answered",
            "SELECT f.*, a.answer_value, coalesce(a.n_values, 0) AS n_values, 'For job ''' || JOB_ID || ''', the ''' || phrase || "
            "''' is related to ''' || field || ''' in the ' || EVENT || ' record, and the value is ''' || a.answer_value || '''.' AS answer "
            "FROM filled f LEFT JOIN answers a USING (EVENT, JOB_ID, field)",
        ),
    ]


_RECORD = (
    "SELECT qa_id, question, sql, think1, 'Need filters, json_extract, and DISTINCT.' || chr(10) AS think2, tool1, "
    "'execute_sql' AS tool2, answer_value, n_values, answer FROM "
)
for _key, _event in {
    "qa_alloc_fields": "JobAllocation", "qa_transfer": "FileTransfer", "qa_read": "FileRead", "qa_write": "FileWrite",
    "qa_execution": "JobExecution",
}.items():
    add(_key, [GE, *_lookups(_event, 3)], _RECORD + "answered")
_SITES = [
    (
        "site_answers",
        f"SELECT {m('site')} AS site, min(JOB_ID) AS answer_value, count(DISTINCT JOB_ID) AS n_values FROM grid_events "
        "WHERE EVENT = 'JobAllocation' GROUP BY 1",
    ),
    (
        "site_asked",
        f"SELECT 'site:' || CAST(_ID AS VARCHAR) AS qa_id, {m('site')} AS site FROM grid_events WHERE EVENT = 'JobAllocation'",
    ),
    (
        "site_records",
        f"SELECT qa_id, replace({many(vocab.SITE_QUESTIONS)}[1 + {index_of('42:template', 'qa_id', 4)}], '{{site}}', site) AS question, "
        f"replace({lit(vocab.SITE_SQL)}, '{{site}}', site) AS sql, 'According to ''allocation'' in the question, check_JobAllocation should be used.' "
        "|| chr(10) AS think1, 'check_JobAllocation' AS tool1, answer_value, n_values, 'At site ''' || site || ''', the allocated job id is ''' "
        "|| answer_value || '''.' AS answer FROM site_asked JOIN site_answers USING (site)",
    ),
]
add("qa_alloc_jobid", [GE, *_SITES], _RECORD + "site_records")
add("union_generated", [GE, *_SITES, *_lookups(None, 1)], _RECORD + "site_records UNION ALL " + _RECORD + "answered")
add("fill_template", [GE, *_lookups(None, 1)], "SELECT qa_id, question, sql, think1 FROM filled")
add("answer_batch", [GE, *_lookups(None, 2)], "SELECT EVENT, JOB_ID, field, qa_id, answer_value, n_values FROM answered")
add(
    "synonym_dim", [GE, _FIELDS, _LONG],
    "SELECT f.EVENT, f.field AS key, f.phrase, coalesce(c.n, 0) AS n_events FROM (SELECT EVENT, field, unnest(phrases) AS phrase FROM fields) f "
    "LEFT JOIN (SELECT EVENT, key, count(*) AS n FROM long GROUP BY ALL) c ON c.EVENT = f.EVENT AND c.key = f.field",
)
add("template_tool_mix", [GE, *_lookups(None, 4)], "SELECT EVENT, tool1 AS tool_name, count(*) AS n_records FROM chosen GROUP BY ALL")
add(
    "render_prompts", [GE, QA, *_checks(1)],
    f"SELECT q.qa_id, replace(replace(replace(replace({lit(generation.SQL_PROMPT)}, '{{user_question}}', q.user_question), "
    "'{reason_check}', q.reason_check), '{check_tool}', q.check_tool), '{check_result}', coalesce(c.check_result, '[]')) AS prompt "
    "FROM qa_records q LEFT JOIN check_results c ON c.tool_name = q.check_tool",
)
add(
    "render_general_prompts", [GE, *_checks(1)],
    f"SELECT DISTINCT {m('site')} AS site, replace(replace(CASE WHEN substr(md5('42:vague:' || {m('site')}), 1, 8) < '19999999' "
    f"THEN {lit(generation.VAGUE_GENERAL_PROMPT)} ELSE {lit(generation.GENERAL_PROMPT)} END, '{{site}}', {m('site')}), '{{check_result}}', "
    "(SELECT check_result FROM check_results WHERE tool_name = 'check_All')) AS prompt "
    f"FROM grid_events WHERE EVENT = 'JobAllocation' AND {m('site')} IS NOT NULL",
)
_RESULT_TEXT = (
    "result_text",
    "SELECT qa_id, '[' || string_agg('[' || CASE kind WHEN 'null' THEN 'null' WHEN 'text' THEN '\"' || cell || '\"' ELSE cell END || ']', ', ' ORDER BY row_no) || ']' AS text "
    "FROM sql_results GROUP BY qa_id",
)
add(
    "render_answer_prompts", [QA, SR, _RESULT_TEXT],
    f"SELECT q.qa_id, 0 AS part, replace(replace({lit(generation.ANSWER_PROMPT)}, '{{user_question}}', q.user_question), '{{sql}}', q.sql) "
    "|| coalesce(r.text, '[]') AS prompt FROM qa_records q LEFT JOIN result_text r USING (qa_id)",
)
add(
    "render_job_prompts",
    [GE, _PROFILE, (
        "parts",
        "SELECT JOB_ID, position // 200 AS part, string_agg('[' || event_text || ', ' || meta_text || ']', ', ' ORDER BY position) AS rows "
        "FROM profile GROUP BY ALL",
    )],
    "SELECT JOB_ID, part, CASE WHEN part = 0 THEN replace(CASE WHEN substr(md5('42:vague:' || JOB_ID), 1, 8) < '19999999' "
    f"THEN {lit(generation.VAGUE_QUESTION_PROMPT)} ELSE {lit(generation.QUESTION_PROMPT)} END, '{{jobid}}', JOB_ID) ELSE ', ' END || rows AS prompt FROM parts",
)
add(
    "merge_records", [QA],
    "SELECT qa_id, user_question, check_tool, CASE WHEN qa_id % 2 = 0 THEN reason_sql END AS reason, sql FROM qa_records",
)

# --- validation and routing -------------------------------------------------------
add(
    "validate_reply",
    [*_raw, ("k", "SELECT line_no, CASE WHEN ok THEN json_keys(CASE WHEN ok THEN line ELSE '{}' END) ELSE CAST([] AS VARCHAR[]) END AS keys FROM lines")],
    f"SELECT line_no, len(list_filter({many(vocab.QUESTION_KEYS)}, lambda x: NOT list_contains(keys, x))) = 0 AS valid, "
    f"array_to_string(list_filter({many(vocab.QUESTION_KEYS)}, lambda x: NOT list_contains(keys, x)), ',') AS missing_keys FROM k",
)
add(
    "result_quality", [QA, SR],
    "SELECT qa_id, reason IS NULL AS accepted, reason AS reject_reason FROM (SELECT q.qa_id, CASE WHEN q.qa_id % 17 = 3 THEN 'query_error' WHEN count(r.qa_id) = 0 THEN 'empty' "
    "WHEN count(r.qa_id) = 1 AND max(r.kind) = 'number' AND TRY_CAST(max(r.cell) AS DOUBLE) = 0 THEN 'zero' WHEN count(r.cell) = 0 THEN 'all_null' END AS reason "
    "FROM qa_records q LEFT JOIN sql_results r USING (qa_id) GROUP BY q.qa_id)",
)
add(
    "flag_zero_results", [QA, SR],
    "SELECT q.qa_id, coalesce(count(r.qa_id) = 1 AND TRY_CAST(max(CASE WHEN r.col_no = 0 AND r.kind = 'number' THEN r.cell END) AS DOUBLE) = 0, false) AS flagged "
    "FROM qa_records q LEFT JOIN sql_results r USING (qa_id) GROUP BY q.qa_id",
)
add(
    "expected_marker",
    [QA, SR, (
        "e",
        f"SELECT q.qa_id, any_value({ROUTE}) AS route, CASE WHEN count(r.qa_id) = 0 OR count(*) FILTER (r.cell IS NULL OR lower(r.cell) IN ('null', 'none')) > 0 "
        "THEN '__NULL_RESULT__' ELSE '__ANSWER__' END AS expected_marker FROM qa_records q LEFT JOIN sql_results r USING (qa_id) GROUP BY q.qa_id",
    )],
    "SELECT qa_id, expected_marker, route, (expected_marker = '__ANSWER__' AND route = 'ready') OR "
    "(expected_marker = '__NULL_RESULT__' AND route = 'null_answer') AS agrees FROM e",
)
add("route_answers", [QA, _ROUTED], "SELECT qa_id, route, answer, raw_answer_output FROM routed")
add("stream_route", [QA, _ROUTED], "SELECT qa_id, route, answer FROM routed")
add(
    "strip_answer", [QA],
    "SELECT qa_id, trim(substr(raw_answer, strpos(raw_answer, '__ANSWER__') + 10)) AS answer FROM qa_records WHERE contains(raw_answer, '__ANSWER__')",
)
IS_EMPTY = "tool_result = '[]'"
LOOKS_BAD = "regexp_matches(lower(tool_result), 'no such column|no such table|syntax error|operationalerror|sqlite error|ambiguous column|misuse of aggregate|near ')"
add("is_empty_result", [TS], f"SELECT conv_id, step, {IS_EMPTY} AS is_empty FROM transcript_steps")
add(
    "looks_like_error", [TS],
    f"SELECT conv_id, step, CASE WHEN {LOOKS_BAD} THEN 'near ' END AS found, {LOOKS_BAD} AS looks_like_error FROM transcript_steps",
)
add(
    "capture_errors", [TS],
    "SELECT conv_id, step, CASE WHEN tool_status <> 'ok' THEN tool_status END AS sql_error, CASE WHEN tool_status = 'ok' AND call_status <> 'ok' "
    "THEN call_status END AS answer_error, CASE WHEN tool_status <> 'ok' THEN tool_result ELSE gen_text END AS message, gen_text FROM transcript_steps WHERE tool_status <> 'ok' OR call_status <> 'ok'",
)
_CLEAN = [
    OS,
    ("cut", "SELECT *, trim(split_part(split_part(gen_text, '<eot_id>', 1), '<|eot_id|>', 1), ' ' || chr(10)) AS body FROM only_sql_steps"),
    (
        "unfenced",
        "SELECT *, CASE WHEN starts_with(body, '```') THEN trim(regexp_replace(regexp_replace(body, '^```[^\\n]*\\n?', ''), '\\n```[^\\n]*$', ''), ' ' || chr(10)) ELSE body END AS plain FROM cut",
    ),
    (
        "cleaned",
        "SELECT *, CASE WHEN strpos(upper(plain), 'SELECT') > 0 THEN substr(plain, strpos(upper(plain), 'SELECT')) ELSE plain END AS clean FROM unfenced",
    ),
]
add("clean_sql", _CLEAN, "SELECT conv_id, step, clean AS sql FROM cleaned")

# --- conversations ----------------------------------------------------------------


def _messages(source: str, conv_type: str = "BIGINT"):
    """Seven message rows per record of ``source`` (conv_id, question, think1, tool1, think2, sql, answer, check_result, text)."""

    def row(turn, role, content, tool="NULL", arguments="NULL"):
        return (
            f"SELECT conv_id, CAST({turn} AS BIGINT) AS seq, CAST({turn} AS BIGINT) AS turn, '{role}' AS role, {content} AS content, "
            f"CAST({tool} AS VARCHAR) AS tool_name, CAST({arguments} AS VARCHAR) AS tool_args, "
            f"{lit(tools_json()) if turn == 0 else 'CAST(NULL AS VARCHAR)'} AS tools, true AS opens, true AS closes FROM {source}"
        )

    return (
        "messages",
        " UNION ALL ".join(
            [
                row(0, "system", lit(vocab.SYSTEM_MESSAGE)),
                row(1, "user", "question"),
                row(2, "assistant", "think1", "tool1", "'{\"input\": \"NO_INPUT\"}'"),
                row(3, "tool", "check_result"),
                row(4, "assistant", "think2", "'execute_sql'", "'{\"sql\": ' || CAST(to_json(sql) AS VARCHAR) || '}'"),
                row(5, "tool", "text"),
                row(6, "assistant", "answer"),
            ]
        ),
    )


def _model(think1: str, think2: str):
    return [
        GE, QA, SR, *_checks(1), _ROUTED, _RESULT_TEXT,
        (
            "base",
            f"SELECT q.qa_id AS conv_id, q.user_question AS question, {think1} AS think1, q.check_tool AS tool1, {think2} AS think2, q.sql, q.answer, "
            "c.check_result, coalesce(r.text, '[]') AS text FROM routed q LEFT JOIN check_results c ON c.tool_name = q.check_tool "
            "LEFT JOIN result_text r ON r.qa_id = q.qa_id",
        ),
        _messages("base"),
    ]


add("assemble_llm", _model("q.reason_check", "q.reason_sql"), "SELECT * FROM messages")
add("assemble_no_reasoning", _model("''", "''"), "SELECT * FROM messages")
add(
    "assemble_structured",
    [
        GE, *_checks(1), *_lookups(None, 1),
        (
            "value_text",
            "SELECT EVENT, JOB_ID, key AS field, '[' || string_agg('[' || json_value || ']', ', ' ORDER BY json_value) || ']' AS text FROM "
            "(SELECT DISTINCT EVENT, JOB_ID, key, json_value FROM long WHERE json_value <> 'null') GROUP BY ALL",
        ),
        (
            "base",
            "SELECT a.qa_id AS conv_id, a.question, a.think1, a.tool1, 'Need filters, json_extract, and DISTINCT.' || chr(10) AS think2, a.sql, a.answer, "
            "c.check_result, coalesce(v.text, '[]') AS text FROM answered a LEFT JOIN check_results c ON c.tool_name = a.tool1 "
            "LEFT JOIN value_text v ON v.EVENT = a.EVENT AND v.JOB_ID = a.JOB_ID AND v.field = a.field",
        ),
        _messages("base"),
    ],
    "SELECT * FROM messages",
)


def _five(turn: int, role: str, content: str) -> str:
    return (
        f"SELECT q.qa_id AS conv_id, CAST({turn} AS BIGINT) AS seq, CAST({turn} AS BIGINT) AS turn, '{role}' AS role, {content} AS content, "
        "CAST(NULL AS VARCHAR) AS tool_name, CAST(NULL AS VARCHAR) AS tool_args, CAST(NULL AS VARCHAR) AS tools, true AS opens, true AS closes "
        "FROM routed q LEFT JOIN result_text r ON r.qa_id = q.qa_id"
    )


add(
    "assemble_only_sql", [QA, SR, _ROUTED, _RESULT_TEXT],
    " UNION ALL ".join(
        [
            _five(0, "system", lit(vocab.SYSTEM_MESSAGE)), _five(1, "user", "q.user_question"), _five(2, "assistant", "q.sql"),
            _five(3, "tool", "coalesce(r.text, '[]')"), _five(4, "assistant", "q.answer"),
        ]
    ),
)
add(
    "implode_messages", [],
    "SELECT conv_id, turn // 4096 AS block_no, count(*) AS n_messages, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text "
    "FROM conversations GROUP BY ALL",
)
add(
    "explode_messages", [],
    "SELECT conv_id, turn, role, text AS content FROM conversations",
)
_HEAD, _TAIL = "'<|start_header_id|>' || {0} || '<|end_header_id|>' || chr(10) || chr(10) || ", " || '<|eot_id|>'"
_RENDERED = ("rendered", f"SELECT conv_id, turn AS seq, role, {_HEAD.format('role')}text{_TAIL} AS segment FROM conversations")
add("render_conversation", [_RENDERED], "SELECT conv_id, seq // 4096 AS block_no, string_agg(segment, '' ORDER BY seq) AS text FROM rendered GROUP BY ALL")

# --- tokens, masks, weights -------------------------------------------------------
TOKENS = "regexp_extract_all(segment, '(?s)<\\|[a-z_]+\\|>|[A-Za-z0-9_]+|[ \\t\\r\\n]+|.')"
_TOKENISED = (
    "tokens",
    "SELECT conv_id, seq, role, i - 1 AS i, token, row_number() OVER (PARTITION BY conv_id ORDER BY seq, i) - 1 AS pos, "
    "sum(length(token)) OVER (PARTITION BY conv_id ORDER BY seq, i) AS end_char FROM "
    f"(SELECT conv_id, seq, role, unnest({TOKENS}) AS token, generate_subscripts({TOKENS}, 1) AS i FROM rendered)",
)
add("tokenize", [_RENDERED, _TOKENISED], "SELECT conv_id, pos, token FROM tokens")
add(
    "token_offsets", [_RENDERED, _TOKENISED],
    "SELECT conv_id, pos, token, CAST(end_char - length(token) AS BIGINT) AS start_char, CAST(end_char AS BIGINT) AS end_char FROM tokens",
)
add(
    "truncate_tokens", [_RENDERED, _TOKENISED],
    "SELECT conv_id, seq, count(*) AS n_kept, string_agg(token, '' ORDER BY pos) AS kept_text FROM tokens WHERE pos < 256 GROUP BY ALL",
)
_LEADS = (
    "leads",
    "SELECT *, lead(token, 1) OVER w AS t1, lead(token, 2) OVER w AS t2, lead(token, 3) OVER w AS t3 FROM tokens WINDOW w AS (PARTITION BY conv_id ORDER BY pos)",
)
add(
    "find_subsequence", [_RENDERED, _TOKENISED, _LEADS],
    "SELECT conv_id, pos AS start FROM leads WHERE token = '<|eot_id|>' AND t1 = '<|start_header_id|>' AND t2 = 'assistant' AND t3 = '<|end_header_id|>'",
)


def _masked(limit: str | None = None):
    """Label state of every token, or of those before ``limit``: learned from an assistant header to the next end tag."""
    w = "(PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = "(PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = "(PARTITION BY conv_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return [
        ("cut", f"SELECT * FROM tokens WHERE pos < {limit}" if limit else "SELECT * FROM tokens"),
        (
            "tagged",
            "SELECT *, CASE WHEN token = '<|end_header_id|>' AND lag(token, 1) OVER o = 'assistant' AND lag(token, 2) OVER o = '<|start_header_id|>' "
            "THEN pos + 1 END AS opens_at, CASE WHEN token = '<|eot_id|>' THEN pos END AS eot_at, "
            "CASE WHEN token = '<' AND lead(token, 1) OVER o = 'TOOL_RESPONSE' AND lead(token, 2) OVER o = '>' THEN pos END AS tr_open, "
            "CASE WHEN token = '>' AND lag(token, 1) OVER o = 'TOOL_RESPONSE' AND lag(token, 2) OVER o = '/' AND lag(token, 3) OVER o = '<' "
            "THEN pos END AS tr_close FROM cut WINDOW o AS (PARTITION BY conv_id ORDER BY pos)",
        ),
        (
            "state",
            f"SELECT *, max(opens_at) OVER {before} AS last_open, coalesce(max(eot_at) OVER {before}, -1) AS last_eot, max(eot_at) OVER {after} AS next_eot, "
            f"max(tr_open) OVER {w} AS last_tr, coalesce(max(tr_close) OVER {before}, -1) AS last_tr_close, max(tr_close) OVER {after} AS next_tr FROM tagged",
        ),
        (
            "labelled",
            "SELECT *, coalesce(last_open > last_eot AND next_eot IS NOT NULL, false) AND NOT coalesce(last_tr > last_tr_close AND next_tr IS NOT NULL, false) "
            "AS trained FROM state",
        ),
    ]


TOKEN_ID = "('0x' || substr(md5(token), 1, 15))::BIGINT"
LABEL = f"CASE WHEN trained THEN {TOKEN_ID} ELSE -100 END"
add(
    "label_mask", [_RENDERED, _TOKENISED, *_masked()],
    f"SELECT conv_id, seq, string_agg(CAST({LABEL} AS VARCHAR), ' ' ORDER BY pos) AS labels FROM labelled GROUP BY conv_id, seq",
)
add(
    "mask_unclosed", [_RENDERED, _TOKENISED, *_masked("256")],
    "SELECT conv_id, seq, count(*) AS n_kept, count(*) FILTER (trained) AS n_trained FROM labelled GROUP BY conv_id, seq",
)
_QUOTED = (
    "rendered",
    "SELECT conv_id, turn AS seq, role, "
    + _HEAD.format("role")
    + "'Seen: <TOOL_RESPONSE>' || text || CASE WHEN turn % 3 = 0 THEN '' ELSE '</TOOL_RESPONSE>' END || ' so ' || text"
    + _TAIL
    + " AS segment FROM conversations",
)
add(
    "mask_tool_response", [_QUOTED, _TOKENISED, *_masked()],
    "SELECT conv_id, seq, string_agg(CASE WHEN trained THEN '1' ELSE '0' END, '' ORDER BY pos) AS trained FROM labelled GROUP BY conv_id, seq",
)
add(
    "masked_view", [_RENDERED, _TOKENISED, *_masked()],
    f"SELECT conv_id, seq, string_agg(CASE WHEN trained THEN token ELSE {lit(vocab.PLACEHOLDER)} END, '' ORDER BY pos) AS shown FROM labelled GROUP BY conv_id, seq",
)
_LENGTHS = ("lengths", "SELECT conv_id, count(*) AS n_tokens FROM tokens GROUP BY conv_id")
_LIMIT = ("max_len", "SELECT max(n_tokens) AS longest, least(CAST(ceil(max(n_tokens) / 1024.0) * 1024 AS BIGINT), 8192) AS max_length FROM lengths")
add(
    "length_stats", [_RENDERED, _TOKENISED, _LENGTHS],
    "SELECT count(*) AS n_conversations, min(n_tokens) AS shortest, max(n_tokens) AS longest, count(DISTINCT n_tokens) AS distinct_lengths FROM lengths",
)
add("rounded_max_length", [_RENDERED, _TOKENISED, _LENGTHS, _LIMIT], "SELECT longest, max_length FROM max_len")
add(
    "mask_ratio", [_RENDERED, _TOKENISED, *_masked()],
    "SELECT conv_id, count(*) AS n_tokens, count(*) FILTER (trained) AS n_trained, round(count(*) FILTER (trained) / count(*), 6) AS ratio FROM labelled GROUP BY conv_id",
)
_CALL = "CASE WHEN tool_name IS NOT NULL THEN '<TOOLCALL>[{\"name\": \"' || tool_name || '\", \"arguments\": ' || tool_args || '}]</TOOLCALL>' ELSE '' END"
_RENDERED_MESSAGES = (
    "rendered",
    "SELECT conv_id, seq, role, " + _HEAD.format("CASE WHEN role = 'tool' THEN 'user' ELSE role END")
    + "CASE WHEN role = 'tool' THEN '<TOOL_RESPONSE>' ELSE '' END || coalesce('<TOOLS>' || tools || '</TOOLS>' || chr(10) || chr(10), '') "
    + "|| coalesce(content, '') || " + _CALL
    + " || CASE WHEN role = 'tool' THEN '</TOOL_RESPONSE>' ELSE '' END" + _TAIL + " AS segment FROM messages",
)
add(
    "render_tool_conversation", [*_model("q.reason_check", "q.reason_sql"), _RENDERED_MESSAGES],
    "SELECT conv_id, seq // 4096 AS block_no, md5(string_agg(segment, '' ORDER BY seq)) AS text_hash, CAST(sum(length(segment)) AS INTEGER) AS n_chars "
    "FROM rendered GROUP BY ALL",
)


def _weights():
    w = "(PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = "(PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    after = "(PARTITION BY conv_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    starts = (
        "token LIKE '%json_extract' AND lead(token, 1) OVER o = '(' AND lead(token, 2) OVER o = 'METADATA' AND lead(token, 3) OVER o = ',' "
        "AND lead(token, 4) OVER o = ' ' AND lead(token, 5) OVER o = '''' AND lead(token, 6) OVER o = '$' AND lead(token, 7) OVER o = '.'"
    )
    return [
        (
            "marked",
            f"SELECT *, CASE WHEN {starts} THEN pos END AS call_open, CASE WHEN token = ')' THEN pos END AS call_close, "
            "coalesce((token = '$' AND lead(token, 1) OVER o = '.') OR (token = '.' AND lag(token, 1) OVER o = '$'), false) AS mark "
            "FROM tokens WINDOW o AS (PARTITION BY conv_id ORDER BY pos)",
        ),
        (
            "in_calls",
            f"SELECT conv_id, pos, mark, coalesce(max(call_open) OVER {w} > coalesce(max(call_close) OVER {before}, -1) "
            f"AND max(call_close) OVER {after} IS NOT NULL, false) AS in_call FROM marked",
        ),
        *_masked(),
        (
            "weighted",
            "SELECT l.conv_id, l.seq, l.pos, l.token, l.trained, CASE WHEN NOT l.trained THEN 0 WHEN c.calls IS NULL THEN 1 WHEN k.mark THEN 20 WHEN k.in_call THEN 2 ELSE 1 END AS weight "
            "FROM labelled l JOIN in_calls k USING (conv_id, pos) LEFT JOIN sql_callers c USING (conv_id)",
        ),
    ]


_CALLERS = ("sql_callers", "SELECT DISTINCT conv_id, true AS calls FROM messages WHERE role = 'assistant' AND tool_name = 'execute_sql'")
_MODEL_WEIGHTS = [
    *_model("q.reason_check", "q.reason_sql"), _RENDERED_MESSAGES, _TOKENISED, _CALLERS,
    *_weights(),
]
add(
    "loss_weights", _MODEL_WEIGHTS,
    "SELECT conv_id, seq, string_agg(CAST(weight AS VARCHAR), ' ' ORDER BY pos) AS weights FROM weighted GROUP BY conv_id, seq",
)
add(
    "weight_stats", _MODEL_WEIGHTS,
    "SELECT conv_id, count(*) AS n_tokens, count(*) FILTER (weight > 1) AS n_raised, CAST(max(weight) AS DOUBLE) AS max_weight, "
    "round(sum(weight) / nullif(count(*) FILTER (weight > 0), 0), 6) AS mean_weight FROM weighted GROUP BY conv_id",
)
_NO_CALLERS = ("sql_callers", "SELECT NULL::BIGINT AS conv_id, true AS calls WHERE false")


def _padded(text: str, filler: str) -> str:
    return f"{text} || repeat(' {filler}', width - n)"


add(
    "pad_batches",
    [
        _RENDERED, _TOKENISED, _NO_CALLERS, *_weights(),
        (
            "per_conv",
            f"SELECT conv_id, count(*) AS n, string_agg(CAST({TOKEN_ID} AS VARCHAR), ' ' ORDER BY pos) AS ids, "
            f"string_agg(CAST({LABEL} AS VARCHAR), ' ' ORDER BY pos) AS labs, string_agg(CAST(weight AS VARCHAR), ' ' ORDER BY pos) AS ws FROM weighted GROUP BY conv_id",
        ),
        (
            "batches",
            "SELECT *, (row_number() OVER (ORDER BY md5('42:' || CAST(conv_id AS VARCHAR)), conv_id) - 1) // 4 AS batch_no FROM per_conv",
        ),
        ("sized", "SELECT *, max(n) OVER (PARTITION BY batch_no) AS width FROM batches"),
    ],
    f"SELECT batch_no, conv_id, width, {_padded('ids', '0')} AS input_ids, {_padded(chr(39) + '1' + chr(39) + ' || repeat(' + chr(39) + ' 1' + chr(39) + ', n - 1)', '0')} AS attention_mask, "
    f"{_padded('labs', '-100')} AS labels, {_padded('ws', '0')} AS loss_weights FROM sized",
)
_GAPS = (
    "pieces",
    "SELECT qa_id, unnest(string_split(sql, '$.')) AS gap, generate_subscripts(string_split(sql, '$.'), 1) AS i, len(string_split(sql, '$.')) AS n FROM qa_records",
)
add(
    "find_spans", [QA, _GAPS],
    "SELECT qa_id, CAST(start_char AS BIGINT) AS start_char, CAST(start_char + 2 AS BIGINT) AS end_char FROM (SELECT qa_id, i, n, "
    "sum(length(gap)) OVER (PARTITION BY qa_id ORDER BY i) + 2 * (i - 1) AS start_char FROM pieces) WHERE i < n",
)
_CALL_RE = "'json_extract\\(METADATA, ''\\$\\.[^)]*\\)'"
add(
    "json_extract_spans",
    [QA, (
        "found",
        f"SELECT qa_id, sql, unnest(regexp_extract_all(sql, {_CALL_RE})) AS hit, generate_subscripts(regexp_extract_all(sql, {_CALL_RE}), 1) AS i FROM qa_records",
    ), (
        "gaps",
        f"SELECT qa_id, unnest(regexp_split_to_array(sql, {_CALL_RE})) AS gap, generate_subscripts(regexp_split_to_array(sql, {_CALL_RE}), 1) AS i FROM qa_records",
    )],
    "SELECT qa_id, CAST(end_char - length(hit) AS BIGINT) AS start_char, CAST(end_char AS BIGINT) AS end_char FROM (SELECT f.qa_id, f.hit, "
    "sum(length(g.gap) + length(f.hit)) OVER (PARTITION BY f.qa_id ORDER BY f.i) AS end_char FROM found f JOIN gaps g ON g.qa_id = f.qa_id AND g.i = f.i)",
)
add(
    "loss_curve", ["train_log"],
    "SELECT 'train' AS series, step, loss AS value FROM train_log WHERE loss IS NOT NULL UNION ALL "
    "SELECT 'eval', step, eval_loss FROM train_log WHERE eval_loss IS NOT NULL",
)
_SENTENCES = "trim(regexp_replace(unnest(regexp_split_to_array(lower(text), '[.!?\\n]+')), '[ \\t\\r]+', ' ', 'g'))"
add(
    "leakage_check",
    [
        ("trained", f"SELECT DISTINCT doc_id, {_SENTENCES} AS sentence FROM documents"),
        ("tested", f"SELECT DISTINCT {_SENTENCES} AS sentence FROM benchmark"),
    ],
    "SELECT doc_id, count(*) AS n_shared FROM trained WHERE sentence <> '' AND sentence IN (SELECT sentence FROM tested) GROUP BY doc_id",
)

# --- evaluation -------------------------------------------------------------------
_PARSED = [
    TS,
    (
        "located",
        "SELECT *, strpos(gen_text, '<TOOLCALL>[') AS s, strpos(gen_text, ']</TOOLCALL>') AS e FROM transcript_steps",
    ),
    (
        "cut_calls",
        "SELECT *, s > 0 AS has_call, s > 0 AND e > s AS closed, CASE WHEN s > 0 AND e > s THEN substr(gen_text, s + 10, e - s - 9) END AS calls FROM located",
    ),
    ("valid_calls", "SELECT *, coalesce(json_valid(calls), false) AS ok FROM cut_calls"),
    (
        "first_call",
        "SELECT *, CASE WHEN ok THEN json_extract(CASE WHEN ok THEN calls ELSE '[]' END, '$[0]') END AS call FROM valid_calls",
    ),
    (
        "parsed",
        "SELECT *, CASE WHEN s > 0 THEN substr(gen_text, 1, s - 1) ELSE gen_text END AS reasoning, json_type(call) AS kind, "
        "json_extract_string(call, '$.name') AS tool_name, json_extract_string(call, '$.arguments.sql') AS sql FROM first_call",
    ),
]
_CALL_FORM = (
    "CASE WHEN NOT has_call THEN NULL WHEN NOT closed THEN 'TOOLCALL_TAG_UNCLOSED' WHEN NOT ok THEN 'TOOLCALL_JSON_ERROR' "
    "WHEN kind IS NULL THEN 'EMPTY_TOOLCALL' WHEN kind <> 'OBJECT' THEN 'TOOLCALL_NOT_DICT' END"
)
_NO_NAME = "CASE WHEN kind = 'OBJECT' AND tool_name IS NULL THEN 'TOOLCALL_MISSING_NAME' END"
_BAD_NAME = (
    f"CASE WHEN starts_with(tool_name, 'check_') THEN CASE WHEN NOT list_contains({many(vocab.CHECK_TOOLS)}, tool_name) THEN 'UNKNOWN_CHECK_TOOL' END "
    "WHEN tool_name <> 'execute_sql' THEN 'UNKNOWN_TOOL' END"
)
_NO_SQL = "CASE WHEN tool_name = 'execute_sql' AND sql IS NULL THEN 'SQL_ARGUMENT_ERROR' END"
_OUTCOME = (
    "CASE WHEN tool_status = 'sql_error' THEN 'SQL_EXECUTION_ERROR' WHEN tool_status = 'runtime_error' THEN 'SQL_TOOL_RUNTIME_ERROR' "
    f"WHEN {LOOKS_BAD} THEN 'SQL_HALLUCINATION_OR_EXECUTION_ERROR' WHEN {IS_EMPTY} THEN 'SQL_EMPTY_RESULT' END"
)
_ANSWER = "trim(split_part(gen_text, '<eot_id>', 1))"
_CALL_FAILED = "CASE call_status WHEN 'http_error' THEN 'HTTP_ERROR' WHEN 'parse_error' THEN 'VLLM_RESPONSE_PARSE_ERROR' END"
add(
    "extract_toolcall", _PARSED,
    "SELECT conv_id, step, has_call, closed AS has_call_lenient, reasoning, tool_name, sql FROM parsed",
)
add("toolcall_errors", _PARSED, f"SELECT conv_id, step, {_CALL_FORM} AS error FROM parsed")
add("tool_name_errors", _PARSED, f"SELECT conv_id, step, coalesce({_NO_NAME}, {_BAD_NAME}) AS error FROM parsed")
add("sql_argument_error", _PARSED, f"SELECT conv_id, step, {_NO_SQL} AS error FROM parsed")
add("sql_outcome", _PARSED, f"SELECT conv_id, step, {_OUTCOME} AS error FROM parsed WHERE tool_name = 'execute_sql'")
add(
    "length_cutoff", [OS],
    "SELECT conv_id, step, CASE WHEN step = 0 THEN 'SQL_GENERATION_LENGTH_CUTOFF' ELSE 'ANSWER_GENERATION_LENGTH_CUTOFF' END AS error "
    "FROM only_sql_steps WHERE finish_reason = 'length'",
)
add("final_answer", _PARSED, f"SELECT conv_id, step, {_ANSWER} AS answer, {_ANSWER} = '' AS is_empty FROM parsed WHERE NOT has_call")
_CLASSIFIED = [
    *_PARSED,
    (
        "early",
        f"SELECT *, coalesce({_CALL_FAILED}, CASE WHEN finish_reason = 'length' THEN 'GENERATION_LENGTH_CUTOFF' END, {_CALL_FORM}, "
        f"CASE WHEN NOT has_call AND {_ANSWER} = '' THEN 'EMPTY_FINAL_ANSWER' END, {_NO_NAME}) AS early_error FROM parsed",
    ),
    (
        "signed",
        "SELECT *, CASE WHEN early_error IS NULL AND has_call THEN tool_name || '|' || coalesce(CAST(json_extract(call, '$.arguments') AS VARCHAR), '') END AS signature FROM early",
    ),
    (
        "repeats",
        "SELECT *, CASE WHEN signature IS NOT NULL THEN min(step) OVER (PARTITION BY conv_id, signature) END AS first_step FROM signed",
    ),
    (
        "outcomes",
        f"SELECT *, coalesce(early_error, CASE WHEN step > first_step THEN 'REPEATED_TOOLCALL_LOOP' END, CASE WHEN has_call THEN coalesce({_BAD_NAME}, {_NO_SQL}, "
        f"CASE WHEN tool_name = 'execute_sql' THEN {_OUTCOME} END) ELSE 'SUCCESS' END) AS outcome FROM repeats WHERE step < 4",
    ),
    (
        "verdicts",
        "SELECT conv_id, coalesce(arg_min(outcome, step) FILTER (outcome IS NOT NULL), CASE WHEN max(step) >= 3 THEN 'MAX_ROUNDS_EXCEEDED' ELSE 'TRANSCRIPT_UNFINISHED' END) AS verdict, "
        "coalesce(min(step) FILTER (outcome IS NOT NULL), max(step)) AS last_step FROM outcomes GROUP BY conv_id",
    ),
]
add("repeated_toolcall", _CLASSIFIED, "SELECT conv_id, step, first_step FROM repeats WHERE step > first_step")
_VERDICT = "verdict = 'SUCCESS' AS success, CASE WHEN verdict <> 'SUCCESS' THEN verdict END AS error_type"
add("conversation_verdict", _CLASSIFIED, f"SELECT conv_id, {_VERDICT}, last_step FROM verdicts")
add("max_rounds", _CLASSIFIED, "SELECT conv_id, last_step FROM verdicts WHERE verdict = 'MAX_ROUNDS_EXCEEDED'")
_GOOD = (
    "good",
    f"SELECT v.conv_id, coalesce(arg_max(p.tool_name, p.step) FILTER (starts_with(p.tool_name, 'check_')), '') AS checktool, "
    "coalesce(arg_max(p.sql, p.step) FILTER (p.sql IS NOT NULL), '') AS sql, "
    f"arg_max({_ANSWER}, p.step) AS answer, round(sum(p.elapsed), 6) AS elapsed FROM verdicts v JOIN parsed p ON p.conv_id = v.conv_id AND p.step <= v.last_step "
    "WHERE v.verdict = 'SUCCESS' GROUP BY v.conv_id",
)
add("success_records", [*_CLASSIFIED, _GOOD], "SELECT * FROM good")
add(
    "error_log_sink", [QA, *_CLASSIFIED],
    "SELECT v.conv_id, v.last_step AS step, v.verdict AS error_type, any_value(q.user_question) AS user_request, "
    "CASE WHEN v.verdict IN ('SQL_EXECUTION_ERROR', 'SQL_TOOL_RUNTIME_ERROR') THEN arg_max(p.tool_result, p.step) ELSE coalesce(CASE v.verdict "
    + " ".join(f"WHEN '{kind}' THEN {lit(text)}" for kind, text in vocab.ERROR_MESSAGES.items())
    + " END, v.verdict) END AS error_message, arg_max(p.gen_text, p.step) FILTER (NOT (p.step = v.last_step AND v.verdict IN ('HTTP_ERROR', 'VLLM_RESPONSE_PARSE_ERROR'))) AS last_model_output, "
    "2 + 2 * count(*) + CASE WHEN v.verdict = 'MAX_ROUNDS_EXCEEDED' THEN 0 WHEN v.verdict IN ('HTTP_ERROR', 'VLLM_RESPONSE_PARSE_ERROR') THEN -2 ELSE -1 END AS n_messages, "
    "rtrim('system,user,' || repeat('assistant,tool,', CAST(count(*) - 1 AS BIGINT)) || CASE WHEN v.verdict = 'MAX_ROUNDS_EXCEEDED' THEN 'assistant,tool' "
    "WHEN v.verdict IN ('HTTP_ERROR', 'VLLM_RESPONSE_PARSE_ERROR') THEN '' ELSE 'assistant' END, ',') AS roles, arg_max(p.tool_status, p.step) AS tool_status FROM verdicts v "
    "JOIN parsed p ON p.conv_id = v.conv_id AND p.step <= v.last_step LEFT JOIN qa_records q ON q.qa_id = v.conv_id WHERE v.verdict <> 'SUCCESS' GROUP BY v.conv_id, v.last_step, v.verdict",
)
add(
    "verdict_only_sql",
    [
        *_CLEAN,
        (
            "judged",
            f"SELECT conv_id, step, elapsed, clean, {_ANSWER} AS answer, CASE WHEN step = 0 THEN coalesce({_CALL_FAILED}, "
            f"CASE WHEN finish_reason = 'length' THEN 'SQL_GENERATION_LENGTH_CUTOFF' WHEN clean = '' THEN 'EMPTY_SQL' END, {_OUTCOME}) ELSE coalesce({_CALL_FAILED}, "
            f"CASE WHEN finish_reason = 'length' THEN 'ANSWER_GENERATION_LENGTH_CUTOFF' WHEN {_ANSWER} = '' THEN 'EMPTY_FINAL_ANSWER' END) END AS error FROM cleaned",
        ),
        (
            "ends",
            "SELECT conv_id, coalesce(max(CASE WHEN step = 0 THEN error END), max(CASE WHEN step = 1 THEN error END)) AS error, "
            "max(CASE WHEN step = 0 THEN clean END) AS sql, max(CASE WHEN step = 1 THEN answer END) AS answer, round(sum(elapsed), 6) AS elapsed FROM judged GROUP BY conv_id",
        ),
    ],
    "SELECT conv_id, error IS NULL AS success, error AS error_type, CASE WHEN error IS NULL THEN sql END AS sql, CASE WHEN error IS NULL THEN answer END AS answer, "
    "CASE WHEN error IS NULL THEN elapsed END AS elapsed FROM ends",
)
_SUMMARY = (
    "count(*) AS n_total, count(*) FILTER (v.verdict = 'SUCCESS') AS n_success, count(*) FILTER (v.verdict <> 'SUCCESS') AS n_failed, "
    "round(avg(CASE WHEN v.verdict = 'SUCCESS' THEN 1.0 ELSE 0.0 END), 6) AS success_rate, "
    "round(sqrt(avg(CASE WHEN v.verdict = 'SUCCESS' THEN 1.0 ELSE 0.0 END) * (1 - avg(CASE WHEN v.verdict = 'SUCCESS' THEN 1.0 ELSE 0.0 END)) / count(*)), 6) AS standard_error, "
    "round(avg(g.elapsed), 6) AS mean_seconds"
)
add("benchmark_summary", [*_CLASSIFIED, _GOOD], f"SELECT {_SUMMARY} FROM verdicts v LEFT JOIN good g USING (conv_id)")
add(
    "benchmark_report", [*_CLASSIFIED, _GOOD, ("s", f"SELECT {_SUMMARY} FROM verdicts v LEFT JOIN good g USING (conv_id)")],
    "SELECT unnest(['BENCHMARK SUMMARY', 'Test cases: transcript_steps', 'Errors by class:', 'Errors written to: errors']) AS line UNION ALL "
    "SELECT 'Total: ' || n_total AS line FROM s UNION ALL SELECT 'Success: ' || n_success FROM s UNION ALL "
    "SELECT printf('Success rate: (%.2f ± %.2f)%%', success_rate * 100, standard_error * 100) FROM s UNION ALL "
    "SELECT 'Mean time of successes: ' || mean_seconds || ' s' FROM s UNION ALL SELECT 'Failed: ' || n_failed FROM s UNION ALL "
    "SELECT '  ' || verdict || ': ' || count(*) FROM verdicts WHERE verdict <> 'SUCCESS' GROUP BY verdict",
)
_BREAKDOWN = "SELECT verdict AS error_type, count(*) AS n FROM verdicts WHERE verdict <> 'SUCCESS' GROUP BY 1 ORDER BY n DESC, error_type"
add("error_breakdown", _CLASSIFIED, _BREAKDOWN)
add("stream_error_counts", _CLASSIFIED, _BREAKDOWN)
add(
    "compare_runs",
    [*_CLASSIFIED, _GOOD, ("runs", f"SELECT 'run_' || CAST(v.conv_id % 3 AS VARCHAR) AS run, {_SUMMARY} FROM verdicts v LEFT JOIN good g USING (conv_id) GROUP BY 1")],
    "SELECT a.run, b.run AS other_run, a.success_rate, b.success_rate AS other_rate, round((a.success_rate - b.success_rate) / "
    "sqrt(a.standard_error ** 2 + b.standard_error ** 2), 4) AS gap_in_errors FROM runs a JOIN runs b ON a.run < b.run WHERE a.run = (SELECT min(run) FROM runs)",
)
_CUT = [
    (
        "cut_fields",
        "SELECT conv_id, step, NULLIF(regexp_extract(regexp_extract(gen_text, '(?s)<TOOLCALL>(.*?)</TOOLCALL>', 1), '(?s)\"name\": \"(.*?)\"', 1), '') AS tool_name, "
        "NULLIF(regexp_extract(gen_text, '(?s)\"sql\": \"(.*?)\"', 1), '') AS sql, "
        "NULLIF(regexp_extract(gen_text, '(?s) is ''(.*?)''', 1), '') AS answer_value FROM transcript_steps",
    ),
]
add("extract_fields", [TS, *_CUT], "SELECT * FROM cut_fields")
_SCORES = [
    TS, *_CUT, "gold_records",
    (
        "joined",
        "SELECT g.*, a.tool_name AS tool1, b.tool_name AS tool2, b.sql, c.answer_value, NULLIF(regexp_extract(g.gold_answer, ' is ''(.*?)''', 1), '') AS gold_value "
        "FROM gold_records g LEFT JOIN cut_fields a ON a.conv_id = g.conv_id AND a.step = 0 LEFT JOIN cut_fields b ON b.conv_id = g.conv_id AND b.step = 1 "
        "LEFT JOIN cut_fields c ON c.conv_id = g.conv_id AND c.step = 3",
    ),
    (
        "scored",
        "SELECT conv_id, round(CASE WHEN tool1 = gold_tool OR starts_with(tool1, 'check_') THEN 0.3 ELSE 0.0 END + rest, 4)::DOUBLE AS score, "
        "round(CASE WHEN tool1 = gold_tool THEN 0.3 ELSE 0.0 END + rest, 4)::DOUBLE AS strict_score FROM (SELECT *, "
        "CASE WHEN tool2 = 'execute_sql' AND sql = gold_sql THEN 0.4 ELSE 0.0 END + CASE WHEN answer_value = gold_value THEN 0.3 ELSE 0.0 END AS rest FROM joined)",
    ),
]
add("score_transcripts", _SCORES, "SELECT * FROM scored")
add(
    "average_score", [*_SCORES, *_draws("scored", "conv_id", 50)],
    "SELECT count(*) AS n_drawn, round(avg(score), 6) AS average_score FROM draws JOIN indexed USING (row_index)",
)

# --- audits -----------------------------------------------------------------------
add(
    "vocab_violations", [GE],
    "SELECT 'STATE' AS column_name, lower(STATE) AS value, count(*) AS n_events FROM grid_events WHERE _ID % 11 = 0 GROUP BY 2",
)
_ALLOWED = (
    "allowed",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{e}', '{k}')" for e, ks in vocab.EVENT_KEYS.items() for k in ks)
    + ") t(EVENT, key)",
)
add(
    "key_violations", [GE, _LONG, _ALLOWED],
    "SELECT e AS EVENT, key, count(*) AS n_events FROM (SELECT CASE WHEN _ID % 13 = 0 THEN 'JobAllocation' ELSE EVENT END AS e, key FROM long) l "
    "WHERE NOT EXISTS (SELECT 1 FROM allowed a WHERE a.EVENT = l.e AND a.key = l.key) GROUP BY ALL",
)
add("malformed_metadata", _raw, "SELECT line_no, line FROM lines WHERE NOT ok")
add(
    "key_coverage", [GE, _LONG, _ALLOWED],
    "SELECT a.EVENT, a.key, t.n AS n_events, count(l._ID) AS n_present, round(1 - count(l._ID) / t.n, 6) AS missing_share FROM allowed a "
    "JOIN (SELECT EVENT, count(*) AS n FROM grid_events GROUP BY 1) t ON t.EVENT = a.EVENT "
    "LEFT JOIN long l ON l.EVENT = a.EVENT AND l.key = a.key AND l.value IS NOT NULL GROUP BY a.EVENT, a.key, t.n",
)
add(
    "lint_jobid", [QA, ("j", "SELECT *, CASE WHEN qa_id % 9 = 0 THEN '2700000007' ELSE regexp_extract(user_question, '[0-9]{6,}') END AS job_id FROM qa_records")],
    "SELECT qa_id, contains(user_question, job_id) AS names_job, len(list_filter(regexp_extract_all(user_question, '[0-9]{6,}'), lambda i: i <> job_id)) > 0 AS names_other_job FROM j",
)
_NAMES = "\\b(" + "|".join(
    [c for c in vocab.EVENT_COLUMNS if c != "EVENT"] + [k for k in ALL_KEYS if "_" in k] + ["execute_sql", "json_extract"]
) + ")\\b"
_PLAIN_NAMES = "\\b(" + "|".join(["EVENT"] + [k for k in ALL_KEYS if "_" not in k]) + ")\\b"
add(
    "lint_field_names", [GE, *_lookups(None, 2)],
    f"SELECT qa_id, len(regexp_extract_all(question, '{_NAMES}')) > 0 AS uses_names, "
    f"array_to_string(list_sort(list_distinct(regexp_extract_all(question, '{_NAMES}'))), ',') AS names, "
    f"array_to_string(list_sort(list_distinct(regexp_extract_all(question, '{_PLAIN_NAMES}'))), ',') AS plain_names FROM filled",
)
add(
    "lint_sql", [QA],
    "SELECT qa_id, regexp_matches(sql, 'FROM JOBS') AS other_table, regexp_matches(sql, 'json_extract\\(METADATA, ''[^$]') AS path_not_rooted, "
    "regexp_matches(sql, 'json_extract\\(METADATA, ''(\\$\\.)?(site|host|file|disk|source_site|destination_site)''\\)\\s*=') AS text_field_equals, "
    "regexp_matches(sql, 'JOB_ID LIKE') AS plain_column_like FROM qa_records",
)
add(
    "sql_unknown_keys", [QA, _ALLOWED],
    "SELECT qa_id, key FROM (SELECT DISTINCT qa_id, unnest(regexp_extract_all(sql, 'json_extract\\(METADATA, ''(?:\\$\\.)?([A-Za-z_0-9]+)''', 1)) AS key FROM qa_records) "
    "WHERE key NOT IN (SELECT key FROM allowed)",
)
_SQL_FLAGS = {
    "filters": "\\bWHERE\\b", "json_extract": "JSON_EXTRACT", "aggregation": "\\b(COUNT|SUM|AVG|MIN|MAX)\\s*\\(", "grouping": "\\bGROUP\\s+BY\\b",
    "sorting": "\\bORDER\\s+BY\\b", "distinct_rows": "\\bDISTINCT\\b", "limit_rows": "\\bLIMIT\\b",
}
_PLAN_FLAGS = {
    "filters": "\\bFILTERS?\\b", "json_extract": "JSON_EXTRACT", "aggregation": "\\bAGGREGATION\\b", "grouping": "\\bGROUPING\\b",
    "sorting": "\\bSORTING\\b", "distinct_rows": "\\bDISTINCT\\b", "limit_rows": "\\bLIMIT\\b",
}


def _flag(column: str, pattern: str) -> str:
    return f"regexp_matches(upper({column}), '{pattern}')"


add("sql_features", [QA], "SELECT qa_id, " + ", ".join(f"{_flag('sql', p)} AS {n}" for n, p in _SQL_FLAGS.items()) + " FROM qa_records")


def _named(when_sql: bool) -> str:
    cases = []
    for n in _SQL_FLAGS:
        used, planned = _flag("sql", _SQL_FLAGS[n]), _flag("reason_sql", _PLAN_FLAGS[n])
        cases.append(f"CASE WHEN {used} AND NOT {planned} THEN '{n}' END" if when_sql else f"CASE WHEN {planned} AND NOT {used} THEN '{n}' END")
    return f"concat_ws(',', {', '.join(cases)})"


add(
    "reason_consistency", [QA],
    f"SELECT *, not_named = '' AND not_used = '' AS consistent FROM (SELECT qa_id, {_named(True)} AS not_named, {_named(False)} AS not_used FROM qa_records)",
)
_HITS = ", ".join(
    f"CASE WHEN regexp_matches(lower(user_question), '\\b({'|'.join(words)})(s|ing)?\\b') THEN '{tool}' END" for tool, words in vocab.ROUTING_WORDS.items()
)
add(
    "route_question",
    [QA, ("hits", f"SELECT qa_id, check_tool, list_filter([{_HITS}], lambda t: t IS NOT NULL) AS tools FROM qa_records")],
    "SELECT qa_id, check_tool, CASE WHEN len(tools) = 1 THEN tools[1] ELSE 'check_All' END AS routed_tool, "
    "CASE WHEN len(tools) = 1 THEN tools[1] ELSE 'check_All' END = check_tool AS agrees FROM hits",
)


def _sentences(column: str) -> str:
    return f"len(list_filter(regexp_split_to_array(trim({column}), '[.!?]+(?:\\s+|$)'), lambda x: length(trim(x)) > 0))"


add(
    "lint_reasoning", [QA],
    f"SELECT qa_id, {_sentences('reason_check')} = 1 AS one_sentence, regexp_matches(reason_check, '(?i)\\b(metadata|column|columns|sql|aggregation|schema|json_extract)\\b') "
    f"OR regexp_matches(reason_check, '{_NAMES}') AS schema_words, {_sentences('reason_sql')} <= 2 AS short_plan FROM qa_records",
)
add(
    "lint_answer", [QA, _ROUTED],
    f"SELECT qa_id, {_sentences('answer')} AS n_sentences, {_sentences('answer')} <= 2 AS short_enough, "
    "regexp_matches(answer, '(?i)\\b(sql|database|query|rows|tuples|json_extract)\\b') AS sql_words, "
    "array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(user_question, '[0-9]{6,}')), "
    "lambda i: NOT list_contains(regexp_extract_all(answer, '[0-9]{6,}'), i))), ',') AS lost_ids FROM routed WHERE route = 'ready'",
)
add("difficulty_filter", [QA], "SELECT qa_id, sql FROM qa_records WHERE qa_id % 5 <> 4")
add(
    "answer_agrees", [GE, *_lookups(None, 2)],
    "SELECT qa_id, regexp_extract(answer, ' is ''(.*?)''', 1) AS stated_value, answer_value, regexp_extract(answer, ' is ''(.*?)''', 1) = answer_value AS agrees "
    "FROM answered WHERE answer IS NOT NULL",
)
add(
    "execute_sql", [GE],
    f"SELECT DISTINCT {m('site')} AS site, EVENT FROM grid_events WHERE STATE = 'Finished' AND {m('duration')} IS NOT NULL",
)
