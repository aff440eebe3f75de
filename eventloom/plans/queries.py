"""Every job as a named query over a folder of driver tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import vocab
from eventloom.fixtures import table, view
from eventloom.functions import sampling
from eventloom.functions.metadata import successful
from eventloom.functions.text import matches, tokens
from eventloom.operators import analytics, audits, conversations, evaluation, filters, generation, inspection, quality, training
from eventloom.session import run_dir, written
from eventloom.sources import appends, jsonl, sinks
from eventloom.sources import tools as tool_source
from eventloom.streaming import jobs

QUERIES: dict = {}
SITE, JOB = "SITE_4", "2700000007"
RECORD_SCHEMA = "qa_id bigint, line_no bigint, user_question string, check_tool string, reason_check string, reason_sql string, sql string, raw_answer string"


def query(function):
    QUERIES[function.__name__] = function
    return function


def over(view_name: str, name: str, job) -> None:
    """Register a query that is one job over one view."""
    QUERIES[name] = lambda spark, sf_dir: job(view(spark, sf_dir, view_name))


over_events = partial(over, "grid_events")
over_records = partial(over, "qa_records")
over_steps = partial(over, "transcript_steps")


# --- scans, sources, sinks --------------------------------------------------------

over_events("scan_events", lambda e: e.select(*vocab.EVENT_COLUMNS))
over_events("table_columns", inspection.table_columns)


@query
def read_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "read_jsonl")
    view(spark, sf_dir, "raw_lines").select("line").write.text(path)
    schema = T.StructType([T.StructField(k, T.StringType()) for k in vocab.QUESTION_KEYS])
    rows = jsonl.read_jsonl(spark, path, schema)
    return rows.select(*vocab.QUESTION_KEYS, F.col(jsonl.CORRUPT).alias("corrupt_line"))


over("raw_lines", "load_testcases", jsonl.load_testcases)


@query
def tool_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_source.tool_usage(tool_source.tool_catalog(spark), view(spark, sf_dir, "qa_records"))


@query
def write_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "write_jsonl")
    jsonl.write_jsonl(view(spark, sf_dir, "qa_records"), path, "overwrite")
    return spark.read.schema(RECORD_SCHEMA).json(path)


over_records(
    "resume_from",
    lambda r: jsonl.resume_from(r, 499, r.where(F.col("raw_answer").startswith(vocab.ANSWER))).select(
        "qa_id", "line_no", "user_question"
    ),
)


@query
def route_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "route_sink")
    routed = quality.route_answers(view(spark, sf_dir, "qa_records"))
    sinks.write_split(routed.where("qa_id % 2 = 0"), path, "first")
    for _ in range(2):  # the second time leaves no second copy
        sinks.write_split(routed.where("qa_id % 2 = 1"), path, "second")
    stored = appends.read_appended(spark, path, RECORD_SCHEMA + ", answer string, route string")
    return stored.select("qa_id", "route", "answer")


ERROR_SCHEMA = (
    "conv_id bigint, step bigint, last_model_output string, messages array<struct<role:string,content:string>>, "
    "error_type string, user_request string, error_message string, extra map<string,string>"
)


@query
def error_log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_dir(spark, "error_log")
    asked = view(spark, sf_dir, "qa_records").select(F.col("qa_id").alias("conv_id"), F.col("user_question").alias("user_request"))
    sinks.write_error_log(evaluation.error_records(view(spark, sf_dir, "transcript_steps"), 4, asked), path, "run")
    return appends.read_appended(spark, path, ERROR_SCHEMA).select(
        "conv_id", "step", "error_type", "user_request", "error_message", "last_model_output", F.size("messages").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), F.col("extra")["tool_status"].alias("tool_status"),
    )


# --- filters and projections ------------------------------------------------------

over_events("filter_event", lambda e: filters.of_event(e, "FileTransfer"))
over_events(
    "filter_scalar_eq",
    lambda e: filters.scalar_equals(e, JOB_ID=JOB, EVENT="FileRead", STATE="Finished", STATUS="finished"),
)
over_events("filter_meta_eq", lambda e: filters.meta_equals(e, "site", SITE).select("_ID", "EVENT", "METADATA"))
over_events("filter_meta_like", lambda e: filters.meta_contains(e, "site", "site_1").select("_ID", "EVENT", "METADATA"))
over_events("filter_meta_name", lambda e: filters.meta_is_named(e, "site", "site_4").select("_ID", "EVENT", "METADATA"))
over_events("filter_meta_num_eq", lambda e: filters.meta_number_equals(e, "cores", 4).select("_ID", "JOB_ID", "METADATA"))
over_events("filter_meta_present", lambda e: filters.meta_present(e, "duration").select("_ID", "EVENT"))
over_events("filter_jobid_affinity", lambda e: filters.scalar_equals(e, JOB_ID=int(JOB)).select("_ID", "JOB_ID"))
over_events("filter_success", lambda e: e.select("_ID", "EVENT", successful().alias("is_success")))
over_events("filter_source_site", lambda e: filters.sent_from(e, SITE).select("_ID", "JOB_ID", "STATE"))
over_events(
    "project_meta", lambda e: filters.project_meta(filters.of_event(e, "JobExecution"), "total_queue_time")
)
over_events("flatten_meta", lambda e: filters.flatten(e).drop("STATE", "STATUS", "TIME", "METADATA"))
over_events("meta_unpivot", filters.unpivot)


# --- joins ------------------------------------------------------------------------

over_events(
    "semi_jobs",
    lambda e: analytics.events_of_jobs(
        filters.of_event(e, "JobExecution"), analytics.jobs_with(e, "FileTransfer", "size", 90 * 1048576.0)
    ).select("_ID", "JOB_ID"),
)
over_events("job_profile", inspection.job_profile)


@query
def curate_by_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    curated = quality.curate(view(spark, sf_dir, "qa_records"), view(spark, sf_dir, "curation_decisions"))
    return curated.select("qa_id", "line_no", "decision", "user_question")


@query
def attach_check_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = inspection.check_results(view(spark, sf_dir, "grid_events"), 2)
    return conversations.attach_check_result(view(spark, sf_dir, "qa_records"), results).select(
        "qa_id", "check_tool", "check_result"
    )


@query
def attach_sql_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = view(spark, sf_dir, "qa_records").select("qa_id", "check_tool")
    return conversations.attach_sql_result(records, view(spark, sf_dir, "sql_results"))


over_records(
    "attach_tools",
    lambda r: conversations.attach_tools(r).select(
        "qa_id", F.json_array_length("tools").alias("n_tools"),
        F.get_json_object("tools", "$[6].function.name").alias("last_tool"),
    ),
)


# --- aggregations -----------------------------------------------------------------

over_events("group_stats", lambda e: analytics.group_stats(e, ["EVENT", "STATE"], "duration"))
over_events("distinct_meta", lambda e: analytics.distinct_meta(e, "FileTransfer", "destination_site"))
over_events("distinct_jobs", lambda e: analytics.distinct_jobs(e, "JobAllocation"))
over_events("conditional_agg", analytics.conditional_counts)
over_events("avg_transfer_rate", lambda e: analytics.transfer_rate(e, SITE))
over_events("rank_sites_read", analytics.rank_sites_read)
over_events("job_queue_time", analytics.job_queue_time)
over_events("job_time_breakdown", analytics.job_time_breakdown)
over_events("site_frequencies", analytics.site_frequencies)


@query
def curation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.curation_counts(view(spark, sf_dir, "qa_records"), view(spark, sf_dir, "curation_decisions"))


# --- samples and draws ------------------------------------------------------------

over_events("check_job_allocation", lambda e: inspection.check_event(e, "JobAllocation"))
over_events("check_file_transfer", lambda e: inspection.check_event(e, "FileTransfer"))
over_events("check_file_read", lambda e: inspection.check_event(e, "FileRead"))
over_events("check_file_write", lambda e: inspection.check_event(e, "FileWrite"))
over_events("check_job_execution", lambda e: inspection.check_event(e, "JobExecution"))
over_events("check_all", inspection.check_all)
over_events("sample_jobs", lambda e: inspection.sample_jobs(e, 5))
over_events("topk_metric", lambda e: analytics.top_by(e, "FileRead", "duration", 10))
over_records(
    "sample_with_replacement", lambda r: sampling.draw_with_replacement(r.select("qa_id"), "qa_id", 50)
)
over_records("bernoulli_branch", generation.vague_branch)
over_records("draw_event_type", generation.draw_event_type)


# --- set operations ---------------------------------------------------------------

over_events("union_checks", inspection.union_checks)
over_events("union_generated", generation.all_questions)


@query
def partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1).alias("line_no"))
    return quality.partition_check(lines, view(spark, sf_dir, "curation_decisions"))


# --- generation -------------------------------------------------------------------

over_events("qa_alloc_jobid", generation.site_questions)
over_events("qa_alloc_fields", lambda e: generation.lookup_questions(e, ["JobAllocation"], 3))
over_events("qa_transfer", lambda e: generation.lookup_questions(e, ["FileTransfer"], 3))
over_events("qa_read", lambda e: generation.lookup_questions(e, ["FileRead"], 3))
over_events("qa_write", lambda e: generation.lookup_questions(e, ["FileWrite"], 3))
over_events("qa_execution", lambda e: generation.lookup_questions(e, ["JobExecution"], 3))
over_events(
    "fill_template", lambda e: generation.filled(generation.lookup_draws(e)).select("qa_id", "question", "sql", "think1")
)
over_events(
    "answer_batch",
    lambda e: generation.answer_batch(
        generation.lookup_draws(e, None, 2).select("qa_id", "EVENT", "JOB_ID", "field"), e, generation.ASKABLE
    ),
)
over_events("synonym_dim", generation.synonyms)
over_events("template_tool_mix", lambda e: generation.template_mix(generation.lookup_draws(e, None, 4)))


@query
def render_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = inspection.check_results(view(spark, sf_dir, "grid_events"), 1)
    return generation.sql_prompts(view(spark, sf_dir, "qa_records"), results)


@query
def render_general_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "grid_events")
    return generation.general_prompts(analytics.site_frequencies(events), inspection.check_results(events, 1))


@query
def render_answer_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = quality.with_result_text(view(spark, sf_dir, "qa_records"), view(spark, sf_dir, "sql_results"))
    return generation.answer_prompts(answered)


over_events("render_job_prompts", lambda e: generation.job_prompts(inspection.job_profile(e)))
over_records(
    "merge_records",
    lambda r: generation.merge_records(
        r.select("qa_id", "user_question", "check_tool", F.col("reason_check").alias("reason")),
        r.select("qa_id", "sql", F.when(F.col("qa_id") % 2 == 0, F.col("reason_sql")).alias("reason")),
    ),
)


# --- validation and routing -------------------------------------------------------

over("raw_lines", "validate_reply", lambda r: quality.validate_reply(r).drop("line"))


def over_results(name: str, job) -> None:
    QUERIES[name] = lambda spark, sf_dir: job(view(spark, sf_dir, "qa_records"), view(spark, sf_dir, "sql_results"))


over_results("result_quality", lambda q, r: quality.result_quality(q, r, F.col("qa_id") % 17 == 3))
over_results("flag_zero_results", quality.flag_zero_results)
over_results("expected_marker", quality.marker_disagreements)
over_records("route_answers", lambda r: quality.route_answers(r).select("qa_id", "route", "answer", "raw_answer_output"))
over_records(
    "strip_answer",
    lambda r: r.where(F.col("raw_answer").contains(vocab.ANSWER)).select(
        "qa_id", quality.strip_answer(F.col("raw_answer")).alias("answer")
    ),
)
over_steps("is_empty_result", lambda s: s.select("conv_id", "step", quality.is_empty_result("tool_result").alias("is_empty")))
over_steps(
    "looks_like_error",
    lambda s: s.select("conv_id", "step", quality.error_text_found("tool_result").alias("found")).select(
        "*", F.col("found").isNotNull().alias("looks_like_error")
    ),
)
over_steps("capture_errors", lambda s: quality.capture_errors(s).select("conv_id", "step", "sql_error", "answer_error", "message", "gen_text"))
over("only_sql_steps", "clean_sql", lambda s: s.select("conv_id", "step", quality.clean_sql("gen_text").alias("sql")))


# --- conversations ----------------------------------------------------------------


def _model_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model-written records, answers routed, with their result text."""
    routed = quality.route_answers(view(spark, sf_dir, "qa_records"))
    return conversations.from_model_records(quality.with_result_text(routed, view(spark, sf_dir, "sql_results")))


def _model_messages(spark: SparkSession, sf_dir: str, change=lambda r: r, samples: DataFrame | None = None) -> DataFrame:
    """Message rows of the model-written records with one sampled row per event type."""
    if samples is None:
        samples = inspection.check_results(view(spark, sf_dir, "grid_events"), 1)
    return conversations.assemble(change(_model_records(spark, sf_dir)), samples)


@query
def assemble_structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "grid_events")
    asked = generation.lookup_draws(events).select(
        F.col("qa_id").alias("conv_id"), "EVENT", "JOB_ID", F.col("field").alias("key")
    )
    values = generation.asked_values(events, asked, generation.ASKABLE)
    questions = generation.lookup_questions(events, values=values)
    parts = asked.join(generation.value_parts(events, asked=asked, values=values), ["EVENT", "JOB_ID", "key"]).select(
        "conv_id", "part", "n_parts", "text"
    )
    records = conversations.with_parts(conversations.from_templates(questions), written(parts, "parts"))
    return conversations.assemble(records, inspection.check_results(events, 1))


@query
def assemble_llm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_messages(spark, sf_dir)


@query
def assemble_no_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_messages(spark, sf_dir, conversations.without_reasoning)


@query
def assemble_only_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.assemble_only_sql(_model_records(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.plain_messages(table(spark, sf_dir, "conversations"))


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.measure(conversations.render_segments(_stored(spark, sf_dir)))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.positioned(_segments(spark, sf_dir))


@query
def implode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.implode_messages(_stored(spark, sf_dir)).select(
        "conv_id", "block_no", F.size("messages").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n").alias("text"),
    )


@query
def explode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.explode_messages(conversations.implode_messages(_stored(spark, sf_dir)))


@query
def render_tool_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-written conversations as text, with the tool catalogue in the header."""
    return conversations.render_conversation(_model_messages(spark, sf_dir)).select("conv_id", "block_no", F.md5("text").alias("text_hash"), F.length("text").alias("n_chars"))


@query
def render_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.render_conversation(_stored(spark, sf_dir))


# --- tokens, masks, weights -------------------------------------------------------

SHORT = 256


@query
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.token_rows(_placed(spark, sf_dir)).drop("seq")


@query
def token_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.token_offsets(_placed(spark, sf_dir))


@query
def truncate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.kept(_placed(spark, sf_dir), SHORT).select("conv_id", "seq", "n_kept", "kept_text")


@query
def find_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where an assistant's turn follows another: the needle runs over two messages."""
    needle = [vocab.END_OF_TURN, vocab.HEADER_START, "assistant", vocab.HEADER_END]
    return training.find_in_conversations(_placed(spark, sf_dir), needle)


def _label_text():
    return F.array_join(F.transform(training.labels(), lambda y: y.cast("string")), " ")


@query
def label_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = training.label_mask(_placed(spark, sf_dir))
    return masked.select("conv_id", "seq", _label_text().alias("labels"))


@query
def mask_unclosed(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = training.label_mask(_placed(spark, sf_dir), SHORT)
    return masked.select("conv_id", "seq", "n_kept", F.size(F.filter(training.flags(), lambda t: t)).alias("n_trained"))


@query
def mask_tool_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels where each assistant message quotes a tool response in its own text."""
    quoted = _stored(spark, sf_dir).withColumn(
        "content",
        F.concat(
            F.lit("Seen: "), F.lit(vocab.TOOL_RESPONSE_START), F.col("content"),
            F.when(F.col("seq") % 3 == 0, F.lit("")).otherwise(F.lit(vocab.TOOL_RESPONSE_END)), F.lit(" so "), "content",
        ),
    )
    placed = training.positioned(training.measure(conversations.render_segments(quoted)))
    masked = training.label_mask(placed)
    return masked.select("conv_id", "seq", F.array_join(F.transform(training.flags(), lambda t: F.when(t, "1").otherwise("0")), "").alias("trained"))


@query
def masked_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = training.label_mask(_placed(spark, sf_dir))
    return masked.select("conv_id", "seq", training.masked_view().alias("shown"))


@query
def length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.length_stats(_segments(spark, sf_dir))


@query
def rounded_max_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.rounded_max_length(_segments(spark, sf_dir), vocab.LENGTH_CAP)


@query
def mask_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.mask_ratio(training.label_mask(_placed(spark, sf_dir)))


@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.train_test_split(view(spark, sf_dir, "qa_records").select("qa_id"), "qa_id")


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the model-written conversations."""
    samples = written(inspection.check_results(view(spark, sf_dir, "grid_events"), 1), "samples")
    segments = conversations.render_segments(_model_messages(spark, sf_dir, samples=samples))
    needed = ["conv_id", "seq", "role", "tool_name", "segment"]
    measured = training.measure(segments.select(*needed), shared=conversations.shared_segments(samples))
    measured = written(training.without_plain_pieces(measured), "measured")
    return training.loss_weights(training.positioned(measured))


@query
def loss_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.array_join(F.col("weights").cast("array<int>").cast("array<string>"), " ")
    zeros = F.rtrim(F.repeat(F.lit("0 "), F.col("n_kept")))
    return _weighted(spark, sf_dir).select(
        "conv_id", "seq", F.when(F.col("weights").isNotNull(), shown).otherwise(zeros).alias("weights")
    )


@query
def weight_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training.weight_stats(_weighted(spark, sf_dir))


@query
def pad_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = training.loss_weights(_placed(spark, sf_dir))
    batches = training.pad_batches(training.examples(weighted), id_column="example_id")

    def joined(name: str):
        return F.array_join(F.transform(name, lambda x: x.cast("bigint").cast("string")), " ").alias(name)

    return batches.select(
        "batch_no", "conv_id", "width", *[joined(c) for c in ["input_ids", "attention_mask", "labels", "loss_weights"]]
    )


over_records("find_spans", lambda r: training.find_spans(r, "qa_id", "sql", vocab.JSON_MARK))
over_records("json_extract_spans", lambda r: training.json_extract_spans(r, "qa_id", "sql"))
over("train_log", "loss_curve", training.loss_curve)


@query
def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.leakage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- evaluation -------------------------------------------------------------------

ROUNDS = 4


def _call_checked(*errors):
    def job(steps: DataFrame) -> DataFrame:
        return evaluation.parse_toolcalls(steps).select("conv_id", "step", F.coalesce(*[e() for e in errors]).alias("error"))

    return job


over_steps("extract_toolcall", evaluation.extract_toolcalls)
over_steps("toolcall_errors", _call_checked(evaluation.toolcall_error))
over_steps("tool_name_errors", _call_checked(evaluation.missing_name_error, evaluation.tool_name_error))
over_steps("sql_argument_error", _call_checked(evaluation.sql_argument_error))
over_steps(
    "sql_outcome",
    lambda s: evaluation.parse_toolcalls(s).where(evaluation.tool_name() == vocab.SQL_TOOL).select(
        "conv_id", "step", evaluation.sql_outcome_error().alias("error")
    ),
)
over(
    "only_sql_steps", "length_cutoff",
    lambda s: s.where("finish_reason = 'length'").select(
        "conv_id", "step",
        F.when(F.col("step") == 0, "SQL_GENERATION_LENGTH_CUTOFF").otherwise("ANSWER_GENERATION_LENGTH_CUTOFF").alias("error"),
    ),
)
over_steps(
    "final_answer",
    lambda s: evaluation.parse_toolcalls(s).where("NOT has_call").select(
        "conv_id", "step", evaluation.final_answer().alias("answer"), (evaluation.final_answer() == "").alias("is_empty")
    ),
)
over_steps("repeated_toolcall", evaluation.repeated_toolcalls)
over_steps(
    "max_rounds",
    lambda s: evaluation.conversation_verdict(s, ROUNDS).where("error_type = 'MAX_ROUNDS_EXCEEDED'").select("conv_id", "last_step"),
)
over_steps("conversation_verdict", lambda s: evaluation.conversation_verdict(s, ROUNDS))
over_steps("success_records", lambda s: evaluation.success_records(s, ROUNDS))
over("only_sql_steps", "verdict_only_sql", evaluation.verdict_only_sql)
over_steps("benchmark_summary", lambda s: evaluation.benchmark_summary(evaluation.timed_verdicts(s, ROUNDS)))
over_steps("error_breakdown", lambda s: evaluation.error_breakdown(evaluation.conversation_verdict(s, ROUNDS)))


@query
def benchmark_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = evaluation.timed_verdicts(view(spark, sf_dir, "transcript_steps"), ROUNDS)
    return sinks.report_lines(evaluation.benchmark_summary(timed), evaluation.error_breakdown(timed), "transcript_steps", "errors")


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions = evaluation.predictions_from_steps(view(spark, sf_dir, "transcript_steps"))
    return evaluation.score_transcripts(predictions, view(spark, sf_dir, "gold_records"))


@query
def score_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir)


@query
def average_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.average_score(_scored(spark, sf_dir))


over_steps("extract_fields", evaluation.extract_fields)
over_steps(
    "compare_runs",
    lambda s: evaluation.compare_runs(
        evaluation.timed_verdicts(s, ROUNDS).withColumn("run", F.concat(F.lit("run_"), (F.col("conv_id") % 3).cast("string")))
    ),
)


# --- audits -----------------------------------------------------------------------

over_events(
    "vocab_violations",
    lambda e: audits.vocabulary_violations(
        e.withColumn("STATE", F.when(F.col("_ID") % 11 == 0, F.lower("STATE")).otherwise(F.col("STATE")))
    ),
)
over_events(
    "key_violations",
    lambda e: audits.key_violations(
        e.withColumn("EVENT", F.when(F.col("_ID") % 13 == 0, F.lit("JobAllocation")).otherwise(F.col("EVENT")))
    ),
)
over("raw_lines", "malformed_metadata", lambda r: audits.malformed(r, "line"))
over_events("key_coverage", audits.key_coverage)
over_records(
    "lint_jobid",
    lambda r: audits.job_id_lint(
        r.withColumn("job_id", F.get(matches("user_question", "[0-9]{6,}"), F.lit(0))).withColumn(
            "job_id", F.when(F.col("qa_id") % 9 == 0, F.lit(JOB)).otherwise(F.col("job_id"))
        ),
        F.col("job_id"),
    ),
)
over_events(
    "lint_field_names",
    lambda e: audits.field_name_lint(generation.lookup_questions(e, None, 2), "question"),
)
over_records("lint_sql", audits.sql_lint)


@query
def sql_unknown_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.sql_unknown_keys(view(spark, sf_dir, "qa_records"), audits.allowed_keys(spark))


over_records("sql_features", audits.sql_features)
over_records("reason_consistency", audits.reason_consistency)
over_records("route_question", audits.route_questions)
over_records("lint_reasoning", audits.reasoning_lint)
over_records(
    "lint_answer",
    lambda r: audits.answer_lint(quality.route_answers(r).where("route = 'ready'").select("qa_id", "user_question", "answer")),
)
over_records("difficulty_filter", lambda r: audits.difficulty_filter(r).select("qa_id", "sql"))
over_events("answer_agrees", lambda e: audits.answer_agrees(generation.lookup_questions(e, None, 2)))


# --- streaming --------------------------------------------------------------------


@query
def stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "stream_route")
    jsonl.write_jsonl(view(spark, sf_dir, "qa_records"), f"{base}/in")
    records = jobs.stream_jsonl(spark, f"{base}/in", T.StructType.fromDDL(RECORD_SCHEMA))
    jobs.route_stream(records, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("qa_id", "route", "answer")


@query
def stream_error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_dir(spark, "stream_errors")
    failed = evaluation.conversation_verdict(view(spark, sf_dir, "transcript_steps"), ROUNDS).where("NOT success")
    jsonl.write_jsonl(failed.select("conv_id", "error_type"), f"{base}/in")
    errors = jobs.stream_jsonl(spark, f"{base}/in", T.StructType.fromDDL("conv_id bigint, error_type string"))
    jobs.count_errors_stream(errors, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return jobs.latest_counts(spark, f"{base}/out")


# --- SQL and tools by name --------------------------------------------------------

SITE_READ_SQL = """
SELECT DISTINCT json_extract(METADATA, '$.site') AS site, EVENT FROM EVENTS
WHERE STATE = 'Finished' AND json_extract(METADATA, '$.duration') IS NOT NULL;
"""

over_events("execute_sql", lambda e: inspection.dispatch(e, vocab.SQL_TOOL, sql=SITE_READ_SQL))


@query
def dispatch_tool(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = view(spark, sf_dir, "grid_events")
    rows = None
    for name in vocab.CHECK_TOOLS:
        sample = inspection.dispatch(events, name, n=3).withColumn("tool_name", F.lit(name))
        rows = sample if rows is None else rows.unionByName(sample)
    return rows
