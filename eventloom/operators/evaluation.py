"""Verdicts on stored model transcripts.

A transcript is a set of steps (conv_id, step, elapsed, finish_reason, call_status,
tool_status, tool_result, gen_text). Each step is classified by columns alone; the
verdict of a conversation is that of its first failing step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions.sampling import draw_with_replacement
from eventloom.functions.staged import sealed, staged
from eventloom.functions.text import before_first, strip
from eventloom.operators.audits import stated_value
from eventloom.operators.quality import clean_sql, error_text_found, is_empty_result
from eventloom.vocab import CALL_ERRORS, OUTCOMES, SUCCESS, TOOL_ERRORS, UNFINISHED


# --- one step ---------------------------------------------------------------------


def parse_toolcalls(steps: DataFrame) -> DataFrame:
    """Add the parsed first tool call of each step.

    ``has_call`` the opening mark is there, ``closed`` so is the closing one,
    ``reasoning`` the text before it, the ``_kind`` columns the JSON kinds of the list, of
    its first entry and of that entry's name and SQL, ``call`` the entry itself.
    """
    opening, closing = vocab.TOOLCALL_START + "[", "]" + vocab.TOOLCALL_END
    text = F.coalesce(F.col("gen_text"), F.lit(""))
    rows = staged(steps, _start=F.instr(text, opening))
    rows = staged(
        rows, _end=F.when(F.col("_start") > 0, F.locate(closing, F.substr(text, F.col("_start")))).otherwise(F.lit(0))
    )
    array_text = F.substr(
        text, F.col("_start") + len(vocab.TOOLCALL_START), F.col("_end") - len(vocab.TOOLCALL_START)
    )
    # As a member of an object the list cannot have anything after it.
    wrapped = F.concat(F.lit('{"calls": '), array_text, F.lit("}"))
    rows = staged(
        rows,
        has_call=F.col("_start") > 0,
        closed=F.col("_end") > 0,
        reasoning=F.when(F.col("_start") > 0, F.substr(text, F.lit(1), F.col("_start") - 1)).otherwise(text),
        _calls=F.when(F.col("_end") > 0, F.try_parse_json(wrapped)),
    )
    rows = staged(
        rows,
        calls_kind=F.schema_of_variant("_calls"),
        _call=F.try_variant_get("_calls", "$.calls[0]", "variant"),
    )
    rows = staged(
        rows,
        call_kind=F.schema_of_variant("_call"),
        name_kind=F.schema_of_variant(F.try_variant_get("_call", "$.name", "variant")),
        sql_kind=F.schema_of_variant(F.try_variant_get("_call", "$.arguments.sql", "variant")),
        tool_name=F.try_variant_get("_call", "$.name", "string"),
        sql_argument=F.try_variant_get("_call", "$.arguments.sql", "string"),
        call=F.to_json("_call"),
    )
    rows = rows.drop("_start", "_end", "_calls", "_call")
    return sealed(rows, *[c for c in rows.columns if c not in steps.columns])


def tool_name() -> Column:
    return F.col("tool_name")


def sql_argument() -> Column:
    return F.col("sql_argument")


def toolcall_error() -> Column:
    """What is wrong with the form of the tool call, or NULL."""
    return (
        F.when(~F.col("has_call"), F.lit(None))
        .when(~F.col("closed"), "TOOLCALL_TAG_UNCLOSED")
        .when(F.col("calls_kind").isNull(), "TOOLCALL_JSON_ERROR")
        .when(F.col("call_kind").isNull(), "EMPTY_TOOLCALL")
        .when(~F.col("call_kind").startswith("OBJECT"), "TOOLCALL_NOT_DICT")
    )


def missing_name_error() -> Column:
    return F.when(
        F.col("has_call") & F.col("call_kind").startswith("OBJECT") & F.col("name_kind").isNull(), "TOOLCALL_MISSING_NAME"
    )


def tool_name_error() -> Column:
    """The named tool is not in the catalogue, or the name is no text at all."""
    name = tool_name()
    return F.when(F.col("name_kind") != "STRING", "UNEXPECTED_ERROR").when(name.startswith("check_"), F.when(~name.isin(list(vocab.CHECK_TOOLS)), "UNKNOWN_CHECK_TOOL")).when(
        name != vocab.SQL_TOOL, "UNKNOWN_TOOL"
    )


def sql_argument_error() -> Column:
    return F.when((tool_name() == vocab.SQL_TOOL) & F.col("sql_kind").isNull(), "SQL_ARGUMENT_ERROR")


def _tool_status_error() -> Column:
    failed = F.lit(None).cast("string")
    for status, error in TOOL_ERRORS.items():
        failed = F.coalesce(F.when(F.col("tool_status") == status, error), failed)
    return failed


def sql_outcome_error() -> Column:
    """What became of running the SQL, for steps that ran one."""
    return F.coalesce(
        _tool_status_error(),
        F.when(error_text_found("tool_result").isNotNull(), "SQL_HALLUCINATION_OR_EXECUTION_ERROR"),
        F.when(is_empty_result("tool_result"), "SQL_EMPTY_RESULT"),
    )


def call_error() -> Column:
    """Failures of the call to the model itself."""
    failed = F.lit(None).cast("string")
    for status, error in CALL_ERRORS.items():
        failed = F.coalesce(F.when(F.col("call_status") == status, error), failed)
    return failed


def final_answer(text="gen_text") -> Column:
    """The answer in a text without tool call."""
    return strip(before_first(F.coalesce(F.col(text), F.lit("")), vocab.SHORT_END_OF_TURN))


def extract_toolcalls(steps: DataFrame) -> DataFrame:
    """The reasoning and the first tool call of each step; the lenient reading in which an
    unclosed call counts as no call stands beside the strict one."""
    parsed = parse_toolcalls(steps)
    return parsed.select(
        "conv_id",
        "step",
        "has_call",
        (F.col("has_call") & F.col("closed")).alias("has_call_lenient"),
        "reasoning",
        tool_name().alias("tool_name"),
        sql_argument().alias("sql"),
    )


def classify_steps(steps: DataFrame) -> DataFrame:
    """Each step's own error, apart from repetition.

    ``early_error`` are checks made before a call is compared with earlier calls,
    ``late_error`` those made after it; ``signature`` is the call with sorted keys.
    """
    parsed = parse_toolcalls(steps)
    is_sql = tool_name() == vocab.SQL_TOOL
    early = F.coalesce(
        call_error(),
        F.when(F.col("finish_reason") == "length", "GENERATION_LENGTH_CUTOFF"),
        toolcall_error(),
        F.when(~F.col("has_call") & (final_answer() == ""), "EMPTY_FINAL_ANSWER"),
        missing_name_error(),
    )
    late = F.coalesce(tool_name_error(), sql_argument_error(), F.when(is_sql, sql_outcome_error()))
    is_call = F.col("early_error").isNull() & F.col("has_call")
    return staged(
        staged(parsed, early_error=early),
        signature=F.when(is_call, F.col("call")),
        late_error=F.when(is_call, late),
        is_answer=F.col("early_error").isNull() & ~F.col("has_call"),
    )


def repeated_toolcalls(steps: DataFrame) -> DataFrame:
    """Steps that make the very call an earlier step of the conversation made."""
    signed = sealed(classify_steps(steps).select("conv_id", "step", "signature"), "signature")
    calls = signed.where("signature IS NOT NULL")
    first = calls.groupBy("conv_id", "signature").agg(F.min("step").alias("first_step"))
    return calls.join(first, ["conv_id", "signature"]).where("step > first_step").select(
        "conv_id", "step", "first_step"
    )


# --- one conversation -------------------------------------------------------------


def conversation_verdict(steps: DataFrame, max_rounds: int = vocab.MAX_ROUNDS) -> DataFrame:
    """The outcome of each conversation: (conv_id, success, error_type, last_step).

    A conversation ends at its first error or at its answer. Of equal calls only the
    first two matter, as the second one already ends the conversation, and of the steps
    without a call only the first. The rank filter drops the rest before anything is
    shuffled, so long loops cost nothing.
    """
    classified = classify_steps(steps.where(F.col("step") < max_rounds))
    call_no = F.row_number().over(Window.partitionBy("conv_id", "signature").orderBy("step"))
    repeated = F.col("signature").isNotNull() & (F.col("call_no") > 1)
    outcome = F.coalesce(
        "early_error", F.when(repeated, "REPEATED_TOOLCALL_LOOP"), "late_error", F.when(F.col("is_answer"), SUCCESS)
    )
    # Step and outcome as one number, so that the earliest is found by a plain hash aggregate.
    names = F.array(*[F.lit(o) for o in OUTCOMES])
    code = F.col("step") * 64 + F.array_position(names, outcome)
    ends = (
        classified.withColumn("call_no", call_no)
        .where(F.col("call_no") <= 2)
        .groupBy("conv_id")
        .agg(F.min(code).alias("code"), F.max("step").alias("max_step"))
        .select(
            "conv_id",
            "max_step",
            F.get(names, (F.col("code") % 64 - 1).cast("int")).alias("outcome"),
            F.floor(F.col("code") / 64).alias("last_step"),
        )
    )
    used_up = F.when(F.col("max_step") >= max_rounds - 1, F.lit("MAX_ROUNDS_EXCEEDED")).otherwise(F.lit(UNFINISHED))
    verdict = F.coalesce("outcome", used_up)
    return ends.select(
        "conv_id",
        (verdict == SUCCESS).alias("success"),
        F.when(verdict != SUCCESS, verdict).alias("error_type"),
        F.coalesce("last_step", "max_step").alias("last_step"),
    )


def success_records(steps: DataFrame, max_rounds: int = vocab.MAX_ROUNDS) -> DataFrame:
    """Per successful conversation its last check tool, last SQL, answer and time."""
    good = conversation_verdict(steps, max_rounds).where("success").select("conv_id", "last_step")
    parsed = parse_toolcalls(steps)
    is_check = tool_name().startswith("check_")
    return (
        parsed.join(good, "conv_id")
        .where("step <= last_step")
        .groupBy("conv_id")
        .agg(
            F.coalesce(F.max_by(tool_name(), F.when(is_check, F.col("step"))), F.lit("")).alias("checktool"),
            F.coalesce(F.max_by(sql_argument(), F.when(sql_argument().isNotNull(), F.col("step"))), F.lit("")).alias("sql"),
            F.max_by(final_answer(), "step").alias("answer"),
            F.round(F.sum("elapsed"), 6).alias("elapsed"),
        )
    )


def error_message(error_type="error_type", detail="detail") -> Column:
    """What went wrong: the tool's own text where it failed, else a sentence for the class."""
    kind = F.col(error_type)
    told = F.lit(None).cast("string")
    for name, text in vocab.ERROR_MESSAGES.items():
        told = F.coalesce(F.when(kind == name, F.lit(text)), told)
    return F.coalesce(F.when(kind.isin(*TOOL_ERRORS.values()), F.col(detail)), told, kind)


def error_records(
    steps: DataFrame,
    max_rounds: int = vocab.MAX_ROUNDS,
    requests: DataFrame | None = None,
    system: str = vocab.SYSTEM_MESSAGE,
    extra: Sequence[str] = ("call_status", "finish_reason", "tool_status"),
    order: Sequence[str] = ("elapsed",),
) -> DataFrame:
    """Failed conversations with their request, error message, last output and messages.

    ``requests`` (conv_id, user_request) gives what was asked; messages begin with the system
    message and that request, null where it is not known.

    A call that failed left no output, so messages end before it; where all rounds are used
    up, the last tool result is there too. Steps are brought together by number first, so
    at most ``max_rounds`` entries of a conversation are gathered even where a step was stored
    many times: the first of them by ``order`` and then by its texts stays, and ``n_repeated``
    says how many that left out. ``extra`` names the columns of the last step that are kept as a
    map beside the record.
    """
    failed = conversation_verdict(steps, max_rounds).where("NOT success")
    single = (
        steps.where(F.col("step") < max_rounds)
        .groupBy("conv_id", "step")
        .agg(
            F.min(
                F.struct(
                    *[F.struct(F.col(c).isNull().alias("none"), F.col(c).alias("by")).alias(f"o{i}") for i, c in enumerate(order)],
                    F.coalesce("gen_text", F.lit("")).alias("said"),
                    F.coalesce("tool_result", F.lit("")).alias("got"),
                    F.array(*[F.col(c).cast("string") for c in extra]).alias("extra"),
                )
            ).alias("s"),
            (F.count(F.lit(1)) - 1).alias("again"),
            F.max(F.coalesce(F.col("call_status").isin(*CALL_ERRORS), F.lit(False))).alias("lost"),
        )
    )
    said = F.struct(F.lit("assistant").alias("role"), F.col("s.said").alias("content"))
    got = F.struct(F.lit("tool").alias("role"), F.col("s.got").alias("content"))
    not_said = (F.col("step") == F.col("last_step")) & F.col("lost")
    answered = (F.col("step") < F.col("last_step")) | (F.col("error_type") == "MAX_ROUNDS_EXCEEDED")
    pair = F.array(said, got)
    turn = F.when(not_said, F.slice(pair, 1, 0)).when(answered, pair).otherwise(F.array(said))
    records = (
        single.join(failed, "conv_id")
        .where("step <= last_step")
        .groupBy("conv_id", "error_type", "last_step")
        .agg(
            F.max_by("s.said", F.when(~not_said, F.col("step"))).alias("last_model_output"),
            F.sum("again").alias("n_repeated"),
            F.max_by("s.got", "step").alias("detail"),
            F.map_from_arrays(F.array(*[F.lit(c) for c in extra]), F.max_by("s.extra", "step")).alias("extra"),
            F.flatten(
                F.transform(F.sort_array(F.collect_list(F.struct("step", turn.alias("turn")))), lambda t: t["turn"])
            ).alias("messages"),
        )
        .withColumnRenamed("last_step", "step")
    )
    asked = records.withColumn("user_request", F.lit(None).cast("string")) if requests is None else records.join(
        requests.select("conv_id", "user_request"), "conv_id", "left"
    )
    opening = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("user_request").alias("content")),
    )
    return asked.withColumns({"error_message": error_message(), "messages": F.concat(opening, "messages")}).drop("detail")


def verdict_only_sql(steps: DataFrame) -> DataFrame:
    """The two-round form: SQL first, then the answer, with its own order of checks."""
    first = F.coalesce(
        call_error(),
        F.when(F.col("finish_reason") == "length", "SQL_GENERATION_LENGTH_CUTOFF"),
        F.when(F.col("sql") == "", "EMPTY_SQL"),
        sql_outcome_error(),
    )
    second = F.coalesce(
        call_error(),
        F.when(F.col("finish_reason") == "length", "ANSWER_GENERATION_LENGTH_CUTOFF"),
        F.when(F.col("answer") == "", "EMPTY_FINAL_ANSWER"),
    )
    texts = staged(
        steps.where(F.col("step") < 2),
        sql=F.when(F.col("step") == 0, F.coalesce(clean_sql("gen_text"), F.lit(""))),
        answer=F.when(F.col("step") == 1, final_answer()),
    )
    rounds = staged(texts, error=F.when(F.col("step") == 0, first).otherwise(second))
    per_conversation = rounds.groupBy("conv_id").agg(
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("step"))).alias("error"),
        F.max("step").alias("max_step"),
        F.max("sql").alias("sql"),
        F.max("answer").alias("answer"),
        F.round(F.sum("elapsed"), 6).alias("elapsed"),
    )
    error = F.coalesce("error", F.when(F.col("max_step") < 1, UNFINISHED))
    return per_conversation.select(
        "conv_id",
        error.isNull().alias("success"),
        error.alias("error_type"),
        F.when(error.isNull(), F.col("sql")).alias("sql"),
        F.when(error.isNull(), F.col("answer")).alias("answer"),
        F.when(error.isNull(), F.col("elapsed")).alias("elapsed"),
    )


# --- many conversations -----------------------------------------------------------


def timed_verdicts(steps: DataFrame, max_rounds: int = vocab.MAX_ROUNDS) -> DataFrame:
    """Verdicts with the time of the successful ones."""
    verdicts = conversation_verdict(steps, max_rounds)
    good = verdicts.where("success").select("conv_id", "last_step")
    times = (
        steps.select("conv_id", "step", "elapsed")
        .join(good, "conv_id")
        .where("step <= last_step")
        .groupBy("conv_id")
        .agg(F.round(F.sum("elapsed"), 6).alias("elapsed"))
    )
    return verdicts.join(times, "conv_id", "left")


def _summary_columns() -> list[Column]:
    n, good = F.count(F.lit(1)), F.count_if(F.col("success"))
    rate = F.try_divide(good, n)
    return [
        n.alias("n_total"),
        good.alias("n_success"),
        (n - good).alias("n_failed"),
        F.round(rate, 6).alias("success_rate"),
        F.round(F.sqrt(F.try_divide(rate * (1 - rate), n)), 6).alias("standard_error"),
        F.round(F.avg(F.when(F.col("success"), F.col("elapsed"))), 6).alias("mean_seconds"),
    ]


def benchmark_summary(verdicts: DataFrame) -> DataFrame:
    """Totals, success rate with its binomial error, and mean time of the successes."""
    return verdicts.agg(*_summary_columns())


def error_breakdown(verdicts: DataFrame) -> DataFrame:
    """Failures per class, most frequent first."""
    return (
        verdicts.where("NOT success")
        .groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "error_type")
    )


def compare_runs(verdicts: DataFrame, base: str | None = None) -> DataFrame:
    """Each run beside a base run, by default the first, with the difference in combined standard errors."""
    runs = verdicts.groupBy("run").agg(*_summary_columns()).select("run", "n_total", "success_rate", "standard_error")
    figures = F.struct("run", "success_rate", "standard_error")
    first = runs.agg(F.min(figures) if base is None else F.max(F.when(F.col("run") == base, figures)))
    beside = runs.select(
        F.col("run").alias("other_run"),
        F.col("success_rate").alias("other_rate"),
        F.col("standard_error").alias("other_error"),
        first.scalar().alias("base"),
    ).select("*", "base.*")
    gap = F.col("success_rate") - F.col("other_rate")
    spread = F.sqrt(F.pow("standard_error", F.lit(2)) + F.pow("other_error", F.lit(2)))
    return beside.where("run <> other_run").select(
        "run", "other_run", "success_rate", "other_rate", F.round(F.try_divide(gap, spread), 4).alias("gap_in_errors")
    )


# --- scores -----------------------------------------------------------------------


def plain_fields(text: str = "gen_text") -> dict[str, Column]:
    """Tool name, SQL and stated value cut out of a text by plain search: the SQL ends at
    the next quotation mark, even an escaped one."""
    call = F.regexp_extract_all(text, F.lit(r"(?s)<TOOLCALL>(.*?)</TOOLCALL>"), F.lit(1))
    name = F.regexp_extract_all(F.get(call, F.lit(0)), F.lit(r'(?s)"name": "(.*?)"'), F.lit(1))
    sql = F.regexp_extract_all(text, F.lit(r'(?s)"sql": "(.*?)"'), F.lit(1))
    return {
        "tool_name": F.get(name, F.lit(0)),
        "sql": F.get(sql, F.lit(0)),
        "answer_value": stated_value(text),
    }


def extract_fields(steps: DataFrame) -> DataFrame:
    return steps.select("conv_id", "step", *[c.alias(n) for n, c in plain_fields().items()])


def score_transcripts(predictions: DataFrame, gold: DataFrame) -> DataFrame:
    """Weighted scores of (conv_id, check_text, sql_text, answer_text) against gold records.

    The usual score credits any check tool; the strict one asks for the right one. A gold
    record without a transcript scores nothing.
    """
    check, sql, answer = plain_fields("check_text"), plain_fields("sql_text"), plain_fields("answer_text")
    right_tool = F.coalesce(check["tool_name"] == F.col("gold_tool"), F.lit(False))
    any_check = F.coalesce(check["tool_name"].startswith("check_"), F.lit(False))
    right_sql = F.coalesce((sql["tool_name"] == vocab.SQL_TOOL) & (sql["sql"] == F.col("gold_sql")), F.lit(False))
    right_answer = F.coalesce(answer["answer_value"] == stated_value("gold_answer"), F.lit(False))

    def credit(condition: Column, points: float) -> Column:
        return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))

    return gold.join(predictions, "conv_id", "left").select(
        "conv_id",
        F.round(
            credit(right_tool | any_check, vocab.SCORE_TOOL) + credit(right_sql, vocab.SCORE_SQL)
            + credit(right_answer, vocab.SCORE_ANSWER), 4,
        ).alias("score"),
        F.round(
            credit(right_tool, vocab.SCORE_TOOL) + credit(right_sql, vocab.SCORE_SQL)
            + credit(right_answer, vocab.SCORE_ANSWER), 4,
        ).alias("strict_score"),
    )


def predictions_from_steps(steps: DataFrame) -> DataFrame:
    """The three texts that are scored: the first step, the second and the last one."""
    return steps.groupBy("conv_id").agg(
        F.max(F.when(F.col("step") == 0, F.col("gen_text"))).alias("check_text"),
        F.max(F.when(F.col("step") == 1, F.col("gen_text"))).alias("sql_text"),
        F.max_by("gen_text", "step").alias("answer_text"),
    )


def average_score(scored: DataFrame, n: int = 50, seed=42) -> DataFrame:
    """Mean score of ``n`` records drawn with replacement."""
    drawn = draw_with_replacement(scored, "conv_id", n, seed)
    return drawn.agg(F.count(F.lit(1)).alias("n_drawn"), F.round(F.avg("score"), 6).alias("average_score"))
