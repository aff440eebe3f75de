"""Training conversations as message rows, and their rendered text.

A conversation is a set of rows (conv_id, seq, turn, role, content, tool_name,
tool_args, tools, opens, closes). ``seq`` orders the rows. ``tools`` is the catalogue of a
tool-calling conversation and stands in its first row only. A very long tool result spans
several rows of the same turn; ``opens`` and ``closes`` mark its first and last one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions.joins import left_join_many
from eventloom.functions.running import BLOCK
from eventloom.functions.text import as_column, json_quote
from eventloom.sources.tools import tools_json

MESSAGE_COLUMNS = ["conv_id", "seq", "turn", "role", "content", "tool_name", "tool_args", "tools", "opens", "closes"]
NO_INPUT_ARGUMENTS = '{"input": "' + vocab.NO_INPUT + '"}'


def _message(turn: int, role: str, content, seq=None, tool_name=None, tool_args=None, tools: str | None = None) -> Column:
    return F.struct(
        (F.lit(turn) if seq is None else seq).cast("bigint").alias("seq"),
        F.lit(turn).cast("bigint").alias("turn"),
        F.lit(role).alias("role"),
        as_column(content).alias("content"),
        (F.lit(None) if tool_name is None else as_column(tool_name)).cast("string").alias("tool_name"),
        (F.lit(None) if tool_args is None else as_column(tool_args)).cast("string").alias("tool_args"),
        F.lit(tools).cast("string").alias("tools"),
    )


def sql_arguments(sql) -> Column:
    return F.concat(F.lit('{"sql": '), json_quote(sql), F.lit("}"))


def attach_check_result(records: DataFrame, check_results: DataFrame, tool_column: str = "check_tool") -> DataFrame:
    """Attach the sample its check tool returns to each record; the sample table has six rows."""
    return records.join(
        F.broadcast(check_results.withColumnRenamed("tool_name", tool_column)), tool_column, "left"
    )


def attach_sql_result(records: DataFrame, results: DataFrame) -> DataFrame:
    """Attach result cells to records; a record without a result keeps one empty row."""
    return left_join_many(records, results, ["qa_id"])


def attach_tools(records: DataFrame) -> DataFrame:
    """The same tool catalogue on every record, as a constant column."""
    return records.withColumn("tools", F.lit(tools_json()))


def spread(rows: DataFrame) -> DataFrame:
    """Rows evenly spread: each grows many times over when it becomes a conversation, which
    its size does not show. Parts of one long result separate too."""
    return rows.repartition("conv_id", "part")


def with_parts(records: DataFrame, parts: DataFrame) -> DataFrame:
    """Records (conv_id, ...) with result parts (conv_id, part, n_parts, text) made elsewhere."""
    return left_join_many(records, parts, ["conv_id"]).select(
        *records.columns,
        F.coalesce("part", F.lit(0)).alias("part"),
        F.coalesce("n_parts", F.lit(1)).alias("n_parts"),
        F.coalesce("text", F.lit("[]")).alias("result_text"),
    )


def assemble(
    records: DataFrame, check_results: DataFrame, system: str = vocab.SYSTEM_MESSAGE, tools: str | None = None
) -> DataFrame:
    """Message rows of records (conv_id, question, think1, tool1, think2, tool2, sql, answer)
    that carry their result text (part, n_parts, result_text).

    Seven messages per conversation; only the SQL result, message six, can take several rows.
    The tool catalogue, the default one if none is given, goes along with the first message.
    """
    catalogue = tools_json() if tools is None else tools
    parts = attach_check_result(spread(records), check_results, "tool1")
    first = F.array(
        _message(0, "system", F.lit(system), tools=catalogue),
        _message(1, "user", "question"),
        _message(2, "assistant", "think1", None, "tool1", F.lit(NO_INPUT_ARGUMENTS)),
        _message(3, "tool", "check_result"),
        _message(4, "assistant", "think2", None, "tool2", sql_arguments("sql")),
    )
    result = F.array(_message(5, "tool", "result_text", F.lit(5) + F.col("part")))
    last = F.array(_message(6, "assistant", "answer", F.lit(5) + F.col("n_parts")))
    nothing = F.array_except(last, last)
    is_first = F.col("part") == 0
    is_last = F.col("part") == F.col("n_parts") - 1
    messages = F.concat(
        F.when(is_first, first).otherwise(nothing), result, F.when(is_last, last).otherwise(nothing)
    )
    return parts.select("conv_id", "part", "n_parts", F.inline(messages)).select(
        *MESSAGE_COLUMNS[:-2],
        ((F.col("turn") != 5) | is_first).alias("opens"),
        ((F.col("turn") != 5) | is_last).alias("closes"),
    )


def from_templates(questions: DataFrame) -> DataFrame:
    """Template records in the shape ``assemble`` takes."""
    return questions.select(
        F.col("qa_id").alias("conv_id"), "question", "think1", "tool1", "think2", "tool2", "sql", "answer"
    )


def from_model_records(records: DataFrame) -> DataFrame:
    """Model-written records in the shape ``assemble`` takes; the second tool is fixed."""
    return records.select(
        F.col("qa_id").alias("conv_id"),
        F.col("user_question").alias("question"),
        F.col("reason_check").alias("think1"),
        F.col("check_tool").alias("tool1"),
        F.col("reason_sql").alias("think2"),
        F.lit(vocab.SQL_TOOL).alias("tool2"),
        "sql",
        "answer",
        *[c for c in ("part", "n_parts", "result_text") if c in records.columns],
    )


def without_reasoning(records: DataFrame) -> DataFrame:
    """The same records with the reasons left empty (form inferred from the settings)."""
    return records.withColumns({"think1": F.lit(""), "think2": F.lit("")})


def assemble_only_sql(records: DataFrame, system: str = vocab.SYSTEM_MESSAGE) -> DataFrame:
    """Five messages without tools: system, user, SQL, result, answer (form inferred)."""
    parts = spread(records)
    first = F.array(
        _message(0, "system", F.lit(system)), _message(1, "user", "question"), _message(2, "assistant", "sql")
    )
    result = F.array(_message(3, "tool", "result_text", F.lit(3) + F.col("part")))
    last = F.array(_message(4, "assistant", "answer", F.lit(3) + F.col("n_parts")))
    nothing = F.array_except(last, last)
    is_first = F.col("part") == 0
    is_last = F.col("part") == F.col("n_parts") - 1
    messages = F.concat(
        F.when(is_first, first).otherwise(nothing), result, F.when(is_last, last).otherwise(nothing)
    )
    return parts.select("conv_id", "part", "n_parts", F.inline(messages)).select(
        *MESSAGE_COLUMNS[:-2],
        ((F.col("turn") != 3) | is_first).alias("opens"),
        ((F.col("turn") != 3) | is_last).alias("closes"),
    )


def plain_messages(conversations: DataFrame) -> DataFrame:
    """Stored conversations (conv_id, turn, role, text) as message rows."""
    nothing = F.lit(None).cast("string")
    return conversations.select(
        "conv_id", F.col("turn").alias("seq"), "turn", "role", F.col("text").alias("content"),
        nothing.alias("tool_name"), nothing.alias("tool_args"), nothing.alias("tools"), F.lit(True).alias("opens"), F.lit(True).alias("closes"),
    )


def explode_messages(nested: DataFrame) -> DataFrame:
    """Nested conversations (conv_id, messages) to message rows, with their stored turns."""
    return nested.select("conv_id", F.explode("messages").alias("m")).select("conv_id", "m.turn", "m.role", "m.content")


def implode_messages(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Message rows to nested conversations, at most ``block`` messages in one array.

    An ordinary conversation is one row with ``block_no`` 0. A longer one continues in
    further rows, so no conversation is gathered without bound; every message carries its
    turn. The parts of one turn, as of a long tool result, are put together to one message.
    """
    others = [c for c in ("role", "tool_name", "tool_args", "tools") if c in messages.columns]
    whole = messages.groupBy("conv_id", "turn").agg(
        F.min("seq").alias("seq"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "content"))), lambda p: p["content"]), "").alias("joined"),
        F.count("content").alias("_told"),
        *[F.first(c, ignorenulls=True).alias(c) for c in others],
    )
    message = F.struct("seq", "turn", F.when(F.col("_told") > 0, F.col("joined")).alias("content"), *others)
    return whole.groupBy("conv_id", F.floor(F.col("turn") / F.lit(block)).alias("block_no")).agg(
        F.transform(F.array_sort(F.collect_list(message)), lambda m: m.dropFields("seq")).alias("messages")
    )


def rendered(
    role="role", content="content", tool_name="tool_name", tool_args="tool_args", opens="opens", closes="closes", tools=None
) -> Column:
    """One message row as text with role header and end tag.

    Tool results are shown to the model as a user message between response tags. A tool
    catalogue is shown before the text of the message that carries it.
    """
    role, opens, closes = as_column(role), as_column(opens), as_column(closes)
    is_tool = role == "tool"
    shown_role = F.when(is_tool, F.lit("user")).otherwise(role)
    head = F.concat(
        F.lit(vocab.HEADER_START), shown_role, F.lit(vocab.HEADER_END + "\n\n"),
        F.when(is_tool, F.lit(vocab.TOOL_RESPONSE_START)).otherwise(F.lit("")),
    )
    if tools is not None:
        shown = F.concat(F.lit(vocab.TOOLS_START), as_column(tools), F.lit(vocab.TOOLS_END + "\n\n"))
        head = F.concat(head, F.when(as_column(tools).isNotNull(), shown).otherwise(F.lit("")))
    call = F.when(
        as_column(tool_name).isNotNull(),
        F.concat(
            F.lit(vocab.TOOLCALL_START + '[{"name": "'), as_column(tool_name), F.lit('", "arguments": '),
            F.coalesce(as_column(tool_args), F.lit("{}")), F.lit("}]" + vocab.TOOLCALL_END),
        ),
    ).otherwise(F.lit(""))
    tail = F.concat(
        F.when(is_tool, F.lit(vocab.TOOL_RESPONSE_END)).otherwise(F.lit("")), F.lit(vocab.END_OF_TURN)
    )
    return F.concat(
        F.when(opens, head).otherwise(F.lit("")),
        F.coalesce(as_column(content), F.lit("")),
        call,
        F.when(closes, tail).otherwise(F.lit("")),
    )


def render_segments(messages: DataFrame) -> DataFrame:
    """Each message row with its part of the conversation's text."""
    return messages.withColumn("segment", rendered(tools="tools" if "tools" in messages.columns else None))


def shared_segments(check_results: DataFrame, system: str = vocab.SYSTEM_MESSAGE, tools: str | None = None) -> DataFrame:
    """The segments of ``assemble``'s messages that no record has a part in: the system message with
    its tool catalogue, and the samples of the check tools. A table of fixed size."""
    catalogue = tools_json() if tools is None else tools
    messages = F.array(_message(0, "system", F.lit(system), tools=catalogue), _message(3, "tool", "check_result"))
    rows = check_results.select(F.inline(messages)).withColumns({"opens": F.lit(True), "closes": F.lit(True)})
    return render_segments(rows).select("segment")


def render_conversation(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """The conversation as text; texts of more than ``block`` messages go on in further rows."""
    segments = render_segments(messages)
    return segments.groupBy("conv_id", F.floor(F.col("seq") / F.lit(block)).alias("block_no")).agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("seq", "segment"))), lambda s: s["segment"]), ""
        ).alias("text")
    )
