"""Checks on replies, results and answers, and where each record goes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom import vocab
from eventloom.functions.text import as_column, before_first, is_json_object, json_quote, strip
from eventloom.operators.generation import VALUES_PER_PART
from eventloom.session import written

# --- replies ----------------------------------------------------------------------


def validate_reply(replies: DataFrame, text: str = "line", required: list[str] = vocab.QUESTION_KEYS) -> DataFrame:
    """A reply is valid when it is a JSON object with all required keys."""
    keys = F.when(is_json_object(text), F.json_object_keys(text))
    missing = F.array_except(F.array(*[F.lit(k) for k in required]), F.coalesce(keys, F.array().cast("array<string>")))
    return replies.withColumn("valid", F.size(missing) == 0).withColumn("missing_keys", F.array_join(missing, ","))


# --- results of queries -----------------------------------------------------------


#: What a cell may be; a table of cells without kinds holds text that may be any of them.
NUMBER, TEXT, BOOLEAN, NULL = "number", "text", "boolean", "null"


def result_cells(result: DataFrame, qa_id) -> DataFrame:
    """The rows of a query's result as cells: (qa_id, row_no, col_no, cell, kind).

    ``kind`` keeps what a cell is, so that the number 0 and the text '0' stay apart. Rows are
    numbered in their order from the rows counted in each part of the result.
    """
    names = result.columns
    kinds = [
        NUMBER if isinstance(f.dataType, T.NumericType) else BOOLEAN if isinstance(f.dataType, T.BooleanType) else TEXT
        for f in result.schema.fields
    ]
    plain = result.toDF(*[f"c{i}" for i in range(len(names))])
    cells = [
        F.struct(
            F.lit(i).alias("col_no"),
            F.col(f"c{i}").cast("string").alias("cell"),
            F.when(F.col(f"c{i}").isNull(), NULL).otherwise(kind).alias("kind"),
        )
        for i, kind in enumerate(kinds)
    ]
    held = written(plain.select(F.monotonically_increasing_id().alias("_at"), F.array(*cells).alias("cells")), "cells")
    part = F.shiftright("_at", 33).alias("_part")
    counts = held.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    rows = held.withColumn("_part", part).join(starts, "_part")
    return rows.select(F.lit(qa_id).alias("qa_id"), (F.col("_at") + F.col("_shift")).alias("row_no"), F.inline("cells"))


def _is_zero(results: DataFrame) -> Column:
    zero = F.coalesce(F.col("cell").try_cast("double") == 0, F.lit(False))
    return zero & (F.col("kind") == NUMBER) if "kind" in results.columns else zero


def _cell_json(results: DataFrame) -> Column:
    quoted = json_quote("cell")
    return F.when(F.col("kind").isin(NUMBER, BOOLEAN), F.col("cell")).otherwise(quoted) if "kind" in results.columns else quoted


def _result_facts(results: DataFrame) -> DataFrame:
    """What the checks need to know of each result, in one aggregation."""
    first = (F.col("row_no") == 0) & (F.col("col_no") == 0)
    return results.groupBy("qa_id").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.count_if(F.col("col_no") == 0).alias("n_rows"),
        F.count("cell").alias("n_filled"),
        F.max(first & _is_zero(results)).alias("first_is_zero"),
    )


def result_quality(questions: DataFrame, results: DataFrame, failed: Column | None = None) -> DataFrame:
    """Reject failed queries, empty results, a single number zero, and results with nothing but NULLs.

    ``failed`` is a condition on a question that says its query ended with an error.
    """
    broken = F.coalesce(F.lit(False) if failed is None else failed, F.lit(False))
    facts = questions.select("qa_id", broken.alias("_broken")).join(_result_facts(results), "qa_id", "left")
    reason = (
        F.when(F.col("_broken"), "query_error")
        .when(F.col("n_cells").isNull(), "empty")
        .when((F.col("n_cells") == 1) & F.col("first_is_zero"), "zero")
        .when(F.col("n_filled") == 0, "all_null")
    )
    return facts.select("qa_id", reason.isNull().alias("accepted"), reason.alias("reject_reason"))


def flag_zero_results(questions: DataFrame, results: DataFrame) -> DataFrame:
    """The weaker check: exactly one row whose first cell is the number zero; empty is not flagged."""
    facts = questions.select("qa_id").join(_result_facts(results), "qa_id", "left")
    flagged = (F.col("n_rows") == 1) & F.col("first_is_zero")
    return facts.select("qa_id", F.coalesce(flagged, F.lit(False)).alias("flagged"))


def expected_marker(questions: DataFrame, results: DataFrame) -> DataFrame:
    """The marker an answer has to carry: NULL already for a single NULL-like cell."""
    null_like = F.col("cell").isNull() | F.lower(strip("cell")).isin("null", "none")
    nulls = results.groupBy("qa_id").agg(F.count_if(null_like).alias("n_null"))
    joined = questions.select("qa_id").join(nulls, "qa_id", "left")
    is_null = F.col("n_null").isNull() | (F.col("n_null") > 0)
    return joined.select("qa_id", F.when(is_null, vocab.NULL_RESULT).otherwise(vocab.ANSWER).alias("expected_marker"))


def with_result_text(records: DataFrame, results: DataFrame, rows_per_part: int = VALUES_PER_PART) -> DataFrame:
    """Records with their result as JSON text, in parts of so many rows.

    Adds part, n_parts and result_text; a record without result has the one part ``[]``.
    The number of parts is known from a small aggregate, so the texts are joined by record
    and part, and a result with very many rows is spread like any others.
    """
    part = F.floor(F.col("row_no") / F.lit(rows_per_part)).cast("int")
    sizes = results.groupBy("qa_id").agg((F.floor(F.max("row_no") / F.lit(rows_per_part)) + 1).cast("int").alias("n_parts"))
    rows = results.groupBy("qa_id", "row_no").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("col_no", _cell_json(results).alias("cell")))), lambda c: c["cell"]),
            ", ",
        ).alias("row")
    )
    texts = rows.groupBy("qa_id", part.alias("part")).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("row_no", "row"))),
                lambda r: F.concat(F.lit("["), r["row"], F.lit("]")),
            ),
            ", ",
        ).alias("text")
    )
    numbered = (
        records.join(sizes, "qa_id", "left")
        .withColumn("n_parts", F.coalesce("n_parts", F.lit(1)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)))
    )
    head = F.when(F.col("part") == 0, F.lit("[")).otherwise(F.lit(", "))
    tail = F.when(F.col("part") == F.col("n_parts") - 1, F.lit("]")).otherwise(F.lit(""))
    return (
        numbered.join(texts, ["qa_id", "part"], "left")
        .withColumn("result_text", F.concat(head, F.coalesce("text", F.lit("")), tail))
        .drop("text")
    )


# --- answers ----------------------------------------------------------------------


def answer_route(raw: Column) -> Column:
    """Where an answer goes, by the marker it begins with; nothing is trimmed first."""
    return (
        F.when(raw == vocab.SQL_ERROR, "sql_error")
        .when(raw.startswith(vocab.ANSWER), "ready")
        .when(raw.startswith(vocab.NULL_RESULT), "null_answer")
        .otherwise("incomplete")
    )


def strip_answer(raw: Column) -> Column:
    """The text after the first answer marker, trimmed."""
    at = F.instr(raw, vocab.ANSWER)
    return F.when(at > 0, strip(F.substr(raw, at + len(vocab.ANSWER))))


def route_answers(records: DataFrame, raw: str = "raw_answer") -> DataFrame:
    """Add ``route``, the cleaned ``answer`` and, for unknown formats, the raw text."""
    text = F.coalesce(F.col(raw), F.lit(""))
    known_incomplete = text.startswith(vocab.INCOMPLETE_RESULT)
    return (
        records.withColumn("route", answer_route(text))
        .withColumn(
            "answer",
            F.when(F.col("route") == "ready", strip_answer(text))
            .when(F.col("route") == "null_answer", vocab.NULL_RESULT)
            .when(known_incomplete, strip(text))
            .when(F.col("route") == "incomplete", vocab.UNRECOGNISED),
        )
        .withColumn("raw_answer_output", F.when((F.col("route") == "incomplete") & ~known_incomplete, text))
    )


def marker_disagreements(records: DataFrame, results: DataFrame) -> DataFrame:
    """Expected marker beside the route the given answer took."""
    expected = expected_marker(records, results)
    routed = route_answers(records).select("qa_id", "route")
    agrees = ((F.col("expected_marker") == vocab.ANSWER) & (F.col("route") == "ready")) | (
        (F.col("expected_marker") == vocab.NULL_RESULT) & (F.col("route") == "null_answer")
    )
    return expected.join(routed, "qa_id").withColumn("agrees", agrees)


# --- tool results -----------------------------------------------------------------


def is_empty_result(text) -> Column:
    """Emptiness of a result given as JSON text: null, blank text, empty list or object,
    or an object whose first present row list is empty."""
    text = as_column(text)
    document = F.try_parse_json(text)
    kind = F.schema_of_variant(document)
    row_list = F.coalesce(*[F.size(F.try_variant_get(document, f"$.{k}", "array<variant>")) for k in vocab.RESULT_LIST_KEYS])
    return (
        F.when(F.coalesce(strip(text), F.lit("")) == "", True)
        .when(kind == "VOID", True)
        .when(kind.startswith("ARRAY"), F.json_array_length(text) == 0)
        .when(kind.startswith("OBJECT"), (F.size(F.json_object_keys(text)) == 0) | F.coalesce(row_list == 0, F.lit(False)))
        .when(kind == "STRING", strip(F.try_variant_get(document, "$", "string")) == "")
        .otherwise(False)
    )


def error_text_found(text) -> Column:
    """The first of the error texts that occurs in a result, or NULL."""
    lowered = F.lower(as_column(text))
    return F.coalesce(*[F.when(lowered.contains(mark), F.lit(mark)) for mark in vocab.ERROR_TEXTS])


def capture_errors(steps: DataFrame) -> DataFrame:
    """Whole steps that failed while running SQL or while calling the model.

    ``sql_error`` or ``answer_error`` says how, ``message`` what was reported: the tool's text,
    or what came instead of an answer.
    """
    reported = F.when(F.col("sql_error").isNotNull(), F.col("tool_result")).otherwise(F.col("gen_text"))
    return (
        steps.withColumn("sql_error", F.when(F.col("tool_status") != "ok", F.col("tool_status")))
        .withColumn(
            "answer_error", F.when(F.col("sql_error").isNull() & (F.col("call_status") != "ok"), F.col("call_status"))
        )
        .where(F.col("sql_error").isNotNull() | F.col("answer_error").isNotNull())
        .withColumn("message", reported)
    )


FENCED = r"(?s)^```[^\r\n]*(?:\r\n|\r|\n|\z)(.*?)(?:(?:\r\n|\r|\n|(?<=[\r\n]))```[^\r\n]*)?\z"


def clean_sql(text) -> Column:
    """The SQL in a model's text: cut at the end marks, unfenced, from the first SELECT on."""
    body = strip(before_first(strip(text), vocab.SHORT_END_OF_TURN))
    body = strip(before_first(body, vocab.END_OF_TURN))
    unfenced = F.regexp_replace(F.regexp_replace(body, FENCED, "$1"), r"\r\n|\r", "\n")
    body = strip(F.when(body.startswith("```"), unfenced).otherwise(body))
    return F.regexp_replace(body, r"(?is)^.*?(?=SELECT)", "")


# --- curation ---------------------------------------------------------------------


def curate(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Attach the reviewer's decision to each decided record, by line number."""
    return records.join(decisions, "line_no")


def curation_counts(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """How many records there are in all and on each list."""
    lists = decisions.groupBy(F.col("decision").alias("list_name")).agg(F.count(F.lit(1)).alias("n"))
    total = records.agg(F.lit("total").alias("list_name"), F.count(F.lit(1)).alias("n"))
    return total.unionByName(lists)


def partition_check(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Lines that are on no list or on several: the lists should cover each line once."""
    marks = records.select("line_no", F.lit(0).alias("mark")).unionByName(
        decisions.select("line_no", F.lit(1).alias("mark"))
    )
    return marks.groupBy("line_no").agg(F.sum("mark").alias("n_lists")).where("n_lists <> 1")
