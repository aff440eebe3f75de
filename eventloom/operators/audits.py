"""Audits of the event table and of question / SQL / answer records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions.metadata import ALL_KEYS
from eventloom.functions.text import as_column, is_json_object, matches, sentence_count, strip
from eventloom.operators.filters import unpivot

# --- the event table --------------------------------------------------------------


def vocabulary_violations(events: DataFrame) -> DataFrame:
    """Values of EVENT, STATE and STATUS outside their lists, counted."""
    allowed = {"EVENT": vocab.EVENTS, "STATE": vocab.STATES, "STATUS": vocab.STATUSES}
    checks = F.array(
        *[
            F.struct(
                F.lit(column).alias("column_name"),
                F.col(column).alias("value"),
                (~F.coalesce(F.col(column).isin(values), F.lit(False))).alias("bad"),
            )
            for column, values in allowed.items()
        ]
    )
    return (
        events.select(F.inline(checks))
        .where("bad")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n_events"))
    )


def allowed_keys(spark) -> DataFrame:
    """(EVENT, key) pairs that may occur: a fixed table of some forty rows."""
    pairs = [F.struct(F.lit(e).alias("EVENT"), F.lit(k).alias("key")) for e, ks in vocab.EVENT_KEYS.items() for k in ks]
    return spark.range(1).select(F.inline(F.array(*pairs)))


def key_violations(events: DataFrame) -> DataFrame:
    """Metadata keys that their event type does not have, counted."""
    found = unpivot(events).groupBy("EVENT", "key").agg(F.count(F.lit(1)).alias("n_events"))
    return found.join(F.broadcast(allowed_keys(events.sparkSession)), ["EVENT", "key"], "left_anti")


def malformed(rows: DataFrame, text: str) -> DataFrame:
    """Rows whose text is no JSON object."""
    return rows.where(~is_json_object(text))


def key_coverage(events: DataFrame) -> DataFrame:
    """For every allowed key, how many events of its type carry it and which share lacks it."""
    totals = events.groupBy("EVENT").agg(F.count(F.lit(1)).alias("n_events"))
    present = (
        unpivot(events).where("value IS NOT NULL").groupBy("EVENT", "key").agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        totals.join(F.broadcast(allowed_keys(events.sparkSession)), "EVENT")
        .join(present, ["EVENT", "key"], "left")
        .select(
            "EVENT",
            "key",
            "n_events",
            F.coalesce("n", F.lit(0)).alias("n_present"),
            F.round(1 - F.coalesce("n", F.lit(0)) / F.col("n_events"), 6).alias("missing_share"),
        )
    )


# --- questions --------------------------------------------------------------------


def job_id_lint(records: DataFrame, job_id: Column) -> DataFrame:
    """The question has to name its job and no other long number."""
    ids = matches("user_question", r"[0-9]{6,}")
    return records.select(
        "qa_id",
        F.contains("user_question", job_id).alias("names_job"),
        (F.size(F.filter(ids, lambda i: i != job_id)) > 0).alias("names_other_job"),
    )


_NAMES = [c for c in vocab.EVENT_COLUMNS if c != "EVENT"] + [k for k in ALL_KEYS if "_" in k] + [vocab.SQL_TOOL, "json_extract"]
EXACT_NAME = r"\b(" + "|".join(_NAMES) + r")\b"
#: Names that are plain words as well, so that finding one proves nothing.
PLAIN_NAME = r"\b(" + "|".join(["EVENT"] + [k for k in ALL_KEYS if "_" not in k]) + r")\b"


def field_name_lint(records: DataFrame, text: str) -> DataFrame:
    """Exact column, key or function names used where plain language is asked for; names that
    are plain words too are listed apart."""
    found, plain = matches(text, EXACT_NAME), matches(text, PLAIN_NAME)
    return records.select(
        "qa_id", (F.size(found) > 0).alias("uses_names"), F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("names"),
        F.array_join(F.array_sort(F.array_distinct(plain)), ",").alias("plain_names"),
    )


def routed_tool(question: Column) -> Column:
    """The check tool a question's words point to; none or several give the general one."""
    lowered = F.lower(question)
    hits = F.array_compact(
        F.array(
            *[
                F.when(lowered.rlike(r"\b(" + "|".join(words) + r")(s|ing)?\b"), F.lit(tool))
                for tool, words in vocab.ROUTING_WORDS.items()
            ]
        )
    )
    return F.when(F.size(hits) == 1, F.get(hits, F.lit(0))).otherwise(F.lit(vocab.CHECK_ALL))


def route_questions(records: DataFrame) -> DataFrame:
    tool = routed_tool(F.col("user_question"))
    return records.select(
        "qa_id", "check_tool", tool.alias("routed_tool"), (tool == F.col("check_tool")).alias("agrees")
    )


# --- SQL --------------------------------------------------------------------------


def sql_lint(records: DataFrame) -> DataFrame:
    """Rules for SQL: one table, rooted paths, LIKE for text fields, = for plain columns."""
    sql = F.col("sql")
    sources = F.regexp_extract_all(sql, F.lit(r"(?i)\b(?:from|join)\s+([A-Za-z_]+)"), F.lit(1))
    text_keys = "|".join(vocab.TEXT_KEYS)
    return records.select(
        "qa_id",
        (F.size(F.filter(sources, lambda t: F.upper(t) != "EVENTS")) > 0).alias("other_table"),
        sql.rlike(r"(?i)json_extract\(\s*METADATA\s*,\s*'[^$]").alias("path_not_rooted"),
        sql.rlike(rf"(?i)json_extract\(\s*METADATA\s*,\s*'(\$\.)?({text_keys})'\s*\)\s*=").alias("text_field_equals"),
        sql.rlike(r"(?i)\b(JOB_ID|EVENT|STATE|STATUS)\s+LIKE\b").alias("plain_column_like"),
    )


def sql_keys(records: DataFrame) -> DataFrame:
    """The metadata keys a SQL text asks for: (qa_id, key), each once per record."""
    keys = F.regexp_extract_all("sql", F.lit(r"json_extract\(\s*METADATA\s*,\s*'(?:\$\.)?([A-Za-z_0-9]+)'"), F.lit(1))
    return records.select("qa_id", F.explode(F.array_distinct(keys)).alias("key"))


def sql_unknown_keys(records: DataFrame, known: DataFrame) -> DataFrame:
    """Keys asked for that are not among the known ones: the key list, or the keys of a sample."""
    return sql_keys(records).join(known.select("key").distinct(), "key", "left_anti").select("qa_id", "key")


SQL_OPERATIONS = {
    "filters": r"\bWHERE\b",
    "json_extract": r"JSON_EXTRACT",
    "aggregation": r"\b(COUNT|SUM|AVG|MIN|MAX)\s*\(",
    "grouping": r"\bGROUP\s+BY\b",
    "sorting": r"\bORDER\s+BY\b",
    "distinct_rows": r"\bDISTINCT\b",
    "limit_rows": r"\bLIMIT\b",
}
PLAN_WORDS = {
    "filters": r"\bFILTERS?\b",
    "json_extract": r"JSON_EXTRACT",
    "aggregation": r"\bAGGREGATION\b",
    "grouping": r"\bGROUPING\b",
    "sorting": r"\bSORTING\b",
    "distinct_rows": r"\bDISTINCT\b",
    "limit_rows": r"\bLIMIT\b",
}


def operation_flags(text, patterns: dict[str, str]) -> dict[str, Column]:
    upper = F.upper(as_column(text))
    return {name: upper.rlike(pattern) for name, pattern in patterns.items()}


def sql_features(records: DataFrame) -> DataFrame:
    """Which operations a SQL text uses."""
    return records.select("qa_id", *[c.alias(n) for n, c in operation_flags("sql", SQL_OPERATIONS).items()])


def reason_consistency(records: DataFrame) -> DataFrame:
    """Operations the plan leaves out, and operations it names that the SQL does not use."""
    used = operation_flags("sql", SQL_OPERATIONS)
    named = operation_flags("reason_sql", PLAN_WORDS)

    def listed(flags: dict[str, Column]) -> Column:
        return F.array_join(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), ",")

    missing = {n: used[n] & ~named[n] for n in used}
    unused = {n: named[n] & ~used[n] for n in used}
    return records.select(
        "qa_id", listed(missing).alias("not_named"), listed(unused).alias("not_used")
    ).withColumn("consistent", (F.col("not_named") == "") & (F.col("not_used") == ""))


def difficulty_filter(records: DataFrame) -> DataFrame:
    """Records whose SQL has at least one of the asked-for patterns."""
    flags = operation_flags("sql", SQL_OPERATIONS)
    upper = F.upper("sql")
    hard = (
        (flags["grouping"] & flags["aggregation"])
        | flags["distinct_rows"]
        | upper.rlike(r"(?s)\bWHERE\b.*JSON_EXTRACT")
        | (flags["sorting"] & flags["limit_rows"])
        | upper.rlike(r"\bIN\s*\(\s*SELECT\b")
        | upper.rlike(r"\bSUM\s*\(\s*CASE\b")
    )
    return records.where(hard)


# --- reasons and answers ----------------------------------------------------------

SCHEMA_WORD = r"(?i)\b(metadata|column|columns|sql|aggregation|schema|json_extract)\b|" + EXACT_NAME
SQL_WORD = r"(?i)\b(sql|database|query|rows|tuples|json_extract)\b"


def reasoning_lint(records: DataFrame) -> DataFrame:
    """The reason is one sentence free of schema words; the plan has at most two."""
    return records.select(
        "qa_id",
        (sentence_count("reason_check") == 1).alias("one_sentence"),
        F.col("reason_check").rlike(SCHEMA_WORD).alias("schema_words"),
        (sentence_count("reason_sql") <= 2).alias("short_plan"),
    )


def answer_lint(answers: DataFrame) -> DataFrame:
    """Answers (qa_id, user_question, answer): short, free of SQL words, long ids kept."""
    ids = matches("user_question", r"[0-9]{6,}")
    lost = F.array_except(F.array_distinct(ids), F.array_distinct(matches("answer", r"[0-9]{6,}")))
    return answers.select(
        "qa_id",
        sentence_count("answer").alias("n_sentences"),
        (sentence_count("answer") <= 2).alias("short_enough"),
        F.col("answer").rlike(SQL_WORD).alias("sql_words"),
        F.array_join(F.array_sort(lost), ",").alias("lost_ids"),
    )


def stated_value(text) -> Column:
    """The value an answer states after `` is '``, up to the next quote."""
    found = F.regexp_extract_all(as_column(text), F.lit(r"(?s) is '(.*?)'"), F.lit(1))
    return F.get(found, F.lit(0))


def answer_agrees(records: DataFrame) -> DataFrame:
    """Whether the value stated in the answer text is the value found in the data."""
    stated = stated_value("answer")
    return records.where("answer IS NOT NULL").select(
        "qa_id", stated.alias("stated_value"), "answer_value", F.coalesce(stated == F.col("answer_value"), F.lit(False)).alias("agrees")
    )


def leakage(train: DataFrame, test: DataFrame) -> DataFrame:
    """Training texts that share sentences with test texts, with the number shared.

    Sentences of any length are compared whole, lower-cased, with white space made even.
    Only hashes travel.
    """

    def sentence_hashes(texts: DataFrame, *keep: str) -> DataFrame:
        pieces = F.split(F.lower("text"), r"[.!?\n]+")
        even = strip(F.regexp_replace("piece", r"[ \t\r]+", " "))
        return (
            texts.select(*keep, F.explode(pieces).alias("piece"))
            .select(*keep, even.alias("sentence"))
            .where("sentence <> ''")
            .select(*keep, F.md5("sentence").alias("sentence_hash"))
        )

    shared = sentence_hashes(train, "doc_id").join(
        sentence_hashes(test).distinct(), "sentence_hash", "left_semi"
    )
    return shared.distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_shared"))
