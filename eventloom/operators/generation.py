"""Question / SQL / answer records from templates, all in one plan.

Every random choice is a hash of the record's id, so choosing needs no join, and all
records are answered by one join instead of one SQL run each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom import vocab
from eventloom.functions.metadata import meta
from eventloom.functions.sampling import below_probability, draw_with_replacement, hash_index
from eventloom.functions.text import fill
from eventloom.operators.filters import json_form, of_event, unpivot, unpivot_json, unpivot_kinds
from eventloom.session import written

SEED = 42
RECORD_COLUMNS = [
    "qa_id", "question", "sql", "think1", "think2", "tool1", "tool2", "answer_value", "n_values", "answer",
]
VALUES_PER_PART = 1000


# --- small dimensions -------------------------------------------------------------


def lookup_sql(event: str, alias: str | None) -> str:
    """The SQL template that answers a question about one field of one job."""
    present = "" if event == "JobAllocation" else " AND json_extract(METADATA, '$.{field2}') IS NOT NULL"
    return (
        f"SELECT DISTINCT json_extract(METADATA, '$.{{field2}}') AS {alias or '{field2}'} "
        f"FROM EVENTS WHERE EVENT = '{event}' AND JOB_ID = {{jobid}}{present};"
    )


def _literals(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def template_options(event: str) -> Column:
    """The templates of one event type as an array of structs."""
    options = []
    for question, clear, alias in vocab.LOOKUP_TEMPLATES[event]:
        reason = (
            vocab.REASON_CLEAR.format(word=vocab.EVENT_WORD[event], event=event) if clear else vocab.REASON_AMBIGUOUS
        )
        options.append(
            F.struct(
                F.lit(question).alias("question"),
                F.lit(lookup_sql(event, alias)).alias("sql"),
                F.lit(reason).alias("think1"),
                F.lit(f"check_{event}" if clear else vocab.CHECK_ALL).alias("tool1"),
            )
        )
    return F.array(*options)


def field_options(event: str) -> Column:
    """The fields of one event type, each with its phrases."""
    return F.array(
        *[
            F.struct(F.lit(key).alias("field"), _literals(phrases).alias("phrases"))
            for key, phrases in vocab.SYNONYMS[event].items()
        ]
    )


def _by_event(options) -> Column:
    """Pick a literal by the EVENT column."""
    events = list(vocab.LOOKUP_TEMPLATES)
    choice = F.when(F.col("EVENT") == events[0], options(events[0]))
    for event in events[1:]:
        choice = choice.when(F.col("EVENT") == event, options(event))
    return choice


def pick(options: Column, seed, part) -> Column:
    """One element of an array, chosen by hash."""
    return F.get(options, hash_index(seed, part, F.size(options)).cast("int"))


def synonyms(events: DataFrame) -> DataFrame:
    """Each field's phrases, with the number of events that carry the field."""
    carried = unpivot(events).groupBy("EVENT", "key").agg(F.count(F.lit(1)).alias("n"))
    phrases = reduce(
        DataFrame.unionByName,
        [
            events.sparkSession.range(1)
            .select(F.lit(event).alias("EVENT"), F.explode(field_options(event)).alias("o"))
            .select("EVENT", F.col("o.field").alias("key"), F.explode("o.phrases").alias("phrase"))
            for event in vocab.SYNONYMS
        ],
    )
    return phrases.join(carried, ["EVENT", "key"], "left").select(
        "EVENT", "key", "phrase", F.coalesce("n", F.lit(0)).alias("n_events")
    )


# --- answers ----------------------------------------------------------------------


#: The fields that lookup questions ask for, by event type.
ASKABLE = {event: list(fields) for event, fields in vocab.SYNONYMS.items()}


def asked_values(events: DataFrame, asked: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """Distinct values of the fields asked for: (EVENT, JOB_ID, key, value, is_text), written once.

    Answers and the results of the lookups are both made from them, so METADATA is parsed in one pass,
    and only what a job is asked for becomes rows. ``fields`` names all that may be asked for; ``asked`` has
    EVENT, JOB_ID and key. Events are spread before they are parsed: that takes longer than reading
    them, which a table in few files does in few tasks.
    """
    keys = asked.groupBy("EVENT", "JOB_ID").agg(F.collect_set("key").alias("asked"))
    spread = events.join(keys, ["EVENT", "JOB_ID"]).select("_ID", "EVENT", "JOB_ID", "METADATA", "asked").repartition("_ID", "METADATA")
    names = sorted({key for options in fields.values() for key in options})
    return written(unpivot_kinds(spread, names).distinct(), "values")


def field_answers(
    events: DataFrame, asked: DataFrame, fields: dict[str, list[str]] | None = None, values: DataFrame | None = None
) -> DataFrame:
    """(EVENT, JOB_ID, key) with the number of distinct values and the least of them, of the fields asked for.

    ``asked`` has EVENT, JOB_ID and key; what nobody asked for is dropped before values are
    compared. ``fields`` names all that may be asked for, if that is known: nothing else becomes rows.
    ``values`` are the ``asked_values``, if they are there already.
    """
    if values is None:
        found = unpivot(events, fields).where(F.col("value").isNotNull())
        values = found.join(asked, ["EVENT", "JOB_ID", "key"], "left_semi")
    values = values.select("EVENT", "JOB_ID", "key", "value").distinct()
    return values.groupBy("EVENT", "JOB_ID", "key").agg(
        F.min("value").alias("answer_value"), F.count(F.lit(1)).alias("n_values")
    )


def site_answers(events: DataFrame) -> DataFrame:
    """Per site the number of allocated jobs and the least job id."""
    return (
        of_event(events, "JobAllocation")
        .select(meta("site").alias("site"), "JOB_ID")
        .distinct()
        .groupBy("site")
        .agg(F.min("JOB_ID").alias("answer_value"), F.count(F.lit(1)).alias("n_values"))
    )


# --- generators -------------------------------------------------------------------


def site_draws(events: DataFrame, amount: int | None = None, seed=SEED) -> DataFrame:
    """Sites to ask about, a site as often as it is allocated (or ``amount`` fair draws)."""
    rows = of_event(events, "JobAllocation").select("_ID", meta("site").alias("site")).where("site IS NOT NULL")
    if amount is None:
        return rows.select(F.concat(F.lit("site:"), F.col("_ID").cast("string")).alias("qa_id"), "site")
    drawn = draw_with_replacement(rows, "_ID", amount, seed)
    return drawn.select(F.concat(F.lit("site:"), F.col("draw_no").cast("string")).alias("qa_id"), "site")


def site_questions(events: DataFrame, amount: int | None = None, seed=SEED) -> DataFrame:
    """Which jobs were allocated at a site."""
    asked = site_draws(events, amount, seed).withColumn(
        "template", pick(_literals(vocab.SITE_QUESTIONS), f"{seed}:template", "qa_id")
    )
    clear = vocab.REASON_CLEAR.format(word="allocation", event="JobAllocation")
    return asked.join(site_answers(events), "site", "left").select(
        "qa_id",
        fill("template", site="site").alias("question"),
        fill(F.lit(vocab.SITE_SQL), site="site").alias("sql"),
        F.lit(clear).alias("think1"),
        F.lit(vocab.REASON_DISTINCT).alias("think2"),
        F.lit("check_JobAllocation").alias("tool1"),
        F.lit(vocab.SQL_TOOL).alias("tool2"),
        "answer_value",
        F.coalesce("n_values", F.lit(0)).alias("n_values"),
        fill(F.lit(vocab.SITE_ANSWER), site="site", ans="answer_value").alias("answer"),
    )


def lookup_draws(
    events: DataFrame, kinds: list[str] | None = None, per_job: int = 1, amount: int | None = None, seed=SEED
) -> DataFrame:
    """Which field of which job to ask about, with template and phrase chosen.

    By default every job of every event type is asked about ``per_job`` times; with
    ``amount`` that many draws with replacement are made over all (type, job) pairs.
    """
    kinds = kinds or list(vocab.LOOKUP_TEMPLATES)
    pairs = (
        events.where(F.col("EVENT").isin(kinds) & F.col("JOB_ID").isNotNull())
        .select("EVENT", "JOB_ID")
        .distinct()
        .withColumn("pair", F.concat_ws(":", "EVENT", "JOB_ID"))
    )
    if amount is None:
        draws = pairs.withColumn("draw_no", F.explode(F.sequence(F.lit(1), F.lit(per_job))))
    else:
        draws = draw_with_replacement(pairs, "pair", amount, seed)
    return (
        draws.withColumn("qa_id", F.concat_ws(":", "pair", F.col("draw_no").cast("string")))
        .withColumn("template", pick(_by_event(template_options), f"{seed}:template", "qa_id"))
        .withColumn("option", pick(_by_event(field_options), f"{seed}:field", "qa_id"))
        .select(
            "qa_id",
            "EVENT",
            "JOB_ID",
            F.col("option.field").alias("field"),
            pick(F.col("option.phrases"), f"{seed}:phrase", "qa_id").alias("phrase"),
            "template",
        )
    )


def filled(draws: DataFrame) -> DataFrame:
    """Question, SQL and reasons with all slots filled."""
    slots = {"field1": "phrase", "field2": "field", "jobid": "JOB_ID"}
    return draws.select(
        "qa_id",
        "EVENT",
        "JOB_ID",
        "field",
        "phrase",
        fill("template.question", **slots).alias("question"),
        fill("template.sql", **slots).alias("sql"),
        F.col("template.think1").alias("think1"),
        F.lit(vocab.REASON_DISTINCT).alias("think2"),
        F.col("template.tool1").alias("tool1"),
        F.lit(vocab.SQL_TOOL).alias("tool2"),
    )


def answer_batch(
    questions: DataFrame, events: DataFrame, fields: dict[str, list[str]] | None = None, values: DataFrame | None = None
) -> DataFrame:
    """Answer all questions by one join; an unanswerable one keeps a NULL answer.

    ``fields`` are the fields by event type that questions may ask for, if that is known; ``values``
    the ``asked_values`` of the questions, if they are there already.
    """
    asked = questions.select("EVENT", "JOB_ID", F.col("field").alias("key"))
    answers = field_answers(events, asked, fields, values).withColumnRenamed("key", "field")
    return questions.join(answers, ["EVENT", "JOB_ID", "field"], "left").withColumn(
        "n_values", F.coalesce("n_values", F.lit(0))
    )


def lookup_questions(
    events: DataFrame,
    kinds: list[str] | None = None,
    per_job: int = 1,
    amount: int | None = None,
    seed=SEED,
    values: DataFrame | None = None,
) -> DataFrame:
    """Records asking for one field of one job; ``values`` are the ``asked_values`` of the same draws, if there already."""
    asked = filled(lookup_draws(events, kinds, per_job, amount, seed))
    slots = {"jobid": "JOB_ID", "field1": "phrase", "field2": "field", "event": "EVENT", "ans": "answer_value"}
    return answer_batch(asked, events, ASKABLE, values).select(
        *RECORD_COLUMNS[:-1], fill(F.lit(vocab.LOOKUP_ANSWER), **slots).alias("answer")
    )


def all_questions(events: DataFrame, per_job: int = 1, amount: int | None = None, seed=SEED) -> DataFrame:
    """All generators together."""
    return site_questions(events, amount, seed).unionByName(
        lookup_questions(events, None, per_job, amount, seed).select(*RECORD_COLUMNS)
    )


def template_mix(draws: DataFrame) -> DataFrame:
    """How many records go to the type's own check tool and how many to the general one."""
    return draws.groupBy("EVENT", F.col("template.tool1").alias("tool_name")).agg(F.count(F.lit(1)).alias("n_records"))


def value_parts(
    events: DataFrame, per_part: int = VALUES_PER_PART, asked: DataFrame | None = None, values: DataFrame | None = None
) -> DataFrame:
    """The rows a lookup SQL returns as JSON text, in parts of about ``per_part`` values.

    The parts of one result joined in order are the whole text, so a result with very
    many values is never gathered in one place. ``asked`` (EVENT, JOB_ID, key) names the lookups
    that are made; all are by default. ``values`` are their ``asked_values``, if they are there already.
    """
    group = ["EVENT", "JOB_ID", "key"]
    if values is not None:
        values = values.where(F.col("is_text").isNotNull()).select(*group, json_form("value", "is_text").alias("json_value"))
    else:
        values = unpivot_json(events).where(F.col("json_value") != "null").select(*group, "json_value")
        if asked is not None:
            values = values.join(asked.select(*group), group, "left_semi")
        values = values.distinct()
    sizes = values.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / F.lit(per_part)).alias("n_buckets"))
    spread = F.when(F.col("n_buckets") > 1, hash_index("part", "json_value", F.col("n_buckets")))
    bucketed = values.join(sizes, group).withColumn("bucket", F.coalesce(spread, F.lit(0).cast("bigint")))
    texts = bucketed.groupBy(*group, "bucket").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list("json_value")), lambda v: F.concat(F.lit("["), v, F.lit("]"))), ", "
        ).alias("text")
    )
    return enclosed_parts(texts, bucketed, group, "bucket")


def enclosed_parts(texts: DataFrame, buckets: DataFrame, group: list[str], order: str) -> DataFrame:
    """Number the parts of each text and put the outer brackets and commas in place.

    ``buckets`` holds just the keys of the parts, so that the texts of one group need not
    meet in one task to be numbered.
    """
    window = Window.partitionBy(*group)
    numbers = (
        buckets.select(*group, order)
        .distinct()
        .withColumn("part", F.row_number().over(window.orderBy(order)) - 1)
        .withColumn("n_parts", F.count(F.lit(1)).over(window))
    )
    head = F.when(F.col("part") == 0, F.lit("[")).otherwise(F.lit(", "))
    tail = F.when(F.col("part") == F.col("n_parts") - 1, F.lit("]")).otherwise(F.lit(""))
    return texts.join(numbers, [*group, order]).select(
        *group, "part", "n_parts", F.concat(head, "text", tail).alias("text")
    )


# --- choices made per record ------------------------------------------------------


def vague_branch(records: DataFrame, vague: float = 0.1, seed=SEED) -> DataFrame:
    """Ask a record's question vaguely with the given probability."""
    text_id = F.col("qa_id").cast("string")
    branch = F.when(below_probability(f"{seed}:vague", text_id, vague), F.lit("vague")).otherwise(F.lit("clear"))
    return records.select("qa_id", branch.alias("branch"))


def draw_event_type(records: DataFrame, seed=SEED) -> DataFrame:
    """Per record one of the six checks and a sample size of 1 to 3, all equally likely."""
    text_id = F.col("qa_id").cast("string")
    return records.select(
        "qa_id",
        pick(_literals(vocab.EVENT_CHOICES), f"{seed}:check", text_id).alias("check_tool"),
        (hash_index(f"{seed}:rows", text_id, 3) + 1).alias("n_rows"),
    )


def merge_records(first: DataFrame, second: DataFrame, id_column: str = "qa_id") -> DataFrame:
    """Put two records together; of a column in both the second's value counts, null or not."""
    second_columns = [c for c in second.columns if c != id_column]
    renamed = second.select(id_column, F.lit(True).alias("_there"), *[F.col(c).alias(f"_{c}") for c in second_columns])
    joined = first.join(renamed, id_column, "left")
    merged = [
        F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in second_columns else F.col(c) for c in first.columns if c != id_column
    ]
    added = [F.col(f"_{c}").alias(c) for c in second_columns if c not in first.columns]
    return joined.select(id_column, *merged, *added)


# --- prompts ----------------------------------------------------------------------

STRUCTURE_NOTE = (
    "Columns: "
    + ", ".join(vocab.EVENT_COLUMNS)
    + ". STATE is one of "
    + ", ".join(vocab.STATES)
    + ". STATUS is one of "
    + ", ".join(vocab.STATUSES)
    + ". EVENT is one of "
    + ", ".join(vocab.EVENTS)
    + ". METADATA is JSON; its keys are, by event: "
    + "; ".join(f"{event}: {', '.join(keys)}" for event, keys in vocab.EVENT_KEYS.items())
    + ". A file event succeeded when its STATE is Finished, a JobExecution when its STATUS is finished, "
    + "a JobAllocation when its STATUS is assigned."
)
QUESTION_PROMPT = (
    "Write one question about job {jobid} that needs grouping, ranking or filtering to answer.\n"
    "Table: " + STRUCTURE_NOTE + "\nReturn JSON with the keys " + ", ".join(vocab.QUESTION_KEYS) + ".\nRows: "
)
VAGUE_QUESTION_PROMPT = (
    "Write one question about job {jobid} that leaves open which event type it is about.\n"
    "Table: " + STRUCTURE_NOTE + "\nReturn JSON with the keys " + ", ".join(vocab.QUESTION_KEYS) + ".\nRows: "
)
GENERAL_PROMPT = (
    "Write one question about site {site}, or about sites compared with it, that needs grouping, ranking or filtering to answer "
    "and names no job.\nTable: " + STRUCTURE_NOTE + "\nReturn JSON with the keys " + ", ".join(vocab.QUESTION_KEYS)
    + ".\nSample: {check_result}"
)
VAGUE_GENERAL_PROMPT = (
    "Write one question about site {site} that names no job and leaves open which event type it is about.\n"
    "Table: " + STRUCTURE_NOTE + "\nReturn JSON with the keys " + ", ".join(vocab.QUESTION_KEYS) + ".\nSample: {check_result}"
)
SQL_PROMPT = (
    "Write one SELECT over EVENTS that answers the question, using only keys seen in the sample.\n"
    "Question: {user_question}\nReason: {reason_check}\nTool: {check_tool}\nSample: {check_result}\n"
    "Return JSON with the keys " + ", ".join(vocab.SQL_KEYS) + "."
)
ANSWER_PROMPT = (
    "Answer the question from the result. Begin with " + vocab.ANSWER + ", " + vocab.NULL_RESULT + " or "
    + vocab.INCOMPLETE_RESULT + ".\nQuestion: {user_question}\nSQL: {sql}\nResult: "
)


def sql_prompts(records: DataFrame, check_results: DataFrame) -> DataFrame:
    """One prompt per record for the SQL step. The sample table has six bounded rows."""
    joined = records.join(F.broadcast(check_results), F.col("check_tool") == F.col("tool_name"), "left")
    prompt = fill(
        F.lit(SQL_PROMPT),
        user_question="user_question",
        reason_check="reason_check",
        check_tool="check_tool",
        check_result=F.coalesce("check_result", F.lit("[]")),
    )
    return joined.select("qa_id", prompt.alias("prompt"))


def general_prompts(sites: DataFrame, check_results: DataFrame, vague: float = 0.1, seed=SEED) -> DataFrame:
    """Prompts for questions that are not about one job: one per site, clear or vague, with the
    sample of all event types, a single bounded text."""
    sample = check_results.where(F.col("tool_name") == vocab.CHECK_ALL).select(F.max("check_result")).scalar()
    template = F.when(below_probability(f"{seed}:vague", "site", vague), F.lit(VAGUE_GENERAL_PROMPT)).otherwise(F.lit(GENERAL_PROMPT))
    prompt = fill(template, site="site", check_result=F.coalesce(sample, F.lit("[]")))
    return sites.where("site IS NOT NULL").select("site", prompt.alias("prompt"))


def answer_prompts(answered: DataFrame) -> DataFrame:
    """Prompts for the answer step from records with their result text; a long result
    continues in further parts."""
    head = fill(F.lit(ANSWER_PROMPT), user_question="user_question", sql="sql")
    first = F.when(F.col("part") == 0, head).otherwise(F.lit(""))
    return answered.select("qa_id", "part", F.concat(first, "result_text").alias("prompt"))


def job_prompts(profiles: DataFrame, vague: float = 0.1, seed=SEED, rows_per_part: int = 200) -> DataFrame:
    """Prompts for the question step, one per job, in parts of ``rows_per_part`` events."""
    parts = profiles.groupBy(
        "JOB_ID", F.floor(F.col("position") / F.lit(rows_per_part)).alias("part")
    ).agg(
        F.array_join(
            F.transform(
                F.sort_array(F.collect_list(F.struct("position", "event_text", "meta_text"))),
                lambda r: F.concat(F.lit("["), r["event_text"], F.lit(", "), r["meta_text"], F.lit("]")),
            ),
            ", ",
        ).alias("rows")
    )
    template = F.when(below_probability(f"{seed}:vague", "JOB_ID", vague), F.lit(VAGUE_QUESTION_PROMPT)).otherwise(
        F.lit(QUESTION_PROMPT)
    )
    head = F.when(F.col("part") == 0, fill(template, jobid="JOB_ID")).otherwise(F.lit(", "))
    return parts.select("JOB_ID", "part", F.concat(head, "rows").alias("prompt"))
