"""Looking at the event table: samples per type, job profiles, tools by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.running import running_before
from eventloom.functions.sampling import seeded_hash
from eventloom.functions.text import is_json_object, json_quote
from eventloom.operators import statements
from eventloom.operators.filters import of_event
from eventloom.session import register_json_extract
from eventloom.vocab import CHECK_ALL, CHECK_TOOLS, EVENT_COLUMNS, SAMPLE_ORDER, SQL_TOOL

SEED = 42


def table_columns(events: DataFrame) -> DataFrame:
    """The table's columns in order, with the number of rows that fill each."""
    names = events.columns
    filled = events.agg(*[F.count(F.col(name)).alias(name) for name in names])
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(name).alias("column_name"), F.col(name).alias("n_filled"))
            for i, name in enumerate(names)
        ]
    )
    return filled.select(F.inline(entries))


def _draw_order(seed) -> list[Column]:
    return [seeded_hash(seed, F.col("_ID").cast("string")), F.col("_ID")]


def check_event(events: DataFrame, event: str, n: int = 5, seed=SEED) -> DataFrame:
    """``n`` random events of one type; the same seed gives the same rows."""
    return (
        of_event(events, event).orderBy(*_draw_order(seed)).limit(n).select(F.lit(event).alias("Field"), *EVENT_COLUMNS)
    )


def check_all(events: DataFrame, n: int = 5, seed=SEED) -> DataFrame:
    """``n`` random events of every type in one pass.

    The rank filter reaches the map side, so at most n rows per type and task move.
    """
    order = F.array_position(F.array(*[F.lit(e) for e in SAMPLE_ORDER]), F.col("EVENT"))
    window = Window.partitionBy("EVENT").orderBy(*_draw_order(seed))
    return (
        events.where(F.col("EVENT").isin(SAMPLE_ORDER))
        .withColumn("sample_no", F.row_number().over(window))
        .where(F.col("sample_no") <= n)
        .select(order.cast("int").alias("field_no"), F.col("EVENT").alias("Field"), "sample_no", *EVENT_COLUMNS)
    )


def union_checks(events: DataFrame, n: int = 5, seed=SEED) -> DataFrame:
    """The five single samples put together, from one pass."""
    return check_all(events, n, seed).select("Field", *EVENT_COLUMNS)


def sample_jobs(events: DataFrame, k: int = 1, seed=SEED) -> DataFrame:
    """``k`` random jobs, each job equally likely."""
    jobs = events.select("JOB_ID").where(F.col("JOB_ID").isNotNull()).distinct()
    return jobs.orderBy(seeded_hash(seed, "JOB_ID"), "JOB_ID").limit(k)


def job_profile(events: DataFrame) -> DataFrame:
    """Every event of every job as six labelled texts, numbered by EVENT within the job.

    Rows stay rows, so that a job with very many events is not gathered anywhere; the
    numbers come from windows over slices of at most a million ids.
    """
    sliced = events.withColumn("_slice", F.floor(F.col("_ID") / F.lit(1 << 20)))
    numbered = running_before(
        sliced.withColumn("_one", F.lit(1)), ["JOB_ID"], ["EVENT", "_slice"], ["_ID"], {"position": ("sum", "_one")}
    )

    def labelled(head: str, column: str) -> Column:
        return F.concat(F.lit(head), F.coalesce(F.col(column).cast("string"), F.lit("None")))

    return numbered.select(
        "JOB_ID",
        "position",
        labelled("'EVENT': ", "EVENT").alias("event_text"),
        labelled("'STATE': ", "STATE").alias("state_text"),
        labelled("'STATUS: ", "STATUS").alias("status_text"),
        labelled("'JOB_ID': ", "JOB_ID").alias("job_text"),
        labelled("'TIME': ", "TIME").alias("time_text"),
        labelled("'META': ", "METADATA").alias("meta_text"),
    )


def example_json() -> Column:
    """One event as a JSON array; METADATA is embedded when it parses, quoted when not."""
    document = F.when(is_json_object("METADATA"), F.col("METADATA")).otherwise(json_quote("METADATA"))
    plain = [json_quote(c) for c in ["EVENT", "STATE", "STATUS", "JOB_ID"]]
    cells = [F.col("_ID").cast("string"), *plain, F.coalesce(F.col("TIME").cast("string"), F.lit("null")), document]
    return F.concat(F.lit("["), F.concat_ws(", ", *cells), F.lit("]"))


def check_results(events: DataFrame, n: int = 5, seed=SEED) -> DataFrame:
    """For each check tool the JSON text it returns: (tool_name, check_result).

    Six rows built from at most 5 * n sampled events, so gathering them is bounded.
    """
    examples = check_all(events, n, seed).select("Field", "field_no", "sample_no", example_json().alias("example"))
    columns = "[" + ", ".join(f'"{c}"' for c in EVENT_COLUMNS) + "]"
    fields = examples.groupBy("Field", "field_no").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("sample_no", "example"))), lambda e: e["example"]), ", "
        ).alias("rows")
    )
    texts = fields.select(
        "field_no",
        F.concat(F.lit("check_"), "Field").alias("tool_name"),
        F.concat(
            F.lit('{"Field": "'), "Field", F.lit(f'", "Columns": {columns}, "Example": ['), "rows", F.lit("]}")
        ).alias("check_result"),
    )
    everything = texts.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("field_no", "check_result"))).alias("parts")
    ).select(
        F.lit(CHECK_ALL).alias("tool_name"),
        F.concat(
            F.lit("["), F.array_join(F.transform("parts", lambda p: p["check_result"]), ", "), F.lit("]")
        ).alias("check_result"),
    )
    return texts.drop("field_no").unionByName(everything)


def execute_sql(events: DataFrame, sql: str, known_keys=None, rules=statements.REFUSED) -> DataFrame:
    """Run one query over the event table, known to the SQL as EVENTS; nothing is fetched.

    A statement that is no query, reads anything else, or asks for a JSON path that does not
    start with $, is refused before it runs; a path taken from a column is checked by the tasks. ``rules`` may name the rules that are only
    told by ``statements.findings`` too; ``known_keys`` are the metadata keys it may ask for.
    """
    text = sql.strip().rstrip(";")
    spark = events.sparkSession
    statements.refuse(spark, text, known_keys, rules)
    register_json_extract(spark)
    events.createOrReplaceTempView("EVENTS")
    return spark.sql(text)


def tools(events: DataFrame) -> dict[str, Callable[..., DataFrame]]:
    """Tool name to the job it starts."""
    table = {
        name: (lambda n=5, seed=SEED, fields=tuple(fields): check_event(events, fields[0], n, seed))
        for name, fields in CHECK_TOOLS.items()
        if name != CHECK_ALL
    }
    table[CHECK_ALL] = lambda n=5, seed=SEED: union_checks(events, n, seed)
    table[SQL_TOOL] = lambda sql: execute_sql(events, sql)
    return table


def dispatch(events: DataFrame, tool_name: str, **arguments) -> DataFrame:
    """Start a tool by its name."""
    known = tools(events)
    if tool_name not in known:
        raise ValueError(f"unknown tool: {tool_name}")
    return known[tool_name](**arguments)
