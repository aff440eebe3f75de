"""Filters and projections over the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.metadata import ALL_KEYS, flat, meta, meta_like, meta_named, meta_number, successful
from eventloom.functions.text import json_quote


def of_event(events: DataFrame, event: str) -> DataFrame:
    return events.where(F.col("EVENT") == event)


def scalar_equals(events: DataFrame, **values) -> DataFrame:
    """Exact match on plain columns; a JOB_ID given as a number is compared as text."""
    for column, value in values.items():
        events = events.where(F.col(column) == F.lit(value).cast(events.schema[column].dataType))
    return events


def meta_equals(events: DataFrame, key: str, value: str) -> DataFrame:
    return events.where(meta(key) == value)


def meta_contains(events: DataFrame, key: str, part: str) -> DataFrame:
    return events.where(meta_like(key, part))


def meta_is_named(events: DataFrame, key: str, name: str) -> DataFrame:
    return events.where(meta_named(key, name))


def meta_number_equals(events: DataFrame, key: str, number: float) -> DataFrame:
    return events.where(meta_number(key) == F.lit(float(number)))


def meta_present(events: DataFrame, key: str) -> DataFrame:
    return events.where(meta(key).isNotNull())


def only_successful(events: DataFrame) -> DataFrame:
    return events.where(successful())


def sent_from(events: DataFrame, site: str) -> DataFrame:
    """Transfers whose source is the site; how far they got plays no part."""
    return of_event(events, "FileTransfer").where(meta_named("source_site", site))


def project_meta(events: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    return events.select("_ID", "JOB_ID", meta(key).alias(alias or key))


def flatten(events: DataFrame) -> DataFrame:
    """METADATA as typed columns; rows that do not parse keep their text and get NULLs."""
    return events.withColumn("_meta", flat()).select(
        *[c for c in events.columns], *[F.col(f"_meta.{key}").alias(key) for key in ALL_KEYS]
    )


def unpivot(events: DataFrame, wanted: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per field present in METADATA: ``key`` and ``value`` as text.

    A JSON null stays a row with a NULL value; malformed text gives no rows. ``wanted`` names
    the fields of each event type that are asked for: all else is left out before it becomes rows,
    and so are NULL values.
    """
    fields = F.from_json("METADATA", "map<string,string>")
    if wanted is not None:
        events = events.where(F.col("EVENT").isin(*wanted))
        asked = F.lit(None).cast("array<string>")
        for event, keys in wanted.items():
            asked = F.when(F.col("EVENT") == event, F.array(*[F.lit(k) for k in keys])).otherwise(asked)
        fields = F.map_filter(fields, lambda key, value: F.array_contains(asked, key) & value.isNotNull())
    return events.select("_ID", "EVENT", "JOB_ID", F.explode(fields).alias("key", "value"))


def unpivot_json(events: DataFrame) -> DataFrame:
    """Like ``unpivot`` but the value keeps its JSON form: text quoted, numbers as written."""
    parsed = events.select(
        "_ID",
        "EVENT",
        "JOB_ID",
        F.try_parse_json("METADATA").alias("document"),
        F.from_json("METADATA", "map<string,string>").alias("texts"),
    )
    fields = parsed.lateralJoin(events.sparkSession.tvf.variant_explode(F.col("document").outer()))
    text = F.col("texts")[F.col("key")]
    json_value = F.when(F.schema_of_variant("value") == "STRING", json_quote(text)).otherwise(
        F.coalesce(text, F.lit("null"))
    )
    return fields.select("_ID", "EVENT", "JOB_ID", "key", json_value.alias("json_value"))


def unpivot_kinds(events: DataFrame, keys: list[str]) -> DataFrame:
    """Per row of events the fields named in its array ``asked`` that are not NULL: ``key``, ``value`` as text, ``is_text``.

    ``is_text`` tells whether the value is a JSON string; it is NULL where METADATA as a whole is no valid
    JSON, which ``unpivot_json`` gives no rows for. ``keys`` are all keys that ``asked`` may hold.
    """
    texts = F.from_json("METADATA", "map<string,string>")
    wanted = F.map_filter(texts, lambda key, value: F.array_contains("asked", key) & value.isNotNull())
    parsed = events.select("EVENT", "JOB_ID", F.try_parse_json("METADATA").alias("document"), wanted.alias("wanted"))
    field = F.lit(None).cast("variant")
    for key in keys:
        field = F.when(F.col("key") == key, F.try_variant_get("document", f"$.{key}", "variant")).otherwise(field)
    fields = parsed.select("EVENT", "JOB_ID", "document", F.explode("wanted").alias("key", "value"))
    return fields.select("EVENT", "JOB_ID", "key", "value", (F.schema_of_variant(field) == "STRING").alias("is_text"))


def json_form(value, is_text) -> Column:
    """A value of ``unpivot_kinds`` as ``unpivot_json`` writes it: text quoted, numbers as written."""
    return F.when(F.col(is_text), json_quote(value)).otherwise(F.col(value))
