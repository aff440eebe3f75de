"""Columns over the JSON text in METADATA and the rules about an event's state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.text import as_column
from eventloom.vocab import EVENT_KEYS, FILE_EVENTS, TEXT_KEYS

ALL_KEYS = sorted({key for keys in EVENT_KEYS.values() for key in keys})

FLAT_SCHEMA = T.StructType(
    [T.StructField(key, T.StringType() if key in TEXT_KEYS else T.DoubleType()) for key in ALL_KEYS]
)


def meta(key: str, column: str = "METADATA") -> Column:
    """One field of the JSON text as text; NULL when absent, null or malformed."""
    return F.get_json_object(column, f"$.{key}")


def meta_number(key: str, column: str = "METADATA") -> Column:
    """One field of the JSON text as a number; text that is no number gives NULL."""
    return meta(key, column).try_cast("double")


def like_escaped(text: str) -> str:
    """A literal for LIKE in which % and _ stand for themselves."""
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def meta_like(key: str, part: str) -> Column:
    """The field contains the text, upper and lower case alike."""
    return F.ilike(meta(key), F.lit(f"%{like_escaped(part)}%"))


def meta_named(key: str, name: str) -> Column:
    """The field is the whole name, upper and lower case alike."""
    return F.ilike(meta(key), F.lit(like_escaped(name)))


def successful(allocation_needs_assignment: bool = True) -> Column:
    """Whether the event counts as successful, which depends on its type."""
    allocated = F.col("STATUS") == "assigned" if allocation_needs_assignment else F.lit(True)
    return (
        F.when(F.col("EVENT").isin(FILE_EVENTS), F.col("STATE") == "Finished")
        .when(F.col("EVENT") == "JobExecution", F.col("STATUS") == "finished")
        .when(F.col("EVENT") == "JobAllocation", allocated)
        .otherwise(F.lit(False))
    )


def flat(column: str = "METADATA", *fields: str) -> Column:
    """All known fields, or those named, at once, typed, from a single parse."""
    schema = T.StructType([FLAT_SCHEMA[f] for f in fields]) if fields else FLAT_SCHEMA
    return F.from_json(as_column(column), schema)
