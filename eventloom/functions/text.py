"""Column helpers for text and JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.vocab import WHITESPACE

TOKEN_PATTERN = r"(?s)<\|[a-z_]+\|>|[A-Za-z0-9_]+|[ \t\r\n]+|."


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def tokens(text) -> Column:
    """Cut text into tokens; the tokens joined give the text again."""
    return F.regexp_extract_all(as_column(text), F.lit(TOKEN_PATTERN), F.lit(0))


def matches(text, pattern: str) -> Column:
    """All matches of a pattern, whole match."""
    return F.regexp_extract_all(as_column(text), F.lit(pattern), F.lit(0))


def json_quote(text) -> Column:
    """A JSON string literal, or the word null."""
    one = F.to_json(F.array(as_column(text)))
    return F.when(as_column(text).isNull(), F.lit("null")).otherwise(F.substr(one, F.lit(2), F.length(one) - 2))


def is_json_object(text) -> Column:
    """True when the text is one JSON object and nothing else.

    As the only entry of an array the text cannot have anything after it.
    """
    text = as_column(text)
    entries = F.json_array_length(F.concat(F.lit("["), text, F.lit("]")))
    return F.coalesce((entries == 1) & F.json_object_keys(text).isNotNull(), F.lit(False))


def fill(template, **slots) -> Column:
    """Replace ``{name}`` slots of a template column."""
    filled = as_column(template)
    for name, value in slots.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), as_column(value).cast("string"))
    return filled


def before_first(text, mark: str) -> Column:
    """The text before the first occurrence of a mark, or all of it."""
    return F.substring_index(as_column(text), mark, 1)


def sentence_count(text) -> Column:
    """Number of sentences: stretches of text ended by . ! or ? and white space."""
    parts = F.split(strip(text), r"[.!?]+(\s+|$)")
    return F.size(F.filter(parts, lambda p: F.length(strip(p)) > 0))
