"""Secret scanning with corpus-wide ownership of each candidate value.

Candidates are found in every whole text and hashed. How many repositories and owners
hold a value is counted over the whole corpus: a value that many owners hold is a copied
example, a value of few owners looks live. The base patterns are always reported; other
credential-like values only where ownership says that they look live.

Values leave a text as hashes only. Per value, distinct (repository, owner) pairs are
taken before they are counted, so a value that is in a third of all rows costs one row
per task and pair; its verdict is joined back as one row per value.

Defined results: a null or empty text has no spans; a null repository or owner counts as
one more, of its own; repeated rows hold the same spans each and do not make a value more
widely held, as their repository is the same; texts of any length are searched whole; spans that
start at one place are listed by kind; an empty table gives an empty result; input columns travel
in ``row`` and clash with nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import carried, written

#: Base kinds in their order, then the kinds the method adds.
BASE = ("assign", "access", "hex")
ADDED = ("key", "entropy")
KINDS = (*BASE, *ADDED)
#: A value held by at least this many owners is a copied example.
COMMON_OWNERS = 3

_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# Runs of the minimal length are the runs that pass; the greedy match is the same.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
#: Well-known shapes of provider keys: a prefix with a separator, then a long body.
_KEY = re.compile(r"(?:sk|pk|rk|gh[opsu]|xox[abp]|glpat|npm|hf)[_-][A-Za-z0-9_-]{16,}", re.ASCII)
_OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{24,}")

_SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.IntegerType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("value", T.StringType()),
        ]
    )
)


def _opaque(value: str) -> bool:
    """Mixed letters and digits with few repeats: no word, number or ruler line."""
    return (
        any(c.isdigit() for c in value)
        and any(c.isupper() for c in value)
        and any(c.islower() for c in value)
        and len(set(value)) * 2 >= min(len(value), 32)
    )


def candidates(text) -> list[tuple[int, int, int, str]]:
    """(kind number, start, end, hash of the value) of all candidates in a text."""
    if not isinstance(text, str) or not text:
        return []
    found = [(0, m.start(), m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [(1, *m.span(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(2, *m.span(), m[0]) for m in _HEX.finditer(text)]
    taken = bytearray(len(text))
    for _, s, e, _ in found:
        taken[s:e] = b"x" * (e - s)
    for kind, pattern, fits in ((3, _KEY, None), (4, _OPAQUE, _opaque)):
        for m in pattern.finditer(text):
            s, e = m.span()
            if (fits is None or fits(m[0])) and not any(taken[s:e]):
                found.append((kind, s, e, m[0]))
                taken[s:e] = b"x" * (e - s)
    return sorted((kind, s, e, sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32]) for kind, s, e, v in found)


@F.pandas_udf(_SPANS)
def _candidates(texts: pd.Series) -> pd.Series:
    return pd.Series([candidates(text) for text in texts])


_candidates = _candidates.asNondeterministic()


def scan(
    docs: DataFrame,
    text: str = "text",
    repository: Column | str = "source",
    owner: Column | str = "source",
    common_owners: int = COMMON_OWNERS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The input ``row`` with ``spans``: kind, start, end, value hash, repositories, owners and ``live``."""
    found = carried(docs, keep, text=text, repository=repository, owner=owner).select(
        "row",
        F.struct(F.col("repository").cast("string").alias("repository"), F.col("owner").cast("string").alias("owner")).alias("place"),
        _candidates("text").alias("found"),
        F.monotonically_increasing_id().alias("no"),
    )
    found = written(found, "candidates")
    each = found.select("no", "place", F.explode("found").alias("s")).select("no", "place", "s.*")
    held = (
        each.select("value", "place")
        .distinct()
        .groupBy("value", F.struct("place.owner").alias("owner"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value")
        .agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))
    )
    judged = (
        each.join(held, "value")
        .select(
            "no",
            F.struct(
                "kind", "start", "end", "value", "repositories", "owners", (F.col("owners") < common_owners).alias("live")
            ).alias("s"),
        )
        .groupBy("no")
        .agg(F.array_sort(F.collect_list("s")).alias("spans"))
    )
    empty = F.array().cast(judged.schema["spans"].dataType)
    return found.join(judged, "no", "left").select("row", F.coalesce("spans", empty).alias("spans"))


def reported(spans: Column) -> Column:
    """Base spans, and of the others those that look live."""
    return F.filter(spans, lambda s: (s["kind"] < len(BASE)) | s["live"])


def listed(spans: Column, by_kind: bool = False) -> Column:
    """``kind:start:end`` of spans, joined by commas; by start, then kind, or the other way."""
    names = F.array(*[F.lit(k) for k in KINDS])
    order = ("kind", "start", "end") if by_kind else ("start", "kind", "end")
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in order])))
    said = F.transform(
        ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.concat_ws(",", said)
