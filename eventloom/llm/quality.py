"""Quality rules as a ledger of failure bits, with versioned policies and ablations.

Every rule is evaluated once per document. The ledger holds the measurements and one bit
per failed rule; a policy is a set of rules that reject, so changing a policy or asking
what a rule is worth reads the bits only, never the text.

Defined results: a null or empty text has zero words and measurements of zero, and fails
``few_words`` only; texts of any length are measured whole; repeated rows are judged
alike, each for itself; no rule compares rows, so there are no ties; an empty table gives an
empty ledger; input columns travel in ``row`` and clash with nothing.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import bytes_of, carried

#: Measurements of a text, in the order ``measured`` gives them.
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_letter_words",
    "n_letters",
    "n_capitals",
)
SYMBOLS = b"#*$%&|<>"

#: Rules in the order of their bits: a condition over the measurements that means failure.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "few_letter_words": "100 * n_letter_words < 70 * n_words",
    "capitals": "100 * n_capitals > 30 * n_letters",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules; a document that fails any of them is rejected."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules=RULES) -> int:
        order = list(rules)
        return sum(1 << order.index(rule) for rule in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STANDARD = Policy("standard", 2, tuple(RULES))


def measure(text) -> tuple[int, ...]:
    """The measurements of one text."""
    raw = bytes_of(text)
    words = raw.split()
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        found = Counter(windows)
        covered = -1  # the last word already counted
        for i, window in enumerate(windows):
            if found[window] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    lines = [line for line in raw.split(b"\n") if line.split()]
    joined = b"".join(words).decode("utf-8", "surrogatepass")
    letters = joined if joined.isalpha() else "".join(filter(str.isalpha, joined))
    return (
        len(words),
        len(joined),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated,
        sum(map(_has_letter, words)),
        len(letters),
        sum(map(str.isupper, letters)),
    )


def _has_letter(word: bytes) -> bool:
    """A word of ASCII letters alone is the common case and needs no decoding."""
    return word.isalpha() or any(map(str.isalpha, word.decode("utf-8", "surrogatepass")))


@F.pandas_udf(T.StructType([T.StructField(name, T.LongType()) for name in MEASURES]))
def _measured(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(text) for text in texts], columns=MEASURES, dtype="int64")


# A filter on the result must not be moved below it and measure every text twice.
_measured = _measured.asNondeterministic()


def ledger(docs: DataFrame, text: str = "text", rules: dict[str, str] = RULES, keep: Sequence[str] | None = None) -> DataFrame:
    """Measurements (columns of ``MEASURES``), ``failed`` (one bit per rule) and the input ``row``."""
    measured = carried(docs, keep, text=text).select("row", _measured("text").alias("m")).select("row", "m.*")
    bits = [F.when(F.expr(condition), F.lit(1 << i)).otherwise(F.lit(0)) for i, condition in enumerate(rules.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed.cast("bigint"))


def rejects(policy: Policy, rules: dict[str, str] = RULES, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) != 0


def verdicts(rows: DataFrame, *policies: Policy, rules: dict[str, str] = RULES) -> DataFrame:
    """Add ``kept_<name>_v<version>`` for each policy, from the bits alone."""
    return rows.select("*", *[(~rejects(p, rules)).alias(f"kept_{p.name}_v{p.version}") for p in policies])


def ablations(rows: DataFrame, policy: Policy, rules: dict[str, str] = RULES) -> DataFrame:
    """What each rule of a policy is worth, one row per rule.

    ``n_failed``: documents that fail it; ``n_only``: documents that would be kept
    without it. Documents are first counted by their bits (at most 2 to the number of
    rules rows, combined before the shuffle); rules are compared with those counts.
    """
    mask = policy.mask(rules)
    counts = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("bigint")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    each = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << list(rules).index(r)).cast("bigint").alias("bit")) for r in policy.rules])
    )
    hit = F.col("bits").bitwiseAND(F.col("rule.bit")) != 0
    return (
        counts.select("bits", "n", each.alias("rule"))
        .groupBy(F.col("rule.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == F.col("rule.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        )
    )
