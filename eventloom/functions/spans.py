"""Sorted intervals inside one row: where tokens end, where patterns match, which tokens a span covers.

Everything works on arrays of one row, so nothing is shuffled. Running sums take
log(n) passes over an array, and a position is found among n sorted ones in log(n) steps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.text import as_column, matches

_STEPS = 31
SPANS = "array<struct<start: int, stop: int>>"


def _steps(size: Column, falling: bool) -> Column:
    """Powers of two up to a size."""
    powers, bits = [1 << i for i in range(_STEPS)], F.length(F.bin(size))
    if falling:
        return F.slice(F.array(*[F.lit(p) for p in reversed(powers)]), _STEPS + 1 - bits, bits)
    return F.slice(F.array(*[F.lit(p) for p in powers]), F.lit(1), bits)


def bound(function, *values: Column) -> Column:
    """``function`` of columns that are evaluated once in a row."""
    names = [f"v{i}" for i in range(len(values))]
    one = F.array(F.struct(*[v.alias(n) for v, n in zip(values, names)]))
    return F.get(F.transform(one, lambda x: function(*[x[n] for n in names])), F.lit(0))


def _running(numbers: Column, combined) -> Column:
    """Each entry of an array combined with all before it, in passes that double their reach."""

    def passes(numbers: Column) -> Column:
        def doubled(sums: Column, step: Column) -> Column:
            return F.transform(sums, lambda x, i: F.when(i < step, x).otherwise(combined(x, F.get(sums, i - step))))

        return F.aggregate(_steps(F.size(numbers), False), numbers, doubled)

    return bound(passes, numbers)


def running_sum(numbers: Column) -> Column:
    """Sums of an array of numbers up to and with each entry."""
    return _running(numbers, lambda x, before: x + before)


def ends_of(pieces: Column) -> Column:
    """Where each piece of a text ends, in characters."""
    return running_sum(F.transform(pieces, lambda t: F.length(t)))


def count_upto(sorted_numbers: Column, limit: Column) -> Column:
    """How many entries of an ascending array are at most ``limit``."""
    return F.aggregate(
        _steps(F.size(sorted_numbers), True),
        F.lit(0),
        lambda n, step: F.when(F.get(sorted_numbers, n + step - 1) <= limit, n + step).otherwise(n),
    )


def spans_of(text, pattern: str) -> Column:
    """All matches of a pattern in order, as (start, stop) in characters."""
    source = as_column(text)

    def placed(before: Column, found: Column) -> Column:
        sizes = F.zip_with(F.slice(before, F.lit(1), F.size(found)), found, lambda b, m: F.length(b) + F.length(m))
        return bound(
            lambda stops: F.zip_with(stops, found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("stop"))),
            running_sum(sizes),
        )

    spans = bound(placed, F.split(source, pattern, -1), matches(source, pattern))
    return F.when(source.rlike(pattern), spans).otherwise(F.array().cast(SPANS))


def flagged(runs: Column, n: Column) -> Column:
    """``n`` flags, true in the runs (first, last), which come in the order of their starts; last is exclusive."""

    def made(runs: Column) -> Column:
        # Runs may overlap: a token already flagged is not flagged again.
        def marked(reach: Column) -> Column:
            def run(f: Column, i: Column) -> Column:
                before = F.coalesce(F.get(reach, i - 1), F.lit(0))
                start = F.greatest(f["first"], before)
                return F.concat(
                    F.array_repeat(F.lit(False), start - before), F.array_repeat(F.lit(True), F.greatest(f["last"], start) - start)
                )

            return F.flatten(F.transform(runs, run))

        return bound(marked, _running(F.transform(runs, lambda f: f["last"]), F.greatest))

    return bound(lambda found: F.concat(found, F.array_repeat(F.lit(False), n - F.size(found))), bound(made, runs))


#: Stands between the tokens of a text in ``runs_of``; a text that holds it itself has to be searched another way.
BORDER = "\x00"


def across_borders(literal: str, escaped) -> str:
    """A regular expression for a literal that token borders may run through."""
    return (BORDER_PATTERN + "*").join(escaped(ch) for ch in literal)


BORDER_PATTERN = r"\x00"


def runs_of(joined, pattern: str) -> Column:
    """The tokens that matches of a pattern touch, as runs (first, last), in a text whose tokens are joined by ``BORDER``.

    A token's number is the number of borders before it, so nothing is done token by token.
    """

    def borders(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(BORDER), F.lit("")))

    def placed(before: Column, found: Column) -> Column:
        crossed = F.zip_with(F.slice(before, F.lit(1), F.size(found)), found, lambda b, m: borders(b) + borders(m))
        return bound(
            lambda upto: F.zip_with(upto, found, lambda e, m: F.struct((e - borders(m)).alias("first"), (e + 1).alias("last"))),
            running_sum(crossed),
        )

    source = as_column(joined)
    return bound(placed, F.split(source, pattern, -1), matches(source, pattern))


def covered(ends: Column, spans: Column, whole: bool = False) -> Column:
    """For each token whether it overlaps one of the spans; ``whole``: whether it lies in one.

    ``ends`` are the token ends; spans come in the order of their starts. A span's first and
    last token are looked up in the sorted ends, and the flags between are made at once.
    """

    def flags(ends: Column, spans: Column) -> Column:
        n = F.size(ends)

        def tokens_of(s: Column) -> Column:
            if whole:
                first = F.when(s["start"] > 0, count_upto(ends, s["start"] - 1) + 1).otherwise(F.lit(0))
                last = F.greatest(first, count_upto(ends, s["stop"]))
            else:
                first = count_upto(ends, s["start"])
                last = F.least(count_upto(ends, s["stop"] - 1) + 1, n)
            return F.struct(first.alias("first"), last.alias("last"))

        return bound(lambda found: flagged(found, n), F.transform(spans, tokens_of))

    return F.when(F.size(spans) > 0, bound(flags, ends, spans)).otherwise(F.array_repeat(F.lit(False), F.size(ends)))
