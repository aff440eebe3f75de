"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a classifier decides.

Candidates are found in every whole text by broad patterns. Labelers (a strict form, a
gazetteer, the words before, the borders, the company of other candidates) each vote
yes, no or nothing. Expectation-maximisation over the counts of vote patterns estimates how
often each labeler is right; the estimated truth then trains a naive Bayes classifier over
features of a span, which also covers spans no labeler voted on. Spans of the base kinds are
always reported; spans of the other kinds where the classifier says so.

All of it is DataFrame and SQL functions. What is gathered is bounded: at most 3 to the
number of labelers vote patterns, and one weight per feature value.

Defined results: a null or empty text has no spans; a text of any length is searched whole;
repeated rows each have their spans; spans are listed by kind, then start; an empty
table gives an empty result; input columns travel in ``row`` and clash with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import carried, quoted, written

MARK, STAND_IN = "\u0001", "\u0002"
#: Base kinds in their order, then the kinds the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("long_number", "local_phone", "id_number", "account")
KINDS = (*BASE, *ADDED)

# A match can only begin where a run of its first class begins, or right after the match
# before; saying so keeps the search linear and finds the same matches. Repeated groups are
# possessive (++): nothing follows them, and others would recurse once per repetition.
_LOCAL = r"[A-Za-z0-9._%+-]"
_PATTERNS = (
    (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "@"),
    (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]+){3}", "."),
    (r"[0-9](?:[\x20-]?[0-9])++", None),
    (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    (
        r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|\(?[0-9]{3}\)?\x20?[0-9]{3}[-.\x20][0-9]{4}"
        r"|[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})(?![0-9A-Za-z])",
        None,
    ),
)

#: Top-level domains, reserved names and address ranges, and words of context.
DOMAINS = "com org net edu gov int info biz io ai dev app eu de fr es it nl ch at uk us ca au jp br in"
RESERVED = r"(?i)(example|test|invalid|localhost)\b"
PRIVATE_RANGES = r"^(0|10|127|255|192\.168|169\.254)\."
WORDS_FOR = (
    "mail email contact write call phone tel telephone mobile fax card credit account iban ssn passport ip server host "
    "from kontakt anrufen telefon konto karte courriel appeler carte compte correo llamar tarjeta cuenta"
)
WORDS_AGAINST = "version release isbn issn doi section figure table page order invoice item part model no nr id seed"

ROUNDS = 15


def _parts(text: Column, pattern: str, needs: str | None) -> Column:
    """A text cut at its matches: text before, match, text between, match, ..."""
    cut = F.split(F.regexp_replace(text, F.lit(f"({pattern})"), F.lit(f"{MARK}$1{MARK}")), MARK, -1)
    return F.when(text.contains(needs), cut) if needs else cut


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _matches(kind: Column, parts: Column) -> Column:
    """The matches in ``parts`` with code-point positions and what stands around them.

    A part starts after the parts before it: after whole chunks, whose starts are summed once,
    and after the parts before it in its own chunk. So many matches in a text stay affordable.
    """
    chunk = 256

    def starts_of_chunks(lengths: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / chunk).cast("int"))
        sums = F.transform(firsts, lambda c: F.aggregate(F.slice(lengths, c * chunk + 1, chunk), F.lit(0), lambda a, n: a + n))
        return F.aggregate(sums, F.array(F.lit(0)), lambda found, n: F.array_append(found, F.element_at(found, -1) + n))

    def found(lengths: Column, starts: Column) -> Column:
        def at(i: Column) -> Column:
            own = F.slice(lengths, i - i % chunk + 1, i % chunk)
            return F.get(starts, F.floor(i / chunk).cast("int")) + F.aggregate(own, F.lit(0), lambda a, n: a + n)

        return F.transform(
            F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)),
            lambda i: F.struct(
                kind.alias("kind"),
                at(i).alias("start"),
                (at(i) + F.get(lengths, i)).alias("end"),
                F.get(parts, i).alias("value"),
                F.right(F.get(parts, i - 1), F.lit(24)).alias("before"),
                F.left(F.get(parts, i + 1), F.lit(8)).alias("after"),
            ),
        )

    inner = _bound(F.transform(parts, F.char_length), lambda n: _bound(starts_of_chunks(n), lambda s: found(n, s)))
    return F.when(F.size(parts) > 1, inner)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the last digit fits the others."""
    n = F.length(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: (
            F.substr(digits, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda s, d: s + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def _octets_fit(value: Column) -> Column:
    """All numbers at most 255, however many zeros lead."""
    numbers = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(numbers, lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0)) <= 255).otherwise(False))


def _valid(kind: int, s: Column) -> Column:
    """What a match of a base kind must fulfil beyond its pattern."""
    if kind == 1:
        return _octets_fit(s["value"])
    digits = _digits(s["value"])
    if kind == 2:
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == 3:
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _check(kind: int):
    return lambda s: _valid(kind, s)


def _added_kind(value: Column) -> Column:
    return (
        F.when(value.rlike("^[0-9]{13,19}$"), 4)
        .when(value.rlike("^[A-Z]"), 7)
        .when(value.rlike("^[0-9]{3}-[0-9]{2}-"), 6)
        .otherwise(5)
    )


def found(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The input ``row``, a row number ``no`` and the array ``spans`` of candidates; the base ones are valid."""
    clean = F.translate(F.coalesce(F.col("text"), F.lit("")), MARK, STAND_IN)
    rows = carried(docs, keep, text=text).select("row", clean.alias("text"))
    # A generator of one row keeps the cut texts from being computed once per use.
    cut = rows.select(
        "row", F.inline(F.array(F.struct(*[_parts(F.col("text"), p, needs).alias(f"p{k}") for k, (p, needs) in enumerate(_PATTERNS)])))
    )
    matched = cut.select("row", F.inline(F.array(F.struct(*[_matches(F.lit(k), F.col(f"p{k}")).alias(f"m{k}") for k in range(5)]))))
    base = F.array_compact(F.array(*[F.filter(f"m{k}", _check(k)) for k in range(4)]))
    valid = matched.select("row", F.inline(F.array(F.struct(F.flatten(base).alias("base"), F.col("m4").alias("other")))))
    apart = F.filter(
        F.coalesce("other", F.array().cast(matched.schema["m4"].dataType)),
        lambda a: ~F.exists("base", lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])),
    )
    others = F.transform(apart, lambda s: s.withField("kind", _added_kind(s["value"])))
    return valid.select("row", F.monotonically_increasing_id().alias("no"), F.concat("base", others).alias("spans"))


def _among(words: str) -> str:
    return "|".join(words.split())


def votes() -> dict[str, Column]:
    """Each labeler's vote on a candidate: 1 yes, 0 no, null nothing."""
    kind, value = F.col("kind"), F.col("value")
    digits = _digits(value)
    strict = (
        F.when(kind == 0, value.rlike(r"^[A-Za-z0-9][^@]*@[A-Za-z0-9][^@]*\.[A-Za-z]{2,}$") & ~value.rlike(r"\.\.|\.-|-\."))
        .when(kind == 1, value.rlike(r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$"))
        .when(kind.isin(2, 4), F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False))
        .when(kind == 3, value.rlike(r"^\+[1-9][0-9]{0,2}[ .(-]"))
        .when(kind == 5, value.rlike(r"^\([2-9][0-9]{2}\) ?[0-9]{3}-[0-9]{4}$"))
        .when(kind == 6, ~value.rlike("^(?:000|666|9)|-00-|-0000$"))
        .otherwise(value.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{4}[0-9]{7,}$"))
    )
    gazetteer = (
        F.when((kind == 0) & value.rlike(RESERVED), None)
        .when(kind == 0, value.rlike(rf"(?i)\.(?:{_among(DOMAINS)})$"))
        .when(kind == 1, ~value.rlike(PRIVATE_RANGES))
        .when(kind.isin(2, 4), digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"))
        .when(kind.isin(5, 6), None)
        .otherwise(None)
    )
    context = F.when(F.col("before").rlike(rf"(?i)\b(?:{_among(WORDS_FOR)})\W*$"), True).when(
        F.col("before").rlike(rf"(?i)\b(?:{_among(WORDS_AGAINST)})\W*$"), False
    )
    border = ~(F.col("before").rlike("[0-9A-Za-z_/=-]$") | F.col("after").rlike(r"^[0-9A-Za-z_/=-]|^\.[0-9]"))
    company = F.when(F.col("in_text") > 1, True)
    return {
        name: vote.cast("int")
        for name, vote in (("strict", strict), ("gazetteer", gazetteer), ("context", context), ("border", border), ("company", company))
    }


def _features() -> Column:
    """What the classifier looks at: one value per feature, all from small fixed sets."""
    value = F.col("value")
    named = {
        "kind": F.col("kind"),
        "digits": F.least(F.length(_digits(value)), F.lit(20)),
        "length": F.least(F.floor(F.char_length(value) / 4), F.lit(12)),
        "first": F.when(value.rlike("^[0-9]"), "d").when(value.rlike("^[A-Za-z]"), "a").otherwise("p"),
        "before": F.when(F.col("before").rlike("[A-Za-z]$"), "a").when(F.col("before").rlike("[0-9]$"), "d").when(F.col("before").rlike(r"\s$|^$"), "s").otherwise("p"),
        "after": F.when(F.col("after").rlike("^[A-Za-z]"), "a").when(F.col("after").rlike("^[0-9]"), "d").when(F.col("after").rlike(r"^\s|^$"), "s").otherwise("p"),
    }
    return F.array(*[F.concat_ws(":", F.col("kind").cast("string"), F.lit(n), v.cast("string")) for n, v in named.items()])


def reliabilities(patterns: DataFrame, labelers: Sequence[str], rounds: int = ROUNDS) -> DataFrame:
    """One row (share, hits, misses): expectation-maximisation over counted vote patterns.

    ``hits[l]`` is how often labeler l says yes of what is personal, ``misses[l]`` of what is
    not, where it votes. Few made-up votes in favour of the labelers keep estimates off 0 and 1.
    """
    n = len(labelers)
    gathered = patterns.agg(F.collect_list(F.struct(F.array(*labelers).alias("v"), F.col("n").cast("double").alias("n"))).alias("ps"))
    odds = (
        "ln(q.share / (1 - q.share)) + aggregate(sequence(0, {last}), 0D, (s, l) -> s + CASE p.v[l] "
        "WHEN 1 THEN ln(q.hits[l] / q.misses[l]) WHEN 0 THEN ln((1 - q.hits[l]) / (1 - q.misses[l])) ELSE 0D END)"
    ).format(last=n - 1)
    judged = f"transform(ps, p -> named_struct('v', p.v, 'n', p.n, 'y', 1 / (1 + exp(-({odds})))))"

    def voted(weight: str, only_yes: bool) -> str:
        counts = "e.v[l] = 1" if only_yes else "e.v[l] IS NOT NULL"
        return f"aggregate(es, 0D, (s, e) -> s + IF({counts}, e.n * {weight}, 0D))"

    def rates(weight: str, yes: int, no: int) -> str:
        return (
            f"transform(sequence(0, {n - 1}), l -> ({voted(weight, True)} + {yes}) / ({voted(weight, False)} + {yes + no}))"
        )

    updated = (
        "named_struct('share', (aggregate(es, 0D, (s, e) -> s + e.n * e.y) + 1) / (aggregate(es, 0D, (s, e) -> s + e.n) + 2), "
        f"'hits', {rates('e.y', 4, 1)}, 'misses', {rates('(1 - e.y)', 1, 4)})"
    )
    # The estimates of one round are an array of one, so that its name stands for them in the next step.
    step = f"element_at(transform(array({judged}), es -> {updated}), 1)"
    start = f"named_struct('share', 0.5D, 'hits', array_repeat(0.8D, {n}), 'misses', array_repeat(0.2D, {n}))"
    return gathered.select(F.expr(f"aggregate(sequence(1, {rounds}), {start}, (q, r) -> {step})").alias("q")).select("q.*")


def classified(candidates: DataFrame) -> DataFrame:
    """Candidates of texts (no, spans), one row each, with ``probability``.

    ``candidates`` should be a written table: it is read twice.
    """
    labelers = votes()
    each = candidates.select("no", F.size("spans").alias("in_text"), F.explode("spans").alias("s")).select("no", "in_text", "s.*")
    voted = written(
        each.select("no", "kind", "start", "end", _features().alias("features"), *[v.alias(n) for n, v in labelers.items()]), "votes"
    )
    patterns = voted.groupBy(*labelers).agg(F.count(F.lit(1)).alias("n"))
    q = reliabilities(patterns, list(labelers)).first()
    share = F.ln(F.lit(q.share / (1 - q.share)))
    odds = share
    for i, name in enumerate(labelers):
        yes, no = F.ln(F.lit(q.hits[i] / q.misses[i])), F.ln(F.lit((1 - q.hits[i]) / (1 - q.misses[i])))
        odds = odds + F.when(F.col(name) == 1, yes).when(F.col(name) == 0, no).otherwise(0.0)
    labelled = voted.withColumn("y", 1 / (1 + F.exp(-odds)))
    counted = (
        labelled.select("y", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("y").alias("yes"), F.sum(1 - F.col("y")).alias("no"))
    )
    # One weight per feature value: few hundred, whatever the corpus.
    weights = counted.select(F.map_from_entries(F.collect_list(F.struct("feature", F.ln((F.col("yes") + 1) / (F.col("no") + 1))))).alias("w"))
    scored = labelled.withColumn("w", weights.scalar())
    # The smoothed log odds of the features, averaged: their values are far from independent.
    mean = F.aggregate(F.transform("features", lambda f: F.col("w")[f]), F.lit(0.0), lambda s, x: s + x) / F.size("features")
    return scored.select("no", "kind", "start", "end", (1 / (1 + F.exp(-mean))).alias("probability"))


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """The input ``row`` with ``spans`` (kind, start, end, probability) of personal data, by kind and start."""
    rows = written(found(docs, text, keep), "candidates")
    kept = classified(rows.select("no", "spans")).where((F.col("kind") < len(BASE)) | (F.col("probability") >= threshold))
    by_text = kept.groupBy("no").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end", "probability"))).alias("personal"))
    empty = F.array().cast(by_text.schema["personal"].dataType)
    return rows.select("no", "row").join(by_text, "no", "left").select("row", F.coalesce("personal", empty).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``<KIND>``; of overlapping spans the first, then the longest, counts."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("longest"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    built = F.aggregate(
        order,
        begin,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                (-s["longest"]).alias("at"),
                F.concat(
                    a["out"],
                    F.array(F.substr(text, a["at"] + 1, s["start"] - a["at"]), F.element_at(names, s["kind"] + 1)),
                ).alias("out"),
            ),
        ).otherwise(a),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1, F.greatest(F.char_length(text) - a["at"], F.lit(0)))),
    )
    return F.when(F.size(spans) > 0, built).otherwise(text)


def redact(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The input with personal data in ``text`` replaced; its other columns stay."""
    rows = scan(docs, text, threshold=threshold)
    told = [F.col(f"row.{quoted(c)}") if c != text else redacted(F.col(f"row.{quoted(c)}"), F.col("spans")).alias(c) for c in docs.columns]
    return rows.select(*told)


def listed(spans: Column) -> Column:
    """``kind:start:end`` by kind, then start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end")])))
    said = F.transform(
        ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.concat_ws(",", said)
