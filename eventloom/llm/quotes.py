"""Conversations rebuilt from quotations.

Messages that answer others often carry them along as quoted lines (``>``, ``>>``, ...).
Quote levels are parsed, quoted passages (paragraphs and single lines) are normalised and
hashed, and joined to the first message that holds the same passage as its own words: the
first earlier one in the same conversation, else the first earlier one anywhere. A message answers
the origin of its least deeply quoted passages; where several qualify, of the most quoted
characters, then the latest. Following answers up to a message that answers none gives the
conversation a message belongs to and its depth there, so that ordering by (root, depth,
turn) puts each answer after what it answers. Quoted lines leave the text.

All of it is DataFrame functions. A passage keeps one row per conversation and one for the
corpus, taken by map-side minima, so a very common line or first turn costs no pairs. Depths
come from pointer doubling: as many rounds as the logarithm of the longest chain.

Defined results: a null or empty text has no passages and stays as it is; a message with a
null conversation or turn is kept and neither answers nor is answered; repeated
(conversation, turn) rows share their answer and depth; of several holders of a passage the first
in order counts; texts of any length are read whole; an empty table gives an empty result; input
columns travel in ``row`` and clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import carried, written

MARK, STAND_IN = "\u0001", "\u0002"
# Possessive, as a greedy group would recurse once per level.
_PREFIX = r"^(?:[\x20\t]*+>)++"
#: How the line before a quotation says who wrote it.
_ATTRIBUTION = r"(?i)\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"


def _lines(text: Column) -> Column:
    """Lines with their quote level and their text without quote marks."""
    clean = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), MARK, STAND_IN)

    def parsed(line: Column) -> Column:
        prefix = F.regexp_extract(line, _PREFIX, 0)
        level = F.char_length(F.regexp_replace(prefix, "[^>]", ""))
        body = F.substr(line, F.char_length(prefix) + 1)
        return F.struct(level.alias("level"), F.when(level > 0, F.regexp_replace(body, r"^[\x20\t]", "")).otherwise(line).alias("body"))

    return F.transform(F.split(clean, "\n", -1), parsed)


def _without_attribution(lines: Column) -> Column:
    """Lines that name the author of a quotation right below are part of it."""
    return F.transform(
        lines,
        lambda line, i: F.when(
            (line["level"] == 0) & line["body"].rlike(_ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0),
            line.withField("level", F.lit(-1)),
        ).otherwise(line),
    )


def _passages(lines: Column) -> Column:
    """Paragraphs: runs of lines of one level without a blank line, with their level."""
    blank = lambda line: ~line["body"].rlike(r"\S")
    tagged = F.transform(
        lines,
        lambda line, i: F.when(
            (i == 0) | blank(line) | (F.get(lines, i - 1)["level"] != line["level"]) | blank(F.get(lines, i - 1)),
            F.concat(F.lit(MARK), line["level"].cast("string"), F.lit(":"), line["body"]),
        ).otherwise(F.concat(F.lit("\n"), line["body"])),
    )
    cut = F.filter(F.split(F.array_join(tagged, ""), MARK, -1), lambda p: p != "")
    return F.transform(
        cut,
        lambda p: F.struct(
            F.substring_index(p, ":", 1).cast("int").alias("level"),
            F.substr(p, F.instr(p, ":") + 1).alias("body"),
        ),
    )


def normalised(body: Column) -> Column:
    """Words in lower case with single spaces, so that wrapping and case don't matter."""
    return F.trim(F.regexp_replace(F.lower(body), r"\s+", " "))


def parsed(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """The input ``row`` with conv, turn, ``own`` (the text without quotations), ``levels`` and ``passages``."""
    rows = carried(messages, conv=conv_id, turn=turn, text=text)
    lined = rows.select("row", "conv", "turn", "text", F.inline(F.array(F.struct(_lines(F.col("text")).alias("lines")))))
    marked = lined.select("row", "conv", "turn", "text", F.inline(F.array(F.struct(_without_attribution(F.col("lines")).alias("lines")))))
    quoting = F.exists("lines", lambda line: line["level"] > 0)
    own = F.array_join(F.transform(F.filter("lines", lambda line: line["level"] == 0), lambda line: line["body"]), "\n")
    tidy = F.regexp_replace(F.regexp_replace(own, "\n{3,}", "\n\n"), r"^\n+|\n+$", "")
    return marked.select(
        "row",
        "conv",
        "turn",
        F.when(quoting, tidy).otherwise(F.col("text")).alias("own"),
        F.array_max(F.transform("lines", lambda line: F.greatest(line["level"], F.lit(0)))).alias("levels"),
        F.inline(F.array(F.struct(_passages(F.col("lines")).alias("passages")))),
    )


def _units(rows: DataFrame) -> DataFrame:
    """Normalised passages and, of longer ones, their lines: conv, turn, level, hash and weight."""
    each = rows.where("conv IS NOT NULL AND turn IS NOT NULL").select("conv", "turn", F.explode("passages").alias("p"))
    bodies = F.when(F.col("p.body").contains("\n"), F.concat(F.array("p.body"), F.split("p.body", "\n"))).otherwise(F.array("p.body"))
    return (
        each.select("conv", "turn", "p.level", F.explode(bodies).alias("body"))
        .select("conv", "turn", "level", normalised(F.col("body")).alias("body"))
        .where("body <> ''")
        .select("conv", "turn", "level", F.md5("body").alias("hash"), F.char_length("body").alias("weight"))
    )


def linked(rows: DataFrame) -> DataFrame:
    """For each quoted passage of a message, ``origin``, the (conv, turn) it comes from, or null.

    ``rows`` is a written table of parsed messages.
    """
    units = _units(rows)
    own = units.where("level = 0")
    # First a minimum per conversation and passage, then of those one per passage.
    here = own.groupBy("hash", "conv").agg(F.min("turn").alias("first"))
    anywhere = here.groupBy("hash").agg(F.min(F.struct(F.col("conv").alias("conv"), F.col("first").alias("turn"))).alias("elsewhere"))
    quoted = units.where("level > 0").groupBy("conv", "turn", "level", "hash").agg(F.sum("weight").alias("weight"))
    at = F.struct(F.col("conv").alias("conv"), F.col("turn").alias("turn"))
    near = F.when(F.col("first") < F.col("turn"), F.struct(F.col("conv").alias("conv"), F.col("first").alias("turn")))
    far = F.when(F.col("elsewhere") < at, F.col("elsewhere"))
    return (
        quoted.join(here, ["hash", "conv"], "left")
        .join(anywhere, "hash", "left")
        .select("conv", "turn", "level", "weight", F.coalesce(near, far).alias("origin"))
    )


def answers(links: DataFrame) -> DataFrame:
    """What each quoting message answers: conv, turn, ``quoted``, ``linked`` and ``parent``."""
    by_origin = links.groupBy("conv", "turn", "origin").agg(
        F.min("level").alias("level"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")
    )
    rank = F.struct(-F.col("level"), "weight", "origin.turn", "origin.conv")
    return by_origin.groupBy("conv", "turn").agg(
        F.sum("n").alias("quoted"),
        F.sum(F.when(F.col("origin").isNotNull(), F.col("n")).otherwise(0)).alias("linked"),
        F.max_by("origin", F.when(F.col("origin").isNotNull(), rank)).alias("parent"),
    )


def roots(parents: DataFrame) -> DataFrame:
    """For each message (conv, turn) with a ``parent``: ``root`` and ``depth``. Parents are always earlier."""
    at = F.struct(F.col("conv").alias("conv"), F.col("turn").alias("turn"))
    state = written(parents.select(at.alias("node"), F.col("parent").alias("root"), F.lit(1).cast("bigint").alias("depth")), "answers")
    while True:
        above = state.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        state = written(
            state.join(above, "root", "left").select(
                "node",
                F.coalesce("next", "root").alias("root"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "answers",
        )
        if state.where("moved").isEmpty():
            return state.select("node", "root", "depth")
        state = state.drop("moved")


def conversations(messages: DataFrame, conv_id: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """The input ``row`` of each message with its text without quotations and its place.

    ``conversation``, ``root_turn``, ``depth`` and the turn order a conversation by answers.
    """
    rows = written(parsed(messages, conv_id, turn, text), "messages")
    told = written(answers(linked(rows)), "answered")
    tree = roots(told.where("parent IS NOT NULL"))
    placed = told.join(tree.select("node.*", "root", "depth"), ["conv", "turn"], "left")
    return rows.join(placed, ["conv", "turn"], "left").select(
        "row",
        "own",
        "levels",
        F.coalesce("quoted", F.lit(0)).alias("quoted"),
        F.coalesce("linked", F.lit(0)).alias("linked"),
        F.col("parent.conv").alias("answers_conv"),
        F.col("parent.turn").alias("answers_turn"),
        F.coalesce("root.conv", "conv").alias("conversation"),
        F.coalesce("root.turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
    )
