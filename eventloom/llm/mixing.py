"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / size times. Expected copies are summed
in the order of document size, one offset per source is added, and a document is emitted
once per integer its stretch of the sum crosses. As neighbours in that order are of like
size, a source's taken words differ from its target by less than its largest document.

The order within a source is (size, hash of the id, id). Running sums are made in three
steps, over sizes, over hash ranges of one size, and inside a range, so neither a hot
source nor a large group of equal documents is sorted in one task.

All of it is DataFrame operations; runs agree because order and offset depend on ids and
a seed only. Defined results: a null or empty text has size 0 and may be emitted, which
takes no words; the null source is a source of its own and comes last; a source without
words has target 0 and emits nothing; equal rows with equal ids are interchangeable; an
empty table gives an empty mix; input columns travel in ``row`` and clash with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import WORD, carried, hash32, ranked, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEATS = 2


def words_in(text: Column) -> Column:
    """Number of words; null counts as no text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Targets for a table (source, source_size) of one row per source.

    All targets are one level times the weight, stopped at ``max_repeats`` times the size;
    the level is where they add up to the shared words. Sources reach their stop in the
    order of stop / weight, so the level follows from running sums in that order. This is one
    row per source, not per document, so one task orders it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    listed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    stop = F.col("source_size") * max_repeats
    by_stop = Window.orderBy(stop / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum(stop).over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    levels = listed.withColumn("_level", level).withColumn("_reached", F.col("_level") * F.col("weight") > stop)
    # The first source that does not reach its stop sets the level for all that follow.
    final = F.min(F.when(~F.col("_reached"), F.struct(stop / F.col("weight"), F.col("_level")))).over(whole)
    return levels.withColumn("_final", final["_level"]).select(
        "source",
        "source_size",
        F.least(stop.cast("double"), F.coalesce(F.col("_final") * F.col("weight"), stop.cast("double"))).alias("target"),
    )


def copies(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = 7,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The input ``row`` with size, source_size, target and ``copies``, the times it is emitted."""
    # A null source is kept apart from an empty name; both are keys that joins can use.
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"))
    measured = written(
        carried(docs, keep, doc_id=doc_id, source=source, text=text).select(
            "row",
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
            key.alias("key"),
            words_in(F.col("text")).alias("size"),
        ),
        "sizes",
    )
    by_size = written(
        measured.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")), "size-counts"
    )
    sources = targets(
        by_size.groupBy("key").agg(F.sum("words").alias("source_size")).select(F.when(~F.col("key.none"), F.col("key.name")).alias("source"), "source_size"),
        weights,
        share,
        max_repeats,
    )
    earlier = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = by_size.select("key", "size", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead")).join(
        sources.select(key.alias("key"), "source_size", "target"), "key"
    )
    placed = ranked(measured.withColumn("h", hash32("id")), ["key", "size"], "h", ["id"], "place", beside=ahead)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # 16 bits of offset leave the sums exact up to 2**36 rows of a source.
    offset = F.floor(hash32(F.lit(str(seed)), F.col("key.name")) / F.lit(1 << 16)) / F.lit(float(1 << 16))
    rank = F.col("ahead") + F.col("place")
    return placed.select(
        "row",
        "size",
        "source_size",
        "target",
        (F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)).alias("copies"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each input row as often as it is emitted, with the input's columns."""
    return (
        copies(docs, **options)
        .where("copies > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
        .select("row.*")
    )


def copies_sql(table: str = "documents", weights=WEIGHTS, share=SHARE, max_repeats=MAX_REPEATS, seed: int = 7) -> str:
    """DuckDB SQL for (doc_id, size, source_size, target, taken) over a table or query."""
    listed = ", ".join(str(float(w)) for w in weights)
    hash32 = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"
    return f"""
WITH measured AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD.replace(chr(92) + 'x20', ' ')}')) AS BIGINT) AS size,
    {hash32.format("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h
  FROM {table}),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    list_value({listed})[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}] AS weight
  FROM measured GROUP BY source),
levels AS (
  SELECT *, ({share} * sum(source_size) OVER () - coalesce(sum({max_repeats} * source_size) OVER earlier, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM sizes
  WINDOW earlier AS (ORDER BY {max_repeats} * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (
  SELECT source, source_size, CAST(least({max_repeats} * source_size, coalesce(weight * arg_min(level, {max_repeats} * source_size / weight)
    FILTER (level * weight <= {max_repeats} * source_size) OVER (), {max_repeats} * source_size)) AS DOUBLE) AS target
  FROM levels),
placed AS (
  SELECT m.doc_id, m.size, g.source_size, g.target, CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
    floor({hash32.format(f"'{seed}:' || coalesce(m.source, '')")} / 65536) / 65536.0::DOUBLE AS u,
    row_number() OVER (PARTITION BY m.source ORDER BY m.size, m.h, m.doc_id) AS r
  FROM measured m JOIN goals g ON m.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  CAST((floor(rate * r + u) - floor(rate * (r - 1) + u)) * size AS BIGINT) AS taken
FROM placed"""
