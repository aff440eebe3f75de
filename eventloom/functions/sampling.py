"""Seeded choices that do not depend on partitioning, so runs repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 5


def seeded_hash(seed, *parts) -> Column:
    """md5 over ``seed:part:part...`` as hex text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(p) if isinstance(p, str) else p for p in parts]))


def hash_number(digest: Column) -> Column:
    """The first 60 bits of a hex digest as a non-negative number."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_index(seed, part, n) -> Column:
    """A number in [0, n) for each row."""
    return F.pmod(hash_number(seeded_hash(seed, part)), n if isinstance(n, Column) else F.lit(n))


def below_probability(seed, part, probability: float) -> Column:
    """True for about ``probability`` of all ids; the same ids on every run."""
    if probability >= 1:
        return F.lit(True)
    bound = format(int(probability * 16**8), "08x")
    return F.substring(seeded_hash(seed, part), 1, 8) < F.lit(bound)


def dense_index(rows: DataFrame, id_column: str, seed=0, name: str = "row_index") -> DataFrame:
    """Number all rows 0..N-1 in hash order without sorting them in one task.

    Rows fall evenly into 16**5 buckets by the start of their hash and are numbered
    inside their bucket: 100,000 rows each at 10**11 rows. The bucket offsets are a table
    of at most 1,048,576 rows of 24 bytes, which is what makes the broadcast safe.
    """
    keyed = rows.withColumn("_hash", seeded_hash(seed, F.col(id_column).cast("string"))).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", id_column)
    return (
        keyed.withColumn("_position", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_offset") + F.col("_position") - 1)
        .drop("_hash", "_bucket", "_offset", "_position")
    )


#: Stretches of row numbers that draws and buckets are joined by.
STRETCHES = 1024


def draw_with_replacement(rows: DataFrame, id_column: str, n: int, seed=42) -> DataFrame:
    """Draw ``n`` rows, each draw independent of the others; adds ``draw_no``.

    Draws are numbers of rows in hash order. Only counts per hash bucket, made on the map side,
    tell which bucket a number falls into and which place it has there; then rows of
    the buckets hit are put in order, no others. The draws depend on seed and ids alone.
    """
    hashed = seeded_hash(seed, F.col(id_column).cast("string"))
    bucket = F.substring(hashed, 1, BUCKET_DIGITS)
    counts = rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket",
        "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(F.lit(0))).alias("_size"),
    )
    stretch = lambda number: F.floor(number * STRETCHES / F.col("_size")).cast("bigint")
    spread = offsets.withColumn("_stretch", F.explode(F.sequence(stretch(F.col("_offset")), stretch(F.col("_offset") + F.col("_rows") - 1))))
    draws = (
        rows.sparkSession.range(n)
        .withColumnRenamed("id", "draw_no")
        .withColumn("_size", counts.agg(F.sum("_rows").alias("n")).scalar())
        .where("_size > 0")
        .withColumn("_number", hash_index(f"{seed}:draw", F.col("draw_no").cast("string"), F.col("_size")))
        .withColumn("_stretch", stretch(F.col("_number")))
        .drop("_size")
    )
    inside = (F.col("_number") >= F.col("_offset")) & (F.col("_number") < F.col("_offset") + F.col("_rows"))
    hits = draws.join(spread, "_stretch").where(inside).select("draw_no", "_bucket", (F.col("_number") - F.col("_offset") + 1).alias("_rank"))
    keyed = rows.withColumn("_hash", hashed).withColumn("_bucket", F.substring("_hash", 1, BUCKET_DIGITS))
    hit = keyed.join(hits.select("_bucket").distinct(), "_bucket", "left_semi")
    order = Window.partitionBy("_bucket").orderBy("_hash", id_column)
    return hit.withColumn("_rank", F.row_number().over(order).cast("bigint")).join(hits, ["_bucket", "_rank"]).drop("_bucket", "_rank", "_hash")
