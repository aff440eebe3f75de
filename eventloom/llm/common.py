"""What several corpus operators share: words, staged tables, packed rows, components."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.session import run_dir, written

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python functions import it; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def quoted(name: str) -> str:
    """A column name taken literally, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def carried(rows: DataFrame, keep: Sequence[str] | None = None, **named) -> DataFrame:
    """The columns an operator works on, and the input row beside them as ``row``.

    Input columns with the same names as an operator's own cannot clash with them this way.
    ``keep`` names the columns of the row that are still wanted afterwards; all by default.
    """
    ship(rows.sparkSession)
    row = F.struct(*[F.col(quoted(c)) for c in (rows.columns if keep is None else keep)])
    return rows.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in named.items()], row.alias("row"))


def ranked(
    rows: DataFrame,
    keys: list[str],
    spread: str,
    order: list[str],
    name: str,
    each: int = 50_000,
    beside: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each key 1, 2, ... in ``name``, in the order of ``spread`` and then ``order``.

    ``spread`` is an evenly spread number of 32 bits. A key's rows are cut into ranges of it
    of about ``each`` rows, so the largest key is never sorted in one task; each range
    starts after the counted rows of the ranges before it. ``rows`` should be a written
    table: it is read twice. Keys must not be null. ``beside`` is a table of one row per key
    whose columns are wanted too; they come along with the starts, so rows move once.
    """
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    ranges = pieces_for(counted.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0], each)
    ranged = rows.withColumn("_range", F.floor(F.col(spread) * ranges / (1 << 32)))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    )
    if beside is not None:
        starts = starts.join(beside, keys)
    place = Window.partitionBy(*keys, "_range").orderBy(spread, *order)
    return (
        ranged.withColumn("_place", F.row_number().over(place))
        .join(starts, [*keys, "_range"])
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_range", "_place", "_start")
    )


def hash32(*parts: Column) -> Column:
    """An evenly spread number of 32 bits that other engines can compute too."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("bigint")


def bytes_of(text) -> bytes:
    """UTF-8 of a text; a null is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def pieces_for(rows: int, each: int) -> int:
    """How many pieces of about ``each`` rows make up ``rows`` rows."""
    return max(1, -(-int(rows) // each))


#: Bits of a sieve, and those in one row of it: 1,024 rows of 4 KB at most.
SIEVE_BITS, _ROW_BITS = 1 << 25, 1 << 15


def sieved(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``maybe``: false only where ``key`` is certainly not in ``wanted``; neither side has null keys.

    Wide rows need not move to a join that few of them will meet. The bits set at the hashes of the wanted
    keys are at most 4 MB however many there are, which is what makes the broadcast safe; with very many
    keys more rows are let through, so an exact join has to follow.
    """
    at = F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS))
    row, bit = F.floor(at / _ROW_BITS).alias("_row"), (at % _ROW_BITS).alias("_bit")
    # Places move, not rows of the sieve: a task's own sieve would be as long as the whole one.
    bits = wanted.select(row, bit).repartition("_row").groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.floor(byte / F.pow(F.lit(2), F.col("_bit") % 8)) % 2 == 1, F.lit(False))
    return (
        rows.select("*", row, bit)
        .join(F.broadcast(bits), "_row", "left")
        .withColumn("maybe", is_set)
        .drop("_row", "_bit", "_bits")
    )


def components(nodes: DataFrame, links: DataFrame, node: str = "id", a: str = "a", b: str = "b") -> DataFrame:
    """The smallest node reachable from each node: columns ``node`` and ``component``.

    Links are rewired in alternating rounds: each node's larger neighbours are linked to
    its smallest one, then its smaller neighbours and itself are. Rounds end when nothing
    changes, after about log(longest path) of them, with one link from each node to its
    component's smallest. The smallest neighbour is a map-side aggregate and is joined back,
    so no neighbourhood is gathered, and Spark can split the join of a node with very many links.
    Each round is written to the shared folder.
    """

    def rewired(edges: DataFrame, larger: bool) -> DataFrame:
        if larger:
            both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = both.join(least, "u")
        if larger:
            new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v"))
            )
        return new.where("u <> v").distinct()

    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    before = None
    while True:
        edges = written(rewired(rewired(edges, True), False), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.join(edges.select(F.col("u").alias(node), F.col("v").alias("component")), node, "left").select(
        node, F.coalesce("component", node).alias("component")
    )


__all__ = ["WORD", "bytes_of", "carried", "components", "documents", "hash32", "pieces_for", "quoted", "ranked", "run_dir", "ship", "sieved", "written"]
