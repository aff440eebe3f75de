"""SimHash near-duplicates by segment popcounts and a grid join.

A fingerprint's 64 bits are 32 segments of two bits. The bits set in each segment make a
vector whose Manhattan distance never exceeds the number of differing bits, so links
within three bits have vectors within three of each other. Of the two halves of the
vector at least one then lies within one: its grid cell is the same, or neighbours in a
single coordinate. Two points at distance one have coordinate sums of different parity,
so only points of even sum look into neighbouring cells. What meets in a cell is checked
on all 64 bits. Nothing is missed; there is no cap on a cell.

Fingerprints are compared once however many documents share them. Components come from
links between fingerprints, rewired round by round in the shared folder.

Defined results: null, empty and blank texts have fingerprint zero and link like any
other; equal texts have equal fingerprints; a null id counts as larger than all others; repeated
rows are one group; of equal ids the first row read stays; a text of any length has one
fingerprint of all its shingles; an empty table gives an empty result; input columns travel in
``row`` and clash with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import bytes_of, carried, components, written

SHINGLE = 3
SEED = 42
MAX_BITS = 3
_CHUNK = 1 << 16  # shingles whose bits are summed at once


def fingerprint(text, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, as a signed 64-bit number."""
    words = bytes_of(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    last = max(1, len(words) - shingle + 1)
    hashes = np.fromiter(
        (digest(joined[s : e - 1], SEED) for s, e in zip(starts[:last], starts[min(shingle, len(words)) :])), np.uint64, last
    )
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of some hashes, as a signed 64-bit number."""
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK]
        set_bits += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(text) for text in texts], dtype="int64")


_fingerprints = _fingerprints.asNondeterministic()


def popcounts(half: Column) -> Column:
    """Bits set in each of the 16 two-bit segments of half a fingerprint, each count in its own segment."""
    return half - F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))


def _cells(fp: Column) -> list[tuple[int, Column]]:
    return [(0, popcounts(fp.bitwiseAND(F.lit(0xFFFFFFFF)))), (1, popcounts(F.shiftrightunsigned(fp, 32)))]


def _sum_is_even(cell: Column) -> Column:
    """Parity of the sum of a cell's 16 counts: the parity of their low bits."""
    return F.bit_count(cell.bitwiseAND(F.lit(0x55555555))) % 2 == 0


def _neighbours(cell: Column) -> Column:
    """The cell itself and, for an even sum, all cells one step away."""
    steps = []
    for i in range(16):
        one = 1 << (2 * i)
        count = F.shiftright(cell, 2 * i).bitwiseAND(F.lit(3))
        steps += [F.when(count < 2, cell + F.lit(one)), F.when(count > 0, cell - F.lit(one))]
    return F.filter(F.when(_sum_is_even(cell), F.array(cell, *steps)).otherwise(F.array(cell)), lambda c: c.isNotNull())


def links(fingerprints: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints that differ in at most three bits."""
    if max_bits > 3:
        raise ValueError("two halves guarantee a half within one bit only up to three bits")
    points = fingerprints.select(F.col(fp).alias("fp"))
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("half"), cell.alias("cell")) for h, cell in _cells(F.col("fp"))]))
    halves = points.select("fp", each.alias("at")).select("fp", "at.half", "at.cell")
    stored = halves.select("half", "cell", F.col("fp").alias("b"))
    looking = halves.select("half", F.explode(_neighbours(F.col("cell"))).alias("cell"), F.col("fp").alias("a"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return (
        looking.join(stored, ["half", "cell"])
        .where((F.col("a") != F.col("b")) & near)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def fingerprinted(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """The input ``row`` with its fingerprint ``fp``."""
    return carried(docs, keep, text=text).select("row", _fingerprints("text").alias("fp"))


def component_of_prints(prints: DataFrame) -> DataFrame:
    """Each distinct ``fp`` of a written table with its component of linked fingerprints."""
    points = prints.select("fp").distinct()
    return written(components(points, links(points), node="fp"), "components")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``fp`` and ``component_id``, the smallest id reachable by links."""
    prints = written(fingerprinted(docs, text, [doc_id]).select(F.col(f"row.{doc_id}").alias(doc_id), "fp"), "fingerprints")
    found = component_of_prints(prints)
    least = prints.groupBy("fp").agg(F.min(doc_id).alias("least")).join(found, "fp")
    smallest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    return prints.join(found.join(smallest, "component").select("fp", "component_id"), "fp").select(doc_id, "fp", "component_id")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows of one document per group, the one with the smallest id; a null id is the largest."""
    rows = written(fingerprinted(docs, text).withColumn("no", F.monotonically_increasing_id()), "fingerprints")
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col(f"row.{doc_id}").isNull(), F.col(f"row.{doc_id}"), "no")).alias("first"))
    chosen = first.join(component_of_prints(rows), "fp").groupBy("component").agg(F.min("first")["no"].alias("no"))
    return rows.join(chosen, "no", "left_semi").select("row.*")
