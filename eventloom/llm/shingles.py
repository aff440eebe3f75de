"""Near copies by SimHash fingerprints and the exact Jaccard similarity of word shingles.

Two texts are linked if their sets of word shingles have a Jaccard similarity of at least
a given bound. Which texts may be is found by SimHash first: the fingerprint of a text's set of
shingles goes through the popcount grid of ``simhash``, and texts whose fingerprints hang together over links
of at most three bits share a cell. Pairs at 0.8 differ in more bits (up to 17 in the small table), and a limit that
wide would meet a share of all pairs of unlike texts. So 24 further cells hold texts with equal bands of minima: 120
minima of rehashed shingles in bands of five, so a pair at 0.8 shares no band in one of 13,000 cases, and a
closer pair less often. Texts that share a cell, directly or over others, are gathered in
numbered pieces of bounded size, each two pieces of a gathering meet in one task, and there
the similarity itself is computed until all linked texts are known to hang together.
A large group of copies costs one comparison a text, not all pairs, and nothing is capped.

Defined results: null, empty and blank texts are copies of each other; a text of fewer words
than a shingle is one shingle; texts of equal words are copies and compared once; a text of any
length is one set of all its shingles; of equal ids the first row read stays; a null id
counts as larger than all others; an empty table gives an empty result; input columns travel in
``row`` and clash with nothing, whatever characters their names have.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm import simhash
from eventloom.llm.common import bytes_of, carried, components, quoted, sieved, written

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
PIECE = 2_000_000  # shingles of a gathering in one piece
_CHUNK = 4096  # shingles rehashed at once
_FACTORS = np.array([xxhash.xxh64_intdigest(b"%d" % i) | 1 for i in range(BANDS * ROWS)], np.uint64)[:, None]


def shingles(text, shingle: int = SHINGLE) -> tuple[int, np.ndarray]:
    """A number for the words of a text, and the sorted distinct hashes of its shingles."""
    words = bytes_of(text).lower().split()
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    last = max(1, len(words) - shingle + 1) if words else 0
    ends = starts[min(shingle, len(words)) :]
    return digest(joined), np.unique(np.fromiter((digest(joined[s : e - 1]) for s, e in zip(starts[:last], ends)), np.uint64, last))


def bands(hashes: np.ndarray) -> np.ndarray:
    """The minima of a set of shingles under each rehashing, a number for each band of them."""
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for i in range(0, len(hashes), _CHUNK):
        np.minimum(least, (hashes[None, i : i + _CHUNK] * _FACTORS).min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(row.tobytes()) for row in least.reshape(BANDS, ROWS)], np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared) if len(both) else 1.0


def linked(keys: list[int], sets: list[np.ndarray], cells_of: np.ndarray, bound: float) -> list[tuple[int, int]]:
    """Links enough to join all of these texts that links between texts sharing a cell join.

    ``cells_of`` has a row for each text and a column for each kind of cell.
    """
    root, found = list(range(len(keys))), []
    sizes = np.array([len(s) for s in sets], np.int64)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def untried(i: int, others: list[int], kind: int) -> set[int]:
        # Who shared an earlier cell was compared there, unless it hung together with i already.
        js = np.array(others)
        js = js[np.minimum(sizes[js], sizes[i]) >= bound * np.maximum(sizes[js], sizes[i])]
        return set(js[~(cells_of[js, :kind] == cells_of[i, :kind]).any(1)].tolist())

    for kind in range(cells_of.shape[1]):
        cells = defaultdict(list)
        for i, number in enumerate(cells_of[:, kind].tolist()):
            cells[number].append(i)
        for cell in cells.values():
            parts: dict[int, list[int]] = {}
            for i in cell:
                mine = [i]
                apart = [head for head in parts if find(head) != find(i)]
                left = untried(i, [j for head in apart for j in parts[head]], kind) if apart else set()
                for head in apart if left else []:
                    if find(head) != find(i):
                        for j in parts[head]:
                            if j in left and similarity(sets[i], sets[j]) >= bound:
                                root[find(i)] = find(j)
                                found.append((keys[j], keys[i]))
                                break
                for head in list(parts):
                    if find(head) == find(i):
                        mine = parts.pop(head) + mine
                parts[mine[0]] = mine
    return found


def sketched(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """The input ``row`` with the ``key`` of its words, the ``n`` of its shingles, their fingerprint ``fp`` and ``bands``."""
    rows = carried(docs, text=text).select("row", "text")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, n, prints, numbers = [], [], [], []
            for body in batch.column("text"):
                key, hashes = shingles(body.as_py(), shingle)
                keys.append(key)
                n.append(len(hashes))
                prints.append(simhash.majority(hashes))
                numbers.append(bands(hashes).tobytes())
            made = [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(n, pa.int64()), pa.array(prints, pa.int64())]
            yield pa.record_batch([batch.column("row"), *made, pa.array(numbers, pa.binary())], names=["row", "key", "n", "fp", "bands"])

    # A schema as an object: names of input columns may hold any character.
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("key", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("fp", T.LongType()),
            T.StructField("bands", T.BinaryType()),
        ]
    )
    return rows.mapInArrow(sketch, schema)


def links(rows: DataFrame, distinct: DataFrame, shingle: int, bound: float) -> DataFrame:
    """Pairs ``a``, ``b`` of keys that join what is linked. ``rows`` has ``no`` and the text, ``distinct`` the sketch of each
    key (``n``, ``fp``, ``bands``) and the ``no`` of a row with its text."""
    grouped = distinct.join(simhash.component_of_prints(distinct), "fp")
    print_cell = F.unhex(F.lpad(F.hex("component"), 16, "0"))
    distinct = written(grouped.select("key", "no", "n", F.concat(print_cell, "bands").alias("cells")), "cells")
    each = F.transform(F.sequence(F.lit(0), F.lit(BANDS)), lambda i: F.xxhash64(i, F.substring("cells", i * 8 + 1, F.lit(8))))
    cells = distinct.select("key", F.explode(each).alias("cell"))
    first = cells.groupBy("cell").agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    met = written(cells.join(first, "cell").where("key <> least").select(F.col("key").alias("a"), F.col("least").alias("b")).distinct(), "met")
    nodes = met.select(F.col("a").alias("key")).unionByName(met.select(F.col("b").alias("key"))).distinct()
    gathered = written(components(nodes, met, node="key").join(distinct, "key"), "gathered")
    sizes = gathered.groupBy("component").agg(F.ceil(F.sum("n") / PIECE).alias("pieces"))
    piece = F.pmod(F.xxhash64("key"), F.greatest("pieces", F.lit(1)))
    placed = gathered.join(sizes, "component").withColumn("piece", piece)
    pair = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.greatest("pieces", F.lit(1)) - 1),
        lambda other: F.struct(F.least("piece", other).alias("low"), F.greatest("piece", other).alias("high")),
    )
    # Most texts meet no other, and are left where they are.
    texts = sieved(rows, gathered, "no").where("maybe").select("no", "text")
    meeting = placed.select("no", "key", "component", "cells", pair.alias("pairs")).join(texts, "no").withColumn("at", F.explode("pairs"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key")
        sets = [shingles(body, shingle)[1] for body in group.text]
        numbers = np.frombuffer(b"".join(group.cells), np.uint64).reshape(len(group), BANDS + 1)
        return pd.DataFrame(linked(group.key.tolist(), sets, numbers, bound), columns=["a", "b"], dtype="int64")

    return meeting.select("key", "component", "cells", "at.low", "at.high", "text").groupBy("component", "low", "high").applyInPandas(
        compare, "a bigint, b bigint"
    )


def representatives(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bound: float = SIMILARITY
) -> DataFrame:
    """The input rows of one document per group of near copies, the one with the smallest id; a null id is the largest."""
    rows = written(sketched(docs, text, shingle).withColumn("no", F.monotonically_increasing_id()), "sketches")
    of = F.col(f"row.{quoted(doc_id)}")
    one = F.min(F.struct(of.isNull(), of, "no")).alias("first")
    sketch = [F.first(c).alias(c) for c in ("n", "fp", "bands")]
    distinct = written(rows.groupBy("key").agg(one, *sketch), "distinct")
    # The sketch of a key comes with the row it is taken from, so a text is found by its number.
    texts = rows.select("no", F.col(f"row.{quoted(text)}").alias("text"))
    found = written(links(texts, distinct.select("key", F.col("first.no").alias("no"), "n", "fp", "bands"), shingle, bound), "found")
    whole = components(distinct.select("key", "first"), found, node="key").join(distinct.select("key", "first"), "key")
    chosen = written(whole.groupBy("component").agg(F.min("first")["no"].alias("no")).select("no"), "chosen")
    # Rows are kept where they are unless they may be among those left out; only these move.
    left_out = rows.select("no").join(chosen, "no", "left_anti")
    told = sieved(rows.select("no", "row"), left_out, "no")
    kept = told.where(~F.col("maybe")).unionByName(told.where("maybe").join(chosen, "no", "left_semi"))
    return kept.select("row.*")
