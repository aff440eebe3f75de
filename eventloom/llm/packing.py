"""Best-fit packing of documents into sequences, over the whole corpus.

How many pieces there are of each length is counted with a map-side aggregate; that table
has at most ``capacity`` rows whatever the corpus, so best-fit decreasing runs on it in the
driver. It says, for the n-th piece of a length, in which sequence and where it lies. Pieces
are then numbered within their length in ranges of bounded size, and each looks its
place up. The packing is the one best-fit decreasing gives for all pieces together.

Defined results: a null or empty text is one piece, the end token; a text of any length is
cut into pieces, only the first of which may be shorter; repeated rows are packed
each for itself; pieces of one length change places freely; an empty table gives no pieces; input
columns travel in ``row`` and clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.bestfit import pack_runs, places
from eventloom.llm.common import carried, hash32, ranked, written
from eventloom.llm.tokenizing import default_path, encoder, pieces

CAPACITY = 2048
END = 0


def tokenised(
    docs: DataFrame, text: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END, keep: Sequence[str] | None = None
) -> DataFrame:
    """Pieces of the documents: input ``row``, piece, start, length and ``ids`` (little-endian, 32 bits each)."""
    path = path or default_path()

    @F.pandas_udf(T.ArrayType(T.BinaryType()))
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = encoder(path).ids
        last = end.to_bytes(4, "little")
        for texts in batches:
            yield pd.Series([pieces((ids(t) if isinstance(t, str) else b"") + last, capacity, 4) for t in texts])

    cut_once = cut.asNondeterministic()
    cuts = carried(docs, keep, text=text).select("row", cut_once("text").alias("cut"))
    each = cuts.select("row", (F.length(F.col("cut")[0]) / 4).cast("bigint").alias("first"), F.posexplode("cut").alias("piece", "ids"))
    start = F.when(F.col("piece") == 0, 0).otherwise(F.col("first") + (F.col("piece") - 1) * capacity)
    return each.select(
        "row", "piece", start.cast("bigint").alias("start"), (F.length("ids") / 4).cast("bigint").alias("length"), "ids"
    )


def packed(items: DataFrame, length: str = "length", order: Sequence[str] = (), capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to items of at most ``capacity``: best-fit decreasing over all of them.

    ``order`` names columns that tell items apart; it makes the numbering the same on every run.
    ``items`` should be a written table: it is read three times.
    """
    counts = {r[0]: r[1] for r in items.groupBy(length).count().collect()}  # at most ``capacity`` rows
    runs, _ = pack_runs(counts, capacity)

    @F.pandas_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(sizes: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        bins, offsets = places(runs, sizes.to_numpy("int64"), numbers.to_numpy("int64"))
        return pd.DataFrame({"sequence_id": bins, "offset": offsets})

    spread = hash32(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order])
    numbered = ranked(items.withColumn("_spread", spread), [length], "_spread", list(order), "_number")
    return numbered.select(*items.columns, place(F.col(length), F.col("_number") - 1).alias("_at")).select(*items.columns, "_at.*")


def layout(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the id, piece, start, length, ids_crc32, sequence_id and offset."""
    cut = tokenised(docs, text, path, capacity, keep=[doc_id])
    narrow = cut.select(F.col(f"row.{doc_id}").alias(doc_id), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packed(written(narrow, "pieces"), "length", [doc_id, "piece", "ids_crc32"], capacity)
