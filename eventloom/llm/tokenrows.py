"""Packed token ids in binary rows, ready to be memory-mapped by a trainer.

Documents are tokenised, overlong ones split without loss, and packed by best-fit
decreasing within blocks of a partition, so token ids never cross the network. A block
ends when it has ``block_tokens`` ids; each block leaves at most a few rows unfilled.

A row holds ``capacity`` ids (padded), the cumulative lengths of its segments and where
positions start again from zero. ``write`` stores rows as Parquet through Spark, on any
store that Spark reaches; ``matrix`` and ``positions`` read rows back.

Defined results: a null or empty text is the end token alone; repeated rows are each
packed; documents of one length change places freely; an empty table gives no rows; only the id and
the text are read, so no other column clashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.bestfit import pack_runs, places
from eventloom.llm.common import ship
from eventloom.llm.packing import CAPACITY, END
from eventloom.llm.tokenizing import default_path, encoder, pieces

BLOCK_TOKENS = 4_000_000
SCHEMA = (
    "sequence_id bigint, n_tokens int, n_segments int, input_ids binary, cu_seqlens array<int>, "
    "resets array<int>, doc_ids array<{id_type}>, pieces array<int>, starts array<bigint>"
)


def _rows(block: list[tuple], capacity: int, dtype: np.dtype, pad: int, first_id: int, id_type: pa.DataType) -> pa.RecordBatch:
    """Pack (id, piece, start, ids) of one block and lay its sequences out."""
    sizes = np.array([len(b[3]) // dtype.itemsize for b in block], dtype=np.int64)
    order = np.argsort(-sizes, kind="stable")
    sizes = sizes[order]
    found, begin, counts = np.unique(-sizes, return_index=True, return_counts=True)
    runs, _ = pack_runs(dict(zip((-found).tolist(), counts.tolist())), capacity)
    numbers = np.arange(len(sizes)) - np.repeat(begin, counts)
    bins, offsets = places(runs, sizes, numbers)
    by_bin = np.lexsort((offsets, bins))
    columns = {name: [] for name in ("n_tokens", "n_segments", "input_ids", "cu_seqlens", "doc_ids", "pieces", "starts")}
    padding = np.array([pad], dtype=dtype).tobytes()
    for chosen in np.split(by_bin, np.flatnonzero(np.diff(bins[by_bin])) + 1):
        parts = [block[i] for i in order[chosen]]
        ends = np.cumsum(sizes[chosen])
        ids = b"".join(p[3] for p in parts)
        columns["n_tokens"].append(int(ends[-1]))
        columns["n_segments"].append(len(parts))
        columns["input_ids"].append(ids + padding * (capacity - int(ends[-1])))
        columns["cu_seqlens"].append([0, *ends.tolist()])
        columns["doc_ids"].append([p[0] for p in parts])
        columns["pieces"].append([p[1] for p in parts])
        columns["starts"].append([p[2] for p in parts])
    columns["sequence_id"] = list(range(first_id, first_id + len(columns["n_tokens"])))
    columns["resets"] = [cu[:-1] for cu in columns["cu_seqlens"]]
    types = {
        "sequence_id": pa.int64(),
        "n_tokens": pa.int32(),
        "n_segments": pa.int32(),
        "input_ids": pa.binary(),
        "cu_seqlens": pa.list_(pa.int32()),
        "resets": pa.list_(pa.int32()),
        "doc_ids": pa.list_(id_type),
        "pieces": pa.list_(pa.int32()),
        "starts": pa.list_(pa.int64()),
    }
    return pa.record_batch([pa.array(columns[n], t) for n, t in types.items()], names=list(types))


def packed_rows(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    end: int = END,
    pad: int = END,
    dtype: str = "<u2",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per packed sequence; see ``SCHEMA``. ``dtype`` must hold the tokenizer's ids."""
    path, kind = path or default_path(), np.dtype(dtype)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, last = encoder(path, dtype).ids, np.array([end], dtype=kind).tobytes()
        first_id, block, held, id_type = TaskContext.get().partitionId() << 33, [], 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                start = 0
                for n, part in enumerate(pieces((ids(body.as_py()) if body.is_valid else b"") + last, capacity, kind.itemsize)):
                    block.append((key, n, start, part))
                    start += len(part) // kind.itemsize
                held += start
                if held >= block_tokens:
                    rows = _rows(block, capacity, kind, pad, first_id, id_type)
                    first_id, block, held = first_id + len(rows), [], 0
                    yield rows
        if block:
            yield _rows(block, capacity, kind, pad, first_id, id_type)

    ship(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(pack, SCHEMA.format(id_type=narrow.schema["doc_id"].dataType.simpleString()))


def write(rows: DataFrame, folder: str) -> None:
    """Store packed rows as Parquet, ids uncompressed by dictionary and ordered within each file."""
    rows.sortWithinPartitions("sequence_id").write.option("parquet.enable.dictionary", "false").parquet(folder)


def matrix(ids: Iterable[bytes], capacity: int = CAPACITY, dtype: str = "<u2") -> np.ndarray:
    """Rows of ``input_ids`` as a matrix of ids."""
    return np.frombuffer(b"".join(bytes(i) for i in ids), dtype=dtype).reshape(-1, capacity)


def positions(resets: Iterable[int], capacity: int = CAPACITY) -> np.ndarray:
    """Position ids of a row: they start again at each reset."""
    starts = np.zeros(capacity, dtype=np.int64)
    for r in resets:
        starts[r] = r
    return np.arange(capacity) - np.maximum.accumulate(starts)
