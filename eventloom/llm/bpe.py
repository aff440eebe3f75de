"""Byte-level BPE: token ids of whole texts by a rank file, and the bytes of token ids.

A text is cut into words by a pattern. Documents are gathered in blocks of some million words,
and ranked merges are folded over the byte array of each distinct word of a block, once. Each part
of a word, at first a byte, is one number: the rank of the pair it forms with the next part,
its place, its token. So the least number is the pair to merge next, the leftmost of equals,
and the fold merges until no pair has a rank. Ranks of pairs are a literal table: the row of
a left token is shifted to where its right tokens meet free slots, so a rank is one look at
the slot of both. Decoding concatenates the pieces of all ids. Nothing is shuffled, and a lost
executor's blocks are made again from the input.

The fold is there twice, with equal results: ``encoded_words`` is a column of Spark's higher-order
functions, ``fold_words`` does a merge in all words of a block at a time on arrays. ``encoded``
takes the second, as the first goes beyond the limits of the check tool (README).

A word that is a token needs no merges. Words over ``LONG`` bytes, for which a fold takes quadratic
time, are merged by a heap, by the same rule.

Defined results: a null or empty text has no tokens; texts of any length are encoded whole, a single
word of any length too; repeated rows each have their result; ties of equal rank are
merged leftmost first; an empty table gives an empty result; input columns travel in ``row``
and clash with nothing.
"""

from __future__ import annotations

import base64
import heapq
import json
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import bytes_of, carried

#: Words of a block; words of more bytes are merged by a heap; rows decoded at once.
BLOCK_WORDS = 4_000_000
LONG = 128
DECODE_ROWS = 256
#: Bits of a token, and of a part's place in its word.
_BITS = 20
_MASK = (1 << _BITS) - 1
_NONE = (1 << 21) - 1


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@dataclass(frozen=True)
class Vocabulary:
    """The table of a rank file's pairs: each left token's shift, and the owner and rank of each slot."""

    shifts: list[int]
    owners: list[int]
    values: list[int]


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"no rank for the bytes {missing}")
    if max(ranks.values()) >= _MASK:
        raise ValueError(f"ranks need more than {_BITS} bits")
    return ranks


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Tokens of a word: the pair of the least rank, the leftmost of equals, is merged until none has a rank."""
    ends, before, alive = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1)), [True] * len(word)
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if ends[i] < len(word):
            end = ends[ends[i]]
            rank = ranks.get(word[i:end])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end))

    for i in range(len(word)):
        offer(i)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or ends[i] >= len(word) or ends[ends[i]] != end:
            continue
        alive[ends[i]] = False
        ends[i] = end
        if end < len(word):
            before[end] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < len(word):
        out.append(ranks[word[i : ends[i]]])
        i = ends[i]
    return out


def _shifted(rows: dict[int, dict[int, int]], size: int) -> tuple[list[int], list[int], list[int]]:
    """Rows of a sparse table laid over each other: each row's shift, and the owner and value of each slot."""
    shifts = [0] * size
    owners, values = (np.full(4 * size + 1024, -1, np.int64) for _ in range(2))
    for a in sorted(rows, key=lambda a: (-len(rows[a]), a)):
        columns = np.fromiter(rows[a], np.int64)
        # Look from a place of the row's own on, so that rows do not crowd at the table's start.
        shift, width = a * 7919 % (2 * size), 256
        while True:
            while columns.max() + shift + width > len(owners):
                owners, values = (np.concatenate([x, np.full(size, -1, np.int64)]) for x in (owners, values))
            fits = np.arange(shift, shift + width)
            for c in columns:
                fits = fits[owners[fits + c] < 0]
                if not len(fits):
                    break
            if len(fits):
                break
            shift, width = shift + width, 2 * width
        shifts[a] = int(fits[0])
        owners[columns + shifts[a]], values[columns + shifts[a]] = a, np.fromiter(rows[a].values(), np.int64)
    used = int(np.flatnonzero(owners >= 0).max(initial=-1)) + 1
    return shifts, owners[:used].tolist(), values[:used].tolist()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    ranks = read_ranks(path)
    rows: dict[int, dict[int, int]] = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                rows.setdefault(left, {})[right] = rank
    return Vocabulary(*_shifted(rows, max(ranks.values()) + 1))


def _literal(values: list, kind: str) -> Column:
    """A literal array; parsed once, when the plan is made."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def _bound(function, *values: Column) -> Column:
    """``function`` of columns that are evaluated once."""
    names = [f"v{i}" for i in range(len(values))]
    one = F.array(F.struct(*[v.alias(n) for v, n in zip(values, names)]))
    return F.get(F.transform(one, lambda x: function(*[x[n] for n in names])), F.lit(0))


def encoded_words(parts: Column, known: Vocabulary) -> Column:
    """Token ids of each word of an array of words, given as the numbers of their parts."""
    tables = (
        _literal(known.shifts, "bigint"),
        _literal(known.owners, "bigint"),
        _literal([v << 2 * _BITS for v in known.values], "bigint"),
    )
    none, mask, place = F.lit(_NONE << 2 * _BITS), F.lit(_MASK), F.lit(_MASK << _BITS)

    def encode(shifts, owners, values) -> Column:
        def rank(slot: Column, a: Column) -> Column:
            """Rank of a pair, in the high bits: there is one if the slot of both belongs to the left token."""
            return F.when(F.get(owners, slot) == a, F.get(values, slot)).otherwise(none)

        def step(parts: Column, _) -> Column:
            def merge(at: Column) -> Column:
                least, left = F.get(parts, at - 1), F.get(parts, at - 2)
                token, before = F.shiftright(least, 2 * _BITS), left.bitwiseAND(mask)

                def joined(token, here, after, left, before, met) -> Column:
                    # ``after`` and ``met`` are the slots of the new token with its neighbours.
                    new = here.bitwiseOR(F.when(after.isNull(), none).otherwise(rank(after, token)))
                    rest = F.slice(parts, at + 2, F.lit(LONG))
                    return F.when(
                        at > 1, F.concat(F.slice(parts, F.lit(1), at - 2), F.array(left.bitwiseOR(rank(met, before)), new), rest)
                    ).otherwise(F.concat(F.array(new), rest))

                return _bound(
                    joined,
                    token,
                    least.bitwiseAND(place) + token,
                    F.get(shifts, token) + F.get(parts, at + 1).bitwiseAND(mask),
                    left.bitwiseAND(place.bitwiseOR(mask)),
                    before,
                    F.get(shifts, before) + token,
                )

            least = F.array_min(parts)
            at = F.array_position(parts, least).cast("int")
            return F.when(least >= none, parts).otherwise(F.get(F.transform(F.array(at), merge), F.lit(0)))

        def word(parts: Column) -> Column:
            # A word of n parts takes n - 1 merges at most.
            whole = F.aggregate(F.slice(parts, F.lit(2), F.lit(LONG)), parts, step)
            return F.transform(whole, lambda p: p.bitwiseAND(mask).cast("int"))

        return F.transform(parts, word)

    return _bound(encode, *tables)


@lru_cache(maxsize=2)
def _byte_ranks(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token of each byte, and the rank of each pair of bytes."""
    ranks = read_ranks(path)
    pair = np.full((256, 256), _NONE, np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            pair[token[0], token[1]] = rank
    return np.array([ranks[bytes([b])] for b in range(256)], np.int64), pair


def parts_of(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """The parts of words before any merge, one for each byte, and how many each word has."""
    first, pair = _byte_ranks(path)
    lengths = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(lengths)
    flat = np.frombuffer(b"".join(words), np.uint8)
    ranked = np.append(pair[flat[:-1], flat[1:]], _NONE)[: len(flat)]
    ranked[ends[lengths > 0] - 1] = _NONE
    place = np.arange(len(flat)) - np.repeat(ends - lengths, lengths)
    return (ranked << 2 * _BITS) | (place << _BITS) | first[flat], lengths


@lru_cache(maxsize=2)
def _table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    known = vocabulary(path)
    # A token's slots may lie behind the last one in use.
    free = np.full(1 << _BITS, -1, np.int64)
    return np.array(known.shifts), np.concatenate([known.owners, free]), np.concatenate([known.values, free])


def fold_words(parts: np.ndarray, lengths: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of words, one after the other, and how many each has.

    The fold of ``encoded_words``, a merge in every word at a time: a word's least part is merged with
    the part behind it, and its pairs with both neighbours get their ranks. Words without a pair
    of a rank leave.
    """
    shifts, owners, values = _table(path)
    low = (1 << 2 * _BITS) - 1

    def with_rank(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        token = left & _MASK
        slot = shifts[token] + (right & _MASK)
        return (left & low) | (np.where(owners[slot] == token, values[slot], _NONE) << 2 * _BITS)

    word = np.flatnonzero(lengths)
    counts, done_words, done_parts, done_counts = lengths[word], [], [], []
    while len(word):
        starts = np.cumsum(counts) - counts
        least = np.minimum.reduceat(parts, starts)
        going = (least >> 2 * _BITS) < _NONE
        if not going.all():
            of_part = np.repeat(going, counts)
            done_words.append(word[~going])
            done_counts.append(counts[~going])
            done_parts.append(parts[~of_part])
            word, counts, least, parts = word[going], counts[going], least[going], parts[of_part]
            starts = np.cumsum(counts) - counts
        if not len(word):
            break
        at = np.flatnonzero(parts == np.repeat(least, counts))
        rank, ends = least >> 2 * _BITS, starts + counts
        new = (least & (_MASK << _BITS)) | rank
        after = at + 2 < ends
        new[~after] |= _NONE << 2 * _BITS
        new[after] = with_rank(new[after], parts[at[after] + 2])
        parts[at] = new
        before = at > starts
        parts[at[before] - 1] = with_rank(parts[at[before] - 1], new[before])
        kept = np.ones(len(parts), bool)
        kept[at + 1] = False
        parts, counts = parts[kept], counts - 1
    # Back in the order of the words.
    sizes = np.zeros(len(lengths), np.int64)
    words = np.concatenate([np.zeros(0, np.int64), *done_words])
    ended = np.concatenate([np.zeros(0, np.int64), *done_counts])
    tokens = np.concatenate([np.zeros(0, np.int64), *done_parts]) & _MASK
    sizes[words] = ended
    order = np.argsort(words, kind="stable")
    return _gathered(tokens, np.cumsum(ended) - ended, ended, order), sizes


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches of ``values`` at ``which``, one after the other."""
    taken = sizes[which]
    total = np.concatenate([[0], np.cumsum(taken)])
    return values[np.repeat(starts[which] - total[:-1], taken) + np.arange(total[-1])]


@lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pieces one after the other, and the start and size of each id's; the last one stands for unknown ids."""
    ranks = read_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 2)
    for token, rank in ranks.items():
        pieces[rank] = token
    sizes = np.array([len(p) for p in pieces], np.int64)
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(sizes) - sizes, sizes


def _binary(data: bytes, cuts: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Stretches of bytes as an Arrow array; null where not valid."""
    bits = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(valid), [bits, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(data)])


def _bytes_and_ids(tokens: np.ndarray, lengths: np.ndarray, valid: np.ndarray, path: str) -> tuple[pa.Array, pa.Array]:
    """For each row of ids the pieces one after the other, and the ids as little-endian 32-bit numbers."""
    pieces, starts, sizes = _pieces(path)
    known = (tokens >= 0) & (tokens < len(sizes) - 1)
    which = np.where(known, tokens, len(sizes) - 1)
    ends = np.concatenate([[0], np.cumsum(sizes[which])])
    cuts = np.concatenate([[0], np.cumsum(lengths)])
    missing = np.concatenate([[0], np.cumsum(sizes[which] == 0)])[cuts]
    joined = _gathered(pieces, starts, sizes, which)
    return (
        _binary(joined.tobytes(), ends[cuts], valid & (np.diff(missing) == 0)),
        _binary(tokens.astype("<u4").tobytes(), 4 * cuts, valid),
    )


def decoded(rows: DataFrame, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``rows`` with ``bytes``, the pieces of their token ids one after the other, and ``packed``, the ids as little-endian 32-bit numbers.

    Null ids, and ids of which one is unknown, have null bytes.
    """
    path = path or default_path()
    schema = T.StructType([*rows.schema.fields, *_BYTES])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, DECODE_ROWS) for whole in batches for a in range(0, whole.num_rows, DECODE_ROWS)):
            column = batch.column(ids)
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            tokens = column.flatten().to_numpy(zero_copy_only=False)
            lengths = np.where(valid, np.diff(column.offsets.to_numpy()), 0)
            yield pa.record_batch([*batch.columns, *_bytes_and_ids(tokens, lengths, valid, path)], names=schema.names)

    return rows.mapInArrow(decode, schema)


_BYTES = [T.StructField("bytes", T.BinaryType()), T.StructField("packed", T.BinaryType())]


def encoded(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] | None = None,
    path: str | None = None,
    pattern: str | None = None,
    block_words: int = BLOCK_WORDS,
    decode: bool = False,
) -> DataFrame:
    """The input ``row`` with ``ids``, the token ids of its text, and ``n_tokens``; ``decode`` adds the columns of ``decoded``."""
    path, pattern = path or default_path(), pattern or default_pattern()
    read_ranks(path)
    named = carried(docs, keep, text=text).select("row", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, ranks = regex.compile(pattern).findall, read_ranks(path)
        rows, lengths, numbers, seen = [], [], array("I"), {}

        def flush() -> Iterator[pa.RecordBatch]:
            words = [bytes_of(w) for w in seen]
            ready = [[ranks[w]] if w in ranks else merged(w, ranks) if len(w) > LONG else None for w in words]
            tokens, sizes = fold_words(*parts_of([b"" if r else w for w, r in zip(words, ready)], path), path)
            given = np.array([len(r) if r else 0 for r in ready], np.int64)
            flat = np.fromiter((t for r in ready if r for t in r), np.int64, int(given.sum()))
            # A word's tokens are in one of the two lists.
            starts = np.where(given > 0, len(tokens) + np.cumsum(given) - given, np.cumsum(sizes) - sizes)
            values, sizes = np.concatenate([tokens, flat]).astype(np.int32), sizes + given
            which, ends = np.frombuffer(numbers, np.uint32), np.cumsum(lengths)
            whole = pa.concat_arrays([r.combine_chunks() if isinstance(r, pa.ChunkedArray) else r for r in rows])
            for a in range(0, len(lengths), DECODE_ROWS):
                b = min(a + DECODE_ROWS, len(lengths))
                mine = which[(ends[a - 1] if a else 0) : ends[b - 1]]
                total = np.concatenate([[0], np.cumsum(sizes[mine])])
                cuts = total[np.concatenate([[0], np.cumsum(lengths[a:b])])]
                found = _gathered(values, starts, sizes, mine)
                ids = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(found))
                columns = [whole.slice(a, b - a), pa.array(np.diff(cuts).astype(np.int64)), ids]
                if decode:
                    columns += _bytes_and_ids(found, np.diff(cuts), np.ones(b - a, bool), path)
                yield pa.record_batch(columns, names=schema.names)

        for batch in batches:
            carried_rows, begin = batch.column("row"), 0
            for i, body in enumerate(batch.column("text")):
                found = split(body.as_py() or "")
                numbers.extend([seen.setdefault(w, len(seen)) for w in found])
                lengths.append(len(found))
                if len(numbers) >= block_words:
                    rows.append(carried_rows.slice(begin, i + 1 - begin))
                    begin = i + 1
                    yield from flush()
                    rows, lengths, numbers, seen = [], [], array("I"), {}
            if begin < len(carried_rows):
                rows.append(carried_rows.slice(begin))
        if lengths:
            yield from flush()

    ids = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([named.schema["row"], *ids, *(_BYTES if decode else [])])
    return named.mapInArrow(encode, schema)
