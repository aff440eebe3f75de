"""Language-model scores by a probabilistic suffix tree over words.

A state of the tree is a context of zero, one or more words. The root's distribution is the
add-one unigram; a longer context becomes a state where knowing it tells something about the
next word: the sum over its occurrences in training, each left out of its own counts, of the log
ratio to what the state of its suffix says must pass a threshold. A state's distribution is
its counts smoothed towards its suffix's, with the strength that does best in the same
test. A word is scored by the longest context before it that is a state.

Counts of word sequences are far too many rows to move one by one. Documents are cut into
blocks of some million words; a block asks, per context and word after it that it holds, how often
they occur in the whole corpus. Questions travel as packed arrays to the bucket the context's hash
falls in, which adds up the counts of all blocks, judges the context and answers each block in the
order of its questions: one exchange for an order. A context with more occurrences than one task
should hold is cut up by the words after it, and the sums of its pieces are put together on the driver.
A sequence is asked for only if the sequence it extends is frequent enough to be a context.
A context is closed when what is left to gain after it is not over the threshold. An occurrence
of a word seen m times after the context can gain at most what a context with these m
occurrences and no others would gain; the sum of that over the occurrences bounds every longer context.
Rounds end when all contexts are closed. From the third
order on a block carries its open positions, with the chance of the word; the first two are gone over again
from their answers. The logs of closed ones are added to their texts' scores and not looked at again.

All occurrences of a long context are few enough for one task. From some length on the open
positions leave their blocks, with the words before them, for the bucket that all occurrences
of their context fall in, and are judged there for many lengths on end. The bucket is told by
the smallest hash of a few words among the context's last ones, so neighbours mostly share it and words
are sent once for a run of them. Contexts that occur too often for that go on by rounds of questions, first for
counts, then for gains.
Words and sequences are known by 64-bit hashes. No task holds more than a block or a bucket,
a hot word is one entry per block, and no vocabulary or tree is sent to all.

Defined results: a null or empty text is its end token; texts of any length are scored
whole; repeated rows count as often as they are there; with nothing to train on all words
are unknown; of strengths of equal gain the first counts; an empty table gives an empty result;
input columns travel in ``row`` and clash with nothing.
"""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import bytes_of, carried, written

#: The end token's hash: no word holds a space.
END = xxhash.xxh64_intdigest(b" ")


@dataclass(frozen=True)
class Tree:
    """Settings: longest context (null: none), lengths judged one by one, occurrences and gain (nats) a context needs,
    strengths to choose from; words of a block and of a bucket; shortest contexts whose positions are gathered in
    buckets, and the most occurrences of one there."""

    depth: int | None = None
    single: int = 8
    min_count: int = 2
    min_gain: float = 4.0
    strengths: tuple[float, ...] = (2.0, 100.0)
    block_tokens: int = 1_500_000
    bucket_tokens: int = 2_000_000
    gathered: int = 4
    gathered_count: int = 200_000


_ZIP, _UNZIP = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(values: np.ndarray, width: int | None = None) -> bytes:
    """Numbers of one width, byte plane by byte plane, compressed; of some width, its lowest bytes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return _ZIP.compress(b"".join(planes[:, i].tobytes() for i in range(width or values.itemsize)))


def _unpacked(data: bytes, dtype, width: int | None = None) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(_UNZIP.decompress(data), np.uint8).reshape(width or size, -1)
    out = (np.empty if len(planes) == size else np.zeros)((planes.shape[1], size), np.uint8)
    for i, plane in enumerate(planes):
        out[:, i] = plane
    return out.view(dtype).ravel()


def _packed_small(numbers: np.ndarray) -> bytes:
    """Whole numbers in as many bytes as the largest takes."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + _packed(numbers.astype(np.uint64), width)


def _unpacked_small(data: bytes) -> np.ndarray:
    return _unpacked(data[1:], np.int64, data[0])


def _packed_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as packed differences."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, np.uint64), dtype=np.uint64)


def _gain_type(tree: Tree) -> np.dtype:
    """A context's gain by each strength, and what is left after each and after none: a byte on a scale of powers."""
    width = len(tree.strengths)
    return np.dtype([("gain", np.float32, (width,)), ("left", np.uint8, (width + 1,))])


def _scaled(left: np.ndarray, tree: Tree) -> np.ndarray:
    """What is left, in bytes; rounded up, so no context is closed by it."""
    with np.errstate(divide="ignore"):
        steps = np.ceil(16 * (np.log2(left / max(abs(tree.min_gain), 1e-9)) + 12))
    return np.where(left > 0, np.clip(steps, 1, 255), 0).astype(np.uint8)


def _unscaled(scaled: np.ndarray, tree: Tree) -> np.ndarray:
    return np.where(scaled > 0, max(abs(tree.min_gain), 1e-9) * np.exp2(scaled / 16 - 12), 0.0)


#: What a word counts in a sequence's sum, for each place that it is before the last word.
FACTOR = 0xC2B2AE3D27D4EB4F

#: A block goes over the orders before this one again from their answers; from it on it carries its open positions.
REPLAYED = 3


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.full(n, base, np.uint64))


class Windows:
    """Words in a row, from which the hash of any sequence of them is told."""

    def __init__(self, words: np.ndarray):
        self.power = _powers(FACTOR, len(words))
        weighed = words * _powers(pow(FACTOR, -1, 1 << 64), len(words))
        self.running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(weighed)])

    def keys(self, ends: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the sequences of some length that end at places."""
        return _mixed(self.power[ends] * (self.running[ends + 1] - self.running[ends + 1 - length]))


def _mixed(sums: np.ndarray) -> np.ndarray:
    """Hashes of sequences from the sums of their words."""
    mixed = (sums ^ (sums >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and which of them each key is.

    Keys are sorted by value with their places in the low bits, many times faster than places by keys; keys that only
    differ in these bits are put in order after.
    """
    if len(keys) < 1000:
        return np.unique(keys, return_inverse=True)
    low = np.uint64(len(keys).bit_length())
    mask = (np.uint64(1) << low) - np.uint64(1)
    if int(keys.max()).bit_length() + int(low) <= 64:
        found = np.sort((keys << low) | np.arange(len(keys), dtype=np.uint64))
        order, found = (found & mask).astype(np.int64), found >> low
        new = np.concatenate([[True], found[1:] != found[:-1]])
        which = np.empty(len(keys), np.int64)
        which[order] = np.cumsum(new) - 1
        return found[new], which
    order = np.sort((keys & ~mask) | np.arange(len(keys), dtype=np.uint64))
    order = (order & mask).astype(np.int64)
    found = keys[order]
    high = found >> low
    mixed_up = np.flatnonzero((high[1:] == high[:-1]) & (found[1:] != found[:-1]))
    if len(mixed_up):
        for value in np.unique(high[mixed_up]):
            a, b = np.searchsorted(high, value), np.searchsorted(high, value, "right")
            order[a:b] = order[a:b][np.argsort(found[a:b])]
        found = keys[order]
    new = np.concatenate([[True], found[1:] != found[:-1]])
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    return found[new], which


# --- blocks ---------------------------------------------------------------------------

def _block_schema(row: T.StructType) -> T.StructType:
    """A schema as an object: names of input columns may hold any character."""
    packed = [T.StructField(name, T.BinaryType()) for name in ("lengths", "trains", "vocabulary", "words")]
    return T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(row)), *packed])


def blocks(docs: DataFrame, train: Column, text: str, keep: Sequence[str] | None, tree: Tree) -> DataFrame:
    """Documents in blocks: the input rows, and packed arrays of lengths, flags, distinct words and word numbers."""
    named = carried(docs, keep, train=F.coalesce(train, F.lit(False)), text=text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = xxhash.xxh64_intdigest
        number, rows, trains, words, held = TaskContext.get().partitionId() << 33, [], [], [], 0

        def flush() -> pa.RecordBatch:
            all_words = np.concatenate(words)
            vocabulary, numbers = _numbered(all_words)
            lengths = np.array([len(w) for w in words], np.int64)
            values = pa.concat_arrays([r.combine_chunks() if isinstance(r, pa.ChunkedArray) else r for r in rows])
            return pa.record_batch(
                [
                    pa.array([number], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                    *[
                        pa.array([data], pa.binary())
                        for data in (
                            _packed(lengths),
                            _packed(np.array(trains, np.uint8)),
                            _packed_sorted(vocabulary),
                            _packed(numbers.astype(np.uint32)),
                        )
                    ],
                ],
                names=["block", "rows", "lengths", "trains", "vocabulary", "words"],
            )

        for batch in batches:
            flags, texts, carried_rows = batch.column("train").to_pylist(), batch.column("text"), batch.column("row")
            begin = 0
            for i, body in enumerate(texts):
                tokens = bytes_of(body.as_py()).lower().split()
                words.append(np.array([*map(hashed, tokens), END], np.uint64))
                trains.append(flags[i])
                held += len(tokens) + 1
                if held >= tree.block_tokens:
                    rows.append(carried_rows.slice(begin, i + 1 - begin))
                    begin = i + 1
                    yield flush()
                    number, rows, trains, words, held = number + 1, [], [], [], 0
            if begin < len(carried_rows):
                rows.append(carried_rows.slice(begin))
        if words:
            yield flush()

    return named.select("row", "train", "text").mapInArrow(cut, _block_schema(named.schema["row"].dataType))


def _rounds(tree: Tree) -> Iterator[tuple[int, int]]:
    """Shortest and longest context of each round."""
    first = 1
    while tree.depth is None or first <= tree.depth:
        last = first if first <= tree.single else 2 * (first - 1)
        last = last if tree.depth is None else min(last, tree.depth)
        yield first, last
        first = last + 1


class Block:
    """A block's words, and its open positions: those where a longer context may still help."""

    def __init__(self, row, tree: Tree, told: pd.DataFrame):
        self.number, self.tree, self.told = int(row.block), tree, told
        self.lengths = _unpacked(row.lengths, np.int64)
        self.vocabulary = _unpacked_sorted(row.vocabulary)
        self.words = _unpacked(row.words, np.uint32)
        self.train = np.repeat(_unpacked(row.trains, np.uint8) > 0, self.lengths)
        self.place = np.arange(len(self.words)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

    def first_questions(self) -> tuple[np.ndarray, np.ndarray]:
        return self.vocabulary, np.bincount(self.words[self.train], minlength=len(self.vocabulary)).astype(np.uint32)

    @cached_property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.lengths)), self.lengths)

    @cached_property
    def windows(self) -> Windows:
        return Windows(self.vocabulary[self.words])

    def heard(self, what: str, dtype, step: int | None = None) -> np.ndarray:
        """What was told of something; without a type, numbers packed in few bytes."""
        mine = self.told[self.told.what == what]
        mine = (mine if step is None else mine[mine.step == step]).sort_values("bucket")
        unpacked = [_unpacked(n, dtype) if dtype else _unpacked_small(n) for n in mine.numbers]
        return np.concatenate([np.zeros(0, dtype or np.int64), *unpacked])

    def says(self, what: str, numbers: bytes, total: int = 0) -> tuple:
        """A message to itself."""
        return (self.number, what, 0, self.number, b"", numbers, total, 0)

    def by_text(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, weights=values, minlength=len(self.lengths))


class FirstOrders(Block):
    """A block while its contexts are short and nearly all its positions are open.

    It asks of each distinct context and word after it how often they occur. All occurrences of a context meet in
    one bucket, which judges it at once; a context with too many of them is cut up by the words after it, and the
    sums of the pieces are put together before the next order.
    """

    def begun(self, total: int, distinct: int, scoring: bool) -> None:
        """Take up the state before the first order; scores are not needed if it is gone over again later."""
        known = self.heard("count", np.uint64, 0).astype(np.int64)
        base = (known + 1.0) / (total + distinct + 1.0)
        ahead = np.concatenate([[0], known[self.words[:-1]]])
        self.at = np.flatnonzero((self.place >= 1) & (ahead >= self.tree.min_count))
        self.most, self.chance = ahead[self.at], base[self.words[self.at]]
        self.score = None
        if scoring:
            logs = np.log10(base)[self.words]
            self.bases, self.knowns = self.by_text(logs), self.by_text((known > 0)[self.words])
            logs[self.at] = 0.0
            self.score = self.by_text(logs)

    def resumed(self) -> None:
        """Take up the state that it left with its last questions."""
        self.bases, self.knowns, self.score = None, None, np.zeros(len(self.lengths))
        self.at, self.most = np.cumsum(self.heard("at", None)), self.heard("most", None)
        self.chance = self.heard("chance", np.float32).astype(np.float64)

    def carried(self) -> list[tuple]:
        return [
            self.says("at", _packed_small(np.diff(self.at, prepend=0)), len(self.at)),
            self.says("chance", _packed(self.chance.astype(np.float32))),
            self.says("most", _packed_small(self.most)),
        ]

    def number_contexts(self, order: int) -> None:
        """Contexts of some length by ascending key, and the sequences of them and a word.

        Positions whose words so far are very frequent need an exact count to go on, also where the position before
        is closed: there the sequence is asked for alone. ``most`` is an upper bound, and exact for these positions.
        """
        at, extra = self.at, self.at[:0]
        if order == 1:
            keys, state = self.vocabulary, self.words[at - 1].astype(np.int64)
        else:
            keys, state = _numbered(self.windows.keys(at - 1, order))
        self.given, self.whole = np.zeros(len(keys), np.int64), keys
        wide = np.flatnonzero(self.most > self.tree.gathered_count)
        if len(wide):
            self.given[state[wide]] = self.most[wide]
            pieces = np.maximum(1, -(-self.given // self.tree.gathered_count))
            first = np.cumsum(pieces) - pieces
            whole = np.repeat(np.arange(len(keys)), pieces)
            piece = np.arange(len(whole)) - first[whole]
            spread, key = pieces[state[wide]].astype(np.uint64), keys[whole]
            state = first[state]
            state[wide] += (_mixed(self.vocabulary[self.words[at[wide]]]) % spread).astype(np.int64)
            cut = self.given[whole] > 0
            key[cut] = _mixed(key[cut] + (piece[cut] + 1).astype(np.uint64) * np.uint64(FACTOR))
            extra = np.setdiff1d(at[wide[self.place[at[wide]] > order]] - 1, at)
            alone, which = np.unique(_mixed(self.windows.keys(extra, order + 1)), return_inverse=True)
            state, key = np.concatenate([state, len(key) + which]), np.concatenate([key, alone])
            self.given = np.concatenate([self.given[whole], np.zeros(len(alone), np.int64)])
            self.whole = np.concatenate([keys[whole], alone])
            by_key = np.argsort(key)
            rank = np.empty(len(key), np.int64)
            rank[by_key] = np.arange(len(key))
            keys, state, self.given, self.whole = key[by_key], rank[state], self.given[by_key], self.whole[by_key]
        self.asked, self.state = np.concatenate([at, extra]), state
        sequences = state.astype(np.uint64) * np.uint64(len(self.vocabulary)) + self.words[self.asked]
        sequences, self.which = _numbered(sequences)
        self.context, self.word = (x.astype(np.int64) for x in np.divmod(sequences, np.uint64(len(self.vocabulary))))
        self.keys = keys
        self.sizes = np.bincount(self.context, minlength=len(keys))

    def questions(self, order: int, bits: int) -> list[tuple]:
        """One packed message for each bucket, told by the first bits of a context's key."""
        counts = np.bincount(self.which[self.train[self.asked]], minlength=len(self.word))
        chance = np.ones(len(self.word), np.float32)
        chance[self.which[: len(self.at)]] = self.chance
        ids = self.heard("id", None, 0)[self.word]
        used = np.flatnonzero(self.sizes)
        keys, sizes, given, whole = self.keys[used], self.sizes[used], self.given[used], self.whole[used]
        buckets = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
        cuts, out = np.flatnonzero(np.diff(buckets, prepend=-1)), []
        ends = np.concatenate([[0], np.cumsum(sizes)])
        for a, b in zip(cuts, [*cuts[1:], len(keys)]):
            mine, cut = slice(ends[a], ends[b]), np.flatnonzero(given[a:b])
            parts = (
                _packed_sorted(keys[a:b]),
                _packed_small(sizes[a:b]),
                _packed_small(ids[mine]),
                _packed(chance[mine]),
                _packed_small(counts[mine]),
                _packed_small(cut),
                _packed_small(given[a:b][cut]),
                _packed(whole[a:b][cut]),
            )
            out.append((self.number, "asked", order, int(buckets[a]), b"", _joined(parts), 0, 0))
        return out

    def settle(self, order: int, cut: tuple[np.ndarray, np.ndarray]) -> None:
        """Take the states of an order, and tell what stays open from what is closed.

        ``cut`` has the keys of contexts that were cut up, ascending, and what was chosen for them.
        """
        kinds, used = 2 * len(self.tree.strengths) + 2, np.flatnonzero(self.sizes)
        mine = self.told[(self.told.what == "told") & (self.told.step == order)].sort_values("bucket")
        told = np.zeros(len(self.keys), np.int64)
        told[used] = np.concatenate([np.zeros(0, np.int64), *map(_unpacked_small, mine["keys"])])
        seen = np.concatenate([np.zeros(0, np.int64), *map(_unpacked_small, mine.numbers)])
        n, choice = told // kinds, told % kinds
        pieces = np.flatnonzero((self.given > 0) & (self.sizes > 0))
        n[pieces] = self.given[pieces]
        if len(pieces):
            choice[pieces] = cut[1][np.searchsorted(cut[0], self.whole[pieces])]
        state, m = self.state[: len(self.at)], seen[self.which]
        n, choice, extra, m = n[state], choice[state], m[len(self.at) :], m[: len(self.at)]
        s = np.array([*self.tree.strengths, 0.0])[choice >> 1]
        self.chance = np.where(s > 0, (m + s * self.chance) / np.maximum(n + s, 1e-9), self.chance)
        place = self.place[self.at]
        # Contexts to come end before these positions: counted where the positions before are asked for too.
        most = np.concatenate([n[:1], np.where(np.diff(self.at) == 1, m[:-1], n[1:])])
        if len(extra):
            found = np.searchsorted(self.at, self.asked[len(self.at) :] + 1)
            most[found] = extra
        self.most = most
        self.close(~((choice & 1 == 1) & (place > order) & (most >= self.tree.min_count)))

    def close(self, which: np.ndarray) -> None:
        if self.score is not None:
            logs = np.log10(self.chance[which])
            self.score += np.bincount(self.text[self.at[which]], weights=logs, minlength=len(self.lengths))
        still = np.flatnonzero(~which)
        self.at, self.chance, self.most = self.at[still], self.chance[still], self.most[still]

    def scores(self) -> list[tuple]:
        """Scores of what is closed."""
        out = [self.says("score", _packed(self.score))]
        return out if self.bases is None else [*out, self.says("base", _packed(self.bases)), self.says("known", _packed(self.knowns))]

    def left(self, upto: int, final: bool) -> list[tuple]:
        """What goes on from contexts of ``upto`` words on, if any does, and the scores of what is closed."""
        if final:
            self.close(np.ones(len(self.at), bool))
        out, leaves = self.scores(), self.most <= self.tree.gathered_count
        if leaves.any():
            out.append(_left(self.number, "open", upto, 0, self.at[leaves], self.chance[leaves]))
        if not leaves.all():
            at = self.at[~leaves]
            out.append(self.says("at", _packed(np.diff(at, prepend=0).astype(np.uint64)), len(at)))
            out.append(self.says("ahead", _packed(self.most[~leaves].astype(np.uint64))))
            out.append(self.says("chance", _packed(self.chance[~leaves].astype(np.float32))))
        return out


class LaterRound(Block):
    """A block whose open positions have contexts too frequent to be gathered: rounds of questions and answers."""

    def opened(self) -> LaterRound:
        """Take up the state before a round: open positions and those before them are looked at, ``spots``."""
        places = np.cumsum(self.heard("at", np.uint64), dtype=np.uint64).astype(np.int64)
        self.spots = np.union1d(places, places - 1)
        self.place, self.text, self.train = self.place[self.spots], self.text[self.spots], self.train[self.spots]
        self.at = np.searchsorted(self.spots, places)
        self.ahead = self.heard("ahead", np.uint64).astype(np.int64)
        self.chance, self.closed = np.ones(len(self.spots)), np.zeros(len(self.spots), bool)
        self.chance[self.at] = self.heard("chance", np.float32)
        self.closed[self.at] = True
        return self

    def keys(self, ends: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the sequences of some length that end at positions."""
        return self.windows.keys(self.spots[ends], length)

    def sequences(self, order: int) -> np.ndarray:
        """Where sequences of order + 1 words end that are asked for: open positions, and those before them."""
        asked = np.zeros(len(self.spots), bool)
        asked[self.at[self.place[self.at] >= order]] = True
        asked[self.at[self.place[self.at] > order] - 1] = True
        return np.flatnonzero(asked)

    def counting(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        ends = self.sequences(order)
        keys, which = _numbered(self.keys(ends, order + 1))
        return keys, np.bincount(which[self.train[ends]], minlength=len(keys)).astype(np.uint32)

    def counted(self, order: int) -> np.ndarray:
        """Counts of the sequences, as answered per distinct one."""
        which = _numbered(self.keys(self.sequences(order), order + 1))[1]
        return self.heard("count", np.uint64, 2 * order)[which].astype(np.int64)

    def judged(self, first: int, last: int) -> Iterator[tuple]:
        """Per order of a round: where words after its contexts are, whose they are, counts of contexts and with the word.

        Of a context that occurs twice, before a word once, all words follow once: nothing can be gained.
        """
        ahead = np.zeros(len(self.spots), np.int64)
        ahead[self.at] = self.ahead
        for order in range(first, last + 1):
            seen = np.full(len(self.spots), -1, np.int64)
            seen[self.sequences(order)] = self.counted(order)
            at = self.at[(self.place[self.at] >= order) & (ahead[self.at] >= self.tree.min_count)]
            at = at[(ahead[at] > 2) | (seen[at] != 1)]
            keys, state = _numbered(self.keys(at - 1, order))
            yield order, at, keys, state, ahead[at], seen[at]
            ahead = np.concatenate([[0], seen[:-1]])
        self.next_ahead = ahead

    def gains(self, first: int, last: int) -> Iterator[tuple]:
        """Per order its contexts and, over this block's training words, each strength's gain and what is then left."""
        strengths, least = self.tree.strengths, min(self.tree.strengths)
        lowest = self.chance.copy()
        for order, at, keys, state, n, seen in self.judged(first, last):
            mine = self.train[at]
            at, state, n, seen = at[mine], state[mine], n[mine], seen[mine]
            before = self.chance[at]
            after = [(seen + s * before) / (n + s) for s in strengths]
            lowest[at] = np.minimum(lowest[at], np.min(after, axis=0)) if len(at) else lowest[at]
            parts = [np.log((seen - 1 + s * before) / (n - 1 + s)) - np.log(before) for s in strengths]
            for chance in [*after, before] if order == last else []:
                chance = chance if first == last else lowest[at]
                parts.append(np.maximum(0, np.log((seen - 1 + least * chance) / (seen - 1 + least)) - np.log(chance)))
            sums = np.zeros((2 * len(strengths) + 1, len(keys)))
            for i, part in enumerate(parts):
                sums[i] = np.bincount(state, weights=part, minlength=len(keys))
            width, told = len(strengths), np.empty(len(keys), _gain_type(self.tree))
            told["gain"], told["left"] = sums[:width].T, _scaled(sums[width:], self.tree).T
            yield order, keys, told

    def settle(self, first: int, last: int, final: bool = False) -> None:
        """Take the states of a round, and tell what stays open from what is closed."""
        chance, still = self.chance.copy(), self.at[:0]
        strengths = np.array([*self.tree.strengths, 0.0])
        for order, at, _, state, n, seen in self.judged(first, last):
            mine = self.heard("gain", np.uint8, 2 * order + 1)[state]
            s = strengths[mine >> 1]
            use = s > 0
            chance[at[use]] = (seen[use] + s[use] * self.chance[at[use]]) / (n[use] + s[use])
            still = at[mine & 1 == 1]
        if final:
            still = still[:0]
        self.still = still[(self.place[still] > last) & (self.next_ahead[still] >= self.tree.min_count)] if len(still) else still
        self.closed[self.still], self.upto = False, last + 1
        chance[self.still] = chance[self.still].astype(np.float32)
        self.chance = chance

    def settled(self) -> list[tuple]:
        """What goes on after a round, and the scores of what it closed."""
        out, still, upto = [], self.still, self.upto
        leaves = self.next_ahead[still] <= self.tree.gathered_count if len(still) else np.zeros(0, bool)
        if leaves.any():
            out.append(_left(self.number, "open", upto, 0, self.spots[still[leaves]], self.chance[still[leaves]]))
            still = still[~leaves]
        if len(still):
            out.append(self.says("at", _packed(np.diff(self.spots[still], prepend=0).astype(np.uint64)), len(still)))
            out.append(self.says("ahead", _packed(self.next_ahead[still].astype(np.uint64))))
            out.append(self.says("chance", _packed(self.chance[still].astype(np.float32))))
        out.append(self.says("score", _packed(self.by_text(np.where(self.closed, np.log10(self.chance), 0.0)))))
        return out


# --- questions and answers ------------------------------------------------------------

_MESSAGE = "block bigint, what string, step int, bucket bigint, keys binary, numbers binary, total bigint, distinct bigint"
_SCORES = "block bigint, n_tokens array<bigint>, n_known array<bigint>, base_score array<double>, score array<double>"


def _questions(block: int, what: str, step: int, keys: np.ndarray, numbers: np.ndarray, bits: int) -> list[tuple]:
    """One packed message for each bucket, told by the first bits of the keys."""
    buckets = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.diff(buckets, prepend=-1))
    return [
        (block, what, step, int(buckets[a]), _packed_sorted(keys[a:b]), _packed(numbers[a:b]), 0, 0)
        for a, b in zip(cuts, [*cuts[1:], len(keys)])
    ]


def _joined(parts: Iterable[bytes]) -> bytes:
    return b"".join(len(part).to_bytes(4, "little") + part for part in parts)


def _parted(data: bytes) -> list[bytes]:
    out, begin = [], 0
    while begin < len(data):
        end = begin + 4 + int.from_bytes(data[begin : begin + 4], "little")
        out.append(data[begin + 4 : end])
        begin = end
    return out


def _left(block: int, what: str, step: int, bucket: int, places: np.ndarray, chance: np.ndarray) -> tuple:
    """Places of a block and the chances of their words, from which contexts of ``step`` words on are to be judged."""
    packed = _packed_sorted(places.astype(np.uint64)), _packed(chance.astype(np.float32))
    return (block, what, step, bucket, *packed, len(places), 0)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def _choices(gains: np.ndarray, left: np.ndarray, tree: Tree) -> np.ndarray:
    """Choices for contexts from the gain by each strength, and what is left after each and after none.

    A choice is twice a strength's number, odd if open. Sums of single precision: at the threshold it is open.
    """
    best = np.where(gains.max(0) > tree.min_gain, gains.argmax(0), len(gains))
    return 2 * best + (left[best, np.arange(len(best))] > tree.min_gain - 1e-3 * abs(tree.min_gain))


def _answers(questions: DataFrame, tree: Tree, bits: int = 0) -> DataFrame:
    """Add up what all blocks say of a key: counts, or gains by which a strength is chosen. Words get numbers too."""
    width = len(tree.strengths)

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        what, step, bucket = group.what.iloc[0], int(group.step.iloc[0]), int(group.bucket.iloc[0])
        keys = [_unpacked_sorted(k) for k in group["keys"]]
        found, where = _numbered(np.concatenate(keys))
        if what == "count":
            numbers = np.concatenate([_unpacked(n, np.uint32) for n in group.numbers])
            out = np.bincount(where, weights=numbers, minlength=len(found)).astype(np.uint64)
        else:
            gains = np.concatenate([_unpacked(n, _gain_type(tree)) for n in group.numbers])
            columns = [*gains["gain"].T, *_unscaled(gains["left"], tree).T]
            sums = np.array([np.bincount(where, weights=column, minlength=len(found)) for column in columns])
            out = _choices(sums[:width], sums[width:], tree).astype(np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        rows = [
            (int(b), what, step, bucket, b"", _packed(out[where[e - len(k) : e]]), 0, 0)
            for b, k, e in zip(group.block, keys, ends)
        ]
        if step == 0:
            rows[0] = (*rows[0][:6], int(out.sum()), int((out > 0).sum()))
            ids = np.empty(len(found), np.int64)  # frequent words have small ones
            ids[np.argsort(-out.astype(np.int64), kind="stable")] = np.arange(len(found))
            ids = (ids << bits) | bucket
            rows += [
                (int(b), "id", step, bucket, b"", _packed_small(ids[where[e - len(k) : e]]), 0, 0)
                for b, k, e in zip(group.block, keys, ends)
            ]
        return _frame(rows, _MESSAGE)

    return questions.groupBy("what", "step", "bucket").applyInPandas(answer, _MESSAGE)


def _judgements(asked: DataFrame, tree: Tree) -> DataFrame:
    """Judge the contexts of an order, all whose occurrences meet, and tell each block what it asked for.

    Of a context that was cut up, sums of gains are told instead; what a block tells itself is passed on.
    A word seen once after a context gains log(s / (n - 1 + s)) whatever its chance was, and leaves nothing to gain.
    """
    strengths, least, width = (*tree.strengths, 0.0), min(tree.strengths), len(tree.strengths)

    def judge(group: pd.DataFrame) -> pd.DataFrame:
        if group.what.iloc[0] != "asked":
            return group
        group = group.sort_values("block")
        step, bucket = int(group.step.iloc[0]), int(group.bucket.iloc[0])
        parts = list(zip(*map(_parted, group.numbers)))
        keys = [_unpacked_sorted(p) for p in parts[0]]
        sizes, ids, counts = (np.concatenate([_unpacked_small(p) for p in parts[i]]) for i in (1, 2, 4))
        chance = np.concatenate([_unpacked(p, np.float32) for p in parts[3]])
        ends = np.cumsum([len(k) for k in keys])
        cut = np.concatenate([_unpacked_small(p) + e - len(k) for p, e, k in zip(parts[5], ends, keys)])
        found, where = _numbered(np.concatenate(keys))
        given, whole = np.zeros(len(found), np.int64), np.zeros(len(found), np.uint64)
        given[where[cut]] = np.concatenate([_unpacked_small(p) for p in parts[6]])
        whole[where[cut]] = np.concatenate([_unpacked(p, np.uint64) for p in parts[7]])
        bits = np.uint64(int(ids.max(initial=0)).bit_length())
        sequences, which = _numbered((np.repeat(where, sizes).astype(np.uint64) << bits) | ids.astype(np.uint64))
        context = (sequences >> bits).astype(np.int64)
        m = np.bincount(which, weights=counts, minlength=len(sequences))
        before = np.empty(len(sequences))
        before[which] = chance

        def summed(which: np.ndarray, parts: np.ndarray | None = None) -> np.ndarray:
            return np.bincount(which, weights=parts, minlength=len(found))

        here, once, again = summed(context, m), summed(context[m == 1]), np.flatnonzero(m > 1)
        n = np.where(given > 0, given, here)
        context, mine, before = context[again], m[again], before[again]
        total, logs = n[context], np.log(before)

        def gain(s: float) -> np.ndarray:
            more = summed(context, mine * (np.log(mine - 1 + s * before) - logs))
            return more + once * np.log(s) - here * np.log(np.maximum(n, 1) - 1 + s)

        def left(s: float) -> np.ndarray:
            after = (mine + s * before) / (total + s) if s else before
            return summed(context, mine * np.maximum(0, np.log((mine - 1 + least * after) / (mine - 1 + least)) - np.log(after)))

        gains, lefts = np.array([gain(s) for s in strengths[:-1]]), np.array([left(s) for s in strengths])
        choice = np.where(n < tree.min_count, 2 * width, _choices(gains, lefts, tree))
        told, seen = n.astype(np.int64) * (2 * width + 2) + choice, m.astype(np.int64)[which]
        cuts = np.cumsum([0, *np.add.reduceat(sizes, ends - [len(k) for k in keys])])
        rows = [
            (int(b), "told", step, bucket, _packed_small(told[where[e - len(k) : e]]), _packed_small(seen[c:d]), 0, 0)
            for b, k, e, c, d in zip(group.block, keys, ends, cuts, cuts[1:])
        ]
        rows[0] = (*rows[0][:6], int(here[(choice & 1 == 1) & (given == 0)].sum()), 0)
        cut = np.flatnonzero(given)
        if len(cut):
            sums = np.concatenate([gains, lefts])[:, cut]
            rows.append((rows[0][0], "cut", step, bucket, _packed(whole[cut]), _packed(sums.ravel()), 0, 0))
        return _frame(rows, _MESSAGE)

    return asked.groupBy("what", "step", "bucket").applyInPandas(judge, _MESSAGE)


def _put_together(told: DataFrame, step: int, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
    """Keys and choices of contexts that were cut up: one for each ``gathered_count`` words of the corpus at most."""
    sums, width = 2 * len(tree.strengths) + 1, len(tree.strengths)
    rows = told.where((F.col("what") == "cut") & (F.col("step") == step)).select("keys", "numbers").collect()
    keys = np.concatenate([np.zeros(0, np.uint64), *[_unpacked(r["keys"], np.uint64) for r in rows]])
    parts = np.concatenate([np.zeros((sums, 0)), *[_unpacked(r["numbers"], np.float64).reshape(sums, -1) for r in rows]], axis=1)
    keys, which = np.unique(keys, return_inverse=True)
    parts = np.array([np.bincount(which, weights=part, minlength=len(keys)) for part in parts])
    return keys, _choices(parts[:width], parts[width:], tree)


# --- positions gathered in buckets ----------------------------------------------------

_RUNS = (
    "block bigint, bucket int, places binary, since binary, chance binary, "
    "starts binary, lengths binary, trains binary, vocabulary binary, words binary"
)


def _stretches(tree: Tree, first: int) -> Iterator[list[tuple[int, int]]]:
    """Rounds judged on end in a bucket, from contexts of ``first`` words on: the longer they are, the fewer are open."""
    stretch = []
    for low, high in _rounds(tree):
        if high < first:
            continue
        stretch.append((low, high))
        begin = stretch[0][0]
        if high >= (tree.single if begin <= tree.single else 3 * begin if begin <= 8 * tree.single else 15 * begin):
            yield stretch
            stretch = []
    if stretch:
        yield stretch


def _smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each value and the ``width - 1`` before it."""
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        hashes = np.concatenate([hashes[:step], np.minimum(hashes[step:], hashes[:-step])])
        reach += step
    return hashes


def _runs(row, told: pd.DataFrame, first: int, last: int, bits: int) -> list[tuple]:
    """A block's open positions and the words before them, for the buckets of their contexts of ``first`` words.

    One word more than the longest context is sent, where there is one, to tell contexts that end there.
    """
    lengths, words = _unpacked(row.lengths, np.int64), _unpacked(row.words, np.uint32)
    trains, vocabulary = _unpacked(row.trains, np.uint8), _unpacked_sorted(row.vocabulary)
    at = np.concatenate([_unpacked_sorted(k) for k in told["keys"]]).astype(np.int64)
    chance = np.concatenate([_unpacked(n, np.float32) for n in told.numbers])
    since = np.repeat(told.step.to_numpy(), told.total.to_numpy())
    bucket = np.zeros(len(at), np.int64)
    if bits:
        # Only words of the contexts are looked at; those of one context stay in a row.
        change = np.bincount(at - first, minlength=len(words)) - np.bincount(at, minlength=len(words))
        covered = np.cumsum(change) > 0
        size = max(1, min(4, first // 2))
        hashes = Windows(vocabulary[words[covered]])
        hashes = hashes.keys(np.arange(size - 1, len(hashes.power)), size)
        hashes = _smallest(np.concatenate([np.zeros(size - 1, np.uint64), hashes]), first - size + 1)
        bucket = (_mixed(hashes[np.cumsum(covered)[at - 1] - 1]) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((at, bucket))
    at, chance, since, bucket = at[order], chance[order], since[order], bucket[order]
    ends = np.cumsum(lengths)
    text = np.searchsorted(ends, at, "right")
    begin = np.maximum(ends[text] - lengths[text], at - last - 1)
    fresh = np.concatenate([[True], (np.diff(bucket) != 0) | (np.diff(text) != 0) | (begin[1:] > at[:-1])])
    starts, runs = begin[fresh], np.flatnonzero(fresh)
    sizes = at[np.append(runs[1:], len(at)) - 1] + 1 - starts
    out, cuts = [], np.flatnonzero(np.diff(bucket, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(at)]):
        c, d = np.searchsorted(runs, [a, b])
        skipped = starts[c:d] - (np.cumsum(sizes[c:d]) - sizes[c:d])
        used, numbers = _numbered(words[np.arange(sizes[c:d].sum()) + np.repeat(skipped, sizes[c:d])].astype(np.uint64))
        packed = (
            _packed_sorted(at[a:b].astype(np.uint64)),
            _packed(since[a:b].astype(np.uint32)),
            _packed(chance[a:b]),
            _packed_sorted(starts[c:d].astype(np.uint64)),
            _packed(sizes[c:d].astype(np.uint32)),
            _packed(trains[text[runs[c:d]]]),
            _packed_sorted(vocabulary[used]),
            _packed(numbers.astype(np.uint32)),
        )
        out.append((int(row.block), int(bucket[a]), *packed))
    return out


class Gathered:
    """All occurrences of some contexts: their words, and the words before them as far as they are judged now."""

    def __init__(self, group: pd.DataFrame, tree: Tree):
        def joined(parts) -> np.ndarray:
            return np.concatenate(list(parts))

        self.tree = tree
        words = joined(_unpacked_sorted(v)[_unpacked(w, np.uint32)] for v, w in zip(group.vocabulary, group.words))
        self.windows = Windows(words)
        places = [_unpacked_sorted(p).astype(np.int64) for p in group.places]
        starts = [_unpacked_sorted(s).astype(np.int64) for s in group.starts]
        sizes = [_unpacked(n, np.uint32).astype(np.int64) for n in group.lengths]
        counts = np.cumsum([0, *map(len, starts)])
        run = joined(np.searchsorted(s, p, "right") - 1 + c for s, p, c in zip(starts, places, counts))
        sizes = joined(sizes)
        self.places, self.blocks = joined(places), np.repeat(group.block.to_numpy(), [len(p) for p in places])
        self.reach = self.places - joined(starts)[run]  # words before a position that are here
        self.at = (np.cumsum(sizes) - sizes)[run] + self.reach
        self.word = _numbered(words[self.at])[1]
        self.train = joined(_unpacked(t, np.uint8) for t in group.trains)[run] > 0
        self.since = joined(_unpacked(s, np.uint32) for s in group.since).astype(np.int64)
        self.chance = joined(_unpacked(c, np.float32) for c in group.chance).astype(np.float64)
        self.open = np.ones(len(self.at), bool)

    def contexts(self, live: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions whose contexts of some length occur often enough, with the contexts' numbers and counts."""
        live = live[self.reach[live] >= order]
        keys, state = _numbered(self.windows.keys(self.at[live] - 1, order))
        n = np.bincount(state[self.train[live]], minlength=len(keys))
        often = n[state] >= self.tree.min_count
        return live[often], state[often], n

    def judge(self, first: int, last: int) -> None:
        """A round. What is not among its contexts any more, or has too little left to gain, is closed.

        Longer contexts of the round are judged against the same chances, later rounds against those that the round
        leaves; a context is closed when neither leaves enough.
        """
        strengths, least = np.array([*self.tree.strengths, 0.0]), min(self.tree.strengths)
        before, after = self.chance, self.chance.copy()
        live = np.flatnonzero(self.open & (self.since <= first))
        self.open[live] = False
        for order in range(first, last + 1):
            live, state, n = self.contexts(live, order)
            if not len(live):
                break
            keys, which = _numbered((state * len(self.at) + self.word[live]).astype(np.uint64))
            mine = self.train[live]
            seen = np.bincount(which[mine], minlength=len(keys))[which]
            learnt, m, total, old = state[mine], seen[mine], n[state[mine]], before[live[mine]]

            def summed(parts: np.ndarray) -> np.ndarray:
                return np.bincount(learnt, weights=parts, minlength=len(n))

            def left(chance: np.ndarray) -> np.ndarray:
                return summed(np.maximum(0, np.log((m - 1 + least * chance) / (m - 1 + least)) - np.log(chance)))

            gains = np.array([summed(np.log((m - 1 + s * old) / (total - 1 + s)) - np.log(old)) for s in strengths[:-1]])
            s = strengths[np.where(gains.max(0) > self.tree.min_gain, gains.argmax(0), len(strengths) - 1)][state]
            use = s > 0
            after[live[use]] = (seen[use] + s[use] * before[live[use]]) / (n[state[use]] + s[use])
            more = left(after[live[mine]])
            more = np.maximum(more, left(old)) if order < last else more
            live = live[(more > self.tree.min_gain - 1e-3 * abs(self.tree.min_gain))[state]]
        if last != self.tree.depth:
            self.open[self.contexts(live, last + 1)[0]] = True
        self.chance = after

    def told(self, bucket: int) -> list[tuple]:
        """To each block, what is closed and what stays open."""
        kinds = np.where(self.open, np.maximum(self.since, 1), 0)
        order = np.lexsort((self.places, kinds, self.blocks))
        kinds, blocks = kinds[order], self.blocks[order]
        cuts = np.flatnonzero(np.diff(blocks, prepend=blocks[0] - 1).astype(bool) | np.diff(kinds, prepend=-1).astype(bool))
        return [
            _left(
                int(blocks[a]), "open" if kinds[a] else "closed", int(kinds[a]), bucket, self.places[order[a:b]], self.chance[order[a:b]]
            )
            for a, b in zip(cuts, [*cuts[1:], len(order)])
        ]


def _gathered(runs: DataFrame, stretch: list[tuple[int, int]], tree: Tree) -> DataFrame:
    """Judge gathered positions for a stretch of rounds."""

    def judge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        found = Gathered(group, tree)
        for first, last in stretch:
            found.judge(first, last)
        return _frame(found.told(int(group.bucket.iloc[0])), _MESSAGE)

    return runs.groupBy("bucket").applyInPandas(judge, _MESSAGE)


def scored(
    docs: DataFrame, train: Column, text: str = "text", keep: Sequence[str] | None = None, tree: Tree = Tree()
) -> DataFrame:
    """The input ``row`` with n_tokens, n_known, train_tokens, base_score and score (log10).

    ``train`` says which documents the tree learns from.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Kept partitioned by block, so only messages move afterwards; a lost part is made again.
    held = blocks(docs, train, text, keep, tree).repartition(parts, "block").persist(StorageLevel.DISK_ONLY)
    packed = held.select("block", "lengths", "trains", "vocabulary", "words")

    def size(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"n": [len(_unpacked(w, np.uint32)) for w in batch.words]})

    tokens = packed.select("words").mapInPandas(size, "n bigint").agg(F.sum("n")).first()[0] or 0

    def bits_for(positions: int) -> int:
        return max(0, int(np.ceil(np.log2(max(1, positions / tree.bucket_tokens)))))

    bits = bits_for(tokens)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block = Block(row, tree, batch)
                yield _frame(_questions(block.number, "count", 0, *block.first_questions(), bits), _MESSAGE)

    vocabulary = written(_answers(packed.mapInPandas(words, _MESSAGE), tree, bits), "state")
    totals = vocabulary.agg(F.sum("total"), F.sum("distinct")).first()
    total, distinct = int(totals[0] or 0), int(totals[1] or 0)

    def together(messages: DataFrame, kind: type, function) -> DataFrame:
        """Blocks that have messages, with all of them."""

        def each(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(told):
                for row in rows.itertuples():
                    out += function(kind(row, tree, told))
            return _frame(out, _MESSAGE)

        return packed.groupBy("block").cogroup(messages.groupBy("block")).applyInPandas(each, _MESSAGE)

    def both(a: DataFrame | None, b: DataFrame) -> DataFrame:
        return b if a is None else a.unionByName(b)

    def of(messages: DataFrame, *what: str) -> DataFrame:
        return messages.where(F.col("what").isin(*what))

    def step(rows: DataFrame, purpose: str = "state") -> DataFrame:
        """A written table; files shuffled for it are let go of, which else stay until the driver happens to collect garbage."""
        made = written(rows, purpose)
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        return made

    def left_in(messages: DataFrame, what: str) -> int:
        return of(messages, what).agg(F.sum("total")).first()[0] or 0

    def taken_up(block: FirstOrders, order: int, cuts: dict, scoring: bool) -> FirstOrders:
        """The state before an order."""
        if order <= REPLAYED:
            block.begun(total, distinct, scoring)
        else:
            block.resumed()
        for done in range(1 if order <= REPLAYED else order - 1, order):
            block.number_contexts(done)
            block.settle(done, cuts[done])
        return block

    def asking(order: int, bits: int, cuts: dict):
        def ask(block: FirstOrders) -> list[tuple]:
            taken_up(block, order, cuts, order >= REPLAYED).number_contexts(order)
            carried = [*block.scores(), *block.carried()] if order >= REPLAYED else []
            return block.questions(order, bits) + carried

        return ask

    def ending(order: int, cuts: dict, final: bool):
        return lambda block: taken_up(block, order, cuts, True).left(order, final)

    told, closed, cuts, order, still = vocabulary, None, {}, 1, tokens
    orders = min(tree.single, tree.gathered - 1, tree.single if tree.depth is None else tree.depth)
    while order <= orders and still:
        now = step(_judgements(together(told, FirstOrders, asking(order, bits, cuts)), tree))
        closed = both(closed, of(now, "score", "base", "known")) if order >= REPLAYED else closed
        cuts = {**cuts, order: _put_together(now, order, tree)}
        still = left_in(now, "told") + (tokens if (cuts[order][1] & 1).any() else 0)
        now = of(now, "told", "at", "chance", "most")
        told = (told if order < REPLAYED else vocabulary).unionByName(now)
        order += 1
    done = step(together(told, FirstOrders, ending(order, cuts, order - 1 == tree.depth or not still)))
    closed = both(closed, of(done, "score", "base", "known"))
    waiting, state = of(done, "open"), of(done, "at", "ahead", "chance")

    def round_of(state: DataFrame, first: int, last: int, bits: int) -> DataFrame:
        """The state after a round by questions."""

        def count(block: LaterRound) -> list[tuple]:
            block.opened()
            return [
                message
                for order in range(first, last + 1)
                for message in _questions(block.number, "count", 2 * order, *block.counting(order), bits)
            ]

        def weigh(block: LaterRound) -> list[tuple]:
            return [
                message
                for order, keys, gains in block.opened().gains(first, last)
                for message in _questions(block.number, "gain", 2 * order + 1, keys, gains, bits)
            ]

        def settle(block: LaterRound) -> list[tuple]:
            block.opened().settle(first, last, last == tree.depth)
            return block.settled()

        told = state.unionByName(step(_answers(together(state, LaterRound, count), tree), "counts"))
        told = told.unionByName(step(_answers(together(told, LaterRound, weigh), tree), "choices"))
        return step(together(told, LaterRound, settle))

    def runs_of(messages: DataFrame, first: int, last: int, bits: int) -> DataFrame:
        def each(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
            return _frame([m for row in rows.itertuples() if len(told) for m in _runs(row, told, first, last, bits)], _RUNS)

        return packed.groupBy("block").cogroup(messages.groupBy("block")).applyInPandas(each, _RUNS)

    for first, last in _rounds(tree):
        if first < order:
            continue
        still = left_in(state, "at")
        if not still:
            break
        # As many buckets as an order needs, open positions and those before them.
        done = round_of(state, first, last, bits_for(2 * still))
        closed, waiting, state = both(closed, of(done, "score")), both(waiting, of(done, "open")), of(done, "at", "ahead", "chance")
    for stretch in _stretches(tree, order):
        still = left_in(waiting, "open")
        if not still:
            break
        first, last = stretch[0][0], stretch[-1][1]
        told = step(_gathered(runs_of(waiting, first, last, bits_for(4 * still * (1 + 2 * last // first))), stretch, tree))
        closed = closed.unionByName(told.where(F.col("what") == "closed"))
        waiting = told.where(F.col("what") == "open")

    def add_up(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        done = []
        for row in rows.itertuples():
            lengths = _unpacked(row.lengths, np.int64)
            sums = {
                what: np.sum([_unpacked(n, np.float64) for n in told.numbers[told.what == what]], axis=0)
                for what in ("known", "base", "score")
            }
            ends = np.cumsum(lengths)
            for _, part in told[told.what == "closed"].iterrows():
                text = np.searchsorted(ends, _unpacked_sorted(part["keys"]), "right")
                chance = _unpacked(part["numbers"], np.float32).astype(np.float64)
                sums["score"] = sums["score"] + np.bincount(text, weights=np.log10(chance), minlength=len(lengths))
            done.append((int(row.block), lengths, sums["known"].astype(np.int64), sums["base"], sums["score"]))
        return _frame(done, _SCORES)

    judged = packed.select("block", "lengths").groupBy("block").cogroup(closed.groupBy("block")).applyInPandas(add_up, _SCORES)
    columns = ("n_tokens", "n_known", "base_score", "score")
    each = held.select("block", "rows").join(judged, "block")
    result = written(
        each.select(F.inline(F.arrays_zip("rows", *columns))).select(
            F.col("rows").alias("row"), "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score"
        ),
        "scores",
    )
    held.unpersist()
    return result
