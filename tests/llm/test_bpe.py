"""Token ids against the public library, and against merging one pair at a time."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import bpe
from eventloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = bpe.read_ranks(bpe.default_path())
    return tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def slow_merged(word: bytes, ranks) -> list[int]:
    """One pair at a time: the least rank, the leftmost of equals."""
    if word in ranks:
        return [ranks[word]]
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def ids_of(spark, texts, **settings):
    rows = bpe.encoded(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), **settings)
    made = bpe.decoded(rows, path=settings.get("path")).select("row.doc_id", "ids", "n_tokens", "bytes", "packed")
    return {r.doc_id: r for r in made.collect()}


HARD = [
    None,
    "",
    " ",
    "   \n\n\t  x  ",
    "I'll we've don't 'S",
    "naïve Ünïcödé ǅ ﬀ 漢字かな 한글 العربية हिन्दी 🤦🏽‍♂️ ‍﻿",
    "a" * 127,
    "a" * 128,
    "a" * 129,
    "ab" * 40_000,
    " " * 30_000 + "end",
    "x7" * 300,
    "1234567890" * 50,
    "<|endoftext|> <|startoftext|>",
    "\x00\x01 \x7f \x85   　",
    "!" * 500,
]


@pytest.mark.parametrize("block_words", [1, 50, bpe.BLOCK_WORDS])
def test_same_as_library(spark, library, block_words):
    draw = random.Random(block_words)
    pool = [chr(c) for c in [*range(32, 127), 10, 9, 0xE9, 0x3B1, 0x4E2D, 0x1F600, 0x300]]
    texts = [*HARD, *HARD[3:6], *("".join(draw.choices(pool, k=draw.randint(1, 200))) for _ in range(60))]
    made = ids_of(spark, texts, block_words=block_words)
    for i, text in enumerate(texts):
        assert made[i].ids == library.encode_ordinary(text or "")
        assert made[i].n_tokens == len(made[i].ids)
        assert bytes(made[i].bytes) == (text or "").encode()


def unnatural(tmp_path) -> str:
    """Ranks that no training gives: longer tokens before their parts, equal bytes by several pairs, a token out of reach."""
    draw, tokens = random.Random(5), [bytes([b]) for b in range(256)]
    more = {bytes(draw.choices(b"abc", k=draw.randint(2, 5))) for _ in range(90)} | {b"zyxw"}
    tokens += sorted(more, key=lambda t: draw.random())
    path = tmp_path / "ranks.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens)))
    return str(path)


def test_any_ranks(spark, tmp_path):
    path = unnatural(tmp_path)
    ranks = bpe.read_ranks(path)
    assert any(bpe.merged(token, ranks) != [rank] for token, rank in ranks.items())
    draw = random.Random(1)
    texts = ["".join(draw.choices("abc", k=draw.randint(1, 60))) for _ in range(200)] + ["zyxw", "zyxwa", "abcab" * 60]
    made = ids_of(spark, texts, path=path)
    for i, text in enumerate(texts):
        assert made[i].ids == slow_merged(text.encode(), ranks)
        assert bytes(made[i].bytes) == text.encode()


def test_heap_merges_like_one_at_a_time(tmp_path):
    ranks = bpe.read_ranks(unnatural(tmp_path))
    draw = random.Random(2)
    for _ in range(500):
        word = bytes(draw.choices(b"abc", k=draw.randint(1, 40)))
        if word not in ranks:
            assert bpe.merged(word, ranks) == slow_merged(word, ranks)


def test_both_folds_are_equal(spark, tmp_path):
    """Higher-order functions over one word, and arrays over all words."""
    draw = random.Random(3)
    for path, letters in ((bpe.default_path(), [*b"abcdetho srn", 0xC3, 0xA9]), (unnatural(tmp_path), b"abc")):
        words = [bytes(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(300)]
        parts, lengths = bpe.parts_of(words, path)
        tokens, sizes = bpe.fold_words(parts.copy(), lengths, path)
        cuts, at = np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([[0], np.cumsum(lengths)])
        arrays = [tokens[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
        given = [parts[a:b].tolist() for a, b in zip(at, at[1:])]
        frame = spark.createDataFrame([(given,)], "parts array<array<bigint>>")
        column = frame.select(bpe.encoded_words(F.col("parts"), bpe.vocabulary(path)).alias("ids")).first().ids
        assert column == arrays == [bpe.merged(w, bpe.read_ranks(path)) for w in words]


def test_ranks_without_a_byte_are_refused(tmp_path):
    path = tmp_path / "few.tiktoken"
    path.write_text("YQ== 0\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(path))


def test_clashing_and_odd_names(spark, library):
    given = spark.createDataFrame(
        [(None, "one two", 1, "a", [1]), (None, "one two", 1, "a", [1])], "doc_id bigint, text string, ids int, `a b.c``d` string, words array<int>"
    )
    rows = bpe.encoded(given)
    assert rows.select("row.*").columns == given.columns
    assert [r.ids for r in rows.collect()] == [library.encode_ordinary("one two")] * 2
    empty = bpe.encoded(given.limit(0))
    assert empty.count() == 0 and empty.columns == ["row", "n_tokens", "ids"]


def test_unknown_ids_have_no_bytes(spark):
    made = bpe.decoded(spark.createDataFrame([([0, 10**6],), ([],), (None,), ([-1],)], "ids array<int>"))
    assert [None if r.bytes is None else bytes(r.bytes) for r in made.collect()] == [None, b"", None, None]
    assert [None if r.packed is None else len(r.packed) for r in made.collect()] == [8, 0, None, 4]


def test_query(spark, sf_dir, documents, library):
    mine = {r.doc_id: r for r in QUERIES["op13_byte_level_bpe"](spark, sf_dir).collect()}
    assert len(mine) == len(documents)
    for row in documents:
        ids = np.array(library.encode_ordinary(row["text"] or ""), "<u4")
        got = mine[row["doc_id"]]
        assert got.n_tokens == len(ids)
        assert got.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_nothing_is_shuffled(spark, sf_dir):
    plan = QUERIES["op13_byte_level_bpe"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
