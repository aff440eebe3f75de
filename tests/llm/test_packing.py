from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import bestfit, packing, tokenizing, tokenrows
from eventloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def plain():
    """Ids by the tokenizer itself, the whole text at once."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizing.default_path())
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def one_by_one(sizes, capacity):
    """Best-fit decreasing, looking at every bin for every item; rooms left in the end."""
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= size]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= size
        else:
            rooms.append(capacity - size)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_runs_are_best_fit_decreasing(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 7, 32, 100])
    sizes = [draw.randint(1, capacity) for _ in range(draw.randint(0, 400))]
    counts = {s: sizes.count(s) for s in set(sizes)}
    runs, bins = bestfit.pack_runs(counts, capacity)
    filled = {}
    for size, n in counts.items():
        where, offsets = bestfit.places(runs, np.full(n, size), np.arange(n))
        for b, o in zip(where, offsets):
            filled.setdefault(int(b), []).append((int(o), size))
    for parts in filled.values():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end <= capacity
    assert sorted(capacity - sum(s for _, s in parts) for parts in filled.values()) == one_by_one(sizes, capacity)
    assert bins == len(filled)


def test_tree_finds_the_tightest_room():
    draw = random.Random(1)
    tree, used = bestfit.RoomTree(50), set()
    for _ in range(2000):
        room = draw.randint(0, 50)
        tree.set(room, room not in used)
        used ^= {room}
        size = draw.randint(0, 50)
        assert tree.tightest(size) == min((r for r in used if r >= size), default=None)


def test_ids_are_those_of_the_tokenizer(plain, documents):
    ids = tokenizing.encoder(tokenizing.default_path()).ids
    odd = ["", " ", "  a", "a  b", "a b ", "a\n b", "a \nb\n\n c", "é è", "\t\t x", "x  y", "a <|endoftext|> b", "1 22 333", "don't  we'll"]
    draw = random.Random(4)
    odd += ["".join(draw.choice(" \n\tab1.'é　") for _ in range(30)) for _ in range(300)]
    for text in [*odd, *[d["text"] or "" for d in documents]]:
        assert np.frombuffer(ids(text), "<u4").tolist() == plain(text)[:-1]


def test_layout_is_whole_and_gapless(spark, sf_dir, documents, plain):
    rows = QUERIES["op3_best_fit_packing"](spark, sf_dir).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == {d["doc_id"] for d in documents}
    for d in documents:
        ids, pieces = plain(d["text"]), sorted(by_doc[d["doc_id"]], key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert sum(r.length for r in pieces) == len(ids)
        assert all(r.length == 2048 for r in pieces[1:]) and (len(ids) <= 2048) == (len(pieces) == 1)
        for r in pieces:
            part = np.array(ids[r.start : r.start + r.length], dtype="<u4").tobytes()
            assert len(part) == 4 * r.length and zlib.crc32(part) == r.ids_crc32
    for parts in by_sequence.values():
        end = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == end
            end += r.length
        assert end <= 2048
    assert len(by_sequence) == len(one_by_one([r.length for r in rows], 2048))


def test_edges(docs_of, plain):
    docs = docs_of(None, "", "word " * 9000, *["same words here"] * 50, (None, "x", None)).withColumn("length", F.lit("clash"))
    rows = packing.layout(docs, capacity=100).collect()
    assert sum(r.length for r in rows) == sum(len(plain(d.text)) for d in docs.collect())
    assert max(r.length for r in rows) == 100
    assert packing.layout(docs.limit(0)).count() == 0
    assert tokenrows.packed_rows(docs.limit(0)).count() == 0


def test_rows_round_trip(spark, docs_of, documents, plain, tmp_path):
    texts = [d["text"] for d in documents] + [None, ""]
    docs = docs_of(*texts)
    tokenrows.write(tokenrows.packed_rows(docs, block_tokens=20_000), str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows")).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    ids = tokenrows.matrix([r.input_ids for r in rows])
    assert ids.shape == (len(rows), 2048)
    back = {}
    for r, row in zip(rows, ids):
        cuts = r.cu_seqlens
        assert cuts[0] == 0 and cuts[-1] == r.n_tokens and len(cuts) == r.n_segments + 1
        assert r.resets == cuts[:-1] and not row[r.n_tokens :].any()
        place = tokenrows.positions(r.resets)
        for a, b, doc, piece, start in zip(cuts, cuts[1:], r.doc_ids, r.pieces, r.starts):
            back.setdefault(doc, []).append((piece, start, row[a:b].tolist()))
            assert place[a:b].tolist() == list(range(b - a))
    for i, text in enumerate(texts):
        joined = []
        for n, (piece, start, part) in enumerate(sorted(back[i])):
            assert piece == n and start == len(joined)
            joined += part
        assert joined == plain(text)


def test_rows_of_the_query_hold_every_token(spark, sf_dir, documents, plain):
    rows = QUERIES["op6_token_rows"](spark, sf_dir).collect()
    assert sum(r.n_tokens for r in rows) == sum(len(plain(d["text"])) for d in documents)
