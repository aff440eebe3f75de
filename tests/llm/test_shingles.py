from __future__ import annotations

import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import common, shingles


def shingles_of(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in range(9, 14)}
    ).split(" ")
    words = [w for w in words if w]
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def slow_kept(texts):
    """Smallest ids of the groups that pairs with five-word Jaccard of 0.8 or more make, and those pairs."""
    sets, root, pairs = {d: shingles_of(t) for d, t in texts.items()}, {d: d for d in texts}, set()
    holders = defaultdict(list)

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d in sorted(texts):
        near = {e for s in sets[d] or [""] for e in holders[s]}
        for e in near:
            if not sets[d] or Fraction(len(sets[d] & sets[e]), len(sets[d] | sets[e])) >= Fraction(4, 5):
                pairs.add((e, d))
                low, high = sorted((find(e), find(d)))
                root[high] = low
        for s in sets[d] or [""]:
            holders[s].append(d)
    return sorted({find(d) for d in texts}), pairs


def near_copies(count, seed=4):
    """Texts of random words, and copies of them with some words changed: some closer than 0.8, some less."""
    draw, texts = random.Random(seed), []
    for i in range(count):
        words = [f"w{draw.randrange(5000)}" for _ in range(draw.choice([60, 200, 1000]))]
        texts.append(" ".join(words))
        for k in (1, len(words) // 50, len(words) // 30):
            copy = list(words)
            for at in draw.sample(range(len(words)), k):
                copy[at] = f"x{draw.randrange(5000)}"
            texts.append(" ".join(copy))
    return texts


def test_stage_equals_all_pairs(spark, docs_of):
    texts = near_copies(60)
    want, pairs = slow_kept(dict(enumerate(texts)))
    got = sorted(r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs_of(*texts), "").collect())
    assert got == want and len(pairs) > 60 and len(want) > 60


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_tables_equal_all_pairs(spark, table):
    docs = spark.read.parquet(f"/root/testdata/{table}/documents.parquet")
    want, pairs = slow_kept({r.doc_id: r.text for r in docs.collect()})
    assert sorted(r.doc_id for r in shingles.representatives(docs).collect()) == want and pairs


def test_pieces_of_a_large_group(docs_of, monkeypatch):
    monkeypatch.setattr(shingles, "PIECE", 150)
    texts = near_copies(3, seed=5)
    want, _ = slow_kept(dict(enumerate(texts)))
    assert sorted(r.doc_id for r in shingles.representatives(docs_of(*texts)).collect()) == want


def test_edges(docs_of):
    long = " ".join(f"w{i}" for i in range(70_000))
    rows = docs_of(None, "", "  \n", "One", "one", "One two", "a b c d", "A B  C D", long, long, (None, "a b c d", "s"), (6, "a b c d", "s"))
    kept = shingles.representatives(rows).collect()
    assert sorted(r.doc_id for r in kept) == [0, 3, 5, 6, 8]
    assert kept[0].__fields__ == rows.columns
    assert shingles.representatives(rows.limit(0)).count() == 0


def test_stage_goes_through_the_fingerprint_grid(docs_of, monkeypatch):
    """With no bands of minima to meet in, fingerprints within three bits still find copies, and the similarity decides."""
    seen, grid = [], shingles.simhash.links
    monkeypatch.setattr(shingles.simhash, "links", lambda points, *rest: seen.append(points.columns) or grid(points, *rest))
    words = [f"w{i}" for i in range(3000)]
    near = " ".join([*words[:-1], "changed"])
    kept = sorted(r.doc_id for r in shingles.representatives(docs_of(" ".join(words), near, " ".join(words[:1500]))).collect())
    assert seen and kept == [0, 2]


def test_unique_rows_stay_where_they_are(spark, docs_of, monkeypatch):
    """Only rows that may meet others move to a join, and a sieve too small for its keys lets more through but loses none."""
    ids = spark.range(3000).withColumnRenamed("id", "no")
    wanted = ids.where("no % 10 = 3")
    for bits, most in ((common.SIEVE_BITS, 310), (64, 3000)):
        monkeypatch.setattr(common, "SIEVE_BITS", bits)
        told = common.sieved(ids, wanted, "no")
        maybe = {r.no for r in told.where("maybe").collect()}
        assert told.columns == ["no", "maybe"] and told.count() == 3000
        assert {n for n in range(3000) if n % 10 == 3} <= maybe and len(maybe) <= most
    assert common.sieved(ids, wanted.limit(0), "no").where("maybe").count() == 0
    moved = []
    real = common.sieved
    monkeypatch.setattr(shingles, "sieved", lambda rows, *rest: moved.append(real(rows, *rest)) or moved[-1])
    texts = near_copies(20)
    want, _ = slow_kept(dict(enumerate(texts)))
    got = sorted(r.doc_id for r in shingles.representatives(docs_of(*texts)).collect())
    assert got == want and len(moved) == 2
    assert {r.row.doc_id for r in moved[1].where(~F.col("maybe")).collect()} <= set(want)


def test_many_unlike_texts_in_one_cell():
    """Texts that share a cell but not enough words are compared once each, whatever further cells they share."""
    calls, count = [], 60
    sets = [np.unique(np.arange(5) + 10 * i).astype(np.uint64) for i in range(count)]
    cells = np.zeros((count, shingles.BANDS + 1), np.uint64)
    real = shingles.similarity
    try:
        shingles.similarity = lambda a, b: calls.append(1) or real(a, b)
        assert shingles.linked(list(range(count)), sets, cells, 0.8) == []
    finally:
        shingles.similarity = real
    assert len(calls) == count * (count - 1) // 2
