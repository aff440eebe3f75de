"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from compare import connect, difference

from eventloom.llm import bestposition
from eventloom.llm.oracle import ORACLE
from eventloom.llm.queries import QUERIES

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def slow_terms(text):
    return TERM.findall((text or "").translate(LOWER))


def slow_ranked(docs, items, k=50):
    counts = [(doc, Counter(slow_terms(text))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    big_n, big_l = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        wanted = set(slow_terms(text)) & set(df)
        scored = []
        for (doc, c), n in zip(counts, sizes):
            m = 50 + (50 * n * big_n) // max(1, big_l)
            score = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, i + 1, None if null else doc, -score) for i, (score, null, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **settings):
    given = spark.createDataFrame(docs, "doc_id bigint, text string")
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted(map(tuple, bestposition.ranked(given.repartition(3), asked, **settings).collect()), key=repr)


def test_terms():
    assert [t.decode() for t in bestposition.terms("Ab_c-9É é x{y}\x7f\x00Z")] == slow_terms("Ab_c-9É é x{y}\x7f\x00Z")
    assert bestposition.terms(None) == bestposition.terms("") == bestposition.terms("!? \n") == []


@pytest.mark.parametrize("seed,k", [(0, 3), (1, 50), (2, 1)])
def test_random_texts(spark, monkeypatch, seed, k):
    monkeypatch.setattr(bestposition, "GROUP_BYTES", 60)
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(words[min(29, int(draw.expovariate(0.2)))] for _ in range(n))
    docs = [(i, text(draw.choice([0, 1, 3, 20]))) for i in range(120)]
    docs += [(i, docs[3][1]) for i in range(200, 260)] + [(5, "w1 w2"), (5, "w1 w2"), (None, "w1 w2"), (300, None), (301, "")]
    items = [(i, text(draw.choice([1, 4, 12]))) for i in range(8)] + [(8, None), (9, "nowhere"), (None, "w1"), (3, "w1 W1")]
    assert found(spark, docs, items, k=k) == slow_ranked(docs, items, k)


def test_reading_stops_early(monkeypatch):
    """The lists are read until the bound falls below the k-th score, not to their end."""
    rng = np.random.default_rng(0)
    size, terms = 5000, 3
    tfs = np.where(np.arange(size) < 60, 50, 1)
    rows = [(d, t, tfs[d] if t == d % terms or d < 60 else 1) for d in range(size) for t in range(terms) if d < 60 or rng.random() < 0.5]
    d, t, f = (np.array(x) for x in zip(*rows))
    row = type("Row", (), {})()
    row.ids, row.docs, row.terms = list(range(size)), d.astype(np.int32).tobytes(), t.astype(np.int32).tobytes()
    row.tfs, row.lengths = f.astype(np.int64).tobytes(), np.full(size, 100, np.int64).tobytes()
    corpus = bestposition.Corpus(size, size * 100, np.array([700, 690, 680], np.int64))
    lists = bestposition.Lists(row, corpus)
    reads = []
    unique = np.unique
    monkeypatch.setattr(bestposition.np, "unique", lambda x: reads.append(len(x)) or unique(x))
    at, score = lists.best(np.arange(3), 10, 1)
    assert sum(reads) < len(rows) / 4
    whole = np.zeros(size, np.int64)
    np.add.at(whole, lists.docs, lists.value)
    assert sorted(score.tolist(), reverse=True)[:10] == sorted(whole.tolist(), reverse=True)[:10]


def test_long_text_extra_columns_and_empty_tables(spark):
    docs = [(1, "x " * 300_000 + "rare"), (2, "rare"), (3, "y" * 500_000)]
    assert found(spark, docs, [(0, "rare"), (1, "y" * 500_000)]) == slow_ranked(docs, [(0, "rare"), (1, "y" * 500_000)])
    odd = spark.createDataFrame([(1, "rare", 3, "q")], "doc_id bigint, text string, score int, `item_id.x y``` string")
    items = spark.createDataFrame([("a", "rare", 1)], "item_id string, text string, rank int")
    assert [tuple(r) for r in bestposition.ranked(odd, items).select("item_id", "rank", "doc_id").collect()] == [("a", 1, 1)]
    for empty_docs, empty_items in ((odd.limit(0), items), (odd, items.limit(0))):
        made = bestposition.ranked(empty_docs, empty_items)
        assert made.columns == ["item_id", "rank", "doc_id", "score"] and made.count() == 0


def test_query_on_larger_table(spark):
    larger = "/root/testdata/sf0.01"
    name = "op12_best_position_search"
    assert difference(QUERIES[name](spark, larger), connect(larger), ORACLE[name]) is None
