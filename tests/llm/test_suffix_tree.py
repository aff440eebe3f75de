from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm import suffix_tree
from eventloom.llm.queries import QUERIES

END = object()


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*(w for w in lower.translate({c: " " for c in range(9, 14)}).split(" ") if w), END]


def slow_scores(texts, trained, tree):
    """Base score, score and known words of each text, one word after the other; no context is ever closed."""
    texts = [words_of(t) for t in texts]
    learnt = [t for t, use in zip(texts, trained) if use]
    counts = Counter(w for t in learnt for w in t)
    total, distinct = sum(counts.values()), len(counts)
    longest = min(tree.depth or 10**9, max((len(t) for t in texts), default=0))
    rounds, first = [], 1
    while first <= longest:
        last = first if first <= tree.single else 2 * (first - 1)
        rounds.append(range(first, min(last, longest) + 1))
        first = last + 1
    after = defaultdict(Counter)  # of contexts with min_count occurrences; those that end in a rarer one are rarer still
    places = [(t, i) for t in learnt for i in range(1, len(t))]
    for k in range(1, longest + 1):
        found = defaultdict(Counter)
        for t, i in places:
            if i >= k:
                found[tuple(t[i - k : i])][t[i]] += 1
        often = {context: seen for context, seen in found.items() if sum(seen.values()) >= tree.min_count}
        after.update(often)
        places = [(t, i) for t, i in places if i >= k and tuple(t[i - k : i]) in often]
        if not places:
            break
    states = {}

    def chance(context, word, upto):
        p = (counts[word] + 1) / (total + distinct + 1)
        for lengths in rounds:
            best = None
            for k in lengths:
                if k > min(upto, len(context)) or context[-k:] not in after:
                    return p if best is None else smoothed(best, word, p)
                best = context[-k:] if context[-k:] in states else best
            p = p if best is None else smoothed(best, word, p)  # by the longest state of the round
        return p

    def smoothed(context, word, p):
        seen, s = after[context], states[context]
        return (seen[word] + s * p) / (sum(seen.values()) + s)

    for lengths in rounds:
        new = {}
        for context, seen in after.items():
            n = sum(seen.values())
            if len(context) not in lengths or n < tree.min_count:
                continue
            gains = []
            for s in tree.strengths:
                gain = 0.0
                for w, c in seen.items():
                    p = chance(context, w, lengths[0] - 1)
                    gain += c * math.log((c - 1 + s * p) / (n - 1 + s) / p)
                gains.append(gain)
            if max(gains) > tree.min_gain:
                new[context] = tree.strengths[gains.index(max(gains))]
        states |= new
    out = []
    for t in texts:
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in t)
        score = sum(math.log10(chance(tuple(t[max(0, i - longest) : i]), w, longest)) for i, w in enumerate(t))
        out.append((len(t), sum(counts[w] > 0 for w in t), total, base, score))
    return out, states


def compare(got, want):
    for a, b in zip(got, want, strict=True):
        assert a[:3] == b[:3]
        assert a[3] == pytest.approx(b[3], rel=1e-9) and a[4] == pytest.approx(b[4], rel=1e-6)


def test_equals_slow_version(docs_of):
    draw = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    texts = []
    for i in range(120):
        text = [draw.choice(words) for _ in range(draw.randrange(40))]
        if i % 3 == 0:
            text[5:5] = "The quick brown fox jumps over it".split()
        text[3:3] = draw.choice(["left turn goes", "right turn stays"]).split()  # what follows "turn" depends on the word before
        texts.append(" ".join(text))
    texts += [None, "", "unseen words only", " \n", texts[0]]
    tree = suffix_tree.Tree(depth=3, min_count=4, block_tokens=300, bucket_tokens=200)
    docs = docs_of(*texts).withColumn("block", F.lit("clash")).withColumn("score", F.lit(0))
    rows = suffix_tree.scored(docs, F.col("doc_id") % 5 != 0, tree=tree).collect()
    got = {r.row.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows}
    want, states = slow_scores(texts, [i % 5 != 0 for i in range(len(texts))], tree)
    assert {1, 2} <= {len(c) for c in states}
    compare([got[i] for i in range(len(texts))], want)
    assert rows[0].row.block == "clash"


def test_query_equals_slow_version(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op9_suffix_tree_scores"](spark, sf_dir).collect()}
    held_out = [zlib.crc32(str(d["doc_id"]).encode()) % 7 == 2 for d in documents]
    want, _ = slow_scores([d["text"] for d in documents], [not h for h in held_out], suffix_tree.Tree())
    rows = [got[d["doc_id"]] for d in documents]
    assert [r.held_out for r in rows] == held_out and len(got) == len(documents)
    compare([(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows], want)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


def test_edges(docs_of):
    docs = docs_of("a b", None)
    rows = suffix_tree.scored(docs, F.lit(False)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(0, 0, 0.0, 0.0)] * 2
    null = suffix_tree.scored(docs, F.lit(None).cast("boolean")).collect()
    assert all(r.train_tokens == 0 for r in null)
    assert suffix_tree.scored(docs.limit(0), F.lit(True)).count() == 0
    long = suffix_tree.scored(docs_of("x y " * 100_000, "x"), F.lit(True), tree=suffix_tree.Tree(block_tokens=1000)).collect()
    assert {r.n_tokens for r in long} == {200_001, 2}


def test_long_contexts_become_states(docs_of):
    """The word after a passage of five words depends on the word before it."""
    draw = random.Random(8)
    texts = []
    for i in range(60):
        noise = [f"w{draw.randrange(30)}" for _ in range(6)]
        texts.append(" ".join([*noise, f"start{i % 2}", *"and so it goes on".split(), f"end{i % 2}"]))
    rows = suffix_tree.scored(docs_of(*texts), F.lit(True)).collect()
    got = {r.row.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows}
    want, states = slow_scores(texts, [True] * len(texts), suffix_tree.Tree())
    assert max(len(c) for c in states) == 6
    compare([got[i] for i in range(len(texts))], want)


def test_odd_and_clashing_names_are_carried(spark):
    schema = "doc_id bigint, text string, `a b.c``d` string, block bigint, score string"
    rows = spark.createDataFrame([(1, "one two", "x", 3, "s"), (2, None, None, None, None)], schema)
    made = suffix_tree.scored(rows, F.lit(True))
    assert made.select("row.*").columns == rows.columns and made.count() == 2


def test_passage_of_thirty_words(docs_of):
    """The word after a passage depends on the passage's first word; lengths of 17 to 32 words are one round."""
    draw = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(29))
    texts = []
    for i in range(60):
        noise = " ".join(f"w{draw.randrange(30)}" for _ in range(6))
        texts.append(f"{noise} start{i % 2} {passage} end{i % 2} {noise}")
    docs = docs_of(*texts)
    rows = suffix_tree.scored(docs, F.lit(True), tree=suffix_tree.Tree(block_tokens=500, bucket_tokens=300)).collect()
    got = {r.row.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows}
    want, states = slow_scores(texts, [True] * len(texts), suffix_tree.Tree())
    assert max(len(c) for c in states) >= 30
    compare([got[i] for i in range(len(texts))], want)
    short = suffix_tree.scored(docs, F.lit(True), tree=suffix_tree.Tree(depth=16)).collect()
    assert sum(r.score for r in rows) > sum(r.score for r in short) + 10


def test_near_copies_with_independent_edits(docs_of):
    """Contexts stay open over hundreds of words where copies differ in a few words each."""
    draw = random.Random(10)
    text = [f"t{draw.randrange(60)}" for _ in range(70)]
    texts = [" ".join(f"x{draw.randrange(60)}" if draw.random() < 0.03 else w for w in text) for _ in range(30)]
    tree = suffix_tree.Tree(single=2, block_tokens=700, bucket_tokens=500)
    rows = suffix_tree.scored(docs_of(*texts), F.col("doc_id") % 5 != 0, tree=tree).collect()
    got = {r.row.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows}
    want, _ = slow_scores(texts, [i % 5 != 0 for i in range(len(texts))], tree)
    compare([got[i] for i in range(len(texts))], want)


def test_root_only(docs_of):
    rows = suffix_tree.scored(docs_of("a b a", "b"), F.lit(True), tree=suffix_tree.Tree(depth=0)).collect()
    assert all(r.score == pytest.approx(r.base_score) and r.base_score < 0 for r in rows)


@pytest.mark.parametrize("often", [8, 10**6])
def test_gathered_contexts_equal_slow_version(docs_of, monkeypatch, often):
    """Contexts stay open over hundreds of words: long ones are judged in a few steps, frequent ones by questions."""
    draw = random.Random(12)
    text = [f"t{draw.randrange(50)}" for _ in range(300)]
    texts = [" ".join(f"x{draw.randrange(50)}" if draw.random() < 0.01 else w for w in text) for _ in range(14)]
    texts += [None, texts[0], " ".join(text[100:]), " ".join(text[:40])]
    steps = []
    kept = suffix_tree.written
    monkeypatch.setattr(suffix_tree, "written", lambda rows, purpose: steps.append(purpose) or kept(rows, purpose))
    tree = suffix_tree.Tree(single=2, min_gain=1.0, gathered_count=often, block_tokens=700, bucket_tokens=500)
    rows = suffix_tree.scored(docs_of(*texts), F.col("doc_id") % 5 != 0, tree=tree).collect()
    got = {r.row.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows}
    want, states = slow_scores(texts, [i % 5 != 0 for i in range(len(texts))], tree)
    assert max(len(c) for c in states) > 64
    compare([got[i] for i in range(len(texts))], want)
    assert often == 8 or len(steps) <= 16  # by questions alone a round is three steps


@pytest.mark.parametrize("often", [5, 200_000])
def test_an_order_is_asked_and_judged_in_one_step(docs_of, monkeypatch, often):
    """Also where contexts occur too often for one bucket and are cut up."""
    draw = random.Random(14)
    words = [f"w{i}" for i in range(12)]
    texts = [" ".join(draw.choice(words[: 3 + i % 9]) for _ in range(draw.randrange(30))) for i in range(90)]
    steps = []
    kept = suffix_tree.written
    monkeypatch.setattr(suffix_tree, "written", lambda rows, purpose: steps.append(purpose) or kept(rows, purpose))
    tree = suffix_tree.Tree(depth=3, min_gain=1.0, gathered_count=often, block_tokens=200, bucket_tokens=150)
    rows = suffix_tree.scored(docs_of(*texts), F.col("doc_id") % 4 != 0, tree=tree).collect()
    got = {r.row.doc_id: (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows}
    want, states = slow_scores(texts, [i % 4 != 0 for i in range(len(texts))], tree)
    assert {len(c) for c in states} == {1, 2, 3}
    compare([got[i] for i in range(len(texts))], want)
    assert len(steps) == 6  # words, three orders, what is left, scores
