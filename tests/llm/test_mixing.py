from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from eventloom.llm import mixing
from eventloom.llm.queries import ORACLE, QUERIES


def slow_targets(sizes):
    """Share, stop what is above twice its size, share the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2 * sizes[s] for s in above)
        open_ -= above
    return target


def test_query_equals_sql(spark, sf_dir):
    name = "op5_mix_sources"
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def test_takes_what_the_targets_say(spark, sf_dir, documents):
    rows = QUERIES["op5_mix_sources"](spark, sf_dir).collect()
    source = {d["doc_id"]: d["source"] for d in documents}
    sizes, taken, largest, target = Counter(), Counter(), defaultdict(int), {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s] += r["size"]
        taken[s] += r.taken
        largest[s] = max(largest[s], r["size"])
        target[s] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = slow_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-12)
        assert abs(taken[s] - target[s]) <= largest[s]


def test_edges(docs_of):
    given = [("a b c", "x"), (None, "x"), ("", None), ("a b", None), ("a " * 500, "y"), ("", "z"), ("w", "")] + [("same text", "hot")] * 300
    docs = docs_of(*given).withColumn("size", F.lit("clash")).withColumn("key", F.lit(1))
    rows = mixing.copies(docs).collect()
    assert len(rows) == len(given)
    total = Counter()
    for r in rows:
        total[r.row.source] += r.copies * r["size"]
    sizes = Counter()
    for text, source in given:
        sizes[source] += len((text or "").split())
    want = slow_targets(sizes)
    assert {r.row.source: r.target for r in rows} == pytest.approx(want)
    assert total["z"] == 0 and abs(total["hot"] - want["hot"]) <= 2
    emitted = mixing.mixed(docs)
    assert emitted.columns == docs.columns
    assert emitted.count() == sum(r.copies for r in rows)
    assert sorted(map(repr, emitted.collect())) == sorted(map(repr, mixing.mixed(docs.repartition(7)).collect()))
    assert mixing.mixed(docs.limit(0)).count() == 0
