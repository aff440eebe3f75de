from __future__ import annotations

import random

import xxhash

from eventloom.llm import simhash
from eventloom.llm.queries import QUERIES


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in range(9, 14)}
    ).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(prints):
    """Smallest id reachable over links of at most three bits."""
    distinct = sorted(set(prints.values()))
    at = {p: i for i, p in enumerate(distinct)}
    root = list(range(len(distinct)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            if (a ^ distinct[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for doc, p in prints.items():
        r = find(at[p])
        least[r] = min(least.get(r, doc), doc)
    return {doc: least[find(at[p])] for doc, p in prints.items()}


def test_query_equals_slow_version(spark, sf_dir, documents):
    prints = {d["doc_id"]: slow_fingerprint(d["text"]) for d in documents}
    groups = slow_groups(prints)
    got = QUERIES["op2_simhash_groups"](spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{p:016x}", groups[d]) for d, p in prints.items()}
    assert len(got) == len(documents)


def test_links_are_all_found(spark):
    """Random points, and chains and clusters around them, against all pairs."""
    draw = random.Random(3)
    points = set()
    for _ in range(60):
        p = draw.getrandbits(64)
        for _ in range(12):
            points.add(p)
            for _ in range(draw.randrange(4)):
                p ^= 1 << draw.randrange(64)
    points |= {0, 2**64 - 1, 2**63}
    signed = sorted(p - 2**64 if p >= 2**63 else p for p in points)
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()}
    mask = 2**64 - 1
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & mask).bit_count() <= 3}
    assert got == want and len(want) > 200


def test_edges(docs_of):
    long = " ".join(f"w{i}" for i in range(70_000))
    texts = [None, "", "  \n", "One", "one", "One two", "a b c d", "A B C D", long, long]
    rows = docs_of(*texts, (None, "a b c d", "s"), (6, "a b c d", "s"))
    got = {}
    for r in simhash.groups(rows).collect():
        got.setdefault(r.doc_id, []).append((r.fp & (2**64 - 1), r.component_id))
    for i, text in enumerate(texts):
        assert got[i][0][0] == slow_fingerprint(text)
    assert [got[i][0][1] for i in (0, 1, 2, 4, 7, 9)] == [0, 0, 0, 3, 6, 8]
    assert got[None][0][1] == 6 and len(got[6]) == 2
    kept = simhash.representatives(rows).collect()
    assert sorted(r.doc_id for r in kept) == [0, 3, 5, 6, 8]
    assert kept[0].__fields__ == rows.columns
    assert simhash.groups(rows.limit(0)).count() == 0 and simhash.representatives(rows.limit(0)).count() == 0
