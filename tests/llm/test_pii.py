from __future__ import annotations

import re
from hashlib import sha256

from pyspark.sql import functions as F

from eventloom.llm import pii
from eventloom.llm.queries import QUERIES


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def slow_base(text):
    text, spans = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    return spans


HARD = [
    None,
    "",
    "a@b.c_x@y.org z@@q.com .a@b-.c- a@b@c.d é@x.y",
    "first.last%+x@mail.example.com,second@x.co.uk.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.03.255 1.2.3 99999999999999999999.1.1.1 1.2.3.",
    "4465758382889437 4465758382889437 x4111 1111 1111 1111x 4111-1111-1111-1112 0000000000000",
    "+1 (523) 555-1055 and +49-(0)30.1234567 or +1 2 ++12345678901 +1234567890123456789",
    "😀😀 a@b.cd 😀 +1 523 555 1055",
    "control \x01 a@b.cd \x02 \x01x@y.zz",
    "1 " * 30_000 + "a@b.cd " * 500,
    "a@" + "b." * 30_000 + "cd " + "1." * 30_000 + "x" * 50_000 + "@y.zz +" + "1-" * 30_000,
]


def spans_of(row):
    return [(pii.KINDS[s.kind], s.start, s.end) for s in row.spans]


def test_base_patterns_on_hard_texts(docs_of):
    docs = docs_of(*HARD).withColumn("no", F.lit("clash")).withColumn("spans", F.lit(1)).withColumn("m0", F.lit(2))
    got = {r.row.doc_id: r for r in pii.scan(docs).collect()}
    for i, text in enumerate(HARD):
        base = [s for s in spans_of(got[i]) if s[0] in pii.BASE]
        assert base == slow_base(text), text
        assert got[i].row.no == "clash"


def test_query_equals_slow_version(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op8_personal_data"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    some = 0
    for d in documents:
        spans, row = slow_base(d["text"]), got[d["doc_id"]]
        some += len(spans)
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert row.base_sha256 == sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(row.spans.split(","))
    assert some


def test_no_python_on_the_main_path(docs_of):
    plan = pii.scan(docs_of("a@b.cd"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_reliabilities_follow_the_votes(spark):
    """Two labelers that agree and one that contradicts them: the third is believed less."""
    rows = [(1, 1, 0, 400), (0, 0, 1, 400), (1, 1, 1, 100), (0, 0, 0, 100), (None, 1, None, 10)]
    q = pii.reliabilities(spark.createDataFrame(rows, "a int, b int, c int, n bigint"), ["a", "b", "c"]).first()
    assert q.hits[0] > 0.9 and q.misses[0] < 0.1 and q.hits[2] < 0.3 and q.misses[2] > 0.7
    assert 0.4 < q.share < 0.6


def slow_reliabilities(patterns, n, rounds):
    share, hits, misses = 0.5, [0.8] * n, [0.2] * n
    for _ in range(rounds):
        judged = []
        for votes, count in patterns:
            yes, no = share, 1 - share
            for v, h, m in zip(votes, hits, misses):
                if v is not None:
                    yes, no = yes * (h if v else 1 - h), no * (m if v else 1 - m)
            judged.append((votes, count, yes / (yes + no)))
        share = (sum(c * y for _, c, y in judged) + 1) / (sum(c for _, c, _ in judged) + 2)
        for i in range(n):
            cast = [(v[i], c, y) for v, c, y in judged if v[i] is not None]
            hits[i] = (sum(c * y for v, c, y in cast if v) + 4) / (sum(c * y for _, c, y in cast) + 5)
            misses[i] = (sum(c * (1 - y) for v, c, y in cast if v) + 1) / (sum(c * (1 - y) for _, c, y in cast) + 5)
    return share, hits, misses


def test_reliabilities_equal_slow_version(spark):
    rows = [(1, None, 30), (0, 1, 7), (1, 1, 12), (0, 0, 55), (None, None, 3), (None, 0, 9)]
    q = pii.reliabilities(spark.createDataFrame(rows, "a int, b int, n bigint"), ["a", "b"], rounds=7).first()
    share, hits, misses = slow_reliabilities([(r[:2], r[2]) for r in rows], 2, 7)
    assert abs(q.share - share) < 1e-9
    assert all(abs(x - y) < 1e-9 for x, y in zip([*q.hits, *q.misses], [*hits, *misses]))


def test_added_kinds_and_redaction(docs_of):
    texts = ["call (499) 555-6503 now", "mail a@b.com or +1 523 555 1055!", "nothing here", None, "", "twice x@y.org x@y.org"] * 20
    docs = docs_of(*texts).withColumn("a.b `c", F.lit(1)).withColumn("row", F.lit(2))
    rows = {r.row.doc_id: spans_of(r) for r in pii.scan(docs).collect()}
    assert ("local_phone", 5, 19) in rows[0]
    hidden = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert hidden[1] == "mail <EMAIL> or <PHONE>!" and hidden[2] == "nothing here" and hidden[3] is None and hidden[4] == ""
    assert hidden[5] == "twice <EMAIL> <EMAIL>" and hidden[0] == "call <LOCAL_PHONE> now"
    assert pii.redact(docs).columns == docs.columns
    assert pii.redact(docs.limit(0)).count() == 0
