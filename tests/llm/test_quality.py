from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from eventloom.llm import quality
from eventloom.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    """The base measurements, window by window and character by character."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines, dup = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.append(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
    }


def test_query_equals_slow_version(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op4_quality_ledger"](spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for d in documents:
        want, row = slow(d["text"]), got[d["doc_id"]]
        assert {k: row[k] for k in want} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert row.base_failed == failed and not (failed and row.kept)


def test_good_texts_are_kept_and_bad_ones_go(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = QUERIES["op4_quality_ledger"](spark, sf_dir).join(labels, "doc_id").where("not base_failed")
    assert rows.where("quality = 1 and not kept").count() == 0
    assert rows.where("quality = 0 and kept").count() <= 0.1 * rows.where("quality = 0").count()


def test_edges(docs_of):
    texts = [None, "", " \t\n\x0b", "one", "a b c a b c", "x\ny\nx\n \n \nx", "Ä ß　word " * 30, "w " * 200_000]
    rows = quality.ledger(docs_of(*texts).withColumn("failed", F.lit("clash")).withColumn("m", F.lit(1)))
    got = {r.row.doc_id: r for r in rows.collect()}
    for i, text in enumerate(texts):
        assert {k: got[i][k] for k in slow(text)} == slow(text), i
    assert got[0].failed == got[1].failed == 1
    assert got[3].row["failed"] == "clash"
    assert quality.ledger(docs_of(*texts).limit(0)).count() == 0


def test_policies_and_ablations(docs_of):
    good = " ".join(f"word{i}" for i in range(60))
    loud = " ".join(f"WORD{i}" for i in range(60))
    marked = " ".join(f"word{i}##" for i in range(60))
    both = " ".join(f"WORD{i}##" for i in range(60))
    rows = quality.ledger(docs_of(good, loud, marked, both, "short"))
    judged = quality.verdicts(rows, quality.BASE, quality.STANDARD)
    got = {r.row.doc_id: (r.kept_base_v1, r.kept_standard_v2) for r in judged.collect()}
    assert got == {0: (True, True), 1: (True, False), 2: (True, False), 3: (True, False), 4: (False, False)}
    worth = {r.rule: (r.n_failed, r.n_only) for r in quality.ablations(rows, quality.STANDARD).collect()}
    assert worth["capitals"] == (2, 1) and worth["symbols"] == (2, 1) and worth["few_words"] == (1, 1)
    assert worth["long_words"] == (0, 0)
