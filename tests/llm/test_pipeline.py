from __future__ import annotations

import re

import pytest
import test_packing
import test_pii
import test_quality
import test_shingles
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm.common import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """What each stage was given and what it returned."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, sf_dir), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_stages_keep_the_columns(stages):
    assert list(stages) == ["quality", "simhash", "personal_data", "mix", "pack"]
    for given, made in list(stages.values())[:-1]:
        assert given.columns == made.columns


def test_quality_rejects_what_fails_the_base(stages):
    given, made = stages["quality"]
    kept = {r.doc_id for r in made.collect()}
    for r in given.collect():
        m = test_quality.slow(r.text)
        if m["n_words"] < 50 or 2 * m["n_repeat_words"] > m["n_words"]:
            assert r.doc_id not in kept
    assert 0.5 * given.count() < len(kept)


def test_one_of_each_group_stays(stages):
    """The stage's rule: five-word shingles, a Jaccard similarity of 0.8 or more, over all pairs."""
    given, made = stages["simhash"]
    kept, pairs = test_shingles.slow_kept({r.doc_id: r.text for r in given.collect()})
    assert sorted(r.doc_id for r in made.collect()) == kept and pairs


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, `a b.c``d` string, row string, key string, size string, block string"


def test_every_stage_with_odd_and_clashing_names(spark, sf_dir):
    good = " ".join(f"{chr(97 + i % 26)}o{chr(97 + i // 26)}el" for i in range(120)) + "."
    rows = [
        (1, good, "en", "s", 1, "x", "r", "k", "z", "b"),
        (1, good, "en", "s", 1, "x", "r", "k", "z", "b"),
        (None, good + " more of it", None, None, None, None, None, None, None, None),
        (2, None, "en", "s", 1, "x", "r", "k", "z", "b"),
        (3, "", "en", "s", 1, "x", "r", "k", "z", "b"),
        (4, "ünï " * 30_000, "en", "s", 1, "x", "r", "k", "z", "b"),
        (5, good.replace("oa", "ie").replace("ob", "ua"), "de", "t", 1, "x", "r", "k", "z", "b"),
    ]
    for given in (spark.createDataFrame(rows, ODD), spark.createDataFrame([], ODD)):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            made = written(stage(spark, docs, sf_dir), "odd")
            if name != "pack":
                assert made.columns == given.columns
            docs = made
        assert bool(docs.head(1)) == bool(given.head(1))


def test_personal_data_is_gone(stages):
    given, made = stages["personal_data"]
    after = {r.doc_id: r for r in made.collect()}
    assert len(after) == given.count()
    hidden = 0
    for r in given.collect():
        text = after[r.doc_id].text
        if not test_pii.slow_base(r.text) and not re.search("[0-9]", r.text):
            assert text == r.text
        hidden += text != r.text
        assert not re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", text)
        assert after[r.doc_id].n_chars == len(text)
    assert hidden


def test_mix_repeats_documents(stages):
    given, made = stages["mix"]
    copies = made.groupBy("doc_id", "text").count()
    assert copies.agg(F.max("count")).first()[0] == 2
    assert made.join(given, ["doc_id", "text"], "left_anti").count() == 0


def test_pack_holds_everything_once(stages):
    given, made = stages["pack"]
    rows = made.collect()
    assert sum(r.piece == 0 for r in rows) == given.count()
    assert len({r.sequence_id for r in rows}) == len(test_packing.one_by_one([r.length for r in rows], 2048))


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got, want = corpus_pipeline.run(spark, sf_dir).select(key), stages["pack"][1].select(key)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
