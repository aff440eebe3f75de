from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventloom.llm import quotes
from eventloom.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def by_place(rows):
    return {(r.row.conv_id, r.row.turn): r for r in rows.collect()}


def test_table_without_quotes_stays_as_it_is(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = QUERIES["op1_quotation_linking"](spark, sf_dir)
    plain = got.where("levels = 0")
    assert got.count() == given.count()
    assert plain.select(given.columns).exceptAll(given).count() == 0
    assert plain.where("depth > 0 OR answers_conv IS NOT NULL OR conversation <> conv_id OR root_turn <> turn").count() == 0


def test_nested_quotes_are_linked_and_removed(spark):
    rows = [
        (1, 0, "u", "Hello there,\nhow are you?\n\nSecond para."),
        (1, 1, "a", "> Hello there,\n> how are you?\nFine thanks."),
        (1, 2, "u", "On Monday X wrote:\n> > Hello there, how\n> > are you?\n> Fine  THANKS.\n\nGood to hear."),
        (1, 3, "a", ">how are you?\nanother answer"),
        (2, 0, "u", ">> Fine thanks.\n> Good to hear.\nok"),
        (2, 1, "a", "> never said\nstill"),
        (2, 2, "u", "a > b is no quote\n\n\n\nend\n"),
    ]
    got = by_place(quotes.conversations(spark.createDataFrame(rows, SCHEMA)))
    place = {k: (r.answers_conv, r.answers_turn, r.conversation, r.root_turn, r.depth) for k, r in got.items()}
    assert place[1, 0] == (None, None, 1, 0, 0)
    assert place[1, 1] == (1, 0, 1, 0, 1)
    assert place[1, 2] == (1, 1, 1, 0, 2)
    assert place[1, 3] == (1, 0, 1, 0, 1)
    assert place[2, 0] == (1, 2, 1, 0, 3)
    assert place[2, 1] == (None, None, 2, 1, 0)
    assert [got[k].own for k in sorted(got)] == [
        rows[0][3], "Fine thanks.", "Good to hear.", "another answer", "ok", "still", rows[6][3],
    ]
    assert [got[k].levels for k in sorted(got)] == [0, 1, 2, 1, 2, 1, 0]
    assert got[2, 1].quoted == 1 and got[2, 1].linked == 0


def test_first_message_with_a_passage_is_the_origin(spark):
    """A passage in very many messages costs one row, and links go to its first holder."""
    rows = [(c, 0, "u", "the same line") for c in range(300)] + [(7, t, "u", "the same line") for t in range(1, 300)]
    rows += [(7, 400, "a", "> the same line\nyes"), (900, 5, "a", "> The same\n> line\nno")]
    got = by_place(quotes.conversations(spark.createDataFrame(rows, SCHEMA)))
    assert (got[7, 400].answers_conv, got[7, 400].answers_turn) == (7, 0)
    assert (got[900, 5].answers_conv, got[900, 5].answers_turn) == (0, 0)


@pytest.mark.parametrize("length", [2, 3, 9, 40])
def test_long_chains(spark, length):
    rows = [(1, 0, "u", "word0")] + [(1, t, "u", f"> word{t - 1}\nword{t}") for t in range(1, length)]
    got = by_place(quotes.conversations(spark.createDataFrame(rows[::-1], SCHEMA)))
    assert [got[1, t].depth for t in range(length)] == list(range(length))
    assert {(r.conversation, r.root_turn) for r in got.values()} == {(1, 0)}


def test_edges(spark):
    rows = [(1, 0, "u", None), (1, 1, "u", ""), (None, 0, "u", "> x"), (1, None, "u", "> y"), (2, 0, "u", "x"), (2, 1, "u", "> x"), (2, 1, "u", "> x")]
    rows += [(3, 0, None, "long line\n" * 20_000), (3, 1, "u", "> long line\n" * 5000 + "\r\n>\r\n> \u0001"), (4, 0, "u", "> \n>> \n>"), (5, 0, "u", "> " * 20_000 + "deep")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("clash")).withColumn("passages", F.lit(1))
    out = quotes.conversations(docs).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault((r.row.conv_id, r.row.turn), []).append(r)
    assert got[1, 0][0].own is None and got[1, 1][0].own == ""
    assert [r.depth for r in got[2, 1]] == [1, 1]
    assert got[None, 0][0].depth == 0 and got[1, None][0].answers_conv is None
    assert (got[3, 1][0].answers_turn, got[3, 1][0].own) == (0, "")
    assert got[3, 0][0].row.depth == "clash"
    assert quotes.conversations(docs.limit(0)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = quotes.conversations(spark.createDataFrame([(1, 0, "u", "> a")], SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
