"""Corpus queries beside their SQL, on the table and, for quotations, on messages that hold some."""

from __future__ import annotations

import random

import pytest
from compare import connect, difference

from eventloom.llm.oracle import ORACLE
from eventloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) is None


def mail(draw, earlier):
    """A message that quotes some earlier ones, nested, rewrapped or in part."""
    words = ["alpha", "beta", "Gamma", "delta", "so", "be it"]
    own = ["\n".join(" ".join(draw.choices(words, k=draw.randint(1, 5))) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(1, 2))]
    text = "\n\n".join(own)
    for quoted in draw.sample(earlier, min(len(earlier), draw.randint(0, 2))):
        lines = quoted.split("\n")[: draw.choice([1, 2, 99])]
        mark = draw.choice([">", "> ", " > "])
        head = draw.choice(["", "On Monday Ann wrote:\n"])
        text = draw.choice(["{0}{1}\n{2}", "{2}\n\n{0}{1}"]).format(head, "\n".join(mark + line for line in lines), text)
    return text


@pytest.mark.parametrize("seed", range(3))
def test_quotations_equal_sql(spark, tmp_path, seed):
    draw, rows, told = random.Random(seed), [], []
    for conv in range(12):
        for turn in range(draw.randint(1, 6)):
            told.append(mail(draw, told[-8:]))
            rows.append((conv, turn, "user", draw.choice([told[-1]] * 9 + [None, ""])))
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    made = QUERIES["op1_quotation_linking"](spark, str(tmp_path))
    assert made.where("depth > 1").count() > 0 and made.where("linked > 0").count() > 5
    assert difference(made, duck, ORACLE["op1_quotation_linking"]) is None
