"""Statements are judged by their plan, whatever their spelling; draws with replacement."""

from __future__ import annotations

import hashlib

import pytest

from eventloom.functions.sampling import draw_with_replacement
from eventloom.operators import inspection, statements
from eventloom.plans.queries import QUERIES


def rules(spark, sql, known=None):
    return {f.rule for f in statements.findings(spark, sql, known)}


FINE = [
    "SELECT * FROM EVENTS",
    "/* first */ SELECT e.STATE FROM events AS e -- all\n WHERE e.JOB_ID = '1'",
    "WITH t AS (SELECT * FROM EVENTS), u AS (SELECT * FROM t) SELECT COUNT(*) FROM u WHERE EXISTS (SELECT 1 FROM t)",
    "SELECT a.JOB_ID FROM EVENTS a JOIN EVENTS b ON a.JOB_ID = b.JOB_ID",
    "(SELECT 1 AS x) UNION ALL SELECT _ID FROM EVENTS WHERE JOB_ID IN (SELECT JOB_ID FROM EVENTS)",
    "SELECT json_extract(METADATA, '$.site') FROM EVENTS WHERE json_extract(METADATA, '$.site') LIKE 'a%' AND json_extract(METADATA, '$.cores') = 8",
    "SELECT json_extract(METADATA, concat('$.', 'site')) AS s FROM EVENTS",
    "SELECT 'FROM secrets' AS t FROM EVENTS -- FROM other",
]


@pytest.mark.parametrize("sql", FINE)
def test_allowed(spark, sql):
    assert rules(spark, sql) == set()


@pytest.mark.parametrize(
    "sql,rule",
    [
        ("DROP TABLE EVENTS", "no_query"),
        ("INSERT INTO EVENTS SELECT * FROM EVENTS", "no_query"),
        ("SET x = 1", "no_query"),
        ("EXPLAIN SELECT * FROM EVENTS", "no_query"),
        ("SELECT * FROM other", "other_table"),
        ("SELECT * FROM spark_catalog.default.EVENTS", "other_table"),
        ("SELECT * FROM parquet.`/tmp/x`", "other_table"),
        ("SELECT * FROM EVENTS e, other o", "other_table"),
        ("SELECT * FROM EVENTS LEFT JOIN /* x */ other USING (_ID)", "other_table"),
        ("SELECT (SELECT max(x) FROM other) FROM EVENTS", "other_table"),
        ("SELECT * FROM EVENTS WHERE _ID IN (SELECT x FROM (SELECT x FROM other) t)", "other_table"),
        ("WITH t AS (SELECT * FROM other) SELECT * FROM t", "other_table"),
        ("(WITH t AS (SELECT * FROM EVENTS) SELECT _ID FROM t) UNION SELECT _ID FROM t", "other_table"),
        ("WITH t AS (SELECT * FROM t) SELECT * FROM t", "other_table"),
        ("SELECT * FROM range(9)", "other_table"),
        ("SELECT * FROM VALUES (1) AS v(x)", "other_table"),
        ("SELECT json_extract(METADATA, 'site') FROM EVENTS", "path_not_rooted"),
        ('SELECT json_extract(METADATA, "site") FROM EVENTS', "path_not_rooted"),
        ("SELECT json_extract(lower(e.METADATA), /* p */ 'site') FROM EVENTS e", "path_not_rooted"),
        ("SELECT 1 FROM EVENTS GROUP BY 1 HAVING max(JSON_EXTRACT(METADATA,\n'site')) > 1", "path_not_rooted"),
        ("SELECT json_extract(METADATA, concat('si', 'te')) FROM EVENTS", "path_not_rooted"),
        ("SELECT * FROM EVENTS ORDER BY (SELECT max(json_extract(METADATA, 'site')) FROM EVENTS)", "path_not_rooted"),
        ("SELECT json_extract(METADATA, STATE) FROM EVENTS", "path_not_literal"),
        ("SELECT * FROM EVENTS WHERE lower(json_extract(METADATA, '$.site')) = 'x'", "text_field_equals"),
        ("SELECT * FROM EVENTS WHERE 'x' = json_extract(METADATA, '$.host')", "text_field_equals"),
        ("SELECT * FROM EVENTS WHERE json_extract(METADATA, '$.site') IN ('x')", "text_field_equals"),
        ("SELECT * FROM EVENTS e WHERE e.STATE LIKE 'F%'", "plain_column_like"),
    ],
)
def test_told(spark, sql, rule):
    assert rules(spark, sql) == {rule}


def test_keys_of_the_sample(spark):
    sql = "SELECT json_extract(METADATA, '$.site'), json_extract(METADATA, '$.made_up') FROM EVENTS"
    assert [f.detail for f in statements.findings(spark, sql, {"site"})] == ["$.made_up"]


def test_execute_sql_refuses_before_running(spark):
    events = spark.createDataFrame([(1, '{"site": "x"}')], "_ID int, METADATA string")
    spark.range(3).createOrReplaceTempView("other_view")
    for sql in ("SELECT * FROM other_view", "SELECT json_extract(lower(METADATA), 'site') FROM EVENTS", 'SELECT json_extract(METADATA, "site") FROM EVENTS'):
        with pytest.raises(ValueError):
            inspection.execute_sql(events, sql)
    equal = "SELECT _ID FROM EVENTS WHERE json_extract(METADATA, '$.site') = 'x'"
    assert inspection.execute_sql(events, equal).count() == 1
    with pytest.raises(ValueError, match="text_field_equals"):
        inspection.execute_sql(events, equal, rules=statements.REFUSED + statements.TOLD)
    with pytest.raises(ValueError, match="unknown_key"):
        inspection.execute_sql(events, "SELECT json_extract(METADATA, '$.k') FROM EVENTS", {"site"}, ("unknown_key",))


# --- draws with replacement -----------------------------------------------------------


def slow_draws(ids, n, seed=42):
    """Each draw's row number in the order of the hashes."""
    md5 = lambda *parts: hashlib.md5(":".join(str(p) for p in parts if p is not None).encode()).hexdigest()
    order = sorted(ids, key=lambda i: (md5(seed, i), i))
    return sorted((d, order[int(md5(f"{seed}:draw", d)[:15], 16) % len(order)]) for d in range(n)) if order else []


@pytest.mark.parametrize("size,n", [(0, 5), (1, 5), (700, 60), (40, 400)])
def test_draws_depend_on_ids_alone(spark, size, n):
    ids = [3 * i for i in range(size)]
    frame = spark.createDataFrame([(i, f"t{i}") for i in ids], "id bigint, t string")
    for parts in (1, 7):
        got = sorted((r.draw_no, r.id) for r in draw_with_replacement(frame.repartition(parts), "id", n).collect())
        assert got == slow_draws(ids, n)


def test_only_buckets_hit_are_sorted(spark, sf_dir):
    plan = QUERIES["sample_with_replacement"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    window = plan.index("row_number()")
    # Below the numbering the rows have met the buckets that a draw falls into.
    assert "LeftSemi" in plan[window:]
