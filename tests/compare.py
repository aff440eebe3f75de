"""Run queries and their SQL counterparts side by side and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def normal(value):
    """Numbers of either engine as one type, doubles to nine digits."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def difference(spark_frame, connection, sql: str) -> str | None:
    """None when columns and rows agree, otherwise a short report."""
    mine = rows_of(spark_frame.columns, spark_frame.collect())
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(spark_frame.columns) != sorted(names):
        return f"columns {sorted(spark_frame.columns)} and {sorted(names)}"
    if mine == theirs:
        return None
    extra = [r for r in mine if r not in set(theirs)][:2] if len(mine) < 20000 else mine[:1]
    missing = [r for r in theirs if r not in set(mine)][:2] if len(mine) < 20000 else theirs[:1]
    return f"{len(mine)} and {len(theirs)} rows; only here {str(extra)[:700]}; only there {str(missing)[:700]}"


if __name__ == "__main__":
    from eventloom.plans.oracle import ORACLE
    from eventloom.plans.queries import QUERIES
    from eventloom.session import build_session

    sf = sys.argv[1]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    duck = connect(sf)
    for key in sys.argv[2:] or QUERIES:
        started = time.time()
        try:
            report = difference(QUERIES[key](spark, sf), duck, ORACLE[key]) if key in ORACLE else "no SQL"
        except Exception as error:  # noqa: BLE001
            report = f"FAILED {str(error)[:900]}"
        print(f"{key:26s} {time.time() - started:6.2f}s {'ok' if report is None else report}", flush=True)
