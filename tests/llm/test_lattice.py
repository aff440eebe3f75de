from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import lattice
from eventloom.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def slow_groups(rows, threshold=0.98):
    """Links, smallest reachable id of each vector, by all pairs."""
    usable = {}
    for i, (_, v, label) in enumerate(rows):
        if v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64)
            usable[i] = x / np.linalg.norm(x)
    links = {i: set() for i in range(len(rows))}
    for i, j in itertools.combinations(usable, 2):
        if rows[i][2] == rows[j][2] and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= threshold:
            links[i].add(j)
            links[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen), default=None) if rows[i][0] is not None else None
        out.append((rows[i][0], len(links[i]), least))
    return out


def test_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 8)) * 1.5
    point = lattice.decode_e8(x)
    doubled = np.rint(2 * point)
    assert np.allclose(doubled, 2 * point) and ((doubled % 2).min(1) == (doubled % 2).max(1)).all()
    assert (np.abs(point.sum(1)) % 2 == 0).all()
    steps = lattice.minimal_vectors()
    assert len(np.unique(steps, axis=0)) == 240 and np.allclose((steps**2).sum(1), 2)
    gap = ((x - point) ** 2).sum(1)
    assert (gap <= 1 + 1e-9).all()
    assert ((((x - point)[:, None, :] - steps) ** 2).sum(2) >= gap[:, None] - 1e-9).all()


@pytest.fixture(scope="module")
def near():
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for label in range(3):
        for size in (1, 2, 5, 60):
            for _ in range(10):
                center = rng.standard_normal(64)
                for _ in range(size):
                    noise = rng.standard_normal(64) * rng.uniform(0.02, 0.13)
                    rows.append((n, [float(np.float32(x)) for x in (center + noise) * rng.uniform(0.5, 3)], label))
                    n += 1
    return rows


def test_recall_against_all_pairs(spark, near):
    got = {r.vec_id: r for r in lattice.groups(spark.createDataFrame(near, SCHEMA)).collect()}
    want = slow_groups(near)
    assert all(got[i].n_links <= n for i, n, _ in want)
    links = sum(n for _, n, _ in want)
    assert links > 10_000 and sum(r.n_links for r in got.values()) >= 0.99 * links
    assert sum(got[i].component_id != c for i, _, c in want) <= 0.01 * len(want)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_query_equals_all_pairs(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {(r.vec_id, r.n_links, r.component_id) for r in QUERIES["op10_lattice_groups"](spark, sf_dir).collect()}
    assert got == set(slow_groups(rows))


def test_edges(spark):
    one = [1.0] * 8 + [0.5] * 4
    rows = [
        (0, one, 1), (1, one, 1), (2, one, 2), (3, one, None), (4, None, 1), (5, [0.0] * 12, 1), (6, [float("nan")] + one[1:], 1),
        (7, [None] + one[1:], 1), (8, [float("inf")] + one[1:], 1), (9, [x * 1e30 for x in one], 1), (10, one + [0.0], 1), (11, [], 1),
        (12, [-x for x in one], 1), (12, one, 1), (13, [2.0], 1), (14, [5.0], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("point", F.lit("clash")).withColumn("usable", F.lit(0))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in lattice.groups(frame).collect())
    assert got == sorted(slow_groups(rows))
    assert lattice.groups(frame.limit(0)).count() == 0
