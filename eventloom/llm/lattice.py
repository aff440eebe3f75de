"""Near-duplicate vectors by lattice hashing.

A vector is scaled to length one and projected, in each of several tables, onto two random
eight-dimensional subspaces. Each projection is decoded to the nearest point of the E8 lattice;
the two points name a cell. Near vectors fall into the same or into neighbouring cells,
so each vector also looks into the neighbouring cells it lies closest to. Pairs that
meet are checked by their cosine in double precision.

Only vectors with equal, non-null labels and equal dimension are compared. Equal vectors
are first folded into one with a count, so copies cost nothing in the search. Cells have no
cap; a join on a crowded cell is one that Spark can split.

Defined results: a null label, or a vector that is null, zero, or has null or non-finite
components, links with nothing and is its own component; repeated ids are vectors of their own that
share the id; equal vectors link at any place in the order; vectors of unlike lengths do not link;
an empty table gives an empty result; other input columns are not read, so none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import carried, components, written


@dataclass(frozen=True)
class Lattice:
    """Settings of the search. More tables and probes find more; a smaller scale compares less."""

    tables: int = 4
    probes: int = 3
    scale: float = 0.25
    seed: int = 11


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to the neighbouring cells."""
    integral = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            integral.append(v)
    halves = [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(integral + halves)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integral coordinates of even sum."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(1) % 2)
    worst = np.abs(x[odd] - point[odd]).argmax(1)
    gap = x[odd, worst] - point[odd, worst]
    point[odd, worst] += np.where(gap >= 0, 1.0, -1.0)
    return point


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest lattice points: E8 is D8 and D8 moved by one half in every coordinate."""
    whole, moved = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - moved) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return np.where(nearer[:, None], moved, whole)


def _subspaces(dimension: int, s: Lattice) -> np.ndarray:
    """Orthonormal projections, (tables, 2, 8, dimension), or of random directions where the space is too small."""
    random = np.random.default_rng([s.seed, dimension])
    drawn = random.standard_normal((s.tables, max(dimension, 16), 16))
    bases = np.linalg.qr(drawn)[0][:, :dimension, :] * np.sqrt(dimension / 8)
    return bases.transpose(0, 2, 1).reshape(s.tables, 2, 8, dimension)


_MIX = np.random.default_rng(5).integers(1, 1 << 62, 17, dtype=np.int64) * 2 + 1


def cells(vectors: np.ndarray, s: Lattice) -> np.ndarray:
    """Cell numbers (vectors, tables, 1 + probes): the own cell first, then the nearest others.

    The projections are scaled so that distances keep their size on average.
    """
    steps, n = minimal_vectors(), len(vectors)
    out = np.empty((n, s.tables, 1 + s.probes), np.int64)
    k = min(s.probes, 12)
    for t, pair in enumerate(_subspaces(vectors.shape[1], s)):
        points, keys, costs = [], [], []
        for half, basis in enumerate(pair):
            x = vectors @ basis.T / (s.scale * np.sqrt(8))
            own = decode_e8(x)
            weights = _MIX[8 * half : 8 * half + 8]
            with np.errstate(over="ignore"):
                own_key = (2 * own).astype(np.int64) @ weights
                step_key = (2 * steps).astype(np.int64) @ weights
                # |x - own - step|^2 exceeds |x - own|^2 by 2 - 2 (x - own) . step
                extra = 2.0 - 2.0 * (x - own) @ steps.T
                near = np.argpartition(extra, k - 1, axis=1)[:, :k]
                points.append(own_key)
                keys.append(own_key[:, None] + np.concatenate([np.zeros((n, 1), np.int64), step_key[near]], 1))
                costs.append(np.concatenate([np.zeros((n, 1)), np.take_along_axis(extra, near, 1)], 1))
        both = (costs[0][:, :, None] + costs[1][:, None, :]).reshape(n, -1)
        with np.errstate(over="ignore"):
            joint = (keys[0][:, :, None] * _MIX[16] ^ keys[1][:, None, :]).reshape(n, -1)
        both[:, 0] = -1.0  # the own cell stays first
        best = np.argsort(both, axis=1)[:, : 1 + s.probes]
        out[:, t] = np.take_along_axis(joint, best, 1)
    return out


def _cells_of(s: Lattice) -> Column:
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            found = [None] * len(vectors)
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            for rows in by_size.values():
                for at in range(0, len(rows), 2000):
                    some = rows[at : at + 2000]
                    x = np.array([vectors.iloc[i] for i in some], dtype=np.float64)
                    x /= np.abs(x).max(1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    for i, c in zip(some, cells(x, s).reshape(len(some), -1)):
                        found[i] = c
            yield pd.Series(found)

    return compute


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    x, y = a / np.abs(a).max(), b / np.abs(b).max()
    return float(np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)))


@F.pandas_udf(T.DoubleType())
def _cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([cosine(x, y) for x, y in zip(a, b)], dtype="float64")


def _usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def pairs(points: DataFrame, threshold: float, s: Lattice) -> DataFrame:
    """Linked pairs ``a`` < ``b`` of a written table of distinct vectors (point, label, vector)."""
    found = points.select("point", "label", F.size("vector").alias("size"), _cells_of(s)("vector").alias("cells"))
    found = written(found, "cells")
    width = 1 + s.probes
    looked = found.select("point", "label", "size", F.posexplode("cells").alias("at", "cell"))
    looked = looked.select("point", "label", "size", "cell", F.floor(F.col("at") / width).alias("table"), (F.col("at") % width == 0).alias("own"))
    where = ["label", "size", "table", "cell"]
    visitors = looked.select(*where, F.col("point").alias("p"), F.col("own").alias("p_own"))
    residents = looked.where("own").select(*where, F.col("point").alias("q"))
    met = (
        visitors.join(residents, where)
        .where("p <> q AND (NOT p_own OR p < q)")
        .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
        .distinct()
    )
    vectors = points.select("point", F.col("vector").cast("array<double>").alias("vector"))
    with_a = met.join(vectors.select(F.col("point").alias("a"), F.col("vector").alias("x")), "a")
    with_b = with_a.join(vectors.select(F.col("point").alias("b"), F.col("vector").alias("y")), "b")
    return with_b.select("a", "b", _cosine("x", "y").alias("cosine")).where(F.col("cosine") >= threshold).select("a", "b")


def groups(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.98,
    settings: Lattice = Lattice(),
) -> DataFrame:
    """One row per vector: its id, ``n_links``, ``component_id`` and ``kept``."""
    named = carried(rows, [], vec_id=vec_id, vector=vector, label=label)
    named = named.select("vec_id", "label", "vector", _usable(F.col("vector"), F.col("label")).alias("usable"))
    alike = (
        named.where("usable")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"))
        .withColumn("point", F.monotonically_increasing_id())
    )
    points = written(alike, "points")
    linked = written(pairs(points, threshold, settings), "pairs")
    ends = linked.select(F.col("a").alias("point"), F.col("b").alias("other")).unionByName(
        linked.select(F.col("b").alias("point"), F.col("a").alias("other"))
    )
    counts = points.select(F.col("point").alias("other"), "n")
    beside = ends.join(counts, "other").groupBy("point").agg(F.sum("n").alias("beside"))
    member = written(components(points.select("point"), linked, node="point"), "members")
    least = member.join(points, "point").groupBy("component").agg(F.min("least").alias("component_id"))
    told = (
        points.join(beside, "point", "left")
        .join(member.join(least, "component").select("point", "component_id"), "point")
        .select("label", "vector", (F.col("n") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"), "component_id")
    )
    linked_rows = named.where("usable").join(told, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = named.where(~F.col("usable")).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked_rows.unionByName(alone)
    return both.select(F.col("vec_id").alias(vec_id), "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
