"""Merkle manifests against a slow version that builds each tree in memory."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from eventloom.llm import merkle
from eventloom.llm.queries import QUERIES

FIELDS = merkle.FIELDS


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def slow_leaf(row: dict, fields=FIELDS) -> str:
    shown = ["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in fields]
    return digest("".join(shown))


def climb(level: list[str], k: int, fan_out: int) -> tuple[str, list[tuple[str, str]]]:
    """The root of a level, and what stands left and right on the way up from its k-th node."""
    beside = []
    while len(level) > 1:
        start = k - k % fan_out
        beside.append(("".join(level[start:k]), "".join(level[k + 1 : start + fan_out])))
        level = [digest("".join(level[i : i + fan_out])) for i in range(0, len(level), fan_out)]
        k //= fan_out
    return level[0], beside


def slow_manifest(rows: list[dict], fan_out: int = 2) -> dict[int, tuple]:
    groups: dict = {}
    for no, row in enumerate(rows):
        groups.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, slow_leaf(row), no))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for members in groups.values():
        members.sort()
    roots = [climb([m[2] for m in groups[g]], 0, fan_out)[0] for g in order]
    out = {}
    for at, g in enumerate(order):
        root, above = climb(roots, at, fan_out)
        for k, member in enumerate(groups[g]):
            proof = climb([m[2] for m in groups[g]], k, fan_out)[1] + above
            out[member[3]] = (member[2], roots[at], root, proof)
    return out


def fold(leaf: str, proof) -> str:
    for left, right in proof:
        leaf = digest(left + leaf + right)
    return leaf


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")


def found(frame):
    proof = F.transform("proof", lambda s: F.struct(F.lower(F.hex(s["left"])), F.lower(F.hex(s["right"]))))
    return sorted((r[0], r[1], r[2], r[3], [tuple(x) for x in r[4]]) for r in frame.select("row.doc_id", "leaf", "subroot", "root", proof).collect())


@pytest.mark.parametrize(
    "fan_out,run,stretch,sizes",
    [
        (2, 1024, 4096, (1,)),
        (2, 2, 1, (7, 1, 16, 33, 5)),
        (2, 4, 2, (70, 1)),
        (3, 9, 2, (7, 1, 16, 33, 5)),
        (5, 5, 4, (70, 2)),
        (16, 16, 4096, (7, 40)),
    ],
)
def test_any_fan_out_and_height(spark, fan_out, run, stretch, sizes):
    rows = [
        {"doc_id": 1000 * g + (i * 37) % 101, "source": "s", "lang": f"l{g}", "n_chars": i, "text": "é" * i} for g, n in enumerate(sizes) for i in range(n)
    ]
    made = merkle.manifest(table(spark, rows), fan_out=fan_out, run=run, stretch=stretch)
    slow = slow_manifest(rows, fan_out)
    assert found(made) == sorted((rows[no]["doc_id"], *s) for no, s in slow.items())


def test_nulls_ties_and_clashing_names(spark):
    rows = [
        (None, "a", None, 1, "x", "r"),
        (3, None, "", None, None, "r"),
        (3, None, "", None, None, "r"),
        (4, "b", "", 2, "", "q"),
        (5, "b", "é", 2, "y" * 100_000, None),
        (6, "b", "z", 2, "y", None),
        (None, "a", None, 1, "x", "r"),
        (2, "a", None, 1, "x", "r"),
    ]
    dicts = [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows]
    given = spark.createDataFrame(
        [(*r, "t", "u") for r in rows],
        "doc_id bigint, source string, lang string, n_chars bigint, text string, `row` string, tree string, `a b.c``d` string",
    )
    made = merkle.manifest(given, keep=given.columns).select("row.*", "leaf", "subroot", "root")
    slow = slow_manifest(dicts)
    assert made.columns[:8] == given.columns
    mine = sorted((r["leaf"], r["subroot"], r["root"], r["doc_id"] or 0) for r in made.collect())
    assert mine == sorted((*s[:3], dicts[no]["doc_id"] or 0) for no, s in slow.items())


def test_empty_table(spark):
    made = merkle.manifest(table(spark, []), claim=F.lit("00"))
    assert made.count() == 0
    assert made.columns == ["row", "leaf", "subroot", "root", "proof", "folded_root", "verified"]


def test_query_equals_slow_version(spark, sf_dir, documents):
    slow = slow_manifest(documents)
    mine = {r.doc_id: r for r in QUERIES["op11_merkle_manifest"](spark, sf_dir).collect()}
    assert len(mine) == len(documents)
    for no, row in enumerate(documents):
        leaf, subroot, root, proof = slow[no]
        tampered = zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None
        claim = slow_leaf({**row, "n_chars": row["n_chars"] + 1}) if tampered else leaf
        got = mine[row["doc_id"]]
        assert (got.leaf, got.subroot, got.root) == (leaf, subroot, root)
        assert got.proof_sha256 == digest("".join(a + b for a, b in proof))
        assert got.folded_root == fold(claim, proof)
        assert got.verified == (not tampered)


def test_any_change_is_seen(spark):
    rows = [{"doc_id": i, "source": "s", "lang": "l", "n_chars": 1, "text": "t"} for i in range(9)]
    given = table(spark, rows)
    for column, value in (("text", F.lit("u")), ("text", F.lit(None).cast("string")), ("source", F.lit("")), ("n_chars", F.lit(None).cast("bigint"))):
        changed = merkle.leaf([value if c == column else F.col(c) for c in FIELDS])
        assert merkle.manifest(given, claim=changed).where("verified").count() == 0
    assert merkle.manifest(given, claim=merkle.leaf([F.col(c) for c in FIELDS])).where("verified").count() == 9
