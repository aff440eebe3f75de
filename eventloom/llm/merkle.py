"""A Merkle manifest of a table: one tree of digests per group of rows, one tree over the groups, a proof for each row.

A row's leaf is the sha256 of its fields. The leaves of a tree stand in the order of its rows; every
``fan_out`` neighbours become the digest of their digests, up to the tree's root, and these
roots likewise become the manifest's. Rows are put in order by ranges, and
numbered by the rows counted before their range, so no tree is sorted in one task. Levels are
made some at a time, from runs of at most ``RUN`` neighbouring digests.

Proofs come by pointer jumping. Each node holds the siblings of one level, a segment towards
its parent. A round joins the nodes with themselves at the end of their segments: the distance doubles,
and the ancestor's segment is put after the node's own. After round r only nodes of levels
that 2^r divides are looked at again, so all rounds but for the leaves' are small. Ancestors far
up belong to very many leaves; they are repeated for each stretch of ``STRETCH`` leaves
below them, so no join key holds more rows than that.

Defined results: a null field counts as ``-`` and differs from all values; null groups are a group of
their own, before all others; null places come first; equal places are ordered by their leaves,
and equal leaves may change places; a tree of one leaf is that leaf; an empty table gives an empty
result; texts of any length are one digest; input columns travel in ``row`` and clash with nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import carried, quoted, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN_OUT = 2
RUN = 1024  # digests that one row of a run gathers at most
STRETCH = 4096  # leaves that share a join key at most


def field(value: Column) -> Column:
    """A value as it enters a leaf: its length in bytes, a colon, its text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    """Digest of a row, as lower-case hex."""
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def _hex(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def folded(given: Column, proof: Column) -> Column:
    """The root that a leaf's digest and its proof lead to."""
    return F.aggregate(proof, given, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])).cast("binary"), 256))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, from the leaf up and from left to right, as one text of hex digests."""
    return F.array_join(F.transform(proof, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "")


_SEGMENT = "array<struct<left: binary, right: binary>>"


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of (tree, place, digest, no, ...) with ``i``, their place among their tree's rows, and ``n``, the tree's rows."""
    # Numbers of ordered partitions ascend; a row's place is its number less that of the tree's first row there.
    ordered = rows.repartitionByRange("tree", "place", "digest", "no").sortWithinPartitions("tree", "place", "digest", "no")
    ordered = written(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33).alias("part")
    counted = ordered.groupBy("tree", part).agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    earlier = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    starts = counted.select(
        "tree",
        "part",
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"),
    )
    joined = ordered.withColumn("part", part).join(starts, ["tree", "part"])
    return joined.withColumn("i", F.col("at") + F.col("shift")).drop("part", "shift", "at")


def _levels(fan_out: int, run: int) -> int:
    """How many levels a run of at most ``run`` digests makes."""
    levels = 1
    while fan_out ** (levels + 1) <= max(run, fan_out):
        levels += 1
    return levels


def _risen(nodes: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """Runs of nodes of one level with all that stands above them within ``levels`` levels.

    Takes (tree, i, n, digest, beside); gives one row per run with ``i`` and ``n`` of its top
    level, its ``nodes`` from bottom to top, each with the digests beside it, and its ``top`` digest. Where
    a tree's root is met before, the levels end there.
    """
    width = fan_out**levels
    runs = nodes.groupBy("tree", F.floor(F.col("i") / width).alias("run"), "n").agg(
        F.collect_list(F.struct("i", "digest", "beside")).alias("found")
    )
    in_order = F.array_sort("found", lambda a, b: (a["i"] - b["i"]).cast("int"))
    runs = runs.select("tree", "run", "n", in_order.alias("members"))
    node = "struct<level: int, i: bigint, left: binary, right: binary>"
    state = f"struct<digests: array<binary>, first: bigint, n: bigint, made: array<{node}>>"

    def joined(digests: Column) -> Column:
        return F.aggregate(digests, F.lit("").cast("binary"), lambda a, d: F.concat(a, d))

    def rise(at: Column, level: Column) -> Column:
        digests, many = at["digests"], F.size(at["digests"])

        def mine(_, k: Column) -> Column:
            start = k - k % fan_out
            return F.struct(
                (level - 1).cast("int").alias("level"),
                (at["first"] + k).alias("i"),
                joined(F.slice(digests, start + 1, k - start)).alias("left"),
                joined(F.slice(digests, k + 2, start + fan_out - k - 1)).alias("right"),
            )

        def parent(k: Column) -> Column:
            return F.unhex(F.sha2(_hex(joined(F.slice(digests, k * fan_out + 1, fan_out))).cast("binary"), 256))

        higher = F.struct(
            F.transform(F.sequence(F.lit(0), F.floor((many - 1) / fan_out).cast("int")), parent).alias("digests"),
            F.floor(at["first"] / fan_out).alias("first"),
            F.ceil(at["n"] / fan_out).alias("n"),
            F.concat(at["made"], F.transform(digests, mine)).alias("made"),
        )
        return F.when(at["n"] > 1, higher).otherwise(at)

    begin = F.struct(
        F.transform("members", lambda m: m["digest"]).alias("digests"),
        (F.col("run") * width).alias("first"),
        F.col("n"),
        F.array().cast(f"array<{node}>").alias("made"),
    ).cast(state)
    risen = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), begin, lambda at, level: rise(at, level).cast(state))
    done = runs.select("tree", "members", risen.alias("at"))
    return done.select(
        "tree",
        "members",
        F.col("at.made").alias("nodes"),
        F.get("at.digests", F.lit(0)).alias("top"),
        F.col("at.first").alias("i"),
        F.col("at.n").alias("n"),
    )


def _forest(leaves: DataFrame, fan_out: int, run: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From leaves (tree, i, n, digest, beside): the leaves and the inner nodes with the segment of their own level, and the roots."""
    levels, base = _levels(fan_out, run), 0
    bottom, inner, roots, nodes = None, [], [], leaves
    while bottom is None or not nodes.isEmpty():
        runs = written(_risen(nodes, fan_out, levels), "runs")
        if bottom is None:
            # A lone leaf makes no node: its segment is empty.
            mine = lambda k: F.filter(F.array(F.get("nodes", k)), lambda s: s.isNotNull())  # noqa: E731, B023
            found = F.transform(
                "members",
                lambda m, k: F.struct(
                    m["i"].alias("i"),
                    m["digest"].alias("digest"),
                    m["beside"].alias("beside"),
                    F.transform(mine(k), lambda s: F.struct(s["left"].alias("left"), s["right"].alias("right"))).alias("segment"),
                ),
            )
            bottom = runs.select("tree", F.lit(0).alias("level"), F.inline(found))
        made = runs.select("tree", F.explode("nodes").alias("node"))
        inner.append(
            made.select(
                "tree", (F.col("node.level") + base).alias("level"), "node.i", F.array(F.struct("node.left", "node.right")).alias("segment")
            ).where("level > 0")
        )
        roots.append(runs.where("n = 1").select("tree", F.col("top").alias("digest")))
        nodes = runs.where("n > 1").select("tree", "i", "n", F.col("top").alias("digest"), F.lit(0).alias("beside"))
        base += levels
    return bottom, written(reduce(DataFrame.unionByName, inner), "nodes"), written(reduce(DataFrame.unionByName, roots), "roots")


def _doubled(below: DataFrame, nodes: DataFrame, distance: int, fan_out: int, stretch: int) -> DataFrame:
    """Nodes with the segment of the node ``distance`` levels above put after their own, if there is one."""
    reach = fan_out**distance
    repeats = max(1, reach // stretch)
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(repeats - 1).cast("bigint")))
    above = nodes.select(
        "tree", (F.col("level") - distance).alias("level"), F.col("i").alias("top"), F.col("segment").alias("more"), each.alias("part")
    )
    if reach % repeats == 0:
        key = F.floor(F.col("i") / (reach // repeats))
        above = above.withColumn("key", F.col("top") * repeats + F.col("part"))
    else:
        key = F.struct(F.floor(F.col("i") / reach).alias("top"), (F.col("i") % repeats).alias("part"))
        above = above.withColumn("key", F.struct("top", "part"))
    return (
        below.withColumn("key", key)
        .join(above.drop("top", "part"), ["tree", "level", "key"], "left")
        .withColumn("segment", F.concat("segment", F.coalesce("more", F.array().cast(_SEGMENT))))
        .drop("key", "more")
    )


def _proofs(bottom: DataFrame, inner: DataFrame, fan_out: int, stretch: int) -> DataFrame:
    """Leaves with their segment up to the root of their tree."""
    height, distance = (inner.agg(F.max("level")).first()[0] or 0) + 1, 1
    while distance < height:
        bottom = _doubled(bottom, inner.where(F.col("level") == distance), distance, fan_out, stretch)
        if 2 * distance < height:
            going = inner.where(F.col("level") % (2 * distance) == 0)
            inner = written(_doubled(going, inner.where(F.col("level") % distance == 0), distance, fan_out, stretch), "nodes")
        distance *= 2
    return bottom


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    place: str = "doc_id",
    claim: Column | None = None,
    keep: Sequence[str] = ("doc_id",),
    fan_out: int = FAN_OUT,
    run: int = RUN,
    stretch: int = STRETCH,
) -> DataFrame:
    """Each row's ``leaf``, its group's ``subroot``, the ``root`` of all and its ``proof``, an entry for each level.

    ``claim`` is a leaf that someone else holds for the row; with it come ``folded_root``, where claim
    and proof lead, and ``verified``. The columns of ``keep`` come along in ``row``: up to ``run``
    rows of them are gathered, so no texts.
    """
    mine = leaf([F.col(quoted(c)) for c in fields])
    of = F.col(quoted(group)).cast("string")
    rows = carried(
        docs,
        keep,
        tree=F.struct(of.isNotNull().alias("given"), F.coalesce(of, F.lit("")).alias("name")),
        place=F.col(quoted(place)),
        digest=F.unhex(mine),
        claim=F.unhex(mine if claim is None else claim),
    )
    rows = written(rows.withColumn("no", F.monotonically_increasing_id()), "leaves")
    numbered = _numbered(rows).select("tree", "i", "n", "digest", F.struct("claim", "row").alias("beside"))
    bottom, inner, roots = _forest(numbered, fan_out, run)
    proved = _proofs(bottom, inner, fan_out, stretch)

    groups = roots.select(F.lit(0).alias("tree"), F.col("tree").alias("place"), "digest", F.monotonically_increasing_id().alias("no"))
    groups = _numbered(groups).select("tree", "i", "n", "digest", F.struct(F.col("place").alias("of")).alias("beside"))
    top, over, whole = _forest(groups, fan_out, run)
    above = _proofs(top, over, fan_out, stretch).select(
        F.col("beside.of").alias("tree"), F.col("digest").alias("subroot"), F.col("segment").alias("more")
    )
    root = whole.select(_hex(F.col("digest"))).first()
    joined = proved.join(written(above, "groups"), "tree").select(
        F.col("beside.row").alias("row"),
        _hex(F.col("digest")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"),
        F.concat("segment", "more").alias("proof"),
        _hex(F.col("beside.claim")).alias("claim"),
    )
    if claim is None:
        return joined.drop("claim")
    checked = joined.withColumn("folded_root", folded(F.col("claim"), F.col("proof"))).drop("claim")
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))
