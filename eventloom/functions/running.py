"""Running totals per group that stay spread out when one group is huge."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096
_AGGREGATES = {"sum": F.sum, "max": F.max}


def block_of(order_column: str, size: int = BLOCK):
    """Block number for rows ordered by an integer column."""
    return F.floor(F.col(order_column) / F.lit(size)).cast("bigint")


def place_of(keys: list[str], blocks: list[str]):
    """What names a piece of a group: never null, so that joins need no second form of the keys."""
    return F.struct(*keys, *blocks)


def running_before(
    rows: DataFrame,
    keys: list[str],
    blocks: list[str],
    order: list[str],
    totals: dict,
    overall: dict | None = None,
    place: str | None = None,
) -> DataFrame:
    """Add, for each row, aggregates over all earlier rows of its group.

    ``totals`` maps a new column to ``(aggregate, column)`` with aggregate ``sum`` or
    ``max``; ``overall`` does the same for the whole group. ``blocks`` are columns whose
    order agrees with ``order`` and which cut a group into pieces of limited size. Each
    piece is a window partition of its own, and one total per piece is carried over, so
    a group holding a third of all rows is never sorted in one task.

    Window, piece totals and join use one column that names the piece, so the rows themselves
    move once. ``place`` is that column where the rows have it already (``place_of``): rows
    that were arranged by it before then stay where they are.
    """
    overall = overall or {}
    at = place or "_place"
    given = rows if place else rows.withColumn(at, place_of(keys, blocks))
    group = Window.partitionBy(*[f"{at}.{k}" for k in keys])
    piece = Window.partitionBy(at).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = group.orderBy(*[f"{at}.{b}" for b in blocks]).rowsBetween(Window.unboundedPreceding, -1)

    inside = given.select(
        "*", *[_AGGREGATES[kind](column).over(piece).alias(f"_in_{name}") for name, (kind, column) in totals.items()]
    )
    pieces = given.groupBy(at).agg(
        *[_AGGREGATES[kind](column).alias(f"_piece_{name}") for name, (kind, column) in {**totals, **overall}.items()]
    )
    carried = pieces.select(
        at,
        *[_AGGREGATES[kind](f"_piece_{name}").over(earlier).alias(f"_carry_{name}") for name, (kind, _) in totals.items()],
        *[_AGGREGATES[kind](f"_piece_{name}").over(group).alias(name) for name, (kind, _) in overall.items()],
    )

    def combined(name: str, kind: str):
        mine, before = F.col(f"_in_{name}"), F.col(f"_carry_{name}")
        if kind == "sum":
            return F.coalesce(mine, F.lit(0)) + F.coalesce(before, F.lit(0))
        return F.greatest(mine, before)

    return inside.join(carried, at).select(
        *rows.columns, *[combined(name, kind).alias(name) for name, (kind, _) in totals.items()], *overall
    )
