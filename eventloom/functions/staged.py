"""Keep expensive columns from being computed more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def staged(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns in a step of their own, for later steps to refer to."""
    return rows.withColumns(columns)


def sealed(rows: DataFrame, *names: str) -> DataFrame:
    """Fix columns in place: filters on them are not moved below and computed again there.

    The optimizer copies an expression into every filter it pushes down. It does not push
    filters through a generator, and a one-row ``inline`` is the plainest one.
    """
    others = [c for c in rows.columns if c not in names]
    return rows.select(*others, F.inline(F.array(F.struct(*names))))
