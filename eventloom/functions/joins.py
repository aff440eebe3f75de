"""Joins that stay spread out when one key has very many matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_many(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join whose right side may hold a third of its rows under one key.

    Spark can split a skewed right side of an inner join at run time, but not that of a
    left join. So matches come from an inner join, and the rows without match are added
    by an anti join against the distinct keys.
    """
    matched = left.join(right, keys)
    unmatched = left.join(right.select(*keys).distinct(), keys, "left_anti")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name not in keys]
    return matched.unionByName(unmatched.select("*", *empty))
