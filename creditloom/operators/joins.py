"""Joins of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dimension_join(
    fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "left", bounded: bool = False
) -> DataFrame:
    """Join a fact onto a dimension with unique keys.

    A dimension of bounded size (a calendar) is broadcast, so few hot keys do not decide how many tasks
    work. Any other is left to adaptive execution, which broadcasts by the bytes it has measured and
    splits the fact's hot keys where it joins by key. A NULL key in the fact finds nothing.
    """
    return fact.join(F.broadcast(dim) if bounded else dim, keys, how)


def orphan_rows(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """(violations): fact rows whose non-NULL key is missing in the dimension, and NULL keys.

    The fact is counted per key first; the join then sees one row per key, hot or not. It is an
    outer join, since the optimizer would move an anti join back below the counting.
    """
    per_key = fact.groupBy(key).agg(F.count("*").alias("n"))
    known = dim.select(key, F.lit(True).alias("__known"))
    missing = per_key.join(known, key, "left").filter(F.col("__known").isNull())
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
