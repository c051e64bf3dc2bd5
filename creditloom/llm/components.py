"""Connected components of a link table, by alternating large and small stars.

Each round is two joins and two groupings over the links; a node with many links is grouped with
partial minima and its rows may be split by the skew join, so no task needs a component. The links of
each round are written to the shared folder. The number of rounds grows with the logarithm of the
number of nodes, squared at worst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours (``a`` > ``b``) are linked to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """From links ``a`` > ``b``: per linked node, ``node`` and ``root``, the smallest node reachable.

    No links give no rows. Repeated links count once.
    """
    links = materialise(links.distinct(), "links")
    before = None
    while True:
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state == before or not state["n"]:
            break
        before = state
        links = materialise(_small_star(_large_star(links)), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
