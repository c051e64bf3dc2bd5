"""Compare two large tables by order-free checksums per bucket, and cell by cell where they differ.

Rows fall into buckets by a hash of their key. A bucket's checksum is a sum and an exclusive-or of row
hashes, so it doesn't depend on order, partitions or the engine's plan, and repeated rows count. Buckets are
the leaves of a small tree whose nodes add up their children; two trees are compared from the root down.
A tree is a table of a few thousand rows: it can be stored with the data, and an equal copy is
recognised without reading either table again. Only rows of differing buckets are then brought together, and
never by a join: equal rows of both sides cancel out in one aggregate, so a key that occurs often is combined
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves of a tree, and children of a node.
BUCKETS = 4096
FAN = 64
FRACTIONS = ("float", "double")


def _plain(df: DataFrame, columns: list[str], digits: int | None) -> dict[str, Column]:
    """The cells as they are compared: fractions rounded, without a sign on zero."""
    kinds = dict(df.dtypes)

    def cell(c: str) -> Column:
        if kinds[c] not in FRACTIONS:
            return F.col(c)
        value = F.col(c).cast("double")
        return (value if digits is None else F.round(value, digits)) + F.lit(0.0)

    return {c: cell(c) for c in columns}


def row_hash(cells: list[Column], *salt: Column) -> Column:
    """The same for cells that are the same, NULL being the same as NULL and NaN as NaN.

    A NULL leaves a hash as it is, so whether a cell is there is hashed as well.
    """
    return F.xxhash64(*salt, *[part for c in cells for part in (c.isNull(), c)])


def _bucket(df: DataFrame, key: list[str], buckets: int) -> Column:
    return F.pmod(row_hash([F.col(k) for k in key]), F.lit(buckets)).cast("int")


def tree(
    df: DataFrame, key: list[str], columns: list[str], digits: int | None = 6, buckets: int = BUCKETS, fan: int = FAN
) -> DataFrame:
    """(level, node, rows, total, mix): level 0 holds the root, the last level a row per bucket with rows.

    One scan; a row per bucket is left of each task.
    """
    cells = _plain(df, [*key, *columns], digits)
    leaves = (
        df.select(_bucket(df, key, buckets).alias("node"), row_hash(list(cells.values())).alias("h"))
        .groupBy("node")
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.col("h").cast("decimal(38,0)")).alias("total"),
            F.bit_xor(F.xxhash64("h")).alias("mix"),
        )
    )
    depth, width = 0, 1
    while width < buckets:
        depth, width = depth + 1, width * fan
    above = F.array(*[F.struct(F.lit(d).alias("level"), F.lit(fan ** (depth - d)).alias("per")) for d in range(depth + 1)])
    return (
        leaves.select("*", F.explode(above).alias("at"))
        .groupBy(F.col("at.level").alias("level"), F.floor(F.col("node") / F.col("at.per")).cast("int").alias("node"))
        .agg(F.sum("rows").alias("rows"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mix").alias("mix"))
    )


def differing_buckets(a: DataFrame, b: DataFrame, fan: int = FAN) -> list[int]:
    """Buckets whose checksums differ between two trees of the same key, columns and sizes.

    Goes down from the root and looks at children of differing nodes only; at most all buckets are listed.
    """
    depth = max((t.agg(F.max("level")).first()[0] or 0) for t in (a, b))
    nodes = [0]
    for level in range(depth + 1):
        here = (F.col("level") == level) & F.col("node").isin(nodes)
        left, right = (t.filter(here).select("node", F.struct("rows", "total", "mix").alias(n)) for t, n in ((a, "a"), (b, "b")))
        joined = left.join(right, "node", "full_outer")
        found = [r["node"] for r in joined.filter(~F.col("a").eqNullSafe(F.col("b"))).select("node").collect()]
        if not found:
            return []
        nodes = sorted(found) if level == depth else [n * fan + c for n in found for c in range(fan)]
    return nodes


def _in_buckets(df: DataFrame, key: list[str], found: list[int], buckets: int) -> DataFrame:
    return df.filter(_bucket(df, key, buckets).isin(found))


def unmatched_rows(
    a: DataFrame, b: DataFrame, key: list[str], columns: list[str], digits: int | None = 6
) -> DataFrame:
    """Rows that one side has more often: key, columns, ``more_in_a`` and ``more_in_b``."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        cells = _plain(df, [*key, *columns], digits)
        return df.select(*[c.alias(n) for n, c in cells.items()], F.lit(sign).cast("long").alias("__sign"))

    net = side(a, 1).unionByName(side(b, -1)).groupBy(*key, *columns).agg(F.sum("__sign").alias("__net"))
    return net.filter("__net <> 0").select(
        *key,
        *columns,
        F.greatest("__net", F.lit(0)).alias("more_in_a"),
        F.greatest(-F.col("__net"), F.lit(0)).alias("more_in_b"),
    )


def differing_cells(
    a: DataFrame,
    b: DataFrame,
    key: list[str],
    columns: list[str],
    digits: int | None = 6,
    trees: tuple[DataFrame, DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(key, column, value_a, value_b) of every cell that differs, values as text.

    Where a key has one unmatched row on either side these are compared cell by cell. Any other key has one
    row with ``column`` NULL and the numbers of unmatched rows as values. ``trees`` are stored ones, if there
    are; tables with equal trees aren't read.
    """
    trees = trees or tuple(tree(t, key, columns, digits, buckets) for t in (a, b))
    found = differing_buckets(*trees)
    a, b = (_in_buckets(t, key, found, buckets) for t in (a, b))
    rows = unmatched_rows(a, b, key, columns, digits)
    parts = [F.sum("more_in_a").alias("__a"), F.sum("more_in_b").alias("__b")]
    for c in columns:
        for side in "ab":
            # one row at most is meant where these are used
            parts.append(F.max(F.when(F.col(f"more_in_{side}") > 0, F.col(c).cast("string"))).alias(f"__{side}_{c}"))
    per_key = rows.groupBy(*key).agg(*parts)
    one = (F.col("__a") == 1) & (F.col("__b") == 1)
    whole = F.struct(
        F.lit(None).cast("string").alias("column"),
        F.col("__a").cast("string").alias("value_a"),
        F.col("__b").cast("string").alias("value_b"),
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"__a_{c}").alias("value_a"), F.col(f"__b_{c}").alias("value_b"))
            for c in columns
        ]
    )
    apart = F.filter(cells, lambda c: ~c["value_a"].eqNullSafe(c["value_b"]))
    return per_key.select(*key, F.inline(F.when(one, apart).otherwise(F.array(whole))))
