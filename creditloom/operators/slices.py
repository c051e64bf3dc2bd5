"""Order-dependent work without putting a whole group, or the whole table, in one task.

A *slice* is a bounded share of the rows. Work inside a slice is an ordinary window; what a slice
needs to know of the slices before it is one row per slice, so it fits a broadcast whatever the
size of the table.

Two ways to cut:

* ``range_slices`` follows a sort order, so one hot key spreads over as many slices as it needs.
  The cut points are sampled, hence the result is written once before it is read twice.
* ``hash_slices`` follows the hash of a unique key: no sampling and nothing written.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.session import materialise

# Rows of a range slice, about: more rows make more slices.
SLICE_ROWS = 1_000_000
# A key is hot if it holds more than one row in HOT_SHARE, and more than HOT_ROWS, which is also what
# one of its parts holds: more rows make more parts.
HOT_SHARE = 1000
HOT_ROWS = 100_000
# Number of hash slices. The numbering (and draws made from it) depends on it, so it does not follow the
# data by itself: give more for a table with over about 4e9 rows, and the same again to repeat numbers.
HASH_SLICES = 4096


def slice_total(df: DataFrame, rows: int | None = None) -> int:
    """Slices for the rows of ``df``, counted if not given; at least as many as a shuffle has partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-(df.count() if rows is None else rows) // SLICE_ROWS))


def lookup(
    left: DataFrame, right: DataFrame, keys: list[str], small: bool, how: str = "left"
) -> DataFrame:
    """Join onto a table with unique ``keys``, NULL included; ``small`` says its size is bounded."""
    twin = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = reduce(and_, [left[k].eqNullSafe(twin[f"__{k}"]) for k in keys])
    joined = left.join(F.broadcast(twin) if small else twin, condition, how)
    return joined.drop(*[f"__{k}" for k in keys])


def deal_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join onto a large table with unique ``keys`` where a few keys may hold most of ``left``.

    Rows of a hot key are dealt over parts and its one row on the right is repeated per part, so no
    task gets more than about ``hot_rows`` of them. A key is hot if it holds more than that and more
    than one row in HOT_SHARE; hence at most HOT_SHARE keys are hot, which bounds the broadcast.
    ``counts`` (keys, ``n``) saves the counting where it is known. NULL keys pair with each other.
    """
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count("*").alias("n"))
    n_rows = counts.agg(F.sum("n").alias("n")).scalar()
    hot = counts.filter(F.col("n") > F.greatest(n_rows / HOT_SHARE, F.lit(hot_rows))).select(
        *keys, F.ceil(F.col("n") / hot_rows).cast("int").alias("__parts")
    )
    # Both sides look up the hot keys: at most HOT_SHARE rows, found once.
    found = hot.collect()
    if not found:
        return lookup(left, right, keys, small=False, how=how)
    hot = left.sparkSession.createDataFrame(found, hot.schema)
    parts = F.coalesce("__parts", F.lit(1))
    # The partition id separates full copies of a row, which share their hash.
    draw = F.xxhash64(*left.columns) + F.spark_partition_id()
    dealt = lookup(left, hot, keys, small=True).withColumn(
        "__part", F.when(parts > 1, F.pmod(draw, parts).cast("int")).otherwise(0)
    )
    repeated = lookup(right, hot, keys, small=True).withColumn(
        "__part", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    return lookup(
        dealt.drop("__parts"), repeated.drop("__parts"), [*keys, "__part"], small=False, how=how
    ).drop("__part")


def range_slices(df: DataFrame, *order: Column, rows: int | None = None) -> DataFrame:
    """Cut ``df`` into slices of the given order and write it, one folder per slice.

    The rows are counted (unless ``rows`` bounds them), sampled for the cut points and sorted apart, so
    ``df`` should be a table, cheap to make, or end in a shuffle, which sampling and sorting share.
    """
    ranged = df.repartitionByRange(slice_total(df, rows), *order)
    return materialise(
        ranged.withColumn("slice", F.spark_partition_id()), "slices", partition_by=["slice"]
    )


def earlier(by: list[str], order: str):
    """Window over all rows of a group (of the whole, if ``by`` is empty) before the current one."""
    return Window.partitionBy(*(by or [F.lit(1)])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def so_far(window):
    """The rows of ``window`` up to the current one."""
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def number_rows(
    df: DataFrame,
    unique_key: list[str],
    name: str,
    within: list[str] | None = None,
    slices: int = HASH_SLICES,
):
    """Dense numbers from 1 (per ``within`` group), the same on every run for the same rows and slices.

    Each slice is numbered on its own and then shifted by the rows in the slices before it. The rows
    are read twice, so they are written first: where ``df`` picks any of several rows, both readings
    see the same pick. The column's metadata holds the number of slices.
    """
    # A struct key keeps NULL groups apart from others and is never NULL itself, so the window, the
    # totals and the join all work on plain equality of the same column.
    slice_no = F.pmod(F.xxhash64(*unique_key), F.lit(slices)).alias("slice")
    sliced = materialise(df, "numbered").withColumn("__key", F.struct(*(within or []), slice_no))
    groups = [f"__key.{g}" for g in within or []] or [F.lit(1)]
    order = Window.partitionBy(*groups).orderBy("__key.slice")
    shifts = (
        sliced.groupBy("__key")
        .agg(F.count("*").alias("__n"))
        .withColumn("__shift", F.sum("__n").over(so_far(order)) - F.col("__n"))
        .drop("__n")
    )
    inside = Window.partitionBy("__key").orderBy(*unique_key)
    number = (F.col("__in_slice") + F.col("__shift")).alias(name, metadata={"hash_slices": slices})
    return (
        sliced.withColumn("__in_slice", F.row_number().over(inside))
        .join(shifts, "__key")
        .select(*[c for c in df.columns if c != name], number)
    )
