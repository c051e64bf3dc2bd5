"""Order-dependent columns: previous value, running average, rank, latest row, composition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.scalars import steady_round, total
from creditloom.operators.slices import HOT_ROWS, deal_join, earlier, lookup, range_slices, so_far
from creditloom.vocabulary import COMPOSITION_FLOOR, COMPOSITION_SPAN


def running(
    df: DataFrame, key: str, order: list[str], value: str, averaged: str, digits: int = 4, rows: int | None = None
) -> DataFrame:
    """Add ``previous``, ``change`` (types of ``value``) and ``running_avg`` (double) per key, in order.

    One way for every size: range slices, so a key may hold any share of the rows. The order must name
    every row of a key once. Full copies of a row are interchangeable and may be cut apart as well: the
    partition they are read in comes last in the order. ``rows`` saves counting them, and decides the slices.
    """
    tied = df.withColumn("__tie", F.spark_partition_id())
    order = [*order, "__tie"]
    sliced = range_slices(tied, F.col(key), *[F.col(c) for c in order], rows=rows)

    # What a slice leaves to the next one. A slice continues at most one key of an earlier slice,
    # so ``carried`` has at most one row per slice.
    measured = F.col(averaged).cast("double")
    left = sliced.groupBy(key, "slice").agg(
        F.max_by(value, F.struct(*order)).alias("last"),
        F.sum(measured).alias("sum"),
        F.count(measured).alias("n"),
    )
    carried = left.select(
        key,
        "slice",
        F.lag("slice").over(Window.partitionBy(key).orderBy("slice")).alias("__from"),
        F.lag("last").over(Window.partitionBy(key).orderBy("slice")).alias("__last"),
        F.sum("sum").over(earlier([key], "slice")).alias("__sum"),
        F.sum("n").over(earlier([key], "slice")).alias("__n"),
    ).filter(F.col("__from").isNotNull())

    group = Window.partitionBy("slice", key).orderBy(*order)
    inside = sliced.withColumns(
        {
            "__row": F.row_number().over(group),
            "__prev": F.lag(value).over(group),
            "__run": F.sum(measured).over(so_far(group)),
            "__cnt": F.count(averaged).over(so_far(group)),
        }
    )
    joined = lookup(inside, carried, [key, "slice"], small=True)
    previous = F.when(F.col("__row") == 1, F.col("__last")).otherwise(F.col("__prev"))
    run = F.coalesce("__run", F.lit(0.0)) + F.coalesce("__sum", F.lit(0.0))
    count = F.col("__cnt") + F.coalesce("__n", F.lit(0))
    kind = dict(df.dtypes)[value]
    return joined.select(
        *df.columns,
        previous.cast(kind).alias("previous"),
        (F.col(value) - previous).cast(kind).alias("change"),
        steady_round(run / F.nullif(count, F.lit(0)), digits).alias("running_avg"),
    )


def rank_in_group(
    df: DataFrame, group: str, value: str, name: str, hot_rows: int = HOT_ROWS, stored: DataFrame | None = None
) -> DataFrame:
    """Rank (bigint) by descending value, ties share a rank; NULL values come last.

    Rank = 1 + rows with a larger value, counted over distinct values. Periods are few and large, so
    equal values are counted before anything is sorted, and the distinct values are cut into slices
    across all groups: six groups use as many tasks as there are slices. Where ``df`` is dear to make,
    ``stored`` is a table with the same groups and values, and ``df`` is read once.
    """
    stored = df if stored is None else stored
    counts = stored.groupBy(group, value).agg(F.count("*").alias("__n"))
    sliced = range_slices(counts, F.col(group), F.col(value).desc_nulls_last(), rows=stored.count())
    totals = sliced.groupBy(group, "slice").agg(F.sum("__n").alias("__rows"))
    # A slice continues at most one group of an earlier slice: at most one row per slice.
    shifts = totals.select(
        group, "slice", F.sum("__rows").over(earlier([group], "slice")).alias("__before")
    ).filter(F.col("__before").isNotNull())
    inside = Window.partitionBy("slice", group).orderBy(F.col(value).desc_nulls_last())
    larger = F.sum("__n").over(so_far(inside)) - F.col("__n")
    ranks = lookup(
        sliced.withColumn("__larger", larger), shifts, [group, "slice"], small=True
    ).select(
        group,
        value,
        (F.col("__larger") + F.coalesce("__before", F.lit(0)) + 1).cast("bigint").alias(name),
    )

    # Back to the rows: a value shared by many of them (a capped amount, a zero) is a hot key.
    counts = sliced.select(group, value, F.col("__n").alias("n"))
    return deal_join(df, ranks, [group, value], counts=counts, hot_rows=hot_rows)


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Latest row per key. ``max`` of a struct combines on the map side, a window would not."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__row"))
    return newest.select(
        *[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns]
    )


def composition(df: DataFrame, indicators: list[str], digits: int = 6) -> DataFrame:
    """Share of each indicator in its row after scaling all of them to a common range.

    Adds ``<indicator>_share`` and the running upper bound ``<indicator>_upper`` in list order.
    ``df`` holds one row per period, so a window over all of it is calendar-sized.
    """
    periods = Window.partitionBy(F.lit(1))
    scaled = {}
    for c in indicators:
        low, high = F.min(c).over(periods), F.max(c).over(periods)
        span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
        scaled[f"__{c}"] = COMPOSITION_FLOOR + COMPOSITION_SPAN * (F.col(c) - low) / span
    out = df.withColumns(scaled)
    whole = total([F.col(f"__{c}") for c in indicators])
    shares = {
        f"{c}_share": F.round(F.col(f"__{c}") / F.when(whole == 0, 1.0).otherwise(whole), digits)
        for c in indicators
    }
    uppers = {
        f"{c}_upper": F.round(
            total([F.col(f"__{x}") for x in indicators[: i + 1]])
            / F.when(whole == 0, 1.0).otherwise(whole),
            digits,
        )
        for i, c in enumerate(indicators)
    }
    return out.withColumns({**shares, **uppers}).drop(*scaled)
