"""Cleaning steps: de-duplication, filling, fences, scores and scaling.

Statistics that a column needs of its whole table come in as one scalar subquery: a single
aggregate, no collect and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.scalars import clamp, steady_round
from creditloom.operators.quantiles import exact_quantiles, sketch_quantiles
from creditloom.session import materialise

NUMERIC = {"int", "bigint", "double", "float"}
STATS = "__stats"


def with_stats(df: DataFrame, source: DataFrame, parts: list[Column]) -> DataFrame:
    """Add the aggregates of ``source`` as one struct column, computed once.

    A column of its own keeps the optimizer from repeating the subquery in every expression that
    reads a field of it.
    """
    return df.withColumn(STATS, source.agg(F.struct(*parts).alias("s")).scalar())


def stat(name: str) -> Column:
    return F.col(STATS)[name]


def numeric_columns(df: DataFrame, excluding: tuple[str, ...] = ()) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC and c not in excluding]


# --- duplicates ------------------------------------------------------------------------------


def dedup(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, whichever Spark meets first; unused columns can still be pruned."""
    return df.dropDuplicates(keys)


def dedup_ordered(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, always the smallest in column order.

    ``min`` of a struct combines on the map side, so a key held by a third of the rows reaches the
    shuffle as one row per task; a ``row_number`` window would sort all its copies in one place.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row"))
    return best.select(
        *[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns]
    )


def dedup_stats(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after de-duplication without writing the de-duplicated table."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(
        F.sum("n").alias("rows_before"),
        F.count("*").alias("rows_after"),
        (F.sum("n") - F.count("*")).alias("removed"),
    )


# --- missing values ---------------------------------------------------------------------------


def fill_numeric(df: DataFrame, value=0, keep_null: tuple[str, ...] = ()) -> DataFrame:
    """Fill NULL in every numeric column except the named ones."""
    return df.fillna(value, subset=numeric_columns(df, keep_null))


def mean_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill NULL with the column mean; a column without any value stays NULL."""
    measured = with_stats(df, df, [F.avg(c).alias(c) for c in columns])
    filled = {c: F.coalesce(F.col(c).cast("double"), stat(c)) for c in columns}
    return measured.withColumns(filled).drop(STATS)


# --- outliers ----------------------------------------------------------------------------------


def iqr_fences(
    df: DataFrame, columns: list[str], width: float = 1.5, error: float | None = None
) -> DataFrame:
    """(name, q1, q3, low, high) of each column; exact unless a rank ``error`` is allowed."""
    probs = [0.25, 0.75]
    if error is None:
        quantiles = exact_quantiles(df, columns, probs)
    else:
        quantiles = sketch_quantiles(df, columns, probs, error)
    at = {p: F.max(F.when(F.col("prob") == p, F.col("quantile"))) for p in probs}
    spread = (F.col("q3") - F.col("q1")) * width
    return (
        quantiles.groupBy("name")
        .agg(at[0.25].alias("q1"), at[0.75].alias("q3"))
        .withColumns({"low": F.col("q1") - spread, "high": F.col("q3") + spread})
    )


def iqr_cap(
    df: DataFrame, columns: list[str], width: float = 1.5, error: float | None = None
) -> DataFrame:
    """Pull values beyond the fences of their column in to the fence; NULL stays NULL.

    ``df`` is read for the fences and for the rows, and should be a table.
    """
    columns = [c for c in columns if c in df.columns]
    fences = materialise(iqr_fences(df, columns, width, error), "fences")  # a row per column
    picks = [
        F.max(F.when(F.col("name") == c, F.col(side))).alias(f"{c}_{side}")
        for c in columns
        for side in ("low", "high")
    ]
    capped = {
        c: clamp(F.col(c).cast("double"), stat(f"{c}_low"), stat(f"{c}_high")) for c in columns
    }
    return with_stats(df, fences, picks).withColumns(capped).drop(STATS)


def clamp_column(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.withColumn(column, clamp(F.col(column), low, high))


def zscore_of(value: Column, mean: Column, deviation: Column, digits: int = 3) -> Column:
    """Rounded distance from the mean in sample standard deviations; NULL without spread."""
    return F.when(deviation > 0, F.round((value - mean) / deviation, digits))


def zscores(df: DataFrame, columns: list[str], digits: int = 3) -> DataFrame:
    """Add ``<column>_zscore`` for every column."""
    parts = [F.avg(c).alias(f"{c}_mean") for c in columns]
    parts += [F.stddev_samp(c).alias(f"{c}_sd") for c in columns]
    scores = {
        f"{c}_zscore": zscore_of(F.col(c), stat(f"{c}_mean"), stat(f"{c}_sd"), digits)
        for c in columns
    }
    return with_stats(df, df, parts).withColumns(scores).drop(STATS)


def outlier_counts(df: DataFrame, columns: list[str], beyond: float = 3.0) -> DataFrame:
    """(name, n_rows, n_outliers) by z-score; the values themselves are kept."""
    scored = zscores(df, columns)
    counts = scored.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.abs(f"{c}_zscore") > beyond).alias(c) for c in columns],
    )
    rows = [
        F.struct(F.lit(c).alias("name"), F.col("n_rows"), F.col(c).alias("n_outliers"))
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


# --- scaling ------------------------------------------------------------------------------------


def minmax_of(value: Column, low: Column, high: Column, digits: int = 4) -> Column:
    """Rounded position of a value between two bounds; a range of zero counts as one."""
    span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    return F.round((value - low) / span, digits)


def minmax(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Add ``<column>_norm`` in [0, 1] for every column."""
    parts = [F.min(c).alias(f"{c}_min") for c in columns]
    parts += [F.max(c).alias(f"{c}_max") for c in columns]
    scaled = {
        f"{c}_norm": minmax_of(F.col(c), stat(f"{c}_min"), stat(f"{c}_max"), digits)
        for c in columns
    }
    return with_stats(df, df, parts).withColumns(scaled).drop(STATS)


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, n, n_null, mean, sd, min, max) of each column from one aggregate."""
    measures = {
        "n": F.count,
        "mean": F.avg,
        "sd": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    one_row = df.agg(
        F.count("*").alias("__rows"),
        *[
            f(F.col(c).cast("double")).alias(f"{c}__{name}")
            for c in columns
            for name, f in measures.items()
        ],
    )
    rows = [
        F.struct(
            F.lit(c).alias("name"),
            F.col(f"{c}__n").alias("n"),
            (F.col("__rows") - F.col(f"{c}__n")).alias("n_null"),
            steady_round(F.col(f"{c}__mean"), 4).alias("mean"),
            F.round(f"{c}__sd", 4).alias("sd"),
            F.col(f"{c}__min").alias("min"),
            F.col(f"{c}__max").alias("max"),
        )
        for c in columns
    ]
    return one_row.select(F.inline(F.array(*rows)))
