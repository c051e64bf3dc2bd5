"""Wide to long and long to wide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.scalars import month_key_of_text, observed, parse_number


def unpivot_groups(
    df: DataFrame, ids: list[str], key: str, measures: list[str], groups: Mapping[int, Sequence]
) -> DataFrame:
    """One row per id and group of columns, from a single scan.

    ``groups`` maps a key value to the columns that hold its measures. Only the key is unfolded and
    each measure is picked by it, so there is neither a union of scans nor a shuffle, and a measure
    nobody reads is pruned together with its columns (an array of structs would keep them all). A
    measure has the widest type of its columns: none is narrowed, and text does not mix with numbers.
    """
    keys = F.array(*[F.lit(value) for value in groups])
    unfolded = df.withColumn(key, F.explode(keys))

    def picked(position: int) -> Column:
        common = widest(df, [cols[position] for cols in groups.values()])
        arms = " ".join(
            f"WHEN {value} THEN CAST(`{cols[position]}` AS {common})"
            for value, cols in groups.items()
        )
        return F.expr(f"CASE `{key}` {arms} END")

    return unfolded.select(*ids, key, *[picked(i).alias(m) for i, m in enumerate(measures)])


def widest(df: DataFrame, columns: list[str]) -> str:
    """The type that holds every value of the columns, as the analyzer's CASE would choose it."""
    kinds = {df.schema[c].dataType for c in columns}
    if len(kinds) == 1:
        return kinds.pop().simpleString()
    if not all(isinstance(k, T.NumericType) for k in kinds):
        found = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)
        raise TypeError(f"no common type: {found}")
    arms = " ".join(f"WHEN {i} THEN `{c}`" for i, c in enumerate(columns))
    return df.select(F.expr(f"CASE 0 {arms} END AS v")).schema["v"].dataType.simpleString()


def stack_sql(groups: Mapping[int, Sequence], types: Sequence[str]) -> str:
    """``stack`` call over the same groups; a position must hold one type, hence the casts."""
    rows = [
        ", ".join([str(value), *[f"CAST({c} AS {t})" for c, t in zip(cols, types)]])
        for value, cols in groups.items()
    ]
    return f"stack({len(rows)}, {', '.join(rows)})"


def unpivot_one(df: DataFrame, ids: list[str], columns: list[str], key: str, value: str):
    return df.unpivot(ids, columns, key, value)


def latest_by(df: DataFrame, keys: list[str], value: Column, order: Column, name: str):
    """Value of the latest row per key. ``max_by`` combines on the map side."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(name))


def pivot_case(
    df: DataFrame, keys: list[Column], series: Mapping[str, str], name: str, value: Column
) -> DataFrame:
    """Long to wide with one conditional maximum per series; absent series give NULL columns."""
    picks = [F.max(F.when(F.col(name) == s, value)).alias(column) for s, column in series.items()]
    return df.groupBy(*keys).agg(*picks)


def pivot_named(
    df: DataFrame, keys: list[Column], series: Mapping[str, str], name: str, value: Column
) -> DataFrame:
    """The same through ``pivot``. The value list is given, so no job looks for it."""
    wide = df.groupBy(*keys).pivot(name, list(series)).agg(F.max(value))
    return wide.withColumnsRenamed(dict(series))


def macro_by_month(observations: DataFrame, series: Mapping[str, str]) -> DataFrame:
    """Observed months only: (date_key, one column per series), largest of the duplicates."""
    return pivot_case(
        observations.filter(observed(F.col("value"))),
        [month_key_of_text(F.col("obs_date")).alias("date_key")],
        series,
        "series_id",
        parse_number(F.col("value")),
    )


def macro_spine(
    observations: DataFrame, calendar: DataFrame, series: Mapping[str, str]
) -> DataFrame:
    """Every month of ``calendar``: the last observation of each series within that month.

    Observations of other years, earlier or later, do not stand in for a month without one.
    """
    number = parse_number(F.col("value"))
    valued = observations.filter(number.isNotNull() & F.col("series_id").isin(*series))
    # ``max_by`` skips rows without an order, so one aggregate both picks the last observation of
    # each series and turns the series into columns. It leaves one row per month.
    picks = [
        F.max_by(number, F.when(F.col("series_id") == s, F.col("obs_date"))).alias(column)
        for s, column in series.items()
    ]
    months = calendar.select("date_key")
    key = month_key_of_text(F.col("obs_date")).alias("date_key")
    wide = valued.groupBy(key).agg(*picks).join(F.broadcast(months), "date_key", "left_semi")
    return months.join(F.broadcast(wide), "date_key", "left").select("date_key", *series.values())
