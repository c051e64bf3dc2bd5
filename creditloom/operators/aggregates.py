"""Grouped rates, cubes over labels, correlations and shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.scalars import literal_map, steady_round
from creditloom.vocabulary import TARGET


def rate(label: str = TARGET, digits: int = 4) -> Column:
    return steady_round(F.avg(label), digits)


def overall_rate(df: DataFrame, rate_name: str, label: str = TARGET) -> DataFrame:
    return df.agg(rate(label).alias(rate_name), F.count("*").alias("total_clients"))


def rate_by(df: DataFrame, by: str, label: str = TARGET) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("clients"), rate(label).alias("default_rate"))


def means_by(df: DataFrame, keys: list[str], means: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Rounded means per key: output name -> (column, digits)."""
    return df.groupBy(*keys).agg(
        *[steady_round(F.avg(c), digits).alias(name) for name, (c, digits) in means.items()]
    )


def correlation(x: str, y: str, digits: int = 4) -> Column:
    """Rounded Pearson correlation over complete pairs; NULL where one side does not vary.

    ``corr`` itself fails on a constant column under ANSI rules before any guard around it applies.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.round(F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0)), digits) + 0.0


def label_counts(df: DataFrame, labels: list[str], target: str = TARGET) -> DataFrame:
    """Rows and label sums of every combination of the given labels.

    Labels come from dictionaries, so this is a few hundred rows whatever the size of ``df``; all
    rates below are taken from it rather than from expanded copies of the rows.
    """
    return df.groupBy(*labels).agg(
        F.count("*").alias("clients"),
        F.count(target).alias("rated"),
        F.sum(F.col(target).cast("double")).alias("hits"),
    )


def rate_cube(df: DataFrame, labels: list[str], target: str = TARGET) -> DataFrame:
    """Rate per single label and overall, one pass over the rows.

    ``grouping`` is the id of the grouping set; a slice is picked by it, so a label that is itself
    NULL is not taken for a total.
    """
    return cube_of_cells(label_counts(df, labels, target), labels)


def cube_of_cells(cells: DataFrame, labels: list[str]) -> DataFrame:
    """The cube from label counts, which may be those of several batches added up."""
    sets = [[F.col(label)] for label in labels] + [[]]
    return (
        cells.groupingSets(sets, *[F.col(label) for label in labels])
        .agg(
            F.grouping_id().cast("int").alias("grouping"),
            F.sum("clients").alias("clients"),
            F.round(F.sum("hits") / F.nullif(F.sum("rated"), F.lit(0)), 4).alias("default_rate"),
        )
    )


def total_of_cube(cube: DataFrame, labels: list[str]) -> DataFrame:
    every = (1 << len(labels)) - 1
    return cube.filter(F.col("grouping") == every).select(
        "default_rate", F.col("clients").alias("total_clients")
    )


def grouping_of(labels: list[str], label: str) -> int:
    """Grouping id of the set that holds ``label`` alone."""
    every = (1 << len(labels)) - 1
    return every - (1 << (len(labels) - 1 - labels.index(label)))


def long_of_cube(cube: DataFrame, dimensions: Mapping[str, str]) -> DataFrame:
    """(dimension, category, clients, default_rate) without the grand total."""
    labels = list(dimensions.values())
    names = {grouping_of(labels, label): name for name, label in dimensions.items()}
    category = F.coalesce(
        *[F.when(F.col("grouping") == g, F.col(dimensions[n])) for g, n in names.items()]
    )
    return cube.filter(F.col("grouping").isin(*names)).select(
        F.element_at(literal_map(names), F.col("grouping")).alias("dimension"),
        category.alias("category"),
        "clients",
        "default_rate",
    )


def rate_union(df: DataFrame, dimensions: Mapping[str, str], target: str = TARGET) -> DataFrame:
    """The same table as a union of one grouping per dimension, each over the small cell table."""
    cells = label_counts(df, list(dimensions.values()), target)
    parts = [
        cells.groupBy(F.lit(name).alias("dimension"), F.col(label).alias("category")).agg(
            F.sum("clients").alias("clients"),
            F.round(F.sum("hits") / F.nullif(F.sum("rated"), F.lit(0)), 4).alias("default_rate"),
        )
        for name, label in dimensions.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def shares(df: DataFrame, by: str, digits: int = 4) -> DataFrame:
    """(by, rows, share) of each value. The total is a window over the few groups, not the rows."""
    counts = df.groupBy(by).agg(F.count("*").alias("rows"))
    everything = Window.partitionBy(F.lit(1))
    return counts.withColumn(
        "share", F.round(F.col("rows") / F.sum("rows").over(everything), digits)
    )


def nested_by(df: DataFrame, by: str, order: Column, fields: list[str]) -> DataFrame:
    """One row per group with its rows as an ordered list; groups are a handful of categories."""
    entry = F.struct(order.alias("__order"), F.struct(*fields).alias("item"))
    ordered = F.sort_array(F.collect_list(entry))
    return df.groupBy(by).agg(F.transform(ordered, lambda e: e["item"]).alias("items"))
