"""Synthetic volume: class quotas and seeded resampling of exactly the wanted size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators.slices import HOT_ROWS, earlier, number_rows
from creditloom.session import materialise

# Draws in one block; blocks are spread over the tasks.
DRAWS_PER_BLOCK = 100_000


def class_quota(df: DataFrame, label: str, size: int, balanced: bool = False) -> DataFrame:
    """(label, rows, quota): wanted rows per class, equal or in the given proportions.

    Proportional quotas round half to even and need not add up to ``size`` exactly.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("rows"))
    classes = Window.partitionBy(F.lit(1))  # a window over the classes, not over the rows
    if balanced:
        quota = F.floor(F.lit(size) / F.count("*").over(classes))
    else:
        quota = F.bround(F.col("rows") / F.sum("rows").over(classes) * F.lit(float(size)), 0)
    return counts.withColumn("quota", quota.cast("bigint"))


def resample(
    df: DataFrame, key: list[str], label: str, size: int, seed: int, balanced: bool = False
) -> DataFrame:
    """Draw each class to its quota with replacement; the same seed gives the same rows.

    Rows are numbered per class, quota draws are spread over tasks in blocks, each draw picks a
    row number by hash, and one join fetches the rows. Picks are uniform inside a class; a row of a
    rare class is drawn quota / rows times, so it is repeated once per HOT_ROWS draws of it and the
    draws are dealt over the copies. ``draw`` numbers the result densely from 1: a class starts where
    the quotas before it end.
    """
    labelled = df.filter(F.col(label).isNotNull())
    numbered = number_rows(labelled, key, "__row", within=[label])
    classes = earlier([], label)
    quota = class_quota(df, label, size, balanced).withColumn(
        "__start", F.coalesce(F.sum("quota").over(classes), F.lit(0))
    )
    quota = materialise(quota.withColumn("__copies", _copies()), "quota")  # a row per class
    # The number of partitions is given, since adaptive execution would pack these short rows into
    # one task before they unfold into draws.
    last_block = F.floor((F.col("quota") - 1) / DRAWS_PER_BLOCK).cast("int")
    blocks = (
        quota.filter(F.col("quota") > 0)
        .select(
            F.col(label).alias("__class"),
            F.col("rows").alias("__rows"),
            "quota",
            "__start",
            "__copies",
            F.explode(F.sequence(F.lit(0), last_block)).alias("__block"),
        )
        .repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__class", "__block")
    )
    first = F.col("__block").cast("bigint") * DRAWS_PER_BLOCK
    last = F.least(first + DRAWS_PER_BLOCK, F.col("quota")) - 1
    picks = F.pmod(F.xxhash64("__class", "__draw", F.lit(seed)), F.col("__rows")) + 1
    draws = (
        blocks.withColumn("__draw", F.explode(F.sequence(first, last)))
        .withColumn("__pick", picks)
        .select(
            "__class",
            "__pick",
            F.pmod("__draw", F.col("__copies")).alias("__copy"),
            (F.col("__start") + F.col("__draw") + 1).alias("draw"),
        )
    )
    copies = quota.select(F.col(label).alias("__class"), "__copies")
    repeated = numbered.join(F.broadcast(copies), numbered[label] == copies["__class"]).select(
        *numbered.columns, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__copies") - 1)).alias("__n")
    )
    # Planned as small as the blocks they unfold from, the draws would be broadcast: the hint has both sides sorted.
    return draws.hint("merge").join(
        repeated,
        (F.col("__class") == F.col(label))
        & (F.col("__pick") == F.col("__row"))
        & (F.col("__copy") == F.col("__n")),
    ).select(*df.columns, "draw")


def _copies():
    """Copies of each row of a class, so that one copy is drawn about HOT_ROWS times at most."""
    return F.greatest(F.ceil(F.col("quota") / F.col("rows") / HOT_ROWS), F.lit(1)).cast("bigint")


def draw_as_key(drawn: DataFrame, old_key: str, name: str) -> DataFrame:
    """Drop the source key of a resample; the draw, dense already, becomes the key."""
    kept = [c for c in drawn.columns if c not in (old_key, name, "draw")]
    return drawn.select(F.col("draw").alias(name), *kept)


def replace_key(df: DataFrame, old_key: str, name: str, unique_key: list[str]) -> DataFrame:
    """Drop the source key of any table and number the rows densely from 1."""
    renumbered = number_rows(df, unique_key, "__number")
    kept = [c for c in df.columns if c not in (old_key, name)]
    return renumbered.select(F.col("__number").alias(name), *kept)
