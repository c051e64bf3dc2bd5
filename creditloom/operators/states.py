"""Mergeable states per batch: results of all batches so far, with only the new batch read.

Each kind of state is a small table made of one batch (a month, a delivery), stored in a folder of its own, and
merged by an aggregate over the stored rows: label counts (rates, shares, cubes), moments (means, spreads,
correlations), quantile sketches (fences), and bitmaps of keys (distinct keys and duplicates). A batch that runs again
replaces its own state and no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Size of a quantile sketch. The rank error of a fence, measured over many merges, stays below RANK_ERROR.
SKETCH = 800
RANK_ERROR = 0.01
#: Keys of a bitmap (a fixed value of the built-in functions), and the fewest a bitmap should hold on average.
BITMAP_KEYS = 32_768
LEAST_KEYS = 64


def save_batch(state: DataFrame, folder: str, batch: str | int) -> None:
    """Store the state of one batch; the batch again replaces it."""
    state.write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def saved(spark: SparkSession, folder: str) -> DataFrame:
    """The states of all batches, with the column ``batch``."""
    return spark.read.parquet(folder)


# --- counts per label -------------------------------------------------------------------------------------


def merged_counts(states: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Counts and sums of all batches per key."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


# --- moments ----------------------------------------------------------------------------------------------


def moment_state(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """A row per pair of columns: rows that have both, means, squared distances from them, extremes."""
    parts = []
    for i, (x, y) in enumerate(pairs):
        both = F.col(x).isNotNull() & F.col(y).isNotNull()
        a, b = (F.when(both, F.col(c).cast("double")) for c in (x, y))
        n = F.count(a)
        parts.append(
            F.struct(
                F.lit(x).alias("x"),
                F.lit(y).alias("y"),
                n.alias("n"),
                F.avg(a).alias("mean_x"),
                F.avg(b).alias("mean_y"),
                (F.var_pop(a) * n).alias("square_x"),
                (F.var_pop(b) * n).alias("square_y"),
                (F.covar_pop(a, b) * n).alias("product"),
                *[f(v).alias(f"{name}_{side}") for v, side in ((a, "x"), (b, "y")) for f, name in ((F.min, "least"), (F.max, "most"))],
            ).alias(f"p{i}")
        )
    one = df.agg(*parts)
    return one.select(F.inline(F.array(*[f"p{i}" for i in range(len(pairs))]))).filter("n > 0")


def merged_moments(states: DataFrame) -> DataFrame:
    """(x, y, n, mean_x, mean_y, square_x, square_y, product, varies_x, varies_y) over all batches.

    Squared distances are moved to the common mean, never taken as a difference of large sums.
    """
    pair = Window.partitionBy("x", "y")  # a row per batch

    def shared(mean: str):
        return F.sum(F.col("n") * F.col(mean)).over(pair) / F.sum("n").over(pair)

    moved = states.withColumns({"all_x": shared("mean_x"), "all_y": shared("mean_y")}).withColumns(
        {
            "dx": F.col("mean_x") - F.col("all_x"),
            "dy": F.col("mean_y") - F.col("all_y"),
        }
    )
    return moved.groupBy("x", "y").agg(
        F.sum("n").alias("n"),
        F.first("all_x").alias("mean_x"),
        F.first("all_y").alias("mean_y"),
        F.sum(F.col("square_x") + F.col("n") * F.col("dx") * F.col("dx")).alias("square_x"),
        F.sum(F.col("square_y") + F.col("n") * F.col("dy") * F.col("dy")).alias("square_y"),
        F.sum(F.col("product") + F.col("n") * F.col("dx") * F.col("dy")).alias("product"),
        (F.min("least_x") < F.max("most_x")).alias("varies_x"),
        (F.min("least_y") < F.max("most_y")).alias("varies_y"),
    )


def correlations_of(states: DataFrame, names: dict[tuple[str, str], str], digits: int = 4) -> DataFrame:
    """One row with the rounded Pearson correlation of each named pair; NULL where one side does not vary."""
    found = merged_moments(states)
    value = F.col("product") / F.sqrt(F.col("square_x") * F.col("square_y"))
    value = F.when(F.col("varies_x") & F.col("varies_y"), F.round(value, digits) + 0.0)
    return found.agg(
        *[
            F.max(F.when((F.col("x") == x) & (F.col("y") == y), value)).alias(name)
            for (x, y), name in names.items()
        ]
    )


# --- quantile sketches ---------------------------------------------------------------------------------------


def sketch_state(df: DataFrame, columns: list[str], size: int = SKETCH) -> DataFrame:
    """(name, sketch): one quantile sketch of bounded size per column with a value."""
    sketches = [F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(size)).alias(f"s{i}") for i, c in enumerate(columns)]
    counts = [F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("name"), F.col(f"n{i}").alias("n"), F.col(f"s{i}").alias("sketch"))
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*sketches, *counts).select(F.inline(rows)).filter("n > 0").select("name", "sketch")


def merged_quantiles(states: DataFrame, probs: list[float]) -> DataFrame:
    """(name, rows, quantiles) over all batches; quantiles in the order of ``probs``."""
    merged = states.groupBy("name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    found = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs])
    return merged.select("name", F.kll_sketch_get_n_double("sketch").alias("rows"), found.alias("quantiles"))


def merged_fences(states: DataFrame, width: float = 1.5) -> DataFrame:
    """(name, rows, q1, q3, low, high) of each column over all batches, with the rank error of the sketches."""
    quartiles = merged_quantiles(states, [0.25, 0.75])
    spread = (F.col("q3") - F.col("q1")) * width
    return quartiles.select(
        "name", "rows", F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("q3")
    ).withColumns({"low": F.col("q1") - spread, "high": F.col("q3") + spread})


# --- bitmaps of keys ------------------------------------------------------------------------------------------


def key_state(df: DataFrame, key: str, within: list[str] | None = None) -> DataFrame:
    """A row per bucket of keys (and value of ``within``): ``bucket``, ``keys`` as a bitmap, ``rows``, ``no_key``.

    Keys are whole numbers, dense enough that a bitmap is smaller than its keys; others are numbered
    densely first (``replace_key``). Rows without a key are counted.
    """
    within = within or []
    bit = F.when(F.col(key).isNotNull(), F.bitmap_bit_position(key))
    return df.groupBy(*within, F.bitmap_bucket_number(key).alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("keys"),
        F.count(key).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("no_key"),
    )


def merged_keys(states: DataFrame, within: list[str] | None = None) -> DataFrame:
    """One row per bucket for all batches."""
    within = within or []
    return states.groupBy(*within, "bucket").agg(
        F.bitmap_or_agg("keys").alias("keys"), F.sum("rows").alias("rows"), F.sum("no_key").alias("no_key")
    )


def key_counts(states: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(rows_before, rows_after, removed) of a de-duplication on the key over all batches.

    Rows without a key are one group, as they are for ``dedup_stats``.
    """
    merged = merged_keys(states, within)
    distinct = F.bitmap_count("keys") + (F.col("no_key") > 0).cast("int")
    return merged.agg(
        F.coalesce(F.sum(F.col("rows") + F.col("no_key")), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(distinct), F.lit(0)).alias("rows_after"),
    ).withColumn("removed", F.col("rows_before") - F.col("rows_after"))


def repeated_keys(states: DataFrame, batch: DataFrame, within: list[str] | None = None) -> DataFrame:
    """(known, fresh): keys of a new batch's state that stored states have already, and those that they don't."""
    within = within or []
    sides = [
        merged_keys(s, within).select(*within, "bucket", "keys", F.lit(new).alias("new")) for s, new in ((states, False), (batch, True))
    ]
    def size_of(new: bool):
        return F.coalesce(F.max(F.when(F.col("new") == new, F.bitmap_count("keys"))), F.lit(0))

    both = sides[0].unionByName(sides[1]).filter("bucket IS NOT NULL")
    sizes = both.groupBy(*within, "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("keys")).alias("either"), size_of(False).alias("old"), size_of(True).alias("new")
    )
    return sizes.agg(
        F.coalesce(F.sum(F.col("old") + F.col("new") - F.col("either")), F.lit(0)).alias("known"),
        F.coalesce(F.sum(F.col("either") - F.col("old")), F.lit(0)).alias("fresh"),
    )


def check_density(states: DataFrame) -> None:
    """Raise where bitmaps hold so few keys that the keys themselves would be smaller."""
    row = merged_keys(states).filter("bucket IS NOT NULL").agg(F.count("*").alias("n"), F.sum(F.bitmap_count("keys")).alias("k")).first()
    if row["n"] > 1 and row["k"] < LEAST_KEYS * row["n"]:
        raise ValueError(f"{row['k']} keys in {row['n']} bitmaps: number them densely first")
