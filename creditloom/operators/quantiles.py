"""Exact and approximate quantiles of many columns in one pass."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators.slices import so_far

# Rank error of the sketch that brackets a wanted rank is rows / ACCURACY.
ACCURACY = 2_000
# Values of a bracket that one task sorts; a bracket with more is narrowed again.
BRACKET_ROWS = 5_000_000


@dataclass
class Wanted:
    """One quantile: the ranks it lies between, and the values that bracket them (None: no bound)."""

    name: str
    prob: float
    rows: int
    low: float | None = None
    high: float | None = None
    # whether the next bracket keeps its old bound on either side
    keeps: tuple[bool, bool] = (True, True)

    @property
    def position(self) -> float:
        return (self.rows - 1) * self.prob

    def below(self) -> Column:
        value = F.col(self.name).cast("double")
        return F.lit(False) if self.low is None else value < self.low

    def inside(self) -> Column:
        value = F.col(self.name).cast("double")
        inside = value.isNotNull()
        if self.low is not None:
            inside &= value >= self.low
        return inside if self.high is None else inside & (value <= self.high)


def _bracket(df: DataFrame, wanted: list[Wanted], counts: list[tuple[int, int]]) -> None:
    """Narrow each bracket to a few of its own ranks around the wanted ones, by one aggregate.

    Quantiles that share a column and a bracket, as all of a column do at first, share a sketch.
    """
    margin = 3 / ACCURACY
    asked: dict[tuple, list[float]] = {}
    places = []
    for w, (below, inside) in zip(wanted, counts):
        ranks = math.floor(w.position) - below, math.ceil(w.position) - below
        low, high = (r / max(inside - 1, 1) for r in ranks)
        w.keeps = (low - margin <= 0, high + margin >= 1)
        sketch = (w.name, w.low, w.high)
        probs = asked.setdefault(sketch, [])
        places.append((sketch, len(probs)))
        probs += [max(low - margin, 0.0), min(high + margin, 1.0)]
    parts = []
    for i, ((name, low, high), probs) in enumerate(asked.items()):
        value = F.col(name).cast("double")
        if low is not None or high is not None:
            value = F.when(Wanted(name, 0, 0, low, high).inside(), value)
        wished = F.array(*[F.lit(p) for p in probs])
        parts.append(F.percentile_approx(value, wished, ACCURACY).alias(f"q{i}"))
    found = dict(zip(asked, df.agg(*parts).first()))
    for w, (sketch, at) in zip(wanted, places):
        low, high = found[sketch][at : at + 2]
        no_low, no_high = w.keeps
        w.low = w.low if no_low else low
        w.high = w.high if no_high else high


def _counts(df: DataFrame, wanted: list[Wanted]) -> list[tuple[int, int]]:
    """Rows below and rows inside each bracket."""
    parts = [F.count_if(f()) for w in wanted for f in (w.below, w.inside)]
    row = df.agg(*[p.alias(f"n{i}") for i, p in enumerate(parts)]).first()
    return list(zip(row[::2], row[1::2]))


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """(name, prob, quantile) by linear interpolation between neighbouring ranks.

    The built-in exact ``percentile`` keeps every distinct value of a column in the buffer of one
    task. Here a sketch of bounded size gives two values that bracket each wanted rank; a second scan
    counts the rows below and inside; only the values inside, a few in ten thousand, are grouped and
    the rank is picked from them. A bracket that still holds too many distinct rows is narrowed again.
    ``df`` is scanned a few times and should be a table. A column without values has no quantile.
    """
    sizes = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    wanted = [Wanted(c, float(p), sizes[c]) for c in columns for p in probs if sizes[c]]
    if not wanted:
        return df.sparkSession.createDataFrame([], "name string, prob double, quantile double")
    counts = [(0, w.rows) for w in wanted]
    while True:
        before = counts
        _bracket(df, wanted, counts)
        counts = _counts(df, wanted)
        for i, (w, (below, inside)) in enumerate(zip(wanted, counts)):
            if below > math.floor(w.position) or below + inside <= math.ceil(w.position):
                w.low = w.high = None  # the sketch was off: all values are inside then
                counts[i] = (0, w.rows)
        # a bracket that is one value doesn't get narrower, nor does it need to: values are grouped
        wide = [
            inside > BRACKET_ROWS and w.low != w.high and inside < was
            for w, (_, inside), (_, was) in zip(wanted, counts, before)
        ]
        if not any(wide):
            break
    picked = F.array(
        *[
            F.when(
                w.inside(),
                F.struct(F.lit(i).alias("i"), F.col(w.name).cast("double").alias("value")),
            )
            for i, w in enumerate(wanted)
        ]
    )
    values = (
        df.select(F.inline(F.filter(picked, lambda x: x.isNotNull())))
        .groupBy("i", "value")
        .agg(F.count("*").alias("n"))
    )
    spec = F.array(
        *[
            F.struct(
                F.lit(w.name).alias("name"),
                F.lit(w.prob).alias("prob"),
                F.lit(below).cast("bigint").alias("below"),
                F.lit(w.position).alias("position"),
            )
            for w, (below, _) in zip(wanted, counts)
        ]
    )
    last = F.sum("n").over(so_far(Window.partitionBy("i").orderBy("value"))) + F.col("w.below")
    low, high = F.floor(F.col("w.position")), F.ceil(F.col("w.position"))
    ranked = values.withColumn("w", F.get(spec, F.col("i"))).withColumn("last", last)
    # a value holds the ranks from last - n up to last, counted from 0
    holds = lambda rank: (rank >= F.col("last") - F.col("n")) & (rank < F.col("last"))
    share = F.first("w.position") - F.floor(F.first("w.position"))
    at = lambda rank: F.max(F.when(holds(rank), F.col("value")))
    return (
        ranked.where(holds(low) | holds(high))
        .groupBy(F.col("w.name").alias("name"), F.col("w.prob").alias("prob"))
        .agg((at(low) + (at(high) - at(low)) * share).alias("quantile"))
    )


def sketch_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], error: float = 0.01
) -> DataFrame:
    """(name, prob, quantile) from mergeable sketches of bounded size: one aggregate, no sort."""
    accuracy = max(1, round(1 / error))
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    one_row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), wanted, accuracy).alias(c) for c in columns]
    )
    per_column = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).alias("values")) for c in columns]
    )
    return (
        one_row.select(F.inline(per_column))
        .select("name", F.posexplode(F.arrays_zip(wanted.alias("prob"), F.col("values"))))
        .select("name", F.col("col.prob").alias("prob"), F.col("col.values").alias("quantile"))
        .filter(F.col("quantile").isNotNull())
    )


