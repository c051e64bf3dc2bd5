"""New synthetic rows from a Gaussian copula per class.

A model holds, for each class and column, a table of quantiles and the share of NULLs, and for each class
the correlations of the columns' normal scores. Whether a value is NULL is a score of its own, so columns that
are NULL together stay so. It is fitted by two aggregates (quantiles; sums and products of the scores) and is
a small table that can be stored. Drawing needs no source rows: a hash of (seed, class, draw, score) gives
independent normal numbers, the triangular factor of the correlations mixes them, and the quantile tables
turn them into values. No drawn row is made from a source row, values stay inside the observed range of their class, and
the same seed gives the same rows on any cluster.

All work on rows is column expressions; only the model (classes x columns x ``GRID`` numbers, at most
``MODEL_CELLS``) and the moments of a class come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.operators.slices import SLICE_ROWS

#: Steps of a quantile table; a power of two, so that values are found by halving.
GRID = 512
#: Numbers that all quantile tables of a model may have together.
MODEL_CELLS = 4_000_000
#: Rank error of the quantiles is rows / ACCURACY.
ACCURACY = 20_000
WHOLE = ("tinyint", "smallint", "int", "bigint")

# Coefficients of Acklam's rational approximation to the inverse normal distribution.
_CENTRE = (
    (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00),
    (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0),
)
_TAIL = (
    (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00),
    (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0),
)
_LOW = 0.02425
# Coefficients of the normal distribution by Abramowitz and Stegun 26.2.17.
_SLOPE = 0.2316419
_NORMAL = (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530, 0.0)


def _polynomial(coefficients: tuple[float, ...], x: Column) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def normal_score(p: Column) -> Column:
    """Inverse of the normal distribution for 0 < p < 1, to nine digits."""
    q = p - 0.5
    near = _polynomial(_CENTRE[0], q * q) * q / _polynomial(_CENTRE[1], q * q)

    def tail(share: Column) -> Column:
        r = F.sqrt(-2 * F.ln(share))
        return _polynomial(_TAIL[0], r) / _polynomial(_TAIL[1], r)

    return F.when(p < _LOW, tail(p)).when(p > 1 - _LOW, -tail(1 - p)).otherwise(near)


def normal_share(z: Column) -> Column:
    """The normal distribution, to seven digits."""
    t = 1 / (1 + _SLOPE * F.abs(z))
    upper = F.exp(-z * z / 2) / float(np.sqrt(2 * np.pi)) * _polynomial(_NORMAL, t)
    return F.when(z < 0, upper).otherwise(1 - upper)


@dataclass
class Copula:
    """Classes in order; per class and column its quantiles and NULL share; per class the correlations.

    The scores are those of the columns, then whether a value is there for each column that has NULLs.
    """

    label: str
    label_type: str
    columns: list[str]
    types: list[str]
    classes: list
    quantiles: list[list[list[float]]]
    nulls: list[list[float]]
    correlations: list[np.ndarray] | None = None

    @property
    def gaps(self) -> list[int]:
        """Columns with NULLs."""
        return [i for i in range(len(self.columns)) if any(shares[i] > 0 for shares in self.nulls)]

    @property
    def size(self) -> int:
        return len(self.columns) + len(self.gaps)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """One row per class and score, to be stored."""
        rows = []
        for c, cls in enumerate(self.classes):
            for i, (col, kind) in enumerate(zip(self.columns, self.types)):
                known = (self.nulls[c][i], self.quantiles[c][i], self.correlations[c][i].tolist())
                rows.append((str(cls), c, i, col, kind, *known))
            for i in range(len(self.columns), self.size):
                rows.append((str(cls), c, i, None, None, None, None, self.correlations[c][i].tolist()))
        schema = (
            f"`{self.label}` string, place int, position int, column string, type string, nulls double, "
            "quantiles array<double>, correlations array<double>"
        )
        typed = spark.createDataFrame(rows, schema)
        return typed.withColumn(self.label, F.col(self.label).cast(self.label_type))

    @classmethod
    def from_frame(cls, stored: DataFrame) -> Copula:
        """The model that ``to_frame`` has stored."""
        label = stored.columns[0]
        by: dict[int, list] = {}
        for row in stored.collect():  # the model, bounded when it was fitted
            by.setdefault(row["place"], []).append(row)
        rows = [sorted(by[place], key=lambda r: r["position"]) for place in sorted(by)]
        columns = [[r for r in part if r["column"] is not None] for part in rows]
        return cls(
            label,
            dict(stored.dtypes)[label],
            [r["column"] for r in columns[0]],
            [r["type"] for r in columns[0]],
            [part[0][label] for part in rows],
            [[r["quantiles"] for r in part] for part in columns],
            [[r["nulls"] for r in part] for part in columns],
            [np.array([r["correlations"] for r in part]) for part in rows],
        )


def _numbers(values) -> Column:
    """Nested numbers in one flat constant, folded when the query is planned."""
    flat = np.asarray(values, dtype=float).ravel().tolist()
    return F.split(F.lit(",".join(map(repr, flat))), ",").cast("array<double>")


def _of_class(values: list) -> Column:
    """The number of the row's class."""
    return F.get(_numbers(values), F.col("place"))


def _named(stem: str, values: list[Column]) -> list[Column]:
    return [value.alias(f"{stem}{i}") for i, value in enumerate(values)]


def _cols(stem: str, n: int) -> list[Column]:
    return [F.col(f"{stem}{i}") for i in range(n)]


def _apart(rows: DataFrame, *columns: Column | str) -> DataFrame:
    """A projection compiled on its own: the lambda has Spark leave it out of the one method that it makes of
    steps in a row, which these formulas would outgrow."""
    return rows.select(F.get(F.transform(F.array("place"), lambda x: x), F.lit(0)).alias("place"), *columns)


def _classes(df: DataFrame, label: str, most: int) -> list:
    found = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    rows = found.orderBy(label).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{label} has more than {most} classes, too many for one model")
    return [r[0] for r in rows]


def fit(df: DataFrame, label: str, columns: list[str]) -> Copula:
    """Fit one copula per class of ``label``; rows without a class are left out.

    ``df`` is read three times and should be a table. Columns of whole numbers stay whole. A column without
    a value in a class is NULL in all rows drawn for it. Raises where the model would be too large.
    """
    kinds = dict(df.dtypes)
    classes = _classes(df, label, MODEL_CELLS // (GRID + 1) // max(len(columns), 1))
    if not classes:
        raise ValueError(f"no row has a {label}")
    probs = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    parts = [F.count("*").alias("n")]
    for i, c in enumerate(columns):
        parts.append(F.count(c).alias(f"n{i}"))
        parts.append(F.percentile_approx(F.col(c).cast("double"), probs, ACCURACY).alias(f"q{i}"))
    found = {r[label]: r for r in df.groupBy(label).agg(*parts).collect() if r[label] is not None}
    rows = [found[c] for c in classes]
    model = Copula(
        label,
        kinds[label],
        list(columns),
        [kinds[c] for c in columns],
        classes,
        [[r[f"q{i}"] or [0.0] * (GRID + 1) for i in range(len(columns))] for r in rows],
        [[1 - r[f"n{i}"] / r["n"] for i in range(len(columns))] for r in rows],
    )
    model.correlations = [_latent(*m, r) for m, r in zip(moments(df, model), _reach(model))]
    return model


def _place(model: Copula) -> Column:
    """Number of the row's class; NULL for other classes."""
    kind = model.label_type
    arms = F.lit(None).cast("int")
    for i, c in enumerate(model.classes):
        arms = F.when(F.col(model.label) == F.lit(c).cast(kind), i).otherwise(arms)
    return arms


def scores(df: DataFrame, model: Copula) -> DataFrame:
    """``place`` of the class and the normal scores ``z`` of the columns: ties in the middle and NULL for NULL.

    A value's share is read off the quantile table of its class by halving. Each halving of all columns is a
    projection of its own, as compiled code runs many times faster than lambdas do; a point of a table is in
    the constants of one halving only, so all of them together hold the tables a few times.
    """
    n = len(model.columns)
    tables = np.asarray(model.quantiles, dtype=float).reshape(-1, n, GRID + 1)[:, :, :GRID]  # the last point ends the range
    v, below = _cols("v", n), _cols("b", n)
    labelled = df.withColumn("place", _place(model)).filter(F.col("place").isNotNull())
    halved = labelled.select(
        "place",
        *_named("v", [F.col(c).cast("double") for c in model.columns]),
        *_named("b", [F.lit(0) for _ in v]),
    )
    # points come first and classes second in a constant, so that the code of all halvings is the same
    at = [b * len(model.classes) + F.col("place") for b in below]
    step = GRID // 2
    while step:  # so far, the points below the value are counted in steps of 2 * step
        points = [_numbers(tables[:, i, step - 1 :: 2 * step].T) for i in range(n)]
        more = [F.get(points[i], at[i]) < v[i] for i in range(n)]
        halved = _apart(halved, *v, *_named("b", [2 * b + F.when(m, 1).otherwise(0) for b, m in zip(below, more)]))
        step //= 2

    def share(i: int) -> Column:
        point, run = (F.get(_numbers(np.transpose(x)), at[i]) for x in (tables[:, i], [_runs(t) for t in tables[:, i]]))
        # points below the value and points up to it; all but one are known to be below or not
        met = 2 * below[i] + F.when(point == v[i], run).when(point < v[i], 2).otherwise(0)
        # the middle of the points a value lies on; at least half a point off either end
        found = F.least(F.greatest(met, F.lit(1)), F.lit(2 * GRID + 1)) / (2.0 * (GRID + 1))
        return F.when(v[i].isNotNull(), found)

    shares = _apart(halved, *_named("p", [share(i) for i in range(n)]))
    # the formula uses its argument many times, so the shares are columns of their own
    return _apart(shares, F.array(*[normal_score(p) for p in _cols("p", n)]).alias("z"))


def _runs(points: np.ndarray) -> np.ndarray:
    """For each point how many from it on are equal to it."""
    _, firsts, which, counts = np.unique(points, return_index=True, return_inverse=True, return_counts=True)
    return firsts[which] + counts[which] - np.arange(len(points))


def _score(share: float) -> float:
    """``normal_score`` of one number."""
    if _LOW <= share <= 1 - _LOW:
        q = share - 0.5
        return float(np.polyval(_CENTRE[0], q * q) * q / np.polyval(_CENTRE[1], q * q))
    r = np.sqrt(-2 * np.log(min(share, 1 - share)))
    return float(np.polyval(_TAIL[0], r) / np.polyval(_TAIL[1], r)) * (1 if share < _LOW else -1)


def moments(df: DataFrame, model: Copula) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per class the correlations and the standard deviations of the normal scores: those of the columns, then
    of whether the columns with NULLs have a value.

    A pair of scores is compared over the rows that have both. Whether a value is there has two scores per
    class, so sums with it follow from the sums over the rows that have the value.
    """
    n, classes = len(model.columns), len(model.classes)
    # outer, as no array is empty: else a filter on it would be pushed below, with all halvings written out in it
    crossed = scores(df, model).select("place", "z", F.posexplode_outer("z").alias("i", "zi"))
    parts = [F.count("*").alias("rows")]
    for j in range(n):
        other = F.get("z", F.lit(j))
        both, mine = F.col("zi") * other, F.when(other.isNotNull(), F.col("zi"))
        parts += [F.count(both).alias(f"n{j}"), F.sum(mine).alias(f"s{j}")]
        parts += [F.sum(mine * mine).alias(f"q{j}"), F.sum(both).alias(f"p{j}")]
    total = np.zeros(classes)
    sums = np.zeros((classes, 4, n, n))  # counts, scores, squares, products of i over the rows that have j
    for row in crossed.groupBy("place", "i").agg(*parts).collect():  # one row per class and column
        total[row["place"]] = row["rows"]
        for k, name in enumerate("nsqp"):
            sums[row["place"], k, row["i"]] = [row[f"{name}{j}"] or 0.0 for j in range(n)]
    out = []
    for c in range(classes):
        n_, s, q, p = _with_gaps(total[c], *sums[c], *_gap_scores(model, c))
        rows = np.maximum(n_, 1)
        mean, square, product = s / rows, q / rows, p / rows
        # entry i, j: of score i over the rows that have j as well
        deviation = np.sqrt(np.maximum(square - mean * mean, 0))
        scale = deviation * deviation.T
        varies = scale > 1e-9
        spread = product - mean * mean.T
        correlation = np.where(varies, spread / np.where(varies, scale, 1.0), 0.0)
        correlation = np.clip((correlation + correlation.T) / 2, -1, 1)
        np.fill_diagonal(correlation, 1.0)
        out.append((correlation, np.diag(deviation).copy()))
    return out


def _gap_scores(model: Copula, c: int) -> tuple[list[int], list[float | None], list[float | None]]:
    """The columns with NULLs and, in one class, the score of a NULL and of a value; None where there is none."""
    missing = [model.nulls[c][i] for i in model.gaps]
    return (
        model.gaps,
        [_score(share / 2) if share > 0 else None for share in missing],
        [_score((1 + share) / 2) if share < 1 else None for share in missing],
    )


def _with_gaps(total, counts, scored, squares, products, gaps, without, having):
    """Sums over pairs of columns, carried on to the scores of whether a column has a value.

    Each score is, over any rows, a sum of features: 1, whether column i is there, its score and the score's
    square, with 0 for what is missing. So is its square, and whether there is a score.
    """
    n, size = len(counts), len(counts) + len(gaps)
    there, score, square = (slice(1 + k * n, 1 + (k + 1) * n) for k in range(3))
    of = np.zeros((1 + 3 * n, 1 + 3 * n))  # sums of products of two features, as far as they are needed
    of[0, 0] = total
    of[0, there], of[0, score], of[0, square] = np.diag(counts), np.diag(scored), np.diag(squares)
    of[there, there], of[score, there], of[square, there], of[score, score] = counts, scored, squares, products
    of[there, score] = scored.T
    of[1:, 0] = of[0, 1:]
    found, value, squared = (np.zeros((size, 1 + 3 * n)) for _ in range(3))
    for into, part in ((found, there), (value, score), (squared, square)):
        into[:n, part] = np.eye(n)
    for k, (i, low, high) in enumerate(zip(gaps, without, having), n):
        for into, power in ((found, 0), (value, 1), (squared, 2)):
            a, b = (0.0 if x is None else x**power for x in (low, high))
            into[k, 0], into[k, 1 + i] = a, b - a
    return found @ of @ found.T, value @ of @ found.T, squared @ of @ found.T, value @ of @ value.T


def _reach(model: Copula) -> list[np.ndarray]:
    """Per class and score its covariance with the normal number that it stands for; under 1 because of ties."""
    normal = NormalDist()

    def density(share: float) -> float:
        return normal.pdf(normal.inv_cdf(share)) if 0 < share < 1 else 0.0

    out = []
    for table, nulls in zip(model.quantiles, model.nulls):
        found = []
        for values in table:
            _, starts, counts = np.unique(values, return_index=True, return_counts=True)
            lows, highs = starts / (GRID + 1), (starts + counts) / (GRID + 1)
            found.append(
                sum(normal.inv_cdf((a + b) / 2) * (density(a) - density(b)) for a, b in zip(lows, highs))
            )
        for i in model.gaps:
            p = nulls[i]
            step = normal.inv_cdf((1 + p) / 2) - normal.inv_cdf(p / 2) if 0 < p < 1 else 0.0
            found.append(step * density(p))
        out.append(np.array(found))
    return out


def _latent(correlation: np.ndarray, deviation: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Correlations of the normal numbers behind the scores, made positive definite.

    To first order the covariance of two scores is that of their numbers times the reach of both.
    """
    usable = (deviation > 1e-6) & (reach > 1e-6)
    widen = np.where(usable, deviation / np.where(usable, reach, 1.0), 0.0)
    wide = np.clip(correlation * np.outer(widen, widen), -0.999, 0.999)
    np.fill_diagonal(wide, 1.0)
    values, vectors = np.linalg.eigh(wide)
    mended = vectors @ np.diag(np.maximum(values, 1e-6)) @ vectors.T
    size = np.sqrt(np.diag(mended))
    return mended / np.outer(size, size)


def draw(spark: SparkSession, model: Copula, quota: dict, seed: int, digits: int = 2) -> DataFrame:
    """``quota`` rows of each class: ``draw`` (dense from 1, classes in order), the label and the columns.

    Fractional columns have ``digits`` decimals. Classes that the model doesn't know can't be drawn.
    """
    if unknown := set(quota) - set(model.classes):
        raise ValueError(f"no model of {sorted(map(str, unknown))}")
    sizes = [int(quota.get(c, 0)) for c in model.classes]
    starts = np.concatenate(([0], np.cumsum(sizes))).tolist()
    place, first = F.lit(0), F.lit(0).cast("long")
    for c, start in enumerate(starts[1:-1], 1):
        place = F.when(F.col("draw") > start, c).otherwise(place)
        first = F.when(F.col("draw") > start, F.lit(start).cast("long")).otherwise(first)
    # Spark's own number of tasks does not follow the rows
    tasks = max(spark.sparkContext.defaultParallelism, -(-starts[-1] // SLICE_ROWS))
    rows = spark.range(1, starts[-1] + 1, 1, tasks).withColumnRenamed("id", "draw")
    rows = rows.select("draw", place.alias("place"), (F.col("draw") - first).alias("number"))

    n, size, span = len(model.columns), model.size, 1 << 52

    def free(i: int) -> Column:
        drawn = F.xxhash64(F.lit(seed), F.lit(i), "place", "number")
        return (F.pmod(drawn, F.lit(span)) + 0.5) / float(span)

    factors = [np.linalg.cholesky(m) for m in model.correlations]

    def mixed(i: int) -> Column:
        # As text, since the terms of all scores grow with the square of their number. Differences, since Spark
        # puts the terms of a sum in order, for each part of the sum anew.
        weights = [", ".join(f"{-f[i, j]!r}D" for f in np.asarray(factors).astype(object)) for j in range(i + 1)]
        return F.expr(" - ".join(["0.0D", *(f"get(array({w}), place) * e{j}" for j, w in enumerate(weights))]))

    def value(i: int) -> Column:
        of_class = [table[i] for table in model.quantiles]
        quantile = lambda k: F.get(_numbers(of_class), F.col("place") * (GRID + 1) + k)
        inside = F.col(f"p{i}") * GRID
        if model.types[i] in WHOLE:
            found = quantile(F.floor(inside + 0.5).cast("int"))
        else:
            low = F.least(F.floor(inside), F.lit(GRID - 1)).cast("int")
            between = F.round(quantile(low) + (inside - low) * (quantile(low + 1) - quantile(low)), digits)
            least, most = (_of_class([table[k] for table in of_class]) for k in (0, GRID))
            found = F.least(F.greatest(between, least), most)
        if i in model.gaps:
            missing = _of_class([shares[i] for shares in model.nulls])
            drawn = F.col(f"p{n + model.gaps.index(i)}")
            found = F.when((missing == 0) | (drawn >= missing) & (missing < 1), found)
        return found.cast(model.types[i])

    labels = F.lit(None).cast(model.label_type)
    for c, cls in enumerate(model.classes):
        labels = F.when(F.col("place") == c, F.lit(cls).cast(model.label_type)).otherwise(labels)
    # each step looks at the one before many times, so each is a projection of its own
    rows = _apart(rows, "draw", *_named("u", [free(i) for i in range(size)]))
    rows = _apart(rows, "draw", *_named("e", [normal_score(u) for u in _cols("u", size)]))
    rows = _apart(rows, "draw", *_named("z", [mixed(i) for i in range(size)]))
    # no filter on a column is pushed below a generator, where the formulas would be written out in it
    rows = rows.select("draw", "place", F.inline(F.array(F.struct(*_cols("z", size)))))
    rows = _apart(rows, "draw", *_named("p", [normal_share(z) for z in _cols("z", size)]))
    rows = _apart(rows, "draw", *_named("x", [value(i) for i in range(n)]))
    return rows.select("draw", labels.alias(model.label), *[F.col(f"x{i}").alias(c) for i, c in enumerate(model.columns)])


def fidelity(source: DataFrame, drawn: DataFrame, model: Copula) -> DataFrame:
    """Per class and column how close the drawn rows come: ``rows``, means of both, ``in_range``, the distance of
    the means in standard deviations of the source, and the largest difference of a rank correlation.

    Both tables are read twice; only one row per class and column is compared.
    """
    label, n = model.label, len(model.columns)

    def summary(df: DataFrame, name: str) -> DataFrame:
        parts = [F.count("*").alias("rows")]
        for i, c in enumerate(model.columns):
            value = F.col(c).cast("double")
            parts.append(
                F.struct(F.avg(value), F.min(value), F.max(value), F.stddev_pop(value)).alias(f"c{i}")
            )
        one = df.filter(F.col(label).isNotNull()).groupBy(label).agg(*parts)
        cells = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.col(f"c{i}.col1").alias("mean"),
                    F.col(f"c{i}.col2").alias("least"),
                    F.col(f"c{i}.col3").alias("most"),
                    F.col(f"c{i}.col4").alias("deviation"),
                )
                for i, c in enumerate(model.columns)
            ]
        )
        return one.select(F.col(label).alias(f"{name}_class"), F.col("rows"), F.inline(cells))

    ranks = []
    for cls, (a, _), (b, _) in zip(model.classes, moments(source, model), moments(drawn, model)):
        apart = np.abs(a - b)[:n, :n]
        ranks += [(str(cls), c, float(apart[i].max())) for i, c in enumerate(model.columns)]
    ranked = source.sparkSession.createDataFrame(ranks, "class string, column string, rank_gap double")
    a = summary(source, "source").drop("rows").withColumn("class", F.col("source_class").cast("string"))
    b = summary(drawn, "drawn").select(
        F.col("drawn_class").cast("string").alias("class"),
        "column",
        "rows",
        *[F.col(c).alias(f"drawn_{c}") for c in ("mean", "least", "most")],
    )
    joined = a.join(b, ["class", "column"]).join(ranked, ["class", "column"])
    none = F.col("mean").isNull() & F.col("drawn_mean").isNull()
    inside = (F.col("drawn_least") >= F.col("least")) & (F.col("drawn_most") <= F.col("most"))
    gap = F.abs(F.col("drawn_mean") - F.col("mean")) / F.nullif(F.col("deviation"), F.lit(0.0))
    return joined.select(
        F.col("source_class").alias(label),
        "column",
        "rows",
        "mean",
        "drawn_mean",
        (none | F.coalesce(inside, F.lit(False))).alias("in_range"),
        F.when(none | (F.col("drawn_mean") == F.col("mean")), 0.0).otherwise(gap).alias("mean_gap"),
        "rank_gap",
    )
