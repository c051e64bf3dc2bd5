"""Rows drawn from fitted copulas: quotas, ranges, dependence, ties and NULLs."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import checksums, copula
from creditloom.queries import synthetic

N = statistics.NormalDist()


def test_normal_scores(spark):
    p = [1e-9, 0.001, 0.02, 0.3, 0.5, 0.77, 0.98, 1 - 1e-6]
    z = [-9.0, -2.5, -0.1, 0.0, 1.0, 3.3]
    frame = spark.createDataFrame([(a,) for a in p], "p double")
    for row in frame.select("p", copula.normal_score(F.col("p")).alias("z")).collect():
        assert abs(row.z - N.inv_cdf(row.p)) < 1e-7
    frame = spark.createDataFrame([(a,) for a in z], "z double")
    for row in frame.select("z", copula.normal_share(F.col("z")).alias("p")).collect():
        assert abs(row.p - N.cdf(row.z)) < 1e-6


@pytest.fixture(scope="module")
def source(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(1200):
        a, b = rng.normal(size=2)
        kind = ["x", "y", None][i % 3]
        slope = 0.9 if kind == "x" else -0.7
        income = float(np.exp(a))
        debt = float(slope * a + math.sqrt(1 - slope**2) * b)
        rows.append((i, kind, income, None if i % 5 == 0 else debt, int(max(0, round(2 * a))), 7, None, None if i % 5 == 0 else float(b)))
    return spark.createDataFrame(rows, "id long, kind string, income double, debt double, late int, one int, no double, rest double")


COLUMNS = ["income", "debt", "late", "one", "no", "rest"]


def test_drawn_rows(spark, source):
    model = copula.fit(source, "kind", COLUMNS)
    quota = {"x": 3000, "y": 1000}
    drawn = copula.draw(spark, model, quota, 3).cache()
    rows = drawn.collect()
    assert sorted(r.draw for r in rows) == list(range(1, 4001))
    assert {k: sum(r.kind == k for r in rows) for k in quota} == quota
    given = source.collect()
    for kind, sign in (("x", 1), ("y", -1)):
        mine, theirs = ([r for r in rs if r.kind == kind] for rs in (rows, given))
        for c in ("income", "debt", "late"):
            low, high = (f(r[c] for r in theirs if r[c] is not None) for f in (min, max))
            assert all(r[c] is None or low <= r[c] <= high for r in mine)
        assert all(r.one == 7 and r.no is None and isinstance(r.late, int) for r in mine)
        missing = [np.mean([r.debt is None for r in rs]) for rs in (mine, theirs)]
        assert abs(missing[0] - missing[1]) < 0.03
        both = [(r.income, r.debt) for r in mine if r.debt is not None]
        ranks = np.argsort(np.argsort(np.array(both), axis=0), axis=0)
        assert sign * np.corrcoef(ranks.T)[0, 1] > 0.6
        # columns that are missing together stay so
        assert np.mean([(r.debt is None) == (r.rest is None) for r in mine]) > 0.95
    seen = {(r.income, r.debt, r.late) for r in given}
    # at the ends of the range a drawn value can meet one of the source, elsewhere rows are new
    assert sum((r.income, r.debt, r.late) in seen for r in rows) < 0.01 * len(rows)
    report = copula.fidelity(source, drawn, model).collect()
    assert len(report) == 12 and all(r.in_range and r.mean_gap < 0.15 and r.rank_gap < 0.1 for r in report)


def test_same_seed_same_rows(spark, source):
    model = copula.fit(source, "kind", COLUMNS)
    again = copula.Copula.from_frame(model.to_frame(spark))
    first = copula.draw(spark, model, {"x": 50, "y": 10}, 1).orderBy("draw").collect()
    assert first == copula.draw(spark, again, {"x": 50, "y": 10}, 1).repartition(3).orderBy("draw").collect()
    assert first != copula.draw(spark, model, {"x": 50, "y": 10}, 2).orderBy("draw").collect()
    # a class's rows don't depend on the other quotas
    alone = copula.draw(spark, model, {"y": 10}, 1).orderBy("draw").collect()
    assert [tuple(r)[1:] for r in alone] == [tuple(r)[1:] for r in first[50:]]
    assert copula.draw(spark, model, {"x": 0}, 1).count() == 0


def test_rows_go_through_compiled_projections(spark, source):
    """Lambdas are looked up value by value; the one left per step only keeps Spark from merging the steps."""
    model = copula.fit(source, "kind", COLUMNS)
    drawn = copula.draw(spark, model, {"x": 500}, 1)
    for frame in (copula.scores(source, model), drawn):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "aggregate(" not in plan and "Project" in plan
        assert plan.count("lambdafunction(") == plan.count("transform(array(place")
    # a filter is not written out in all the formulas below it
    few = drawn.filter("income > 1 AND debt < 0")
    assert len(few._jdf.queryExecution().optimizedPlan().toString()) < 1_000_000
    assert few.count() == sum(r.income > 1 and r.debt is not None and r.debt < 0 for r in drawn.collect())


def test_scores_are_places_in_the_quantile_table(spark, source):
    model = copula.fit(source, "kind", COLUMNS)
    probe = [None, -1e9, 1e9, float("nan"), 0.0, -0.0, 1.0, 7.0, *model.quantiles[0][0][::64], *model.quantiles[1][1][1::50]]
    rows = [(i, kind, *[probe[(i + c) % len(probe)] for c in range(6)]) for i, kind in enumerate(["x", "y"] * 2 * len(probe))]
    given = spark.createDataFrame(rows, "id long, kind string, " + ", ".join(f"{c} double" for c in COLUMNS))
    found = copula.scores(given, model).select("place", "z").collect()
    want = []
    for _, kind, *values in rows:
        place, scores = model.classes.index(kind), []
        for value, table in zip(values, model.quantiles[place]):
            order = lambda v: math.inf if math.isnan(v) else v
            if value is not None:
                met = sum(q < order(value) for q in table[:-1]) + sum(q <= order(value) for q in table[:-1])
                scores.append(round(N.inv_cdf(min(max(met, 1), 2 * copula.GRID + 1) / (2 * copula.GRID + 2)), 6))
            else:
                scores.append(None)
        want.append((place, *scores))
    got = [(r.place, *[z if z is None else round(z, 6) for z in r.z]) for r in found]
    key = repr
    assert [tuple(0.0 if v == 0 else v for v in r) for r in sorted(got, key=key)] == [
        tuple(0.0 if v == 0 else v for v in r) for r in sorted(want, key=key)
    ]


def test_moments_hold_the_scores_of_missing_values(spark, source):
    model = copula.fit(source, "kind", COLUMNS)
    rows = copula.scores(source, model).collect()
    for place, (correlation, deviation) in enumerate(copula.moments(source, model)):
        z = np.array([[math.nan if v is None else v for v in r.z] for r in rows if r.place == place])
        for i in model.gaps:
            missing = model.nulls[place][i]
            low, high = (N.inv_cdf(p) if 0 < p < 1 else 0.0 for p in (missing / 2, (1 + missing) / 2))
            z = np.column_stack([z, np.where(np.isnan(z[:, i]), low, high)])
        assert z.shape[1] == model.size == len(correlation) > len(COLUMNS)
        for i in range(model.size):
            for j in range(model.size):
                a, b = (z[~np.isnan(z[:, [i, j]]).any(axis=1)][:, k] for k in (i, j))
                if len(a) and a.std() > 1e-6 and b.std() > 1e-6:
                    assert abs(np.corrcoef(a, b)[0, 1] - correlation[i, j]) < 1e-6
            own = z[~np.isnan(z[:, i])][:, i]
            assert abs((own.std() if len(own) else 0.0) - deviation[i]) < 1e-6


def test_limits(spark, source, monkeypatch):
    with pytest.raises(ValueError, match="no model of"):
        copula.draw(spark, copula.fit(source, "kind", ["income"]), {"z": 1}, 1)
    with pytest.raises(ValueError, match="no row has"):
        copula.fit(source.where("kind is null"), "kind", ["income"])
    monkeypatch.setattr(copula, "MODEL_CELLS", 1000)
    with pytest.raises(ValueError, match="too many"):
        copula.fit(source, "id", ["income"])


def _joins(plan):
    found = [plan] if plan.nodeName() == "Join" else []
    children = plan.children()
    return found + [j for i in range(children.size()) for j in _joins(children.apply(i))]


def test_repeats_bring_hashes_together_not_rows(spark, monkeypatch):
    """The joins of the draws and the source hold keys and hashes, however many columns a row has."""
    rows = [(i, *[None if (i + j) % 11 == 0 else float(i * j % 50) for j in range(len(synthetic._COLUMNS))], i % 2) for i in range(200)]
    clients = spark.createDataFrame(rows, ["id", *synthetic._COLUMNS, synthetic.TARGET])
    monkeypatch.setattr(synthetic, "credit_wide", lambda *_: clients)
    found = synthetic.copula_repeats(spark, "")
    joins = _joins(found._jdf.queryExecution().optimizedPlan())
    assert len(joins) == 3
    for join in joins:
        output = join.output()
        assert sum(output.apply(i).dataType().defaultSize() for i in range(output.size())) <= 100
    got = sorted(tuple(r) for r in found.collect())
    assert got == [(k, 500, 500, 0, True, 0) for k in (0, 1)]


def test_repeats_find_rows_of_the_source(spark, monkeypatch):
    """A source of one row only is drawn as it is; NULL cells and repeated rows count as they did."""
    row = [None if j % 3 == 0 else float(j) for j in range(len(synthetic._COLUMNS))]
    clients = spark.createDataFrame(
        [(i, *row, 1) for i in range(20)] + [(99, *row, None)],
        "id long, " + ", ".join(f"{c} double" for c in synthetic._COLUMNS) + f", {synthetic.TARGET} int",
    )
    monkeypatch.setattr(synthetic, "credit_wide", lambda *_: clients)
    assert [tuple(r) for r in synthetic.copula_repeats(spark, "").collect()] == [(1, 105, 105, 0, False, 105)]


def test_row_hash_tells_what_equality_tells(spark):
    values = [None, 0.0, -0.0, 1.0, float("nan"), -float("nan")]
    frame = spark.createDataFrame([(a, b) for a in values for b in values], "a double, b double")
    hashed = frame.select(F.struct("a", "b").alias("r"), *[checksums.row_hash([F.col("a"), F.col("b")], F.lit(s)).alias(f"h{s}") for s in (1, 2)])
    pairs = hashed.alias("x").crossJoin(hashed.alias("y"))
    for s in (1, 2):
        same = F.col(f"x.h{s}") == F.col(f"y.h{s}")
        assert pairs.filter(same != F.col("x.r").eqNullSafe(F.col("y.r"))).count() == 0
