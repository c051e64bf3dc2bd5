"""States per batch, merged, against the same over all rows."""

import random

import pytest
from pyspark.sql import functions as F

from creditloom.operators import aggregates as A
from creditloom.operators import cleaning as C
from creditloom.operators import states as S

SCHEMA = "k long, part int, x double, y double, z double, label string, hit int"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    made = []
    for i in range(3000):
        x = rng.choice([None, 1e9 + rng.random()])
        made.append((rng.randrange(2000), i % 5, x, None if x is None else 5 - x + rng.random(), 0.1, rng.choice(["a", "b", None]), rng.choice([0, 1, None])))
    return spark.createDataFrame(made, SCHEMA).repartition(4).cache()


def stored(spark, rows, folder, state):
    for part in range(5):
        S.save_batch(state(rows.where(f"part = {part}")), folder, part)
    S.save_batch(state(rows.where("part = 2")), folder, 2)  # again
    return S.saved(spark, folder)


def test_counts(spark, rows, shared):
    states = stored(spark, rows, shared("counts"), lambda d: A.label_counts(d, ["label"], "hit"))
    cells = S.merged_counts(states, ["label"], ["clients", "rated", "hits"])
    got, want = A.cube_of_cells(cells, ["label"]), A.rate_cube(rows, ["label"], "hit")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_moments(spark, rows, shared):
    names = {("x", "y"): "xy", ("x", "z"): "xz", ("x", "hit"): "xh"}
    states = stored(spark, rows, shared("moments"), lambda d: S.moment_state(d, list(names)))
    got = S.correlations_of(states, names, 6).first()
    want = rows.agg(*[A.correlation(x, y, 6).alias(n) for (x, y), n in names.items()]).first()
    assert got.xy == pytest.approx(want.xy, abs=2e-6) and got.xh == pytest.approx(want.xh, abs=2e-6)
    assert got.xz is None and want.xz is None
    assert S.correlations_of(S.moment_state(rows.limit(0), list(names)), names).first().xy is None


def test_sketches(spark, shared):
    rows = spark.range(200_000).selectExpr("id % 7 AS part", "CAST(hash(id) AS DOUBLE) AS x", "CAST(NULL AS DOUBLE) AS y")
    rows = rows.withColumn("x", F.when(F.col("part") < 5, F.col("x"))).cache()
    states = stored(spark, rows, shared("sketches"), lambda d: S.sketch_state(d, ["x", "y"]))
    fence = S.merged_fences(states).collect()
    assert [f["name"] for f in fence] == ["x"] and fence[0]["rows"] == rows.where("part < 5").count()
    n = fence[0]["rows"]
    for q, p in (("q1", 0.25), ("q3", 0.75)):
        assert abs(rows.where(F.col("x") <= fence[0][q]).count() / n - p) <= S.RANK_ERROR
    # one batch more reads none of the others
    plan = S.sketch_state(rows.where("part = 6"), ["x"])
    assert plan.collect() == []


def test_keys(spark, rows, shared):
    folder = shared("keys")
    planted = rows.select("k", "part").unionByName(rows.select(F.lit(None).cast("long").alias("k"), "part").limit(7))
    states = stored(spark, planted.cache(), folder, lambda d: S.key_state(d, "k"))
    got, want = S.key_counts(states).first(), C.dedup_stats(planted, ["k"]).first()
    assert tuple(got) == tuple(want)
    new = spark.createDataFrame([(5,), (40_000,), (40_000,), (None,), (90_000,)], "k long")
    known = planted.where("k = 5").count() > 0
    found = S.repeated_keys(states, S.key_state(new, "k")).first()
    assert (found.known, found.fresh) == ((1, 2) if known else (0, 3))
    S.check_density(states)
    sparse = S.key_state(spark.createDataFrame([(i * 10**9,) for i in range(50)], "k long"), "k")
    with pytest.raises(ValueError, match="densely"):
        S.check_density(sparse)
    assert tuple(S.key_counts(S.key_state(new.limit(0), "k")).first()) == (0, 0, 0)


def test_only_the_new_batch_is_read(spark, shared):
    folder = shared("fact")
    spark.range(100).selectExpr("id", "id % 4 AS month", "CAST(id AS DOUBLE) AS x").write.partitionBy("month").parquet(folder)
    batch = spark.read.parquet(folder).where("month = 3")
    for state in (S.sketch_state(batch, ["x"]), S.key_state(batch, "id"), S.moment_state(batch, [("x", "id")])):
        plan = state._jdf.queryExecution().executedPlan().toString()
        assert "(month#" in plan.split("PartitionFilters: ")[1].split("]")[0]
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
