"""Skew-safe operators against plain Spark on data with one hot key, at several widths."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from creditloom.functions.scalars import steady_round
from creditloom.operators import aggregates as A
from creditloom.operators import cleaning as C
from creditloom.operators import joins as J
from creditloom.operators import quantiles as QU
from creditloom.operators import sampling as Y
from creditloom.operators import slices
from creditloom.operators import windows as W


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third of the values are equal, some are NULL."""
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = 1 if i % 3 == 0 else rng.randrange(2, 40)
        value = 5.0 if i % 3 == 1 else None if i % 50 == 0 else round(rng.uniform(-20, 90), 2)
        rows.append((i, key, rng.randrange(500), value))
    return spark.createDataFrame(rows, "n bigint, key int, at int, value double").cache()


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plain_running(df, key, order):
    group = Window.partitionBy(key).orderBy(*order)
    previous = F.lag("value").over(group)
    so_far = group.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {
            "previous": previous,
            "change": F.col("value") - previous,
            "running_avg": steady_round(F.avg("value").over(so_far), 4),
        }
    )


@pytest.mark.parametrize("width, rows", [(1, 50), (3, 1_000_000), (8, 400)])
def test_rank_over_slices(spark, skewed, width, rows, monkeypatch):
    monkeypatch.setattr(slices, "SLICE_ROWS", rows)
    spark.conf.set("spark.sql.shuffle.partitions", width)
    order = Window.partitionBy("key").orderBy(F.col("value").desc_nulls_last())
    want = skewed.withColumn("place", F.rank().over(order).cast("bigint"))
    for hot_rows in (3, 100_000):
        got = W.rank_in_group(skewed, "key", "value", "place", hot_rows=hot_rows)
        assert same(got, want) and got.select("place").dtypes == [("place", "bigint")]
    spark.conf.set("spark.sql.shuffle.partitions", 4)


@pytest.mark.parametrize("width, rows", [(1, 50), (3, 1_000_000), (8, 400)])
def test_running_over_slices(spark, skewed, width, rows, monkeypatch):
    monkeypatch.setattr(slices, "SLICE_ROWS", rows)
    spark.conf.set("spark.sql.shuffle.partitions", width)
    got = W.running(skewed, "key", ["at", "n"], "value", "value", 4)
    rounded = lambda d: d.withColumn("change", F.round("change", 6))
    assert same(rounded(got), rounded(plain_running(skewed, "key", ["at", "n"])))
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_running_types_do_not_depend_on_the_size(spark, monkeypatch):
    rows = [(1, i, Decimal(i) / 10) for i in range(40)]
    df = spark.createDataFrame(rows, "key int, at int, value decimal(9,2)")
    schemas = set()
    for size in (5, 1_000_000):
        monkeypatch.setattr(slices, "SLICE_ROWS", size)
        schemas.add(W.running(df, "key", ["at"], "value", "value").schema.simpleString())
    assert schemas == {
        "struct<key:int,at:int,value:decimal(9,2),previous:decimal(9,2),change:decimal(9,2),running_avg:double>"
    }


def test_copies_of_one_row_are_cut_apart(spark):
    rows = spark.range(0, 4000, 1, 8).select(
        F.lit(1).alias("key"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("at"),
        F.when(F.col("id") % 3 == 0, 2.0).otherwise(F.col("id") * 1.0).alias("value"),
    )
    got = W.running(rows, "key", ["at"], "value", "value", 4)
    assert same(got, plain_running(rows, "key", ["at"]))


def largest_task(df):
    return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_a_hot_key_and_a_rare_class_are_spread(spark, monkeypatch):
    """No task gets more than its share of one key's rows, nor of one drawn row's draws."""
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hot = spark.range(40_000).select((F.col("id") % 4 == 3).cast("bigint").alias("key"), "id")
        dim = spark.createDataFrame([(0, "a"), (1, "b")], "key long, label string")
        joined = slices.deal_join(hot, dim, ["key"], hot_rows=500)
        assert joined.count() == 40_000 and largest_task(joined) < 12_000
        monkeypatch.setattr(Y, "HOT_ROWS", 500)
        monkeypatch.setattr(Y, "DRAWS_PER_BLOCK", 1000)
        rare = spark.range(1000).select("id", (F.col("id") == 0).cast("int").alias("label"))
        drawn = Y.resample(rare, ["id"], "label", 20_000, seed=1, balanced=True)
        assert drawn.filter("id = 0").count() == 10_000
        assert largest_task(drawn.filter("id = 0")) < 4_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_draws_are_never_broadcast(spark, skewed):
    """Blocks are few short rows and the draws they unfold into are not, whatever the planner takes them for."""
    df = skewed.withColumn("label", (F.col("n") % 5 == 0).cast("int"))
    drawn = Y.resample(df, ["n"], "label", 20_000, seed=3)
    assert len(drawn.collect()) == 20_000
    plan = drawn._jdf.queryExecution().executedPlan().toString()  # as it ran, and as it was before
    joins = [line for line in plan.splitlines() if "Join" in line and "__pick" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


def test_numbers_of_an_arbitrary_survivor_are_dense(spark):
    copies = spark.range(2000).select((F.col("id") % 300).alias("k"), (F.col("id") % 7).alias("v"))
    numbered = slices.number_rows(copies.repartition(8).dropDuplicates(["k"]), ["k"], "no", within=["v"])
    gaps = numbered.groupBy("v").agg(F.max("no").alias("m"), F.count("*").alias("n"))
    assert gaps.filter("m <> n").count() == 0
    assert numbered.schema["no"].metadata == {"hash_slices": slices.HASH_SLICES}


def test_quantiles_do_not_shuffle_the_unfolded_table(spark, skewed, monkeypatch):
    monkeypatch.setattr(QU, "ACCURACY", 100)
    for rows in (10, 5_000_000):
        monkeypatch.setattr(QU, "BRACKET_ROWS", rows)
        got = QU.exact_quantiles(skewed, ["value", "at"], [0.25, 0.5])
        want = {c: skewed.agg(F.percentile(c, F.array(F.lit(0.25), F.lit(0.5)))).first()[0] for c in ("value", "at")}
        assert {(r.name, r.prob): r.quantile for r in got.collect()} == pytest.approx(
            {(c, p): v for c, vs in want.items() for p, v in zip((0.25, 0.5), vs)}
        )
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionBy") == 0
    inside = skewed.filter("value IS NOT NULL").count()
    w = QU.Wanted("value", 0.25, inside)
    QU._bracket(skewed, [w], [(0, inside)])
    assert QU._counts(skewed, [w])[0][1] < 0.75 * inside  # a third of the values are equal


@pytest.mark.parametrize("width", [1, 5])
def test_exact_quantiles(spark, skewed, width):
    spark.conf.set("spark.sql.shuffle.partitions", width)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {
        (r.name, r.prob): r.quantile
        for r in QU.exact_quantiles(skewed, ["value", "at"], probs).collect()
    }
    for c in ("value", "at"):
        want = skewed.agg(F.percentile(c, F.array(*[F.lit(p) for p in probs]))).first()[0]
        assert [got[c, p] for p in probs] == pytest.approx(want)
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_sketch_stays_within_its_rank_error(skewed):
    values = sorted(r.at for r in skewed.select("at").collect())
    for row in QU.sketch_quantiles(skewed, ["at"], [0.25, 0.75], 0.01).collect():
        low = sum(v < row.quantile for v in values) / len(values)
        high = sum(v <= row.quantile for v in values) / len(values)
        assert low - 0.02 <= row.prob <= high + 0.02


def test_quantiles_of_an_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = QU.exact_quantiles(df, ["a", "b"], [0.5]).collect()
    assert [(r.name, r.quantile) for r in got] == [("a", 2.0)]
    assert [r.b for r in C.iqr_cap(df, ["a", "b"]).collect()] == [None, None]


def test_numbers_are_dense_and_stable(skewed):
    once = slices.number_rows(skewed, ["n"], "no")
    again = slices.number_rows(skewed.repartition(7), ["n"], "no")
    assert same(once, again)
    assert once.agg(F.min("no"), F.max("no"), F.count_distinct("no")).first() == (1, 3000, 3000)
    per_key = slices.number_rows(skewed, ["n"], "no", within=["key"])
    sizes = per_key.groupBy("key").agg(
        (F.max("no") - F.count("*")).alias("gap"), F.min("no").alias("low")
    )
    assert sizes.filter("gap <> 0 OR low <> 1").count() == 0


def test_resample_meets_its_quota_and_repeats(spark, skewed, monkeypatch):
    monkeypatch.setattr(Y, "DRAWS_PER_BLOCK", 700)
    df = skewed.withColumn("label", (F.col("n") % 5 == 0).cast("int"))
    quota = {r.label: r.quota for r in Y.class_quota(df, "label", 4000).collect()}
    assert quota == {0: 3200, 1: 800}
    drawn = Y.resample(df, ["n"], "label", 4000, seed=3)
    assert {r.label: r["count"] for r in drawn.groupBy("label").count().collect()} == quota
    assert same(drawn, Y.resample(df.repartition(5), ["n"], "label", 4000, seed=3))
    assert not same(drawn, Y.resample(df, ["n"], "label", 4000, seed=4))
    assert drawn.select("n").distinct().count() > 1500  # spread over the source rows
    even = Y.class_quota(df, "label", 4001, balanced=True)
    assert {r.quota for r in even.collect()} == {2000}
    fresh = Y.draw_as_key(drawn, "n", "id")
    assert "n" not in fresh.columns and "draw" not in fresh.columns
    assert fresh.filter("label = 1").agg(F.min("id")).first()[0] == 3201
    renumbered = Y.replace_key(skewed, "n", "id", ["n"])
    assert renumbered.columns[0] == "id" and "n" not in renumbered.columns
    assert fresh.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, 4000, 4000)


def test_ordered_dedup(skewed):
    few = skewed.select("key", "at", "value")
    order = Window.partitionBy("key").orderBy("at", "value")
    want = few.withColumn("r", F.row_number().over(order)).filter("r = 1").drop("r")
    assert same(C.dedup_ordered(few, ["key"]), want)
    stats = C.dedup_stats(few, ["key"]).first()
    assert stats.rows_before - stats.removed == stats.rows_after == want.count()


def test_latest_keeps_one_row_per_key(skewed):
    got = W.latest(skewed, ["key"], ["at", "n"])
    order = Window.partitionBy("key").orderBy(F.desc("at"), F.desc("n"))
    want = skewed.withColumn("r", F.row_number().over(order)).filter("r = 1").drop("r")
    assert same(got, want)


def test_orphans_are_counted_before_the_join(skewed):
    dim = skewed.select("key").filter("key <> 1").distinct()
    found = J.orphan_rows(skewed, dim, "key")
    assert found.first().violations == skewed.filter("key = 1").count()
    optimized = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {
        word: min(i for i, line in enumerate(optimized) if word in line)
        for word in ("Join LeftOuter", "Aggregate [key")
    }
    assert depth["Join LeftOuter"] < depth["Aggregate [key"]


def test_dimension_join_with_and_without_broadcast(spark, skewed):
    dim = skewed.groupBy("key").agg(F.max("at").alias("top"))
    small = J.dimension_join(skewed, dim, ["key"], bounded=True)
    assert same(small, J.dimension_join(skewed, dim, ["key"]))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_are_dealt_over_parts(skewed, how):
    dim = skewed.filter("key % 2 = 1").groupBy("key").agg(F.max("at").alias("top"))
    want = skewed.join(dim, "key", how)
    got = slices.deal_join(skewed, dim, ["key"], how, hot_rows=10)
    assert same(got, want)
    copies = skewed.select("key").unionByName(skewed.select("key"))
    assert same(
        slices.deal_join(copies, dim, ["key"], how, hot_rows=10), copies.join(dim, "key", how)
    )


def test_cube_equals_union_and_separates_null_labels(spark):
    rows = [("a", "x", 1), ("a", None, 0), (None, "y", 1), ("b", "x", None)]
    df = spark.createDataFrame(rows, "p string, q string, hit int")
    dims = {"first": "p", "second": "q"}
    cube = A.rate_cube(df, ["p", "q"], "hit")
    long = A.long_of_cube(cube, dims)
    assert same(long, A.rate_union(df, dims, "hit"))
    assert A.total_of_cube(cube, ["p", "q"]).first() == (round(2 / 3, 4), 4)
    nulls = long.filter("category IS NULL").collect()
    assert {(r.dimension, r.clients) for r in nulls} == {("first", 1), ("second", 1)}


def test_correlation_without_spread_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 2.0, 1.0)], "a double, b double, c double")
    row = df.agg(A.correlation("a", "b").alias("ab"), A.correlation("a", "c").alias("ac")).first()
    assert row.ab is None and row.ac == -1.0


def test_scores_and_scaling(spark):
    df = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0), (3.0, 4.0)], "v double, c double")
    scored = C.zscores(df, ["v", "c"]).orderBy("v").collect()
    assert [r.v_zscore for r in scored] == [-1.0, 0.0, 1.0]
    assert {r.c_zscore for r in scored} == {None}
    scaled = C.minmax(df, ["v", "c"]).orderBy("v").collect()
    assert [r.v_norm for r in scaled] == [0.0, 0.5, 1.0]
    assert {r.c_norm for r in scaled} == {0.0}
    empty = spark.createDataFrame([(None,), (None,)], "v double")
    assert {r.v for r in C.mean_impute(empty, ["v"]).collect()} == {None}
