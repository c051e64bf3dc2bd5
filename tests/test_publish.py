"""Publication in one step: failures, reruns, pruning, clean-up."""

import uuid

import pytest
from pyspark.sql import functions as F

from creditloom.sinks import publish


@pytest.fixture
def database(spark, shared):
    name = f"pub_{uuid.uuid4().hex[:8]}"
    publish.create_database(spark, name, shared(name))
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def fact(spark, n):
    return spark.range(n).selectExpr("CAST(id % 3 AS INT) AS month", "id", "id * 2 AS amount")


def rows(spark, database, name="fact"):
    return spark.table(f"{database}.{name}").count()


def test_failed_load_leaves_the_old_answer(spark, database):
    small = spark.range(3).withColumnRenamed("id", "k")
    assert publish.current(spark, database) == (0, None)
    assert publish.publish_tables(spark, database, {"dim": (small, []), "fact": (fact(spark, 30), ["month"])}) == 1
    first = publish.current(spark, database)
    dying = fact(spark, 60).withColumn("amount", F.when(F.col("id") == 59, F.raise_error(F.lit("x"))).otherwise(1).cast("long"))
    with pytest.raises(Exception, match="x"):
        publish.publish_tables(spark, database, {"dim": (small.limit(1), []), "fact": (dying, ["month"])})
    assert publish.current(spark, database) == first
    assert (rows(spark, database), rows(spark, database, "dim")) == (30, 3)
    assert publish.publish_tables(spark, database, {"dim": (small.limit(1), []), "fact": (fact(spark, 60), ["month"])}) == 2
    assert (rows(spark, database), rows(spark, database, "dim")) == (60, 1)
    assert spark.table(f"{database}.fact").columns == ["month", "id", "amount"]
    assert len(publish.drop_attempts(spark, database, keep=1)) == 2
    assert (rows(spark, database), rows(spark, database, "dim")) == (60, 1)


def test_first_load_fails(spark, database):
    dying = fact(spark, 5).withColumn("amount", F.raise_error(F.lit("x")).cast("long"))
    with pytest.raises(Exception, match="x"):
        publish.publish_tables(spark, database, {"fact": (dying, ["month"])})
    assert publish.current(spark, database) == (0, None)
    publish.publish_tables(spark, database, {"fact": (fact(spark, 5), ["month"])})
    assert rows(spark, database) == 5


def test_only_the_current_attempt_is_read(spark, database):
    for n in (10, 20):
        publish.publish_tables(spark, database, {"fact": (fact(spark, n), ["month"])})
    seen = spark.table(f"{database}.fact").where("month = 1")
    assert seen.count() == 7
    plan = seen._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("FileScan parquet")[1:] if "amount" in x)
    filters = scan.split("PartitionFilters: [")[1].split("DataFilters")[0]
    assert "attempt" in filters and "month" in filters


def test_months_rewritten_alone(spark, database):
    publish.publish_tables(spark, database, {"fact": (fact(spark, 30), ["month"])})
    again = fact(spark, 30).where("month = 2").withColumn("amount", F.lit(0).cast("long"))
    for _ in range(2):
        publish.rewrite_partitions(spark, database, "fact", again)
    found = {r.month: (r.n, r.s) for r in spark.table(f"{database}.fact").groupBy("month").agg(F.count("*").alias("n"), F.sum("amount").alias("s")).collect()}
    assert found == {0: (10, 270), 1: (10, 290), 2: (10, 0)}
    with pytest.raises(ValueError, match="nothing is published"):
        name = f"pub_{uuid.uuid4().hex[:8]}"
        publish.create_database(spark, name, f"/tmp/{name}")
        publish.rewrite_partitions(spark, name, "fact", again)
