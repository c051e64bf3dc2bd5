"""Loads that are published in one step, and partitions that are rewritten alone."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from creditloom.bindings import ANCHOR_YEAR, table
from creditloom.queries.marts import fact_b
from creditloom.queries.registry import query
from creditloom.queries.sql import with_ctes
from creditloom.session import materialise, scratch_path
from creditloom.sinks import publish


def _database(spark):
    name = f"published_{uuid.uuid4().hex[:10]}"
    publish.create_database(spark, name, scratch_path(spark, name))
    return name


def _seen(spark, database, step):
    orders, parts = (spark.table(f"{database}.{t}") for t in ("orders", "parts"))
    return materialise(
        orders.agg(F.count("*").alias("orders"), F.sum("o_orderkey").alias("keys")).select(
            F.lit(step).alias("step"), "orders", "keys", parts.agg(F.count("*").alias("n")).scalar().alias("parts")
        ),
        "seen",
    )


_STEP = "SELECT '{0}' AS step, count(*) AS orders, CAST(sum(o_orderkey) AS BIGINT) AS keys, (SELECT count(*) FROM part {2}) AS parts FROM orders {1}"


@query(
    "publish_interrupted",
    " UNION ALL ".join(
        [
            _STEP.format("first", "WHERE o_orderkey % 2 = 0", "WHERE p_size < 20"),
            _STEP.format("after failure", "WHERE o_orderkey % 2 = 0", "WHERE p_size < 20"),
            _STEP.format("second", "", ""),
        ]
    ),
)
def publish_interrupted(spark, sf):
    """A first load, a second that dies after one of its two tables, the second again: what readers see after each."""
    database = _database(spark)
    orders, parts = table(spark, sf, "orders"), table(spark, sf, "part")
    first = {"parts": (parts.filter("p_size < 20"), []), "orders": (orders.filter("o_orderkey % 2 = 0"), [])}
    publish.publish_tables(spark, database, first)
    seen = [_seen(spark, database, "first")]
    failing = F.when(F.col("o_orderkey") % 7 == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("o_orderkey"))
    try:
        dying = orders.withColumn("o_orderkey", failing.cast("bigint"))
        publish.publish_tables(spark, database, {"parts": (parts, []), "orders": (dying, [])})
    except Exception:  # what Spark raises for a failed write differs by version
        seen.append(_seen(spark, database, "after failure"))
    publish.publish_tables(spark, database, {"parts": (parts, []), "orders": (orders, [])})
    seen.append(_seen(spark, database, "second"))
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


_AGAIN = ANCHOR_YEAR * 100 + 7


@query(
    "month_rewritten",
    with_ctes(
        f"SELECT date_key, count(*) AS rows, CAST(sum(round(bill_amt * 100)::BIGINT * CASE WHEN date_key = {_AGAIN} "
        f"THEN 2 ELSE 1 END) AS BIGINT) AS cents, date_key <> {_AGAIN} AS same_files FROM elt_fact GROUP BY date_key",
        "elt_fact",
    ),
)
def month_rewritten(spark, sf):
    """One month arrives again with doubled bills, twice; the files of the other months stay as they are."""
    database, by = _database(spark), ["date_key"]
    fact = materialise(fact_b(spark, sf), "elt_fact")
    publish.publish_tables(spark, database, {"fact": (fact, by)})

    def state(name):
        stored = spark.table(f"{database}.fact{publish.STORED}")
        file = F.struct("_metadata.file_path", "_metadata.file_modification_time")
        return materialise(stored.groupBy(*by).agg(F.sort_array(F.collect_set(file)).alias(name)), name)

    before = state("before")
    month = fact.filter(F.col("date_key") == _AGAIN).withColumn("bill_amt", F.col("bill_amt") * 2)
    for _ in range(2):
        publish.rewrite_partitions(spark, database, "fact", month)
    cents = F.sum(F.round(F.col("bill_amt") * 100).cast("bigint"))
    found = spark.table(f"{database}.fact").groupBy(*by).agg(F.count("*").alias("rows"), cents.alias("cents"))
    return found.join(before, by).join(state("after"), by).select(
        *by, "rows", "cents", (F.col("before") == F.col("after")).alias("same_files")
    )
