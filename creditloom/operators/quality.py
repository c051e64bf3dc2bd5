"""Data-quality rules of the mart. Every rule is a count of violations; nothing is collected."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.cleaning import NUMERIC
from creditloom.vocabulary import TARGET


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(violations): keys that occur more than once."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("violations"))
    )


def outside(value: Column, allowed: list, null_is_outside: bool = False) -> Column:
    """True where a value is not among the allowed ones. NULL is not outside unless asked for."""
    verdict = ~value.isin(*allowed)
    return F.coalesce(verdict, F.lit(null_is_outside))


def fact_scan(fact: DataFrame, keys: list[str], label: str = TARGET) -> DataFrame:
    """All rules that look at one row at a time, in one aggregate."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return fact.agg(
        F.count("*").alias("n_rows"),
        F.count_if(null_key).alias("null_keys"),
        F.count_if(outside(F.col(label), [0, 1])).alias("bad_labels"),
        F.count_if(F.col("credit_utilization").isNull()).alias("null_utilization"),
        F.count_if(F.col("credit_utilization") < 0).alias("negative_utilization"),
    )


def mistyped(df: DataFrame, measures: list[str]) -> list[str]:
    """Measures whose type is not numeric; schema only, no job."""
    types = dict(df.dtypes)
    return [m for m in measures if m in types and types[m] not in NUMERIC]


def schema_report(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(column, expected, found, conforms) for a declared schema, with the rows it covers."""
    found = dict(df.dtypes)
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(t).alias("expected"),
            F.lit(found.get(c)).cast("string").alias("found"),
            F.lit(found.get(c) == t).alias("conforms"),
        )
        for c, t in expected.items()
    ]
    return df.agg(F.count("*").alias("n_rows")).select("n_rows", F.inline(F.array(*rows)))


# Names of the rules and of their details.
RULES = (
    "uniqueness_id_date",
    "not_null_keys",
    "range_checks",
    "dtype_consistency",
    "referential_integrity",
    "distribution_default_rate",
)


def keyed_scan(
    fact: DataFrame, dim_client: DataFrame, dim_date: DataFrame, keys: list[str], label: str = TARGET
) -> DataFrame:
    """One row with every count over the fact, from one scan grouped by its keys.

    Duplicates, NULL keys, ranges and orphans of both dimensions are all sums over that one grouping.
    A key that is hot in the fact is a few rows after it. A NULL key is an orphan as well. The calendar
    is small by nature; the client dimension is joined by key.
    """
    client, date = keys
    grouped = fact.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count_if(outside(F.col(label), [0, 1])).alias("bad_labels"),
        F.count_if(F.col("credit_utilization").isNull()).alias("null_utilization"),
        F.count_if(F.col("credit_utilization") < 0).alias("negative_utilization"),
    )
    dates = dim_date.select(F.col(date).alias("__date")).distinct()
    clients = dim_client.select(F.col(client).alias("__client")).distinct()
    placed = grouped.join(F.broadcast(dates), grouped[date] == dates["__date"], "left")
    placed = placed.join(clients, placed[client] == clients["__client"], "left")

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    def summed(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return placed.agg(
        F.count_if(F.col("n") > 1).alias("duplicates"),
        rows(F.col(client).isNull() | F.col(date).isNull()).alias("null_keys"),
        summed("bad_labels"),
        summed("null_utilization"),
        summed("negative_utilization"),
        rows(F.col("__date").isNull()).alias("orphan_dates"),
        rows(F.col("__client").isNull()).alias("orphan_clients"),
    )


def rule_report(
    fact: DataFrame,
    dim_client: DataFrame,
    dim_date: DataFrame,
    keys: tuple[str, str] = ("id", "date_key"),
    measures: tuple[str, ...] = ("bill_amt", "pay_amt", "limit_bal"),
    label: str = TARGET,
) -> DataFrame:
    """(rule, violations, details, pass) of the six rules; ``details`` is a JSON text or NULL."""
    wrong = mistyped(fact, list(measures))
    found = dict(fact.dtypes)
    kinds = sorted({found[m] for m in measures if m in found})
    share = dim_client.agg(F.avg(label).alias("r")).scalar()
    details = {
        "range_checks": F.struct(F.col("negative_utilization").alias("neg_utilization_kept")),
        "dtype_consistency": F.struct(F.array(*[F.lit(k) for k in kinds]).alias("types")),
        "referential_integrity": F.struct("orphan_dates", "orphan_clients"),
        "distribution_default_rate": F.struct(
            F.round(F.coalesce(share, F.lit(0.0)), 4).alias("default_rate")
        ),
    }
    violations = (
        F.col("duplicates"),
        F.col("null_keys"),
        F.col("bad_labels") + F.col("null_utilization"),
        F.lit(len(wrong)),
        F.col("orphan_dates") + F.col("orphan_clients"),
        F.when((share > 0) & (share < 1), 0).otherwise(1),
    )
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            count.cast("bigint").alias("violations"),
            (F.to_json(details[rule]) if rule in details else F.lit(None).cast("string")).alias("details"),
        )
        for rule, count in zip(RULES, violations)
    ]
    report = keyed_scan(fact, dim_client, dim_date, list(keys), label).select(F.inline(F.array(*rows)))
    return report.withColumn("pass", F.col("violations") == 0)


def source_rule(lost: DataFrame) -> DataFrame:
    """A seventh row for a report: values of the source that its types could not hold."""
    n = F.coalesce(F.sum("lost"), F.lit(0)).cast("bigint")
    return lost.agg(n.alias("violations")).select(
        F.lit("source_values").alias("rule"),
        "violations",
        F.lit(None).cast("string").alias("details"),
        (F.col("violations") == 0).alias("pass"),
    )


def gate(report: DataFrame) -> DataFrame:
    """(rules, all_pass): the verdict a job turns into its exit code."""
    return report.agg(F.count("*").alias("rules"), F.bool_and("pass").alias("all_pass"))
