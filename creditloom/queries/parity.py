"""The large tables of both paths, compared by checksums and cell by cell."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.operators import checksums
from creditloom.queries.marts import fact_b, mart
from creditloom.queries.registry import query
from creditloom.queries.sql import with_ctes
from creditloom.session import materialise
from creditloom.vocabulary import TARGET

_KEY = ["id", "date_key"]
_CELLS = ["limit_bal", "pay_status", "bill_amt", "pay_amt", TARGET, "credit_utilization", "payment_ratio"]


def _apart(a: str, b: str) -> str:
    return f"round({a}::DOUBLE, 6) IS DISTINCT FROM round({b}::DOUBLE, 6)"


@query(
    "fact_parity",
    with_ctes(
        "SELECT \"column\", sum(apart)::BIGINT AS cells FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CASE WHEN {_apart(f'a.{c}', f'b.{c}')} THEN 1 ELSE 0 END AS apart "
            "FROM fact a JOIN elt_fact b ON a.id = b.id AND a.date_key = b.date_key"
            for c in _CELLS
        )
        + ") GROUP BY \"column\" HAVING sum(apart) > 0",
        "fact",
        "elt_fact",
    ),
)
def fact_parity(spark, sf):
    """How many cells of each column the monthly facts of path A and path B have apart."""
    a, b = (materialise(f.select(*_KEY, *_CELLS), "fact") for f in (mart(spark, sf).fact, fact_b(spark, sf)))
    return checksums.differing_cells(a, b, _KEY, _CELLS).groupBy("column").agg(F.count("*").alias("cells"))


_CHANGED = "id % 97 = 5 AND date_key % 100 = 6"
_LOST = "id % 101 = 7 AND date_key % 100 = 9"
_TWICE = "id % 89 = 3 AND date_key % 100 = 4"


@query(
    "fact_parity_planted",
    with_ctes(
        "SELECT id, date_key, 'bill_amt' AS \"column\", round(bill_amt * 100)::BIGINT AS cents_a, "
        f"round((coalesce(bill_amt, 0) + 1) * 100)::BIGINT AS cents_b FROM elt_fact WHERE {_CHANGED} UNION ALL "
        f"SELECT id, date_key, NULL, 1, 0 FROM elt_fact WHERE {_LOST} UNION ALL "
        f"SELECT id, date_key, NULL, 0, 1 FROM elt_fact WHERE {_TWICE}",
        "elt_fact",
    ),
)
def fact_parity_planted(spark, sf):
    """Changed, lost and repeated rows planted in a copy of the fact are found, and nothing else."""
    fact = materialise(fact_b(spark, sf), "fact")
    bill = F.when(F.expr(_CHANGED), F.coalesce("bill_amt", F.lit(0.0)) + 1).otherwise(F.col("bill_amt"))
    other = fact.filter(f"NOT ({_LOST})").withColumn("bill_amt", bill)
    other = materialise(other.unionByName(other.filter(_TWICE)), "other")
    trees = tuple(materialise(checksums.tree(t, _KEY, _CELLS), "tree") for t in (fact, other))
    found = checksums.differing_cells(fact, other, _KEY, _CELLS, trees=trees)
    amount = F.col("column") == "bill_amt"
    return found.select(
        *_KEY,
        "column",
        *[
            F.when(amount, F.round(F.col(f"value_{s}").cast("double") * 100))
            .otherwise(F.col(f"value_{s}").cast("double"))
            .cast("bigint")
            .alias(f"cents_{s}")
            for s in "ab"
        ],
    )
