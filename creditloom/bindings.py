"""How the given tables stand in for the inputs of a credit-risk mart.

``credit_wide``   one row per customer with six months of history spread over columns
``macro_long``    (series, date text, value text) observations derived from orders
``client_events`` the event table under client / period / amount names

Money is summed as whole cents, so sums do not depend on the order in which tasks finish.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.vocabulary import HISTORY, MISSING_MARKER, SERIES_COLUMNS, TARGET

# Year the monthly keys are anchored at; it lies inside the order dates.
ANCHOR_YEAR = 1998


# Types of the given tables, so that no read starts with a job that looks at file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


# Money in whole cents.
CENTS = "CAST(round({0} * 100) AS BIGINT)"


def _month_columns() -> str:
    """Three columns per billing month, NULL for a client without an order in that month."""
    columns = []
    for month, (status, bill, paid) in HISTORY.items():
        here = f"FILTER (WHERE slot = {month})"
        net = f"sum(status) {here}"
        columns += [
            f"CAST(CASE WHEN {net} < -2 THEN -2 WHEN {net} > 9 THEN 9 ELSE {net} END AS INT) "
            f"AS {status}",
            f"sum(cents) {here} / 100.0D AS {bill}",
            f"sum(quantity) {here} * 1000.0D AS {paid}",
        ]
    return ",\n".join(columns)


def credit_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items are summed per order before the join and orders per client after it, so a hot
    order or client is combined where it is read and never travels row by row."""
    months = [c for position in zip(*HISTORY.values()) for c in position]
    return spark.sql(
        f"""
        SELECT c_custkey AS id,
               CASE WHEN c_custkey % 50 = 0 THEN 0.0D ELSE abs(c_acctbal) * 100 END AS limit_bal,
               CAST(c_custkey % 3 AS INT) AS sex,
               CAST(c_custkey % 7 AS INT) AS education,
               CAST(c_custkey % 4 AS INT) AS marriage,
               CAST(15 + c_custkey % 90 AS INT) AS age,
               {", ".join(months)},
               CAST((c_custkey * 7919) % 100 < 22 AS INT) AS {TARGET}
        FROM {{customer}} LEFT JOIN (
            SELECT o_custkey, {_month_columns()}
            FROM (
                SELECT o_custkey,
                       (month(o_orderdate) - 1) % 6 + 4 AS slot,
                       CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN -1 ELSE 0 END AS status,
                       CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END
                           * {CENTS.format("o_totalprice")} AS cents,
                       quantity
                FROM {{orders}} LEFT JOIN (
                    SELECT l_orderkey, sum(l_quantity) AS quantity
                    FROM {{lineitem}} GROUP BY l_orderkey
                ) ON o_orderkey = l_orderkey
            )
            GROUP BY o_custkey
        ) ON c_custkey = o_custkey
        """,
        customer=table(spark, sf_dir, "customer"),
        orders=table(spark, sf_dir, "orders"),
        lineitem=table(spark, sf_dir, "lineitem"),
    )


def credit_per_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide client rows, one per order, for timings: at scale 0.1 as many as the published runs had.

    The history is arithmetic on the order; the same 25 columns as ``credit_wide``.
    """
    price, key = "o_totalprice", "o_orderkey"
    months = []
    for m, (status, bill, paid) in HISTORY.items():
        months += [
            f"CAST(pmod(hash({key}, {m}), 7) - 2 AS INT) AS {status}",
            f"round({price} * pmod(hash({m}, {key}), 97) / 50, 2) - 900.0D AS {bill}",
            f"round({price} * pmod(hash({m}, {key}, 1), 31) / 100, 2) AS {paid}",
        ]
    return table(spark, sf_dir, "orders").selectExpr(
        f"{key} AS id",
        f"CAST({price} * 2 AS DOUBLE) AS limit_bal",
        f"CAST(pmod({key}, 3) AS INT) AS sex",
        f"CAST(pmod({key}, 7) AS INT) AS education",
        f"CAST(pmod({key}, 4) AS INT) AS marriage",
        f"CAST(15 + pmod({key}, 90) AS INT) AS age",
        *months,
        f"CAST(pmod({key} * 7919, 100) < 22 AS INT) AS {TARGET}",
    )


def macro_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two observations per series and month: mean order price of each half month, as text.

    The leading digit of an order priority picks the series; the fifth is one the mart ignores.
    """
    series = ", ".join(f"'{s}'" for s in [*SERIES_COLUMNS, "OTHER"])
    return spark.sql(
        f"""
        SELECT series_id,
               concat_ws('-', substr(stamp, 1, 4), substr(stamp, 5, 2), substr(stamp, 7, 2))
                   AS obs_date,
               CASE WHEN stamp % 11 = 0 THEN '{MISSING_MARKER}'
                    ELSE concat(mean div 100, '.', lpad(mean % 100, 2, '0')) END AS value
        FROM (
            SELECT element_at(array({series}), CAST(substr(o_orderpriority, 1, 1) AS INT))
                       AS series_id,
                   year(o_orderdate) * 10000 + month(o_orderdate) * 100
                       + CASE WHEN day(o_orderdate) < 15 THEN 1 ELSE 15 END AS stamp,
                   (2 * sum({CENTS.format("o_totalprice")}) + count(*)) div (2 * count(*)) AS mean
            FROM {{orders}} GROUP BY 1, 2
        )
        """,
        orders=table(spark, sf_dir, "orders"),
    )


def client_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        "ts",
        "event_id",
        F.to_date("ts").alias("period"),
        F.col("value").alias("amount"),
    )
