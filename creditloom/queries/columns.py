"""Names, cleaning, reshaping and scalar features."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.bindings import ANCHOR_YEAR, credit_wide, macro_long, table
from creditloom.functions import names as N
from creditloom.functions import scalars as S
from creditloom.operators import cleaning as C
from creditloom.operators import reshape as R
from creditloom.operators.quantiles import exact_quantiles
from creditloom.plans import mart as M
from creditloom.queries.marts import macro_b
from creditloom.queries.registry import query
from creditloom.queries.sql import (
    FEATURES,
    age_case,
    mean,
    month_case,
    ratios,
    with_ctes,
)
from creditloom.session import materialise
from creditloom.vocabulary import (
    AGE_RANGE,
    BILL_COLUMNS,
    CAPPED_COLUMNS,
    HISTORY,
    INDICATORS,
    MONTH_NAMES,
    SCALED_INDICATORS,
    SERIES_COLUMNS,
    TARGET,
)

# --- names and predicates ---------------------------------------------------------------------------


@query(
    "rename_snake",
    "SELECT c_custkey AS id, c_acctbal AS limit_bal, c_nationkey AS pay_0, "
    f"c_mktsegment AS bill_amt1, CAST(c_custkey % 2 AS INT) AS {TARGET} FROM customer",
)
def rename_snake(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.col("c_acctbal").alias(" LIMIT_BAL "),
        F.col("c_nationkey").alias("PAY-0"),
        F.col("c_mktsegment").alias("Bill__Amt1"),
        (F.col("c_custkey") % 2).cast("int").alias("default.payment.next.month"),
    )
    return N.standardise_columns(raw)


@query(
    "rename_safe",
    "SELECT c_custkey AS id, c_acctbal AS limit_bal_nt, c_nationkey AS pay_0, "
    "c_mktsegment AS market_segment FROM customer",
)
def rename_safe(spark, sf):
    raw = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.col("c_acctbal").alias("LIMIT_BAL (NT$)"),
        F.col("c_nationkey").alias("PAY--0"),
        F.col("c_mktsegment").alias("_Market  Segment_"),
    )
    return N.rename_all(raw, N.warehouse_name)


@query(
    "string_normalise",
    "SELECT p_partkey, lower(regexp_replace(trim(p_name), '[\\s.\\-_]+', '_', 'g')) AS name, "
    "lower(regexp_replace(trim(p_brand || ' - ' || p_type), '[\\s.\\-_]+', '_', 'g')) AS kind, "
    "lpad(CAST(p_size AS VARCHAR), 3, '0') AS size_text FROM part",
)
def string_normalise(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        S.normalised_text(F.col("p_name")).alias("name"),
        S.normalised_text(F.concat_ws(" - ", "p_brand", "p_type")).alias("kind"),
        F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size_text"),
    )


@query(
    "json_decode_props",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, "
    "'{\"k\":' || json_extract(props, '$.k') || '}' AS props_again FROM events",
)
def json_decode_props(spark, sf):
    decoded = F.from_json("props", "k int")
    return table(spark, sf, "events").select(
        "event_id", decoded["k"].alias("k"), F.to_json(decoded).alias("props_again")
    )


# --- duplicates -----------------------------------------------------------------------------------------

_LINE = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
_LINE_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _LINE[2:])


@query(
    "dedup_pk",
    f"SELECT {', '.join(_LINE)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, "
    f"l_linenumber ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1",
)
def dedup_pk(spark, sf):
    return C.dedup_ordered(
        table(spark, sf, "lineitem").select(*_LINE), ["l_orderkey", "l_linenumber"]
    )


_DEDUP_STATS = (
    "SELECT count(*) AS rows_before, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_after, "
    "count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS removed FROM lineitem"
)


@query("dedup_stats", _DEDUP_STATS)
def dedup_stats(spark, sf):
    return C.dedup_stats(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# --- missing values ---------------------------------------------------------------------------------------


@query("fill_by_dtype", with_ctes("SELECT * FROM filled", "filled"))
def fill_by_dtype(spark, sf):
    return C.fill_numeric(credit_wide(spark, sf), 0, keep_null=("id",))


@query(
    "fill_keep_label",
    with_ctes(
        "SELECT id, coalesce(pay_0, 0) AS pay_0, coalesce(bill_amt1, 0) AS bill_amt1, pay_amt1 "
        "FROM credit_wide",
        "credit_wide",
    ),
)
def fill_keep_label(spark, sf):
    few = credit_wide(spark, sf).select("id", "pay_0", "bill_amt1", "pay_amt1")
    return C.fill_numeric(few, 0, keep_null=("id", "pay_amt1"))


@query(
    "mean_impute",
    with_ctes(
        "SELECT date_key, "
        + ", ".join(f"round(coalesce({c}, avg({c}) OVER ()), 4) AS {c}" for c in INDICATORS)
        + " FROM macro_monthly",
        "macro_monthly",
    ),
)
def mean_impute(spark, sf):
    filled = C.mean_impute(macro_b(spark, sf), INDICATORS)
    return filled.withColumns({c: F.round(c, 4) for c in INDICATORS})


# --- outliers -----------------------------------------------------------------------------------------------

_EVENT_FENCE = (
    "SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events"
)


@query(
    "iqr_cap",
    "SELECT event_id, round(CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1) "
    "WHEN value > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE value END, 6) AS value "
    f"FROM events, ({_EVENT_FENCE})",
)
def iqr_cap(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return C.iqr_cap(events, ["value"]).withColumn("value", F.round("value", 6))


@query(
    "iqr_fences",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS name, round(quantile_cont({c}, 0.25), 6) AS q1, "
            f"round(quantile_cont({c}, 0.75), 6) AS q3, "
            f"round(2.5 * quantile_cont({c}, 0.25) - 1.5 * quantile_cont({c}, 0.75), 6) AS low, "
            f"round(2.5 * quantile_cont({c}, 0.75) - 1.5 * quantile_cont({c}, 0.25), 6) AS high "
            "FROM filled"
            for c in CAPPED_COLUMNS
        ),
        "filled",
    ),
)
def iqr_fences(spark, sf):
    filled = materialise(C.fill_numeric(credit_wide(spark, sf), 0, keep_null=("id",)), "filled")
    fences = C.iqr_fences(filled, CAPPED_COLUMNS)
    return fences.select("name", *[F.round(c, 6).alias(c) for c in ("q1", "q3", "low", "high")])


@query(
    "iqr_cap_approx",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS outside_band FROM events WHERE value IS NOT NULL",
)
def iqr_cap_approx(spark, sf):
    """Sketch quartiles stay inside the exact ones at ranks off by the allowed error, row by row."""
    events = table(spark, sf, "events").select("event_id", "value").filter("value IS NOT NULL")
    events = materialise(events, "events")
    capped = C.iqr_cap(events, ["value"], error=0.01).withColumnRenamed("value", "capped")
    probs = [0.24, 0.26, 0.74, 0.76]
    exact = {r["prob"]: r["quantile"] for r in exact_quantiles(events, ["value"], probs).collect()}
    first, below, above, third = (exact[p] for p in probs)  # bounds of either quartile
    widest, least = 1.5 * (third - first), 1.5 * (above - below)

    def clamped(low, high):
        return F.least(F.greatest("value", F.lit(low)), F.lit(high))

    lower = clamped(first - widest, above + least) - 1e-9
    upper = clamped(below - least, third + widest) + 1e-9
    inside = F.col("capped").between(lower, upper)
    joined = events.join(capped, "event_id")
    return joined.agg(F.count("*").alias("n_rows"), F.count_if(~inside).alias("outside_band"))


@query(
    "clamp_age",
    with_ctes(
        "SELECT id, CASE WHEN age < 18 THEN 18 WHEN age > 100 THEN 100 ELSE age END AS age "
        "FROM credit_wide",
        "credit_wide",
    ),
)
def clamp_age(spark, sf):
    return C.clamp_column(credit_wide(spark, sf).select("id", "age"), "age", *AGE_RANGE)


@query(
    "zscore_macro",
    with_ctes(
        "SELECT date_key, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 3) AS {c}_zscore"
            for c in INDICATORS
        )
        + " FROM macro_monthly",
        "macro_monthly",
    ),
)
def zscore_macro(spark, sf):
    scored = C.zscores(macro_b(spark, sf), INDICATORS)
    return scored.select("date_key", *[f"{c}_zscore" for c in INDICATORS])


def _outliers_sql(table_name, column):
    return (
        f"SELECT '{column}' AS name, count(*) AS n_rows, count(*) FILTER (abs(round(({column} - m) "
        f"/ s, 3)) > 3) AS n_outliers FROM {table_name}, (SELECT avg({column}) AS m, "
        f"stddev_samp({column}) AS s FROM {table_name})"
    )


@query(
    "zscore_outliers",
    _outliers_sql("events", "value")
    + " UNION ALL "
    + _outliers_sql("lineitem", "l_extendedprice"),
)
def zscore_outliers(spark, sf):
    events = C.outlier_counts(table(spark, sf, "events"), ["value"])
    return events.unionByName(
        C.outlier_counts(table(spark, sf, "lineitem"), ["l_extendedprice"])
    )


@query(
    "minmax_norm",
    with_ctes(
        "SELECT date_key, "
        + ", ".join(
            f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 4) "
            f"AS {c}_norm"
            for c in SCALED_INDICATORS
        )
        + ", 0.0::DOUBLE AS constant_norm FROM macro_monthly",
        "macro_monthly",
    ),
)
def minmax_norm(spark, sf):
    macro = macro_b(spark, sf).withColumn("constant", F.lit(7.5))
    columns = [*SCALED_INDICATORS, "constant"]
    return C.minmax(macro, columns).select("date_key", *[f"{c}_norm" for c in columns])


_PROFILED = ["limit_bal", "age", "bill_amt1", "pay_amt6"]


@query(
    "column_profile",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT '{c}' AS name, count({c}) AS n, count(*) - count({c}) AS n_null, "
            f"{mean(c, 4)} AS mean, round(stddev_samp({c}), 4) AS sd, "
            f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM credit_wide"
            for c in _PROFILED
        ),
        "credit_wide",
    ),
)
def column_profile(spark, sf):
    return C.profile(credit_wide(spark, sf), _PROFILED)


# --- reshaping ------------------------------------------------------------------------------------------------

_GROUPS = {ANCHOR_YEAR * 100 + m: cols for m, cols in HISTORY.items()}


@query(
    "unpivot_struct",
    with_ctes("SELECT id, date_key, pay_status, bill_amt, pay_amt FROM long_raw", "long_raw"),
)
def unpivot_struct(spark, sf):
    return R.unpivot_groups(credit_wide(spark, sf), ["id"], "date_key", M.MEASURES, _GROUPS)


@query(
    "unpivot_stack",
    with_ctes("SELECT * FROM elt_fact", "elt_fact"),
)
def unpivot_stack(spark, sf):
    """The monthly fact of path B as one SQL statement."""
    stack = R.stack_sql(_GROUPS, ["INT", "DOUBLE", "DOUBLE"])
    return spark.sql(
        f"""
        SELECT id, date_key, limit_bal, pay_status, bill_amt, pay_amt, {TARGET},
               round(bill_amt / nullif(limit_bal, 0), 4) AS credit_utilization,
               round(pay_amt / nullif(bill_amt, 0), 4) AS payment_ratio
        FROM {{credit}} LATERAL VIEW {stack} m AS date_key, pay_status, bill_amt, pay_amt
        """,
        credit=credit_wide(spark, sf),
    )


@query(
    "unpivot_single",
    with_ctes(
        " UNION ALL ".join(
            f"SELECT id, '{c}' AS position, {c} AS bill_amt FROM credit_wide" for c in BILL_COLUMNS
        ),
        "credit_wide",
    ),
)
def unpivot_single(spark, sf):
    return R.unpivot_one(credit_wide(spark, sf), ["id"], BILL_COLUMNS, "position", "bill_amt")


@query("macro_pivot_case", with_ctes("SELECT * FROM macro_monthly", "macro_monthly"))
def macro_pivot_case(spark, sf):
    return macro_b(spark, sf)


def _pivot(spark, sf, series):
    return R.pivot_named(
        macro_long(spark, sf).filter(S.observed(F.col("value"))),
        [S.month_key_of_text(F.col("obs_date")).alias("date_key")],
        series,
        "series_id",
        S.parse_number(F.col("value")),
    )


@query("macro_pivot_api", with_ctes("SELECT * FROM macro_monthly", "macro_monthly"))
def macro_pivot_api(spark, sf):
    return _pivot(spark, sf, SERIES_COLUMNS)


@query(
    "macro_pivot_absent_series",
    with_ctes(
        "SELECT date_key, exchange_rate_twd_usd, CAST(NULL AS DOUBLE) AS absent_series "
        "FROM macro_monthly",
        "macro_monthly",
    ),
)
def macro_pivot_absent_series(spark, sf):
    return _pivot(spark, sf, {"EXTAUS": "exchange_rate_twd_usd", "NOSUCH": "absent_series"})


@query("macro_dense_spine", with_ctes("SELECT * FROM spine", "spine"))
def macro_dense_spine(spark, sf):
    calendar = M.calendar_year(spark, ANCHOR_YEAR)
    return R.macro_spine(macro_long(spark, sf), calendar, SERIES_COLUMNS)


@query(
    "macro_last_wins",
    with_ctes(
        "SELECT series_id, date_key, arg_max(CAST(value AS DOUBLE), obs_date) AS value "
        "FROM macro_seen GROUP BY series_id, date_key",
        "macro_seen",
    ),
)
def macro_last_wins(spark, sf):
    rows = macro_long(spark, sf).filter(S.observed(F.col("value")))
    keyed = rows.withColumn("date_key", S.month_key_of_text(F.col("obs_date")))
    number = S.parse_number(F.col("value"))
    return R.latest_by(keyed, ["series_id", "date_key"], number, F.col("obs_date"), "value")


@query(
    "union_by_name",
    "SELECT 'customer' AS kind, c_custkey AS key, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier",
)
def union_by_name(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_custkey").alias("key"),
        F.col("c_acctbal").alias("balance"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("key"),
        F.lit("supplier").alias("kind"),
    )
    return customers.unionByName(suppliers)


# --- scalar functions and features --------------------------------------------------------------------------------


@query(
    "decode_labels",
    with_ctes(
        "SELECT id, sex_label, education_label, marriage_label FROM raw_clients", "raw_clients"
    ),
)
def decode_labels(spark, sf):
    return M.demographics(credit_wide(spark, sf)).select(
        "id", "sex_label", "education_label", "marriage_label"
    )


@query(
    "age_band",
    with_ctes(
        f"SELECT id, {age_case()} AS age_band FROM "
        "(SELECT id, CASE WHEN id % 10 = 3 THEN NULL ELSE age END AS age FROM credit_wide)",
        "credit_wide",
    ),
)
def age_band(spark, sf):
    """NULL ages (one in ten here) fall to the open band, as in path B."""
    ages = credit_wide(spark, sf).select(
        "id", F.when(F.col("id") % 10 == 3, None).otherwise(F.col("age")).alias("age")
    )
    return ages.select("id", S.banded(F.col("age")).alias("age_band"))


def _ratio_sql(zero):
    return with_ctes(f"SELECT id, date_key, {ratios(zero)} FROM long_raw", "long_raw")


def _ratios(spark, sf, zero):
    return M.monthly(credit_wide(spark, sf), ANCHOR_YEAR, zero).select(
        "id", "date_key", "credit_utilization", "payment_ratio"
    )


@query("ratio_null", _ratio_sql(None))
def ratio_null(spark, sf):
    return _ratios(spark, sf, None)


@query("ratio_filled", _ratio_sql("0"))
def ratio_filled(spark, sf):
    return _ratios(spark, sf, 0.0)


_FEATURES = [
    "avg_delay_months",
    "num_months_delayed",
    "total_bill_amt",
    "total_pay_amt",
    "repayment_gap",
]


@query(
    "client_features",
    with_ctes(
        "SELECT id, avg_delay_months, num_months_delayed, "
        + ", ".join(f"round({c}, 2) AS {c}" for c in _FEATURES[2:])
        + f" FROM (SELECT id, {FEATURES} FROM filled)",
        "filled",
    ),
)
def client_features(spark, sf):
    filled = C.fill_numeric(credit_wide(spark, sf), 0, keep_null=("id",))
    return M.client_features(filled).select(
        "id",
        "avg_delay_months",
        "num_months_delayed",
        *[F.round(c, 2).alias(c) for c in _FEATURES[2:]],
    )


@query(
    "date_key",
    "SELECT o_orderkey, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS date_key, "
    "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS date_key_of_text FROM orders",
)
def date_key(spark, sf):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        S.month_key(F.col("o_orderdate")).alias("date_key"),
        S.month_key_of_text(text).alias("date_key_of_text"),
    )


@query(
    "month_name_map",
    "SELECT o_orderkey, CASE WHEN month(o_orderdate) = 12 THEN NULL ELSE "
    + month_case("month(o_orderdate)")
    + " END AS month_name FROM orders",
)
def month_name_map(spark, sf):
    """Months are shifted by one, so that the thirteenth shows an absent key: NULL."""
    named = S.month_name(F.month("o_orderdate") + 1)
    back = {v: MONTH_NAMES[k - 1] for k, v in MONTH_NAMES.items() if k > 1}
    return table(spark, sf, "orders").select(
        "o_orderkey", F.element_at(S.literal_map(back), named).alias("month_name")
    )


@query(
    "month_name_case",
    f"SELECT o_orderkey, {month_case('month(o_orderdate)')} AS month_name FROM orders",
)
def month_name_case(spark, sf):
    key = S.month_key(F.col("o_orderdate"))
    return table(spark, sf, "orders").select(
        "o_orderkey", S.month_name_of_key(key).alias("month_name")
    )


@query(
    "dim_date_build",
    "SELECT CAST(year(d) * 100 + month(d) AS INT) AS date_key, CAST(d AS DATE) AS full_date, "
    "CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, "
    f"{month_case('month(d)')} AS month_name, CAST(quarter(d) AS INT) AS quarter, "
    "month(d) BETWEEN 4 AND 9 AS is_billing_month FROM (SELECT unnest(generate_series("
    "date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), "
    "INTERVAL 1 MONTH)) AS d FROM orders)",
)
def dim_date_build(spark, sf):
    bounds = table(spark, sf, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"),
        F.to_date(F.max("o_orderdate")).alias("last"),
    )
    return M.dim_date_between(bounds)


_MIXED = {1: ("a", "p"), 2: ("b", "q"), 3: ("c", "r")}


@query(
    "unpivot_mixed_types",
    "SELECT o_orderkey, k, CAST(CASE k WHEN 1 THEN o_custkey WHEN 2 THEN o_totalprice + 0.25 "
    "ELSE o_orderkey * 5000000000 END AS DOUBLE) AS v, CAST(CASE k WHEN 1 THEN o_custkey "
    "WHEN 2 THEN o_orderkey * 5000000000 ELSE o_custkey + 1 END AS BIGINT) AS w "
    "FROM orders, (VALUES (1), (2), (3)) AS t(k)",
)
def unpivot_mixed_types(spark, sf):
    """Columns of one measure with different types: int, double and bigint, the narrow one first."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("a"),
        (F.col("o_totalprice") + 0.25).alias("b"),
        (F.col("o_orderkey") * 5000000000).alias("c"),
        F.col("o_custkey").cast("int").alias("p"),
        (F.col("o_orderkey") * 5000000000).alias("q"),
        (F.col("o_custkey") + 1).cast("int").alias("r"),
    )
    return R.unpivot_groups(orders, ["o_orderkey"], "k", ["v", "w"], _MIXED)
