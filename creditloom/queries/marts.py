"""Marts, joins, analytic queries, cubes and KPI tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from creditloom.bindings import ANCHOR_YEAR, credit_wide, macro_long
from creditloom.operators import aggregates as A
from creditloom.operators.joins import dimension_join
from creditloom.plans import kpi as K
from creditloom.plans import mart as M
from creditloom.queries.registry import query
from creditloom.queries.sql import mean, month_case, with_ctes
from creditloom.session import materialise
from creditloom.vocabulary import DIMENSIONS, INDICATORS, SCALED_INDICATORS, TARGET

LABELS = list(DIMENSIONS.values())


# --- inputs of the queries -------------------------------------------------------------------------


def clients_b(spark, sf):
    return M.demographics(credit_wide(spark, sf))


def mart(spark, sf):
    """The mart that is loaded: fences, and one written copy of the clients that dimension and fact share."""
    return M.mart_a(credit_wide(spark, sf), macro_long(spark, sf), ANCHOR_YEAR)


def clients_a(spark, sf):
    return mart(spark, sf).dim_client


def fact_b(spark, sf):
    return M.elt_fact(credit_wide(spark, sf), ANCHOR_YEAR)


def macro_b(spark, sf):
    return M.elt_macro(macro_long(spark, sf))


def landed_macro(spark, sf):
    """Path B keeps its macro table; its size is then checked without a second look at the source."""
    return materialise(macro_b(spark, sf), "elt_macro")


def by_category_a(spark, sf):
    return A.long_of_cube(A.rate_cube(clients_a(spark, sf), LABELS), DIMENSIONS)


def by_category_b(spark, sf):
    return A.long_of_cube(A.rate_cube(clients_b(spark, sf), LABELS), DIMENSIONS)


# --- marts ------------------------------------------------------------------------------------------


def _money(*names):
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "mart_dim_client",
    with_ctes(
        "SELECT * REPLACE ("
        + _money("total_bill_amt", "total_pay_amt", "repayment_gap")
        + ") FROM dim_client",
        "dim_client",
    ),
)
def mart_dim_client(spark, sf):
    clean = M.clean_credit(credit_wide(spark, sf))
    return rounded(M.dim_client(clean), "total_bill_amt", "total_pay_amt", "repayment_gap")


@query(
    "mart_dim_macro",
    with_ctes(
        "SELECT * REPLACE ("
        + ", ".join(f"round({c}, 4) AS {c}" for c in INDICATORS)
        + ") FROM dim_macro",
        "dim_macro",
    ),
)
def mart_dim_macro(spark, sf):
    macro = M.dim_macro(macro_long(spark, sf), M.calendar_year(spark, ANCHOR_YEAR))
    return macro.withColumns({c: F.round(c, 4) for c in INDICATORS})


@query(
    "mart_fact",
    with_ctes(
        "SELECT * REPLACE ("
        + _money("limit_bal", "bill_amt", "pay_amt", *INDICATORS)
        + ") FROM fact",
        "fact",
    ),
)
def mart_fact(spark, sf):
    return rounded(mart(spark, sf).fact, "limit_bal", "bill_amt", "pay_amt", *INDICATORS)


_PLANTED_DUPLICATES = (
    "SELECT * FROM credit_wide UNION ALL SELECT * REPLACE (limit_bal + CASE WHEN id % 2 = 0 THEN 1000 "
    "ELSE -1000 END AS limit_bal, CAST(age + 1 AS INT) AS age) FROM credit_wide WHERE id % 10 < 3"
)


@query(
    "mart_duplicates",
    with_ctes(
        "SELECT id, CASE WHEN age < 18 THEN 18 WHEN age > 100 THEN 100 ELSE age END AS age, "
        "limit_bal AS low, limit_bal AS high, CAST(6 AS BIGINT) AS months_a, 6 * copies AS months_b "
        "FROM (SELECT id, age, limit_bal, count(*) OVER (PARTITION BY id) AS copies, "
        f"row_number() OVER (PARTITION BY id ORDER BY limit_bal) AS r FROM ({_PLANTED_DUPLICATES})) "
        "WHERE r = 1",
        "credit_wide",
    ),
)
def mart_duplicates(spark, sf):
    """Clients that occur twice: path A keeps the same copy in dimension and fact, path B keeps both."""
    wide = credit_wide(spark, sf)
    twice = wide.filter("id % 10 < 3").withColumns(
        {
            "limit_bal": F.col("limit_bal") + F.when(F.col("id") % 2 == 0, 1000.0).otherwise(-1000.0),
            "age": (F.col("age") + 1).cast("int"),
        }
    )
    planted = materialise(wide.unionByName(twice), "planted")
    a = M.mart_a(planted, macro_long(spark, sf), ANCHOR_YEAR, cap=False)
    facts = a.fact.groupBy("id").agg(
        F.min("limit_bal").alias("low"), F.max("limit_bal").alias("high"), F.count("*").alias("months_a")
    )
    kept = M.elt_fact(planted, ANCHOR_YEAR).groupBy("id").agg(F.count("*").alias("months_b"))
    return a.dim_client.select("id", "age").join(facts, "id").join(kept, "id")


@query(
    "fact_macro_left",
    with_ctes(
        "SELECT f.id, f.date_key, f.bill_amt, "
        + ", ".join(f"m.{c}" for c in INDICATORS)
        + " FROM elt_fact f LEFT JOIN macro_monthly m ON f.date_key = m.date_key",
        "elt_fact",
        "macro_monthly",
    ),
)
def fact_macro_left(spark, sf):
    fact = fact_b(spark, sf).select("id", "date_key", "bill_amt")
    return dimension_join(fact, landed_macro(spark, sf), ["date_key"], "left")


@query(
    "default_vs_macro",
    with_ctes("SELECT * FROM vs_macro", "vs_macro"),
)
def default_vs_macro(spark, sf):
    return M.elt_default_vs_macro(fact_b(spark, sf), macro_b(spark, sf))


_CORR = ", ".join(
    f"round(corr(f.{TARGET}, {c}), 4) + 0.0 AS {n}" for n, c in K.CORRELATIONS.items()
)


@query(
    "corr_joined",
    with_ctes(
        f"SELECT {_CORR}, "
        + ", ".join(
            f"round(corr(f.bill_amt, {c}), 4) + 0.0 AS {n.replace('corr_', 'bill_')}"
            for n, c in K.CORRELATIONS.items()
        )
        + " FROM elt_fact f JOIN macro_monthly m ON f.date_key = m.date_key",
        "elt_fact",
        "macro_monthly",
    ),
)
def corr_joined(spark, sf):
    joined = dimension_join(fact_b(spark, sf), landed_macro(spark, sf), ["date_key"], "inner")
    pairs = [(TARGET, c, n) for n, c in K.CORRELATIONS.items()]
    pairs += [("bill_amt", c, n.replace("corr_", "bill_")) for n, c in K.CORRELATIONS.items()]
    return joined.agg(*[A.correlation(x, y).alias(n) for x, y, n in pairs])


# --- the eight analytic queries --------------------------------------------------------------------


@query(
    "q1_overall",
    with_ctes(
        f"SELECT {mean(TARGET, 4)} AS overall_default_rate, count(*) AS total_clients "
        "FROM clients",
        "clients",
    ),
)
def q1_overall(spark, sf):
    return K.overall(clients_a(spark, sf))


def _rate_sql(label):
    return with_ctes(
        f"SELECT {label}, count(*) AS clients, {mean(TARGET, 4)} AS default_rate "
        f"FROM clients GROUP BY {label}",
        "clients",
    )


@query("q2_sex", _rate_sql("sex_label"))
def q2_sex(spark, sf):
    return K.rate_per_label(clients_a(spark, sf), "sex_label")


@query("q3_education", _rate_sql("education_label"))
def q3_education(spark, sf):
    return K.rate_per_label(clients_a(spark, sf), "education_label")


@query("q4_marriage", _rate_sql("marriage_label"))
def q4_marriage(spark, sf):
    return K.rate_per_label(clients_a(spark, sf), "marriage_label")


@query("q5_age_band", _rate_sql("age_band"))
def q5_age_band(spark, sf):
    return K.rate_per_label(clients_a(spark, sf), "age_band")


@query(
    "q6_behaviour",
    with_ctes(
        f"SELECT date_key, month_name, {mean('credit_utilization', 4)} AS avg_credit_utilization, "
        f"{mean('payment_ratio', 4)} AS avg_payment_ratio, "
        f"{mean('bill_amt', 2)} AS avg_bill_amt FROM fact GROUP BY date_key, month_name",
        "fact",
    ),
)
def q6_behaviour(spark, sf):
    m = mart(spark, sf)
    return K.behaviour(m.fact, m.dim_date)


@query(
    "q7_rate_vs_macro",
    with_ctes(
        f"SELECT date_key, month_name, {mean('exchange_rate_twd_usd', 4)} AS avg_fx_twd_usd, "
        f"{mean('real_broad_eer', 4)} AS avg_real_broad_eer, "
        f"{mean('total_reserves', 2)} AS avg_total_reserves, "
        f"{mean(TARGET, 4)} AS default_rate FROM fact GROUP BY date_key, month_name",
        "fact",
    ),
)
def q7_rate_vs_macro(spark, sf):
    m = mart(spark, sf)
    return K.rate_vs_macro(m.fact, m.dim_date)


@query(
    "q8_corr",
    with_ctes(
        "SELECT "
        + ", ".join(
            f"round(corr({TARGET}, {c}), 4) + 0.0 AS {n.replace('corr_', 'corr_default_')}"
            for n, c in K.CORRELATIONS.items()
        )
        + " FROM fact",
        "fact",
    ),
)
def q8_corr(spark, sf):
    return K.correlations(mart(spark, sf).fact, prefix="corr_default_")


# --- cube, slices and KPI tables --------------------------------------------------------------------

_CUBE = (
    "SELECT sex_label, education_label, marriage_label, age_band, "
    "CAST(grouping(sex_label, education_label, marriage_label, age_band) AS INT) AS grouping, "
    f"count(*) AS clients, {mean(TARGET, 4)} AS default_rate FROM raw_clients "
    "GROUP BY GROUPING SETS ((sex_label), (education_label), (marriage_label), (age_band), ())"
)


@query("demographic_cube", with_ctes(_CUBE, "raw_clients"))
def demographic_cube(spark, sf):
    return A.rate_cube(clients_b(spark, sf), LABELS)


@query(
    "cube_slice_total",
    with_ctes(
        f"SELECT {mean(TARGET, 4)} AS default_rate, count(*) AS total_clients "
        "FROM raw_clients",
        "raw_clients",
    ),
)
def cube_slice_total(spark, sf):
    return A.total_of_cube(A.rate_cube(clients_b(spark, sf), LABELS), LABELS)


@query("cube_slice_long", with_ctes("SELECT * FROM cells_b", "cells_b"))
def cube_slice_long(spark, sf):
    return by_category_b(spark, sf)


@query(
    "cube_sample_top",
    with_ctes(
        f"SELECT * FROM ({_CUBE}) ORDER BY clients DESC, default_rate DESC, grouping, "
        "coalesce(sex_label, education_label, marriage_label, age_band) LIMIT 10",
        "raw_clients",
    ),
)
def cube_sample_top(spark, sf):
    return (
        demographic_cube(spark, sf)
        .orderBy(
            F.desc("clients"), F.desc("default_rate"), F.col("grouping"), F.coalesce(*LABELS)
        )
        .limit(10)
    )


@query("kpi_demographic_union", with_ctes("SELECT * FROM cells_a", "cells_a"))
def kpi_demographic_union(spark, sf):
    return A.rate_union(clients_a(spark, sf), DIMENSIONS)


@query("kpi_demographic_onepass", with_ctes("SELECT * FROM cells_a", "cells_a"))
def kpi_demographic_onepass(spark, sf):
    return by_category_a(spark, sf)


@query(
    "kpi_monthly_a",
    with_ctes(
        f"SELECT date_key, month_name, {mean(TARGET, 4)} AS default_rate, "
        f"{mean('exchange_rate_twd_usd', 4)} AS exchange_rate_twd_usd, "
        f"{mean('real_broad_eer', 4)} AS real_broad_eer, "
        f"{mean('total_reserves', 2)} AS total_reserves FROM fact GROUP BY date_key, month_name",
        "fact",
    ),
)
def kpi_monthly_a(spark, sf):
    m = mart(spark, sf)
    return K.monthly_a(m.fact, m.dim_date)


_MONTHLY_B = (
    f"SELECT date_key, {month_case('date_key % 100')} AS month_name, default_rate, "
    + ", ".join(SCALED_INDICATORS)
    + " FROM vs_macro"
)


@query("kpi_monthly_b", with_ctes(_MONTHLY_B, "vs_macro"))
def kpi_monthly_b(spark, sf):
    return K.monthly_b(M.elt_default_vs_macro(fact_b(spark, sf), macro_b(spark, sf)))


# The four KPI tables of a path as cells (tbl, key, name, value), so that tables of different shape go
# into one result: in SQL and in Spark.
KPI_KEYS = {
    "kpi_overall": [],
    "kpi_default_by_demographic": ["dimension", "category"],
    "kpi_monthly_default_vs_macro": ["date_key", "month_name"],
    "kpi_corr_default_macro": [],
}
KPI_MEASURES = {
    "kpi_overall": ["default_rate", "total_clients"],
    "kpi_default_by_demographic": ["clients", "default_rate"],
    "kpi_monthly_default_vs_macro": ["default_rate", *SCALED_INDICATORS],
    "kpi_corr_default_macro": list(K.CORRELATIONS),
}


def _corr_of(source):
    pairs = ", ".join(f"round(corr({TARGET}, {c}), 4) + 0.0 AS {n}" for n, c in K.CORRELATIONS.items())
    return f"SELECT {pairs} FROM {source}"


_KPI_SQL = {
    "a": {
        "kpi_overall": "SELECT * FROM overall_a",
        "kpi_default_by_demographic": "SELECT * FROM cells_a",
        "kpi_monthly_default_vs_macro": f"SELECT date_key, month_name, {mean(TARGET, 4)} AS default_rate, "
        f"{mean('exchange_rate_twd_usd', 4)} AS exchange_rate_twd_usd, "
        f"{mean('real_broad_eer', 4)} AS real_broad_eer, "
        f"{mean('total_reserves', 2)} AS total_reserves FROM fact GROUP BY date_key, month_name",
        "kpi_corr_default_macro": _corr_of("fact"),
    },
    "b": {
        "kpi_overall": f"SELECT {mean(TARGET, 4)} AS default_rate, count(*) AS total_clients FROM raw_clients",
        "kpi_default_by_demographic": "SELECT * FROM cells_b",
        "kpi_monthly_default_vs_macro": _MONTHLY_B,
        "kpi_corr_default_macro": _corr_of("elt_fact JOIN macro_monthly USING (date_key)"),
    },
}
KPI_CTES = ("overall_a", "cells_a", "cells_b", "fact", "raw_clients", "vs_macro", "elt_fact", "macro_monthly")


def cells_sql(path: str) -> str:
    parts = []
    for name, sql in _KPI_SQL[path].items():
        key = " || '|' || ".join(KPI_KEYS[name]) or "''"
        names = ", ".join(f"'{m}'" for m in KPI_MEASURES[name])
        values = ", ".join(f"CAST({m} AS DOUBLE)" for m in KPI_MEASURES[name])
        parts.append(
            f"SELECT '{name}' AS tbl, {key} AS key, unnest([{names}]) AS name, unnest([{values}]) AS value "
            f"FROM ({sql})"
        )
    return " UNION ALL ".join(parts)


def cells(kpis):
    """The same of a mapping of KPI tables."""
    parts = []
    for name, df in kpis.items():
        measures = [
            F.struct(F.lit(m).alias("name"), F.col(m).cast("double").alias("value"))
            for m in KPI_MEASURES[name]
        ]
        key = F.concat_ws("|", *KPI_KEYS[name]) if KPI_KEYS[name] else F.lit("")
        parts.append(df.select(F.lit(name).alias("tbl"), key.alias("key"), F.inline(F.array(*measures))))
    return reduce(lambda a, b: a.unionByName(b), parts)


def kpis_of_both(spark, sf):
    m = mart(spark, sf)
    clients = materialise(m.dim_client.select(*LABELS, TARGET), "clients_a")
    fact = materialise(m.fact.select("date_key", TARGET, *SCALED_INDICATORS), "fact_a")
    labelled = materialise(clients_b(spark, sf).select(*LABELS, TARGET), "clients_b")
    landed = materialise(fact_b(spark, sf).select("date_key", TARGET), "fact_b")
    return {
        "a": K.kpi_tables_a(clients, fact, m.dim_date),
        "b": K.kpi_tables_b(labelled, landed, landed_macro(spark, sf)),
    }


_TOLERANCE = "CASE name WHEN 'clients' THEN 0 WHEN 'total_clients' THEN 0 ELSE 0.0001 END"


@query(
    "path_parity",
    with_ctes(
        "SELECT tbl, key, name, a.value AS value_a, b.value AS value_b, "
        f"coalesce(abs(a.value - b.value) <= {_TOLERANCE}, a.value IS NULL AND b.value IS NULL) AS agrees "
        f"FROM ({cells_sql('a')}) a FULL OUTER JOIN ({cells_sql('b')}) b USING (tbl, key, name)",
        *KPI_CTES,
    ),
)
def path_parity(spark, sf):
    """All four KPI tables of both paths, cell by cell. Counts must be equal, rates within 0.0001."""
    both = {path: cells(kpis) for path, kpis in kpis_of_both(spark, sf).items()}
    return K.parity(both["a"], both["b"], ["tbl", "key", "name"], {"value": F.expr(_TOLERANCE)})


@query(
    "path_parity_demographic",
    with_ctes(
        "SELECT coalesce(a.dimension, b.dimension) AS dimension, "
        "coalesce(a.category, b.category) AS category, a.clients AS clients_a, "
        "a.default_rate AS default_rate_a, b.clients AS clients_b, "
        "b.default_rate AS default_rate_b, "
        "a.clients = b.clients AND abs(a.default_rate - b.default_rate) <= 0.0001 AS agrees "
        "FROM cells_a a FULL OUTER JOIN cells_b b "
        "ON a.dimension = b.dimension AND a.category = b.category",
        "cells_a",
        "cells_b",
    ),
)
def path_parity_demographic(spark, sf):
    return K.parity(
        by_category_a(spark, sf),
        by_category_b(spark, sf),
        ["dimension", "category"],
        {"clients": 0, "default_rate": 0.0001},
    )


@query(
    "category_vs_overall",
    with_ctes(
        "SELECT dimension, category, clients, c.default_rate, "
        "round((c.default_rate - o.default_rate) * 100, 2) + 0.0 AS diff_pp, "
        "c.default_rate >= o.default_rate AS at_or_above FROM cells_a c, overall_a o",
        "cells_a",
        "overall_a",
    ),
)
def category_vs_overall(spark, sf):
    cube = A.rate_cube(clients_a(spark, sf), LABELS)
    return K.versus_overall(A.long_of_cube(cube, DIMENSIONS), A.total_of_cube(cube, LABELS))


@query(
    "default_split",
    with_ctes(
        "SELECT total_clients, default_rate, round(total_clients * default_rate) AS defaulting, "
        "round(total_clients * (1 - default_rate)) AS non_defaulting, "
        "round(1 - default_rate, 4) AS complement_rate FROM overall_a",
        "overall_a",
    ),
)
def default_split(spark, sf):
    return K.default_split(A.overall_rate(clients_a(spark, sf), "default_rate"))


@query(
    "dimension_totals",
    with_ctes(
        "SELECT dimension, CAST(sum(clients) AS BIGINT) AS clients, count(*) AS categories "
        "FROM cells_a GROUP BY dimension",
        "cells_a",
    ),
)
def dimension_totals(spark, sf):
    return K.dimension_totals(by_category_a(spark, sf))


@query(
    "reference_line",
    with_ctes(f"SELECT {mean('default_rate', 6)} AS mean_rate FROM vs_macro", "vs_macro"),
)
def reference_line(spark, sf):
    return K.reference_line(kpi_monthly_b(spark, sf))


@query(
    "risk_extremes",
    with_ctes(
        "SELECT 'highest' AS kind, * FROM (SELECT dimension, category, default_rate FROM cells_a "
        "WHERE category <> 'unknown' ORDER BY default_rate DESC, dimension, category LIMIT 1) "
        "UNION ALL SELECT 'lowest', * FROM (SELECT dimension, category, default_rate FROM cells_a "
        "WHERE category <> 'unknown' ORDER BY default_rate, dimension, category LIMIT 1)",
        "cells_a",
    ),
)
def risk_extremes(spark, sf):
    return K.risk_extremes(by_category_a(spark, sf))


@query(
    "age_band_ordered",
    with_ctes(
        "SELECT category, clients, default_rate, CAST(CASE category WHEN '<30' THEN 0 "
        "WHEN '30-39' THEN 1 WHEN '40-49' THEN 2 WHEN '50-59' THEN 3 WHEN '60+' THEN 4 "
        "ELSE 99 END AS INT) AS position FROM cells_a WHERE dimension = 'age_band'",
        "cells_a",
    ),
)
def age_band_ordered(spark, sf):
    bands = by_category_a(spark, sf).filter(F.col("dimension") == "age_band")
    return bands.select(
        "category",
        "clients",
        "default_rate",
        K.band_position(F.col("category")).alias("position"),
    ).orderBy("position")


@query(
    "kpi_nested",
    with_ctes(
        "SELECT dimension, i - 1 AS place, categories[i] AS category, clients[i] AS clients, "
        "rates[i] AS default_rate FROM (SELECT dimension, list(category ORDER BY p, category) AS "
        "categories, list(clients ORDER BY p, category) AS clients, list(default_rate ORDER BY p, "
        "category) AS rates FROM (SELECT *, CASE WHEN dimension = 'age_band' THEN (CASE category "
        "WHEN '<30' THEN 0 WHEN '30-39' THEN 1 WHEN '40-49' THEN 2 WHEN '50-59' THEN 3 ELSE 4 END)"
        " ELSE -default_rate END AS p FROM cells_a) GROUP BY dimension), range(1, 9) AS r(i) "
        "WHERE i <= len(categories)",
        "cells_a",
    ),
)
def kpi_nested(spark, sf):
    """The nested lists, read back with their places so that they compare as rows."""
    nested = K.summary(by_category_a(spark, sf))
    return nested.select("dimension", F.posexplode("items")).select(
        "dimension", F.col("pos").cast("bigint").alias("place"), "col.*"
    )


@query("kpi_document", with_ctes(cells_sql("a"), *KPI_CTES))
def kpi_document(spark, sf):
    """The summary as one JSON text, parsed back into the cells it was made of."""
    m = mart(spark, sf)
    tables = {
        "kpi_overall": A.overall_rate(m.dim_client, "default_rate"),
        "kpi_corr_default_macro": K.correlations(m.fact),
        "kpi_default_by_demographic": A.long_of_cube(A.rate_cube(m.dim_client, LABELS), DIMENSIONS),
        "kpi_monthly_default_vs_macro": K.monthly_a(m.fact, m.dim_date),
    }
    document = K.summary_document(*tables.values())

    def shape(name, *skip):
        return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in tables[name].schema if f.name not in skip)

    category = shape("kpi_default_by_demographic", "dimension")
    schema = (
        f"struct<overall: struct<{shape('kpi_overall')}>, corr: struct<{shape('kpi_corr_default_macro')}>, "
        f"demo: map<string, array<struct<{category}>>>, "
        f"monthly: array<struct<{shape('kpi_monthly_default_vs_macro')}>>>"
    )
    back = document.select(F.from_json("document", schema).alias("d"))
    groups = back.select(F.explode("d.demo").alias("dimension", "items"))
    return cells(
        {
            "kpi_overall": back.select("d.overall.*"),
            "kpi_corr_default_macro": back.select("d.corr.*"),
            "kpi_default_by_demographic": groups.select("dimension", F.inline("items")),
            "kpi_monthly_default_vs_macro": back.select(F.inline("d.monthly")),
        }
    )
