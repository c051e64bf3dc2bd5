"""Common table expressions the oracle statements are built from (ANSI SQL, DuckDB dialect)."""

from __future__ import annotations

from creditloom.bindings import ANCHOR_YEAR
from creditloom.vocabulary import (
    AGE_BANDS,
    BILL_COLUMNS,
    CAPPED_COLUMNS,
    DIMENSIONS,
    EDUCATION_LABELS,
    HISTORY,
    INDICATORS,
    MARRIAGE_LABELS,
    MONTH_NAMES,
    OPEN_AGE_BAND,
    PAYMENT_COLUMNS,
    SCALED_INDICATORS,
    SERIES_COLUMNS,
    SEX_LABELS,
    STATUS_COLUMNS,
    TARGET,
)

WIDE_NUMBERS = [
    "limit_bal",
    "sex",
    "education",
    "marriage",
    "age",
    *STATUS_COLUMNS,
    *BILL_COLUMNS,
    *PAYMENT_COLUMNS,
    TARGET,
]


def case(column: str, labels: dict, other: str) -> str:
    arms = " ".join(f"WHEN {column} = {k} THEN '{v}'" for k, v in labels.items())
    return f"CASE {arms} ELSE '{other}' END"


def age_case(column: str = "age") -> str:
    arms = " ".join(f"WHEN {column} < {u} THEN '{v}'" for u, v in AGE_BANDS)
    return f"CASE {arms} ELSE '{OPEN_AGE_BAND}' END"


def month_case(expression: str) -> str:
    return case(expression, {m: n for m, n in MONTH_NAMES.items() if m < 12}, MONTH_NAMES[12])


def cap(column: str, low: str, high: str) -> str:
    return (
        f"CASE WHEN {column} < {low} THEN {low} WHEN {column} > {high} THEN {high} "
        f"ELSE {column} END"
    )


def fence(table: str, column: str) -> tuple[str, str]:
    q1, q3 = f"{table}.q1_{column}", f"{table}.q3_{column}"
    return f"({q1} - 1.5 * ({q3} - {q1}))", f"({q3} + 1.5 * ({q3} - {q1}))"


def half_up(value: str, digits: int) -> str:
    """Half away from zero on ten decimals, free of binary noise."""
    return f"CAST(round(CAST({value} AS DECIMAL(30, 10)), {digits}) AS DOUBLE)"


def mean(column: str, digits: int) -> str:
    return half_up(f"avg({column})", digits)


def labels_of() -> str:
    return ", ".join(
        [
            case("sex", SEX_LABELS, "unknown") + " AS sex_label",
            case("education", EDUCATION_LABELS, "unknown") + " AS education_label",
            case("marriage", MARRIAGE_LABELS, "unknown") + " AS marriage_label",
            age_case() + " AS age_band",
        ]
    )


def _history() -> str:
    parts = []
    for month, (status, bill, paid) in HISTORY.items():
        s = f"sum(CASE WHEN slot = {month} THEN status END)"
        parts += [
            f"CAST(CASE WHEN {s} < -2 THEN -2 WHEN {s} > 9 THEN 9 ELSE {s} END AS INT) "
            f"AS {status}",
            f"CAST(sum(CASE WHEN slot = {month} THEN bill END) AS BIGINT) / 100.0::DOUBLE "
            f"AS {bill}",
            f"sum(CASE WHEN slot = {month} THEN quantity END) * 1000.0::DOUBLE AS {paid}",
        ]
    return ", ".join(parts)


def unpivot(source: str, ids: list[str], year: int) -> str:
    parts = [
        f"SELECT {', '.join(ids)}, {year * 100 + m} AS date_key, {s} AS pay_status, "
        f"{b} AS bill_amt, {p} AS pay_amt FROM {source}"
        for m, (s, b, p) in HISTORY.items()
    ]
    return " UNION ALL ".join(parts)


def ratios(zero: str | None) -> str:
    use = half_up("bill_amt / nullif(limit_bal, 0)", 4)
    paid = half_up("pay_amt / nullif(bill_amt, 0)", 4)
    if zero is not None:
        use, paid = f"coalesce({use}, {zero})", f"coalesce({paid}, {zero})"
    return f"{use} AS credit_utilization, {paid} AS payment_ratio"


def _dim_macro() -> str:
    s = {c: f"(avg({c}) OVER ())" for c in INDICATORS}
    z = [
        f"CASE WHEN (stddev_samp({c}) OVER ()) > 0 THEN "
        f"round(({c} - {s[c]}) / (stddev_samp({c}) OVER ()), 3) END AS {c}_zscore"
        for c in INDICATORS
    ]
    low = {c: f"(min({c}) OVER ())" for c in INDICATORS}
    span = {
        c: f"(CASE WHEN (max({c}) OVER ()) = {low[c]} THEN 1.0 "
        f"ELSE (max({c}) OVER ()) - {low[c]} END)"
        for c in INDICATORS
    }
    n = [
        f"round((coalesce({c}, {s[c]}) - {low[c]}) / {span[c]}, 4) AS {c}_norm"
        for c in SCALED_INDICATORS
    ]
    filled = [f"coalesce({c}, {s[c]}) AS {c}" for c in INDICATORS]
    return f"SELECT date_key, {', '.join(filled + z + n)} FROM spine"


_SERIES_CASE = (
    "CASE substr(o_orderpriority, 1, 1) "
    + " ".join(f"WHEN '{i}' THEN '{s}'" for i, s in enumerate(SERIES_COLUMNS, 1))
    + " ELSE 'OTHER' END"
)
_MEAN = "((2 * total + n) // (2 * n))"
_KEY = "CAST(substr(obs_date, 1, 4) AS INT) * 100 + CAST(substr(obs_date, 6, 2) AS INT)"
_PIVOT = ", ".join(
    f"max(CASE WHEN series_id = '{s}' THEN CAST(value AS DOUBLE) END) AS {c}"
    for s, c in SERIES_COLUMNS.items()
)
_CAPS = ", ".join(
    f"{cap(c, *fence('fences', c))} AS {c}" if c in CAPPED_COLUMNS else c
    for c in ["id", *WIDE_NUMBERS]
    if c != "age"
)
_STATUS_SUM = " + ".join(STATUS_COLUMNS)
_LATE = " + ".join(f"CASE WHEN {c} > 0 THEN 1 ELSE 0 END" for c in STATUS_COLUMNS)
BILLED = "(" + " + ".join(BILL_COLUMNS) + ")"
PAID = "(" + " + ".join(PAYMENT_COLUMNS) + ")"
FEATURES = (
    f"round(({_STATUS_SUM}) / 6.0::DOUBLE, 3) AS avg_delay_months, "
    f"CAST({_LATE} AS INT) AS num_months_delayed, {BILLED} AS total_bill_amt, "
    f"{PAID} AS total_pay_amt, {BILLED} - {PAID} AS repayment_gap"
)

# name -> (names it needs, text)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "quantity": (
        (),
        "SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey",
    ),
    "placed": (
        ("quantity",),
        "SELECT o_custkey, (month(o_orderdate) - 1) % 6 + 4 AS slot, "
        "CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'F' THEN -1 ELSE 0 END AS status, "
        "CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END * "
        "CAST(round(o_totalprice * 100) AS BIGINT) AS bill, quantity "
        "FROM orders LEFT JOIN quantity ON o_orderkey = l_orderkey",
    ),
    "history": (("placed",), f"SELECT o_custkey, {_history()} FROM placed GROUP BY o_custkey"),
    "credit_wide": (
        ("history",),
        "SELECT c_custkey AS id, "
        "CASE WHEN c_custkey % 50 = 0 THEN 0.0::DOUBLE ELSE abs(c_acctbal) * 100 END AS limit_bal, "
        "CAST(c_custkey % 3 AS INT) AS sex, CAST(c_custkey % 7 AS INT) AS education, "
        "CAST(c_custkey % 4 AS INT) AS marriage, CAST(15 + c_custkey % 90 AS INT) AS age, "
        + ", ".join(c for p in zip(*HISTORY.values()) for c in p)
        + f", CAST((c_custkey * 7919) % 100 < 22 AS INT) AS {TARGET} "
        "FROM customer LEFT JOIN history ON c_custkey = o_custkey",
    ),
    "filled": (
        ("credit_wide",),
        "SELECT id, "
        + ", ".join(f"coalesce({c}, 0) AS {c}" for c in WIDE_NUMBERS)
        + " FROM credit_wide",
    ),
    "fences": (
        ("filled",),
        "SELECT "
        + ", ".join(
            f"quantile_cont({c}, {p}) AS {q}_{c}"
            for c in CAPPED_COLUMNS
            for q, p in (("q1", 0.25), ("q3", 0.75))
        )
        + " FROM filled",
    ),
    "clean": (
        ("fences",),
        f"SELECT {_CAPS}, CASE WHEN age < 18 THEN 18 WHEN age > 100 THEN 100 ELSE age END AS age "
        "FROM filled, fences",
    ),
    "clients": (
        ("filled",),
        f"SELECT id, {TARGET}, sex, education, marriage, age, {labels_of()} FROM (SELECT * "
        "REPLACE (CASE WHEN age < 18 THEN 18 WHEN age > 100 THEN 100 ELSE age END AS age) "
        "FROM filled)",
    ),
    "dim_client": (
        ("clean",),
        "SELECT id, sex, sex_label, education, education_label, marriage, marriage_label, age, "
        f"age_band, {TARGET}, avg_delay_months, num_months_delayed, total_bill_amt, "
        f"total_pay_amt, repayment_gap FROM (SELECT *, {labels_of()}, {FEATURES} FROM clean)",
    ),
    "raw_clients": (("credit_wide",), f"SELECT *, {labels_of()} FROM credit_wide"),
    "calendar": (
        (),
        f"SELECT CAST({ANCHOR_YEAR * 100} + m AS INT) AS date_key, CAST(m AS INT) AS month "
        "FROM range(1, 13) AS r(m)",
    ),
    "macro_means": (
        (),
        f"SELECT {_SERIES_CASE} AS series_id, strftime(o_orderdate, '%Y-%m-') || "
        "CASE WHEN day(o_orderdate) < 15 THEN '01' ELSE '15' END AS obs_date, "
        "CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total, "
        "count(*) AS n FROM orders GROUP BY 1, 2",
    ),
    "macro_long": (
        ("macro_means",),
        "SELECT series_id, obs_date, CASE WHEN CAST(replace(obs_date, '-', '') AS INT) % 11 = 0 "
        f"THEN '.' ELSE CAST({_MEAN} // 100 AS VARCHAR) || '.' || "
        f"lpad(CAST({_MEAN} % 100 AS VARCHAR), 2, '0') END AS value FROM macro_means",
    ),
    "macro_seen": (
        ("macro_long",),
        f"SELECT series_id, obs_date, value, CAST({_KEY} AS INT) AS date_key FROM macro_long "
        "WHERE value IS NOT NULL AND value <> '.'",
    ),
    "macro_monthly": (
        ("macro_seen",),
        f"SELECT date_key, {_PIVOT} FROM macro_seen GROUP BY date_key",
    ),
    "macro_last": (
        ("macro_seen",),
        "SELECT series_id, date_key, "
        "arg_max(CAST(value AS DOUBLE), obs_date) AS value FROM macro_seen "
        f"WHERE series_id IN ({', '.join(repr(s) for s in SERIES_COLUMNS)}) GROUP BY 1, 2",
    ),
    "spine": (
        ("macro_last", "calendar"),
        "SELECT c.date_key, "
        + ", ".join(
            f"max(CASE WHEN series_id = '{s}' THEN value END) AS {c}"
            for s, c in SERIES_COLUMNS.items()
        )
        + " FROM calendar c LEFT JOIN macro_last l ON c.date_key = l.date_key GROUP BY c.date_key",
    ),
    "dim_macro": (("spine",), _dim_macro()),
    "long_clean": (("clean",), unpivot("clean", ["id", "limit_bal", TARGET], ANCHOR_YEAR)),
    "fact": (
        ("long_clean", "dim_macro"),
        "SELECT l.id, l.date_key, CAST(l.date_key % 100 AS INT) AS month, limit_bal, pay_status, "
        f"bill_amt, pay_amt, {TARGET}, {ratios('0')}, "
        + ", ".join(
            [
                *INDICATORS,
                *[f"{c}_zscore" for c in INDICATORS],
                *[f"{c}_norm" for c in SCALED_INDICATORS],
            ]
        )
        + f", {month_case('l.date_key % 100')} AS month_name "
        "FROM long_clean l LEFT JOIN dim_macro m ON l.date_key = m.date_key",
    ),
    "long_raw": (("credit_wide",), unpivot("credit_wide", ["id", "limit_bal", TARGET], ANCHOR_YEAR)),
    "elt_fact": (
        ("long_raw",),
        f"SELECT id, date_key, limit_bal, pay_status, bill_amt, pay_amt, {TARGET}, "
        f"{ratios(None)} FROM long_raw",
    ),
    "cells_a": (
        ("clients",),
        f"SELECT dimension, category, count(*) AS clients, {mean('d', 4)} AS default_rate FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS dimension, {c} AS category, {TARGET} AS d FROM clients"
            for n, c in DIMENSIONS.items()
        )
        + ") GROUP BY dimension, category",
    ),
    "cells_b": (
        ("raw_clients",),
        f"SELECT dimension, category, count(*) AS clients, {mean('d', 4)} AS default_rate FROM ("
        + " UNION ALL ".join(
            f"SELECT '{n}' AS dimension, {c} AS category, {TARGET} AS d FROM raw_clients"
            for n, c in DIMENSIONS.items()
        )
        + ") GROUP BY dimension, category",
    ),
    "overall_a": (
        ("clients",),
        f"SELECT {mean(TARGET, 4)} AS default_rate, count(*) AS total_clients FROM clients",
    ),
    "vs_macro": (
        ("elt_fact", "macro_monthly"),
        f"SELECT f.date_key, {mean(TARGET, 4)} AS default_rate, "
        + ", ".join(f"max(m.{c}) AS {c}" for c in SCALED_INDICATORS)
        + " FROM elt_fact f LEFT JOIN macro_monthly m ON f.date_key = m.date_key "
        "GROUP BY f.date_key",
    ),
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` preceded by the named table expressions and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for need in CTES[name][0]:
                add(need)
            ordered.append(name)

    for name in names:
        add(name)
    parts = ", ".join(f"{n} AS ({CTES[n][1]})" for n in ordered)
    return f"WITH {parts} {body}"
