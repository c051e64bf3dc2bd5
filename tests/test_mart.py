"""Expectations on two hand-made clients, and planted defects."""

import pytest
from pyspark.sql import functions as F

from creditloom.operators import cleaning as C
from creditloom.operators import quality as Q
from creditloom.operators.reshape import unpivot_groups
from creditloom.plans import kpi as K
from creditloom.plans import mart as M
from creditloom.vocabulary import (
    BILL_COLUMNS,
    HISTORY,
    INDICATORS,
    PAYMENT_COLUMNS,
    STATUS_COLUMNS,
    TARGET,
)

YEAR = 2005
COLUMNS = (
    ["id", "limit_bal", "sex", "education", "marriage", "age", TARGET]
    + STATUS_COLUMNS
    + BILL_COLUMNS
    + PAYMENT_COLUMNS
)
SCHEMA = ", ".join(
    f"{c} {'bigint' if c == 'id' else 'double' if 'amt' in c or 'limit' in c else 'int'}"
    for c in COLUMNS
)
FIRST = [1, 10000.0, 2, 2, 1, 45, 1] + [2, 0, -1, 0, 1, 0] + [1000.0] * 6 + [400.0] * 6
SECOND = [2, 20000.0, 1, 1, 2, 25, 0] + [0] * 6 + [2000.0] * 6 + [2000.0] * 6


@pytest.fixture
def credit(spark):
    return spark.createDataFrame([FIRST, SECOND], SCHEMA)


@pytest.fixture
def observations(spark):
    rows = [("EXTAUS", f"{YEAR}-{m:02d}-01", str(31.0 + m)) for m in range(1, 13)]
    return spark.createDataFrame(rows, "series_id string, obs_date string, value string")


@pytest.fixture
def mart(credit, observations):
    return M.mart_a(credit, observations, YEAR, cap=False)


def test_client_dimension(mart):
    row = mart.dim_client.filter("id = 1").first()
    assert (row.sex_label, row.education_label, row.marriage_label, row.age_band) == (
        "female",
        "university",
        "married",
        "40-49",
    )
    assert row.avg_delay_months == pytest.approx(0.333)
    assert row.num_months_delayed == 2
    assert (row.total_bill_amt, row.total_pay_amt, row.repayment_gap) == (6000.0, 2400.0, 3600.0)
    assert dict(mart.dim_client.dtypes) == M.DIM_CLIENT_SCHEMA


def test_fact_has_one_row_per_client_and_month(mart):
    rows = mart.fact.collect()
    assert len(rows) == 12
    september = next(r for r in rows if r.id == 1 and r.date_key == YEAR * 100 + 9)
    assert september.credit_utilization == pytest.approx(0.1)
    assert september.payment_ratio == pytest.approx(0.4)
    assert september.exchange_rate_twd_usd == pytest.approx(40.0)
    assert september.month_name == "Sep"
    assert september.pay_status == 2
    types = dict(mart.fact.dtypes)
    assert all(types[c] == t for c, t in M.FACT_SCHEMA.items())
    assert len(mart.fact.columns) == 22


def test_zero_limit(spark, observations):
    row = [3, 0.0, 1, 1, 1, 30, 0] + [0] * 6 + [500.0] * 6 + [100.0] * 6
    credit = spark.createDataFrame([row], SCHEMA)
    filled = M.monthly(credit, YEAR, zero=0.0).select("credit_utilization").distinct().collect()
    assert [r[0] for r in filled] == [0.0]
    kept = M.monthly(credit, YEAR, zero=None).select("credit_utilization").distinct().collect()
    assert [r[0] for r in kept] == [None]


def test_calendar(spark):
    calendar = M.calendar_year(spark, YEAR)
    rows = calendar.collect()
    assert len(rows) == 12
    assert {r.month for r in rows if r.is_billing_month} == {4, 5, 6, 7, 8, 9}
    april = next(r for r in rows if r.month == 4)
    assert (april.quarter, april.date_key, april.month_name) == (2, 200504, "Apr")
    assert dict(calendar.dtypes) == M.DIM_DATE_SCHEMA


def test_macro_dimension(mart):
    rows = {r.date_key: r for r in mart.dim_macro.collect()}
    assert len(rows) == 12
    assert rows[200501].exchange_rate_twd_usd == pytest.approx(32.0)
    assert rows[200501].nominal_broad_eer is None  # no such series: present and NULL
    assert rows[200501].exchange_rate_twd_usd_norm == 0.0
    assert rows[200512].exchange_rate_twd_usd_norm == 1.0
    assert {f"{c}_zscore" for c in INDICATORS} <= set(mart.dim_macro.columns)


def test_missing_month_keeps_null_score_and_takes_the_mean(spark):
    values = {m: str(10.0 + m) for m in range(1, 13)}
    values[6] = "."
    rows = [("EXTAUS", f"{YEAR}-{m:02d}-01", v) for m, v in values.items()]
    rows += [("EXTAUS", f"{YEAR}-01-20", "99.0"), ("EXTAUS", f"{YEAR}-02-20", None)]
    # other years do not stand in, be they later or the only ones with this month
    rows += [("EXTAUS", f"{YEAR + 1}-01-20", "7.0"), ("EXTAUS", f"{YEAR - 1}-06-20", "7.0")]
    obs = spark.createDataFrame(rows, "series_id string, obs_date string, value string")
    macro = M.dim_macro(obs, M.calendar_year(spark, YEAR))
    got = {r.date_key % 100: r for r in macro.collect()}
    mean = (99.0 + sum(10.0 + m for m in range(2, 13) if m != 6)) / 11
    assert got[1].exchange_rate_twd_usd == 99.0  # last duplicate of the month wins
    assert got[2].exchange_rate_twd_usd == 12.0  # a later NULL does not
    assert got[6].exchange_rate_twd_usd == pytest.approx(mean)
    assert got[6].exchange_rate_twd_usd_zscore is None


def test_rules_pass_then_fail_on_a_duplicate(mart):
    report = {r["rule"]: r for r in _rules(mart.fact, mart).collect()}
    assert len(report) == 6 and all(r["pass"] for r in report.values()), report
    twice = mart.fact.unionByName(mart.fact.filter("id = 1 AND month = 9"))
    report = {r["rule"]: r for r in _rules(twice, mart).collect()}
    assert report["uniqueness_id_date"]["violations"] == 1
    assert not Q.gate(_rules(twice, mart)).first().all_pass


def _rules(fact, mart):
    return Q.rule_report(fact, mart.dim_client, mart.dim_date)


@pytest.mark.parametrize(
    "column, broken, rule",
    [
        ("id", "CAST(NULL AS BIGINT)", "not_null_keys"),
        (TARGET, "2", "range_checks"),
        ("credit_utilization", "CAST(NULL AS DOUBLE)", "range_checks"),
        ("bill_amt", "CAST(bill_amt AS STRING)", "dtype_consistency"),
        ("date_key", "190001", "referential_integrity"),
        ("id", "77L", "referential_integrity"),
    ],
)
def test_planted_defects(mart, column, broken, rule):
    fact = mart.fact.withColumn(column, F.expr(broken))
    report = {r["rule"]: r["pass"] for r in _rules(fact, mart).collect()}
    assert report[rule] is False


def test_null_label_is_not_outside_unless_asked(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "v int")
    plain = df.filter(Q.outside(F.col("v"), [0, 1])).count()
    strict = df.filter(Q.outside(F.col("v"), [0, 1], null_is_outside=True)).count()
    assert (plain, strict) == (1, 2)


def test_cleaning_order(spark):
    rows = [FIRST, FIRST, [3, None, 1, 1, 1, None, None] + [None] * 18]
    clean = M.clean_credit(spark.createDataFrame(rows, SCHEMA), cap=False)
    got = {r.id: r for r in clean.collect()}
    assert len(got) == 2
    assert (got[3].limit_bal, got[3].age, got[3][TARGET]) == (0.0, 18, 0)


def test_unpivot_keeps_every_value(credit):
    long = unpivot_groups(credit, ["id"], "month", M.MEASURES, HISTORY)
    back = long.groupBy("id").pivot("month", list(HISTORY)).agg(F.max("bill_amt"))
    want = credit.select("id", *[F.col(c[1]).alias(str(m)) for m, c in HISTORY.items()])
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_staged_and_loaded_tables(spark, credit, observations, shared):
    folder, location = shared("staged"), shared("db")
    M.stage_mart(credit, observations, YEAR, folder)
    for _ in range(2):  # a load can be repeated
        M.load_mart(spark, folder, "test_mart_a", location)
    fact = spark.table("test_mart_a.fact_credit_monthly")
    assert fact.count() == 12
    plan = fact.filter("date_key = 200509")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan

    M.land_raw(credit, observations, "test_mart_b", shared("dbb"))
    M.build_elt(spark, "test_mart_b", YEAR)
    assert all(spark.catalog.tableExists(f"test_mart_b.{t}") for t in M.ELT_TABLES)
    trends = spark.table("test_mart_b.elt_client_trends")
    assert trends.filter("prev_bill_amt IS NULL").count() == 2
    assert {r.bill_rank_in_month for r in trends.filter("id = 2").collect()} == {1}


def test_summary_document(spark, mart):
    from creditloom.operators import aggregates as A
    from creditloom.vocabulary import DIMENSIONS

    cube = A.rate_cube(mart.dim_client, list(DIMENSIONS.values()))
    document = K.summary_document(
        A.overall_rate(mart.dim_client, "default_rate"),
        K.correlations(mart.fact),
        A.long_of_cube(cube, DIMENSIONS),
        K.monthly_a(mart.fact, mart.dim_date),
    ).first().document
    import json

    parsed = json.loads(document)
    assert parsed["overall"] == {"default_rate": 0.5, "total_clients": 2}
    assert [x["category"] for x in parsed["demo"]["age_band"]] == ["<30", "40-49"]
    assert [x["category"] for x in parsed["demo"]["sex"]] == ["female", "male"]
    assert [m["date_key"] for m in parsed["monthly"]] == [200500 + m for m in range(4, 10)]


def test_duplicates_survive_in_path_b(spark):
    twice = spark.createDataFrame([FIRST, FIRST], SCHEMA)
    fact = M.elt_fact(twice, YEAR)
    assert fact.count() == 12
    assert M.elt_trends(fact).count() == 12


def test_iqr_cap_of_the_small_vector(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5, 100)], "v double")
    fences = C.iqr_fences(df, ["v"]).first()
    assert (fences.q1, fences.q3, fences.high) == (2.25, 4.75, 8.5)
    assert C.iqr_cap(df, ["v"]).agg(F.max("v")).first()[0] == 8.5
    approx = C.iqr_cap(df, ["v"], error=0.01).agg(F.max("v")).first()[0]
    assert approx < 100
