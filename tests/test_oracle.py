"""Every registered query against its SQL on the smallest given tables."""

import os

import pytest

from oracle_check import compare, connect

import __spark_entry__ as entry
from creditloom.queries import catalogue

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval"):
        assert node not in plan
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None


def test_listed_tables_are_whole(spark, monkeypatch):
    from creditloom.queries import files

    names, listing = [], files.tables.list_tables
    monkeypatch.setattr(files.tables, "list_tables", lambda s, n, like: names.append(n) or listing(s, n, like))
    listed = [r.tableName for r in entry.queries()["table_listing"](spark, SF_DIR).collect()]
    found = {t: spark.table(f"{names[0]}.{t}").count() for t in listed}
    count = lambda t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count()
    assert found == {"kpi_orders": count("orders"), "kpi_parts": count("part")}


def _scans(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    return {
        line.split(SF_DIR + "/")[1].split(".parquet")[0]: line.split("ReadSchema: ")[1]
        for line in plan.splitlines()
        if "FileScan parquet" in line
    }


@pytest.mark.parametrize(
    "name, tables",
    [
        ("demographic_cube", {"customer"}),
        ("unpivot_stack", {"customer", "orders", "lineitem"}),
    ],
)
def test_unused_tables_are_not_read(spark, name, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", 500)
    assert set(_scans(spark, name)) == tables


def test_unused_columns_are_not_read(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 500)
    assert _scans(spark, "demographic_cube")["customer"].startswith("struct<c_custkey:bigint>")
    assert _scans(spark, "dq_uniqueness")["lineitem"].startswith(
        "struct<l_orderkey:bigint,l_linenumber:int>"
    )


def test_rows_come_in_the_stated_order(spark):
    """Rates fall, ties by name; months rise; age bands and stages in their own order."""
    from creditloom.plans import kpi
    from creditloom.queries import marts
    from creditloom.session import materialise

    m = marts.mart(spark, SF_DIR)
    clients, fact = materialise(m.dim_client, "clients"), materialise(m.fact, "fact")
    for label in ("sex_label", "education_label", "marriage_label"):  # q2 to q4
        rows = kpi.rate_per_label(clients, label).collect()
        assert len(rows) > 1 and rows == sorted(rows, key=lambda r: (-r.default_rate, r[label]))
    bands = [r.age_band for r in kpi.rate_per_label(clients, "age_band").collect()]  # q5
    assert len(bands) > 2 and bands == sorted(bands)
    for table in (kpi.behaviour, kpi.rate_vs_macro, kpi.monthly_a):  # q6, q7 and the KPI table
        months = [r.date_key for r in table(fact, m.dim_date).collect()]
        assert len(months) == 6 and months == sorted(months)
    places = [r.position for r in entry.queries()["age_band_ordered"](spark, SF_DIR).collect()]
    assert len(places) > 2 and places == sorted(places)
    stages = [(r.pipeline, r.stage) for r in entry.queries()["metrics_table"](spark, SF_DIR).collect()]
    assert len(stages) > 2 and stages == sorted(stages)


def test_one_mart(spark):
    """The queries read the mart that is loaded, with fences; dimension and fact share the written clients."""
    from creditloom.queries import marts

    m = marts.mart(spark, SF_DIR)
    bounds = m.fact.selectExpr("max(bill_amt) AS most").first().most
    raw = marts.fact_b(spark, SF_DIR).selectExpr("max(bill_amt) AS most").first().most
    assert bounds < raw
    files = [set(d.inputFiles()) for d in (m.dim_client, m.fact)]
    shared = [f for f in files[0] if "filled" in f]
    assert shared and set(shared) <= files[1]


def test_flagship(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "date_key" and result.count() == 6
