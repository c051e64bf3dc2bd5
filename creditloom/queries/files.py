"""Sources and sinks: every round trip writes to the shared scratch folder and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from creditloom.bindings import CENTS, SCHEMAS, credit_wide, macro_long, table
from creditloom.functions.scalars import month_key_of_text, observed, parse_number
from creditloom.operators.observe import landing_metadata as metadata_of
from creditloom.operators.quality import schema_report
from creditloom.plans import kpi as K
from creditloom.plans import mart as M
from creditloom.queries.marts import KPI_CTES, cells, cells_sql, fact_b, kpis_of_both, mart
from creditloom.queries.registry import query
from creditloom.queries.sql import with_ctes
from creditloom.session import scratch_path
from creditloom.sinks import tables
from creditloom.sources import files
from creditloom.streaming.bus import ENVELOPE
from creditloom.vocabulary import CREDIT_TOPIC, KPI_TABLES, MACRO_TOPIC

_MONEY = f"CAST(sum({CENTS.format('o_totalprice')}) AS BIGINT)"
_ORDERS_SQL = (
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, "
    f"{_MONEY} AS cents, CAST(min(o_orderdate) AS DATE) AS first_day, "
    "CAST(max(o_orderdate) AS DATE) AS last_day FROM orders "
    "GROUP BY o_orderstatus, o_orderpriority"
)


def _order_summary(orders):
    return orders.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n_orders"),
        F.expr(_MONEY).alias("cents"),
        F.to_date(F.min("o_orderdate")).alias("first_day"),
        F.to_date(F.max("o_orderdate")).alias("last_day"),
    )


def _database(spark) -> str:
    """A fresh database below the shared folder; the default warehouse folder is left alone."""
    name = f"loom_{uuid.uuid4().hex[:10]}"
    tables.rebuild_database(spark, name, scratch_path(spark, name))
    return name


@query("scan_csv_roundtrip", _ORDERS_SQL)
def scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "orders_csv")
    tables.write_csv(table(spark, sf, "orders"), path)
    return _order_summary(files.read_csv(spark, path, SCHEMAS["orders"]))


@query(
    "scan_json_observations",
    with_ctes("SELECT series_id, obs_date, value FROM macro_long", "macro_long"),
)
def scan_json_observations(spark, sf):
    """One document per series and year, the series only in the path, as nested arrays."""
    observation = F.struct(F.col("obs_date").alias("date"), "value")
    documents = (
        macro_long(spark, sf)
        .groupBy(F.col("series_id").alias("series"), F.substring("obs_date", 1, 4).alias("year"))
        .agg(
            F.min("obs_date").alias("observation_start"),
            F.max("obs_date").alias("observation_end"),
            F.count("*").alias("count"),
            F.sort_array(F.collect_list(observation)).alias("observations"),
        )
        .drop("year")
    )
    path = scratch_path(spark, "observations")
    documents.write.partitionBy("series").json(path)
    return files.read_observations(spark, path, "series=([^/]+)/", multi_line=False)


@query(
    "managed_table_roundtrip",
    _ORDERS_SQL,
)
def managed_table_roundtrip(spark, sf):
    name = f"{_database(spark)}.orders"
    tables.save_table(table(spark, sf, "orders"), name)
    return _order_summary(spark.table(name))


@query("ctas_roundtrip", _ORDERS_SQL)
def ctas_roundtrip(spark, sf):
    database = _database(spark)
    view = f"source_{uuid.uuid4().hex[:10]}"
    table(spark, sf, "orders").createOrReplaceTempView(view)
    tables.create_as(spark, f"{database}.orders", f"SELECT * FROM {view}")
    return _order_summary(spark.table(f"{database}.orders"))


@query(
    "staging_roundtrip",
    with_ctes(
        "SELECT date_key, count(*) AS n_rows, count(bill_amt) AS n_bills, "
        "round(sum(bill_amt), 2) AS bills FROM elt_fact "
        "GROUP BY date_key",
        "elt_fact",
    ),
)
def staging_roundtrip(spark, sf):
    """The fact is staged by period, so a reader of some periods opens only their folders."""
    path = scratch_path(spark, "fact")
    tables.write_parquet(fact_b(spark, sf), path, ["date_key"])
    return spark.read.parquet(path).groupBy("date_key").agg(
        F.count("*").alias("n_rows"),
        F.count("bill_amt").alias("n_bills"),
        F.round(F.sum("bill_amt"), 2).alias("bills"),
    )


@query(
    "csv_numeric_coercion",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CASE WHEN p_retailprice = "
    "floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) "
    "ELSE CAST(p_retailprice AS VARCHAR) END AS p_retailprice FROM part",
)
def csv_numeric_coercion(spark, sf):
    path = scratch_path(spark, "part_csv")
    columns = ["p_partkey", "p_name", "p_retailprice"]
    tables.write_csv(table(spark, sf, "part").select(*columns), path)
    return files.read_text_numbers(spark, path, columns)


def _fields(messages):
    """(topic, key, name, number, text) of each field of a message: number where the text is one."""
    pairs = F.explode(F.from_json("value", "map<string,string>")).alias("name", "v")
    number = F.col("v").try_cast("double")
    return messages.select("topic", "key", pairs).select(
        "topic", "key", "name", number.alias("number"), F.when(number.isNull(), F.col("v")).alias("text")
    )


def _fields_sql(topic, key, source):
    return (
        f"SELECT '{topic}' AS topic, key, name, TRY_CAST(v AS DOUBLE) AS number, "
        "CASE WHEN TRY_CAST(v AS DOUBLE) IS NULL THEN v END AS text FROM (UNPIVOT "
        f"(SELECT CAST({key} AS VARCHAR) AS key, CAST(COLUMNS(*) AS VARCHAR) FROM ({source})) "
        "ON COLUMNS(* EXCLUDE (key)) INTO NAME name VALUE v)"
    )


@query(
    "bus_envelope",
    with_ctes(
        _fields_sql(MACRO_TOPIC, "series_id", "SELECT * FROM macro_long")
        + " UNION ALL "
        + _fields_sql(CREDIT_TOPIC, "id", "SELECT * FROM credit_wide"),
        "macro_long",
        "credit_wide",
    ),
)
def bus_envelope(spark, sf):
    """Whole records as messages, read back field by field."""
    bus = scratch_path(spark, "bus")
    tables.publish(tables.envelope(macro_long(spark, sf), MACRO_TOPIC, "series_id"), bus)
    tables.publish(tables.envelope(credit_wide(spark, sf), CREDIT_TOPIC, "id"), bus)
    return _fields(spark.read.schema(ENVELOPE).parquet(bus))


@query(
    "bus_first_records",
    with_ctes(
        _fields_sql(CREDIT_TOPIC, "id", "SELECT * FROM credit_wide ORDER BY id LIMIT 25"),
        "credit_wide",
    ),
)
def bus_first_records(spark, sf):
    """The row cap of a publisher (a trial run), by key so that it is repeatable."""
    return _fields(tables.envelope(credit_wide(spark, sf), CREDIT_TOPIC, "id", 25))


_ALL_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "table_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _ALL_TABLES
    ),
)
def table_counts(spark, sf):
    return files.count_tables({t: table(spark, sf, t) for t in _ALL_TABLES})


@query(
    "kpi_export",
    with_ctes(
        f"SELECT 'a' AS path, * FROM ({cells_sql('a')}) UNION ALL SELECT 'b', * FROM ({cells_sql('b')})",
        *KPI_CTES,
    ),
)
def kpi_export(spark, sf):
    """KPI tables of both paths as managed tables, all eight exported to CSV and read back from it."""
    parts = []
    for path, kpis in kpis_of_both(spark, sf).items():
        name = _database(spark)
        K.save_kpis(spark, name, kpis)
        written = tables.export_tables(spark, [name], KPI_TABLES, scratch_path(spark, "exports"))
        back = {
            t: files.read_csv(spark, written[f"{name}__{t}"], spark.table(f"{name}.{t}").schema)
            for t in KPI_TABLES
        }
        parts.append(cells(back).select(F.lit(path).alias("path"), "*"))
    return parts[0].unionByName(parts[1])


@query(
    "landing_metadata",
    "SELECT 'orders' AS source, count(*) AS rows, CAST(6 AS BIGINT) AS cols, true AS has_bytes FROM orders "
    "UNION ALL SELECT 'lineitem', count(*), 11, true FROM lineitem",
)
def landing_metadata(spark, sf):
    """The record has a row per file; files and bytes are not in SQL's reach, so they are summed up."""
    both = metadata_of(table(spark, sf, "orders"), "orders").unionByName(
        metadata_of(table(spark, sf, "lineitem"), "lineitem")
    )
    return both.groupBy("source").agg(
        F.sum("rows").alias("rows"),
        F.max("cols").cast("bigint").alias("cols"),
        (F.min("size_bytes") > 0).alias("has_bytes"),
    )


@query("first_source", _ORDERS_SQL)
def first_source(spark, sf):
    """The first candidate that exists is read, whatever comes after it."""
    path = scratch_path(spark, "orders_csv")
    tables.write_csv(table(spark, sf, "orders"), path)
    found = files.first_existing(spark, [f"{path}-absent", path, f"{sf}/orders.parquet"])
    return _order_summary(files.read_csv(spark, found, SCHEMAS["orders"]))


_BAD_SQL = (
    "SELECT CASE WHEN o_orderkey % 7 = 1 THEN CAST(o_custkey AS VARCHAR) || '.0' "
    "WHEN o_orderkey % 7 = 2 THEN CAST(o_custkey AS VARCHAR) || '.5' WHEN o_orderkey % 7 = 3 THEN 'n/a' "
    "WHEN o_orderkey % 7 = 4 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS a, "
    "CASE WHEN o_orderkey % 5 = 1 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) || '.25' END AS b FROM orders"
)


@query(
    "csv_bad_values",
    "SELECT count(*) AS n_rows, CAST(sum(o_custkey) FILTER (o_orderkey % 7 NOT IN (2, 3, 4)) AS BIGINT) "
    "AS sum_a, CAST(sum(o_custkey + 0.25) FILTER (o_orderkey % 5 <> 1) AS DOUBLE) AS sum_b, "
    "count(*) FILTER (o_orderkey % 7 IN (2, 3)) AS lost_a, count(*) FILTER (o_orderkey % 5 = 1) AS lost_b "
    "FROM orders",
)
def csv_bad_values(spark, sf):
    """Numbers that their type cannot hold: counted as lost, while 2.0 is still a whole number."""
    path = scratch_path(spark, "bad_csv")
    view = {"orders": table(spark, sf, "orders")}
    tables.write_csv(spark.sql(_BAD_SQL.replace("FROM orders", "FROM {orders}").replace("VARCHAR", "STRING"), **view), path)
    text = files.read_credit_text(spark, [path])
    kinds = {"a": "bigint", "b": "double"}.get
    lost = files.lost_values(text, kinds).groupBy().pivot("column", ["a", "b"]).agg(F.first("lost"))
    sums = files.typed(text, kinds).agg(F.count("*").alias("n_rows"), F.sum("a").alias("sum_a"), F.sum("b").alias("sum_b"))
    return sums.select(
        "*", lost.select("a").scalar().alias("lost_a"), lost.select("b").scalar().alias("lost_b")
    )


@query("rebuild_twice", _ORDERS_SQL)
def rebuild_twice(spark, sf):
    """A load that is run again leaves the tables of one run."""
    name = _database(spark)
    for _ in range(2):
        tables.rebuild_database(spark, name, scratch_path(spark, name))
        tables.save_table(table(spark, sf, "orders"), f"{name}.orders")
    return _order_summary(spark.table(f"{name}.orders"))


@query(
    "table_listing",
    "SELECT 'kpi_orders' AS \"tableName\", count(*) AS n_rows FROM orders UNION ALL SELECT 'kpi_parts', count(*) FROM part",
)
def table_listing(spark, sf):
    """The tables whose names match, each with the number of rows read back from it."""
    name = _database(spark)
    for t, source in {"kpi_orders": "orders", "kpi_parts": "part", "raw_parts": "part"}.items():
        tables.save_table(table(spark, sf, source), f"{name}.{t}")
    listed = tables.list_tables(spark, name, "kpi_*")
    found = {r["tableName"]: spark.table(f"{name}.{r['tableName']}") for r in listed.collect()}
    counts = files.count_tables(found)
    return listed.join(counts.withColumnRenamed("table_name", "tableName"), "tableName")


def _expected(schema: dict[str, str], rows: str) -> str:
    values = ", ".join(f"('{c}', '{t}')" for c, t in schema.items())
    return (
        f"SELECT n_rows, c AS \"column\", t AS expected, t AS found, true AS conforms "
        f"FROM (VALUES {values}) AS v(c, t), (SELECT count(*) AS n_rows FROM {rows})"
    )


@query("schema_conformance", with_ctes(_expected(M.DIM_CLIENT_SCHEMA, "credit_wide"), "credit_wide"))
def schema_conformance(spark, sf):
    return schema_report(mart(spark, sf).dim_client, M.DIM_CLIENT_SCHEMA)


@query("schema_conformance_fact", with_ctes(_expected(M.FACT_SCHEMA, "elt_fact"), "elt_fact"))
def schema_conformance_fact(spark, sf):
    return schema_report(mart(spark, sf).fact, M.FACT_SCHEMA)


@query(
    "filter_missing_marker",
    with_ctes(
        "SELECT series_id, date_key, CAST(value AS DOUBLE) AS value FROM macro_seen",
        "macro_seen",
    ),
)
def filter_missing_marker(spark, sf):
    rows = macro_long(spark, sf).filter(observed(F.col("value")))
    return rows.select(
        "series_id",
        month_key_of_text(F.col("obs_date")).alias("date_key"),
        parse_number(F.col("value")).alias("value"),
    )
