"""Publication of a set of tables in one step.

Each load writes its tables as an attempt of its own, a partition next to those of earlier loads, and then adds one
row to the table ``published``. Readers use views that pick the attempt of the newest row, so they see all
tables of a load or none of it: a load that dies half-way leaves the old answer, and what it wrote is never
looked at. The views are made once and don't change; the partition is picked at run time, so other attempts
aren't read. Old attempts stay until ``drop_attempts``, for readers that are still at it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.sources.files import delete_path

POINTER = "published"
#: Name of the partition column, and the ending of the tables behind the views.
ATTEMPT = "attempt"
STORED = "_stored"

Tables = Mapping[str, tuple[DataFrame, list[str]]]


def create_database(spark: SparkSession, database: str, location: str) -> None:
    """Create the database and the empty pointer table, where they aren't there yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{POINTER} (version BIGINT, {ATTEMPT} STRING, tables ARRAY<STRING>) USING PARQUET"
    )


def current(spark: SparkSession, database: str) -> tuple[int, str | None]:
    """Number and attempt of the newest publication; (0, None) before the first."""
    pointer = spark.table(f"{database}.{POINTER}")
    row = pointer.agg(F.max("version").alias("v"), F.max_by(ATTEMPT, "version").alias("a")).first()
    return row["v"] or 0, row["a"]


def _missing_view(spark: SparkSession, database: str, name: str) -> bool:
    return not spark.catalog.tableExists(f"{database}.{name}")


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first()["data_type"]


def publish_tables(spark: SparkSession, database: str, tables: Tables) -> int:
    """Write all tables (name -> rows and partition columns) and switch to them in one step.

    Returns the number of the publication. If any table fails, readers keep what they have.
    """
    attempt = uuid.uuid4().hex
    for name, (df, by) in tables.items():
        stored = df.withColumn(ATTEMPT, F.lit(attempt))
        columns = [c for c in df.columns if c not in by]
        (
            stored.select(*columns, ATTEMPT, *by)
            .write.mode("append")
            .format("parquet")
            .partitionBy(ATTEMPT, *by)
            .saveAsTable(f"{database}.{name}{STORED}")
        )
    for name, (df, _) in tables.items():
        if _missing_view(spark, database, name):
            columns = ", ".join(f"`{c}`" for c in df.columns)
            spark.sql(
                f"CREATE VIEW {database}.{name} AS SELECT {columns} FROM {database}.{name}{STORED} WHERE {ATTEMPT} = "
                f"(SELECT max_by({ATTEMPT}, version) FROM {database}.{POINTER} WHERE array_contains(tables, '{name}'))"
            )
    version = current(spark, database)[0] + 1
    row = spark.createDataFrame([(version, attempt, sorted(tables))], f"version long, {ATTEMPT} string, tables array<string>")
    row.coalesce(1).write.mode("append").insertInto(f"{database}.{POINTER}")
    return version


def rewrite_partitions(spark: SparkSession, database: str, name: str, rows: DataFrame) -> None:
    """Replace, in the published table, the partitions that ``rows`` has values for, and no others.

    For a month that arrives again: running it twice gives the same table. Other folders aren't touched.
    """
    table = f"{database}.{name}{STORED}"
    attempt = current(spark, database)[1]
    if attempt is None:
        raise ValueError(f"nothing is published in {database}")
    columns = spark.table(table).columns
    by = columns[columns.index(ATTEMPT) :]
    # the writer's option is heeded for a path, not for a table
    stored = rows.withColumn(ATTEMPT, F.lit(attempt)).select(*columns)
    writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(_location(spark, table))
    spark.catalog.refreshTable(table)


def drop_attempts(spark: SparkSession, database: str, keep: int = 2) -> list[str]:
    """Delete all attempts but those of the newest ``keep`` publications; returns what went.

    For a time when no load runs: an attempt that isn't published yet goes as well.
    """
    pointer = spark.table(f"{database}.{POINTER}")
    kept = {r[ATTEMPT] for r in pointer.orderBy(F.desc("version")).limit(keep).collect()}
    gone = set()
    for table in spark.catalog.listTables(database):
        if not table.name.endswith(STORED):
            continue
        location = _location(spark, f"{database}.{table.name}")
        attempts = spark.table(f"{database}.{table.name}").select(ATTEMPT).distinct()
        for row in attempts.collect():  # a row per load
            if row[ATTEMPT] not in kept:
                delete_path(spark, f"{location}/{ATTEMPT}={row[ATTEMPT]}")
                gone.add(row[ATTEMPT])
        spark.catalog.refreshTable(f"{database}.{table.name}")
    return sorted(gone)
