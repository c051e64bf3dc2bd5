"""Table and file sinks."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Text form of timestamps in messages and landed files; the default of the writers drops microseconds.
TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# What became of a table of an export.
EXPORT = "database string, table string, status string, rows bigint, reason string"


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a parquet table. Partitioning by period lets readers skip whole folders."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def rebuild_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Drop and create, so a load can be run again from the start."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE {database}{where}")


def save_table(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def save_bucketed(df: DataFrame, table: str, key: list[str], buckets: int) -> None:
    """A table whose rows lie in ``buckets`` files by a hash of ``key``, sorted by it.

    Tables with the same key and number of buckets are joined where they lie. Rows are brought
    together by key before the write, so that there is one file per bucket.
    """
    placed = df.repartition(buckets, *key)
    placed.write.mode("overwrite").format("parquet").bucketBy(buckets, *key).sortBy(*key).saveAsTable(table)


def create_as(spark: SparkSession, table: str, select: str) -> None:
    """CREATE TABLE AS SELECT in parquet, replacing an earlier run."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} USING PARQUET AS {select}")


def list_tables(spark: SparkSession, database: str, pattern: str = "*") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database} LIKE '{pattern}'").select("tableName")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_tables(
    spark: SparkSession, databases: Iterable[str], tables: Iterable[str], folder: str, record: str | None = None
) -> dict[str, str]:
    """CSV per table of every database; a table that fails is logged and left out.

    ``record`` is a folder for what became of each table (see ``EXPORT``), as JSON lines.
    """
    written: dict[str, str] = {}
    told: list[tuple] = []
    for database in databases:
        for table in tables:
            name = f"{database}__{table}"
            seen = Observation()
            try:
                rows = spark.table(f"{database}.{table}").observe(seen, F.count(F.lit(1)).alias("rows"))
                write_csv(rows, f"{folder}/{name}")
            except Exception as error:  # the rest of the export goes on
                log.warning("export of %s skipped: %s", name, error)
                told.append((database, table, "skipped", None, str(error).splitlines()[0][:200]))
                continue
            written[name] = f"{folder}/{name}"
            told.append((database, table, "written", seen.get["rows"], None))
    if record:
        write_report(spark.createDataFrame(told, EXPORT), record)
    return written


def write_report(report: DataFrame, path: str) -> None:
    """A rule report or landing record as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)


def envelope(df: DataFrame, topic: str, key: str, limit: int | None = None) -> DataFrame:
    """Rows as keyed JSON messages: (topic, key, value).

    ``limit`` keeps the first rows by key, for a trial run of a publisher.
    """
    rows = df if limit is None else df.orderBy(key).limit(limit)
    return rows.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns), TIMESTAMPS).alias("value"),
    )


def publish(
    messages: DataFrame, target: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> int:
    """Append messages to a bus and return how many there were, counted while they are written.

    The bus is a folder of files, or a broker with ``fmt="kafka"``.
    """
    seen = Observation()
    counted = messages.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(fmt).mode("append").options(**dict(options or {}))
    if fmt == "kafka":
        writer.option("kafka.bootstrap.servers", target).save()
    else:
        writer.save(target)
    return seen.get["rows"]
