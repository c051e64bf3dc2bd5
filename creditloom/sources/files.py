"""File scans: parquet, CSV, nested JSON, and picking the first source that exists."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.names import standardise_columns
from creditloom.functions.scalars import number_or_text

OBSERVATIONS_SCHEMA = T.StructType(
    [
        T.StructField("observation_start", T.StringType()),
        T.StructField("observation_end", T.StringType()),
        T.StructField("units", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField(
            "observations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("date", T.StringType()),
                        T.StructField("value", T.StringType()),
                        T.StructField("realtime_start", T.StringType()),
                        T.StructField("realtime_end", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system that owns the path, whichever it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop.getFileSystem(conf).exists(hadoop)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.getFileSystem(conf).delete(hadoop, True)


def first_existing(spark: SparkSession, candidates: Iterable[str]) -> str:
    candidates = list(candidates)
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these sources exists: {candidates}")


def read_csv(spark: SparkSession, path, schema: T.StructType | None = None) -> DataFrame:
    """CSV with header. Without a schema Spark reads the file twice, so give one for large data."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def header_schema(spark: SparkSession, path: str, type_of: Callable[[str], str]) -> T.StructType:
    """Schema of a CSV from its header line and a rule for types; no pass over the data."""
    names = spark.read.option("header", True).csv(path).columns
    fields = ", ".join(f"`{n}` {type_of(n)}" for n in names)
    return T.StructType.fromDDL(fields)


def typed(text: DataFrame, type_of: Callable[[str], str]) -> DataFrame:
    """Text columns as the types of a rule. A whole number may be written with a fraction of zero.

    What a type cannot hold becomes NULL; ``lost_values`` counts it.
    """
    return text.select(*[_number(F.col(f"`{c}`"), type_of(c)).alias(c) for c in text.columns])


def _number(text: Column, kind: str) -> Column:
    if kind == "string":
        return text
    plain = F.trim(text)
    if kind not in ("int", "bigint"):
        return plain.try_cast(kind)
    fraction = plain.try_cast("decimal(38,6)")
    whole = F.when(fraction == F.floor(fraction), fraction.try_cast(kind))
    return F.coalesce(plain.try_cast(kind), whole)


def lost_values(text: DataFrame, type_of: Callable[[str], str]) -> DataFrame:
    """(column, lost): values that are there as text and not after ``typed``; one scan."""
    names = text.columns
    row = text.agg(
        *[
            F.count_if(
                (F.trim(F.col(f"`{c}`")) != "") & _number(F.col(f"`{c}`"), type_of(c)).isNull()
            ).alias(f"n{i}")
            for i, c in enumerate(names)
        ]
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("lost")) for i, c in enumerate(names)]
    return row.select(F.inline(F.array(*pairs)))


def read_credit_text(spark: SparkSession, candidates: Iterable[str]) -> DataFrame:
    """Credit rows of the first source present, every column as text."""
    path = first_existing(spark, candidates)
    return read_csv(spark, path, header_schema(spark, path, lambda name: "string"))


def read_credit(
    spark: SparkSession,
    candidates: Iterable[str],
    type_of: Callable[[str], str] | None = None,
    rule: Callable[[DataFrame], DataFrame] = standardise_columns,
) -> DataFrame:
    """Credit rows of the first source present, with names made canonical.

    Types come from ``type_of`` where it is given (``lost_values`` tells what they can't hold), else
    they are inferred.
    """
    if type_of:
        return rule(typed(read_credit_text(spark, candidates), type_of))
    return rule(read_csv(spark, first_existing(spark, candidates)))


def read_observations(
    spark: SparkSession, paths, tag_pattern: str, multi_line: bool = False
) -> DataFrame:
    """(series_id, obs_date, value) of nested documents; the series is part of the file path.

    Documents are one JSON line each and are split over tasks. A document over several lines needs
    ``multi_line``, with one task per file. Text that is no document fails the job.
    """
    reader = spark.read.schema(OBSERVATIONS_SCHEMA).option("mode", "FAILFAST")
    documents = reader.option("multiLine", multi_line).json(paths)
    return documents.select(
        F.regexp_extract(F.col("_metadata.file_path"), tag_pattern, 1).alias("series_id"),
        F.explode("observations").alias("o"),
    ).select("series_id", F.col("o.date").alias("obs_date"), F.col("o.value").alias("value"))


def read_series_files(
    spark: SparkSession,
    path_of: Callable[[str], str],
    series: Iterable[str],
    tag_pattern: str,
    multi_line: bool = True,
) -> DataFrame:
    """Observations of the series whose file is there; an absent file means an absent series."""
    present = [p for p in map(path_of, series) if path_exists(spark, p)]
    if not present:
        return spark.createDataFrame([], "series_id string, obs_date string, value string")
    return read_observations(spark, present, tag_pattern, multi_line)


def read_text_numbers(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV read as text with the named columns in normal number form; absent file, no rows."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = read_csv(spark, path, schema)
    return rows.select(*[number_or_text(F.col(c)).alias(c) for c in columns])


def count_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of several tables in one job."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
