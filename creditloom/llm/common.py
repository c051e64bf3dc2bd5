"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The characters that count as blank when words or lines are cut: space and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` does just that on pure ASCII and is many times faster than ``translate``.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The input row as one struct ``doc``, so that no output column can clash with an input column.

    ``columns`` keeps only those input columns.
    """
    return docs.select(F.struct(*([docs[c] for c in columns] or [docs[c] for c in docs.columns])).alias("doc"))


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % of
