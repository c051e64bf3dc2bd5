"""The document pipeline: language, repeated lines, near-duplicates, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of ``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import decontaminate, language_id, line_dedup, packing, simhash
from creditloom.llm.common import read, remainder
from creditloom.session import materialise

#: Tokens and hashes are beyond SQL; the tests hold the stages against plain versions instead.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language to name go: those without a letter."""
    model = language_id.learn(docs.where(remainder(docs["doc_id"], 3) != 1))
    found = language_id.predict(docs, model)
    return found.where(~language_id.rejected()).select("doc.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least ten documents go from all of them; the documents stay."""
    out = line_dedup.drop_repeated_lines(docs)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    untouched = F.col("n_dropped") == 0
    return out.select(
        *(
            F.when(untouched, F.col("doc")[c]).otherwise(changed[c]).alias(c)
            if c in changed
            else F.col("doc")[c].alias(c)
            for c in docs.columns
        )
    )


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, with their ids."""
    return packing.pack(docs, keep=["doc_id"]).select(
        "doc.doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written before the next stage reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
