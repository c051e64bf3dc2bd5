"""Line dedup: drop lines that many documents share.

Lines are normalised, exploded and hashed; the number of distinct documents per hash decides; the
hits go back to their documents as positions, and the text between them is put together again. All
of it is DataFrame functions.

Only hashes and positions are exploded and shuffled; a text moves once, for the last join. A line
that sits in a third of all documents is counted per (hash, document) first and dealt over ``SALTS``
parts when the hits are looked up, so that no task holds all of it.

Defined results: a null text is an empty one, which has one empty line. Blank lines have an empty key
and stay while ``min_chars`` is over 0. Rows with the same id are one document when documents are
counted (all rows without an id together are one as well); each row gets its own text back. Lines are
compared by 96 bits of hash. Further columns are kept in ``doc`` and never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import BLANKS, ascii_lower, packed

#: Parts that a line's rows are dealt over in the look-up. A dropped line has at least ``min_docs``
#: rows, so the copies of the key table stay a small multiple of the rows.
SALTS = 16


def line_keys(text: Column) -> Column:
    """Per line, in order: the two hashes of its key and the key's length."""
    keys = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1)

    def hashed(line: Column) -> Column:
        key = F.trim(line, F.lit(BLANKS))
        return F.struct(
            F.xxhash64(key).alias("a"), F.hash(key).alias("b"), F.char_length(key).alias("n")
        )

    return F.transform(keys, hashed)


def _between(text: Column, drops: Column) -> Column:
    """The text without the lines at the positions ``drops`` (sorted), in time linear in the text."""
    given = F.struct(
        F.split(F.coalesce(text, F.lit("")), "\n", -1).alias("lines"), drops.alias("drops")
    )

    def kept(x: Column) -> Column:
        lines, cut = x["lines"], x["drops"]

        def stretch(k: Column) -> Column:
            first = F.when(k == 0, F.lit(1)).otherwise(F.get(cut, k - 1) + 2)
            end = F.when(k == F.size(cut), F.size(lines) + 1).otherwise(F.get(cut, k) + 1)
            return F.slice(lines, first, end - first)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(cut)), stretch)), "\n")

    # the one-element array binds the pieces once; inside a lambda they would be made again each time
    return F.transform(F.array(given), kept)[0]


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
) -> DataFrame:
    """Per input row: ``doc`` (the row), ``n_lines``, ``n_dropped`` and ``kept`` (the text left)."""
    rows = packed(docs)
    doc_id, text = F.col("doc")[id_col], F.col("doc")[text_col]
    sig = F.xxhash64(text)
    lines = rows.select(
        doc_id.alias("id"), sig.alias("sig"), F.posexplode(line_keys(text)).alias("pos", "key")
    ).where(F.col("key.n") >= min_chars)
    lines = lines.select("id", "sig", "pos", "key.a", "key.b")
    frequent = (
        lines.groupBy("a", "b")
        .agg(F.count_distinct("id").alias("n"), F.max(F.col("id").isNull().cast("int")).alias("none"))
        .where(F.col("n") + F.col("none") >= min_docs)
        .select("a", "b", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("id", "sig"), F.lit(SALTS)).cast("int"))
    drops = (
        salted.join(frequent, ["a", "b", "salt"], "left_semi")
        .groupBy("id", "sig")
        .agg(F.array_sort(F.collect_set("pos")).alias("drops"))
        .select(F.col("id").alias("drop_id"), F.col("sig").alias("drop_sig"), "drops")
    )
    joined = rows.join(
        drops, doc_id.eqNullSafe(F.col("drop_id")) & (sig == F.col("drop_sig")), "left"
    )
    cut = F.coalesce(F.col("drops"), F.array().cast("array<int>"))
    plain = F.coalesce(text, F.lit(""))
    return joined.select(
        "doc",
        (F.char_length(plain) - F.char_length(F.replace(plain, F.lit("\n"), F.lit(""))) + 1)
        .cast("long")
        .alias("n_lines"),
        F.size(cut).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), plain).otherwise(_between(text, cut)).alias("kept"),
    )
