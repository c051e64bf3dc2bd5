"""SimHash near-duplicates through segment bit counts.

A fingerprint is embedded as the bit counts of its 32 two-bit segments. Flipping a bit moves one count
by one, so the Manhattan distance of two embeddings is a lower bound of the Hamming distance. The counts
are kept in unary inside the segment (00, 01, 11), which makes that distance the number of differing
bits of two long integers.

The range join runs on a grid of unit cells. The 32 segments are three blocks; of a Manhattan distance of
at most 4, the block that differs most holds two or more (or there is no more than 2 in all), so the other
two blocks together differ by at most 2. Every fingerprint is put, for each pair of blocks, into its own
cell and into the cells at distance 1. Two fingerprints at distance 0 meet in their own cell, at distance
1 in the own cell of one and a neighbour cell of the other, at distance 2 in a cell between them; each
kind is accepted in those cells only, so a link is found a few times and not in all cells that both are
in. The candidates are then verified exactly. About 100 cells per fingerprint, two long numbers each,
whatever the data; chance meetings are about 1 in 400,000 pairs.

Copies are one fingerprint here. A cell with more than ``DENSE`` fingerprints is not paired out: those
within reach of the cell's smallest fingerprint are linked to it, and only the others are paired, with
all of the cell. Linking through it loses no component: each pair left out is linked through it. Cells of one
fingerprint are left out when cells are written; the others are joined from that table, where the skew
join may split a full cell over tasks.

Defined results: a null text is an empty one; texts without words have fingerprint zero and are linked
like any other. Rows without an id take part; the smallest id that is not null names the component, and
a component without ids has none. Repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.components import components
from creditloom.session import materialise

#: Words of a shingle, seed of its hash, bits that linked fingerprints may differ in.
SHINGLE = 4
SEED = 42
REACH = 4
#: Fingerprints of a cell that are paired out.
DENSE = 64
#: Shingles whose bits are counted together.
_PART = 1 << 16
#: A-Z in lower case; all other bytes stay.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The lower bit of each two-bit segment.
_LOW = 0x5555555555555555
#: First segments of the three blocks, and the end.
_BLOCKS = (0, 11, 22, 32)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 majority bits over the hashes of all shingles, as an unsigned number."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(shingle, len(words)) - 1
    starts, ends = starts[: len(words) - last], ends[last:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist())],
        dtype=np.uint64,
        count=len(starts),
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _PART):
        part = hashes[at : at + _PART]
        counts += _bit_counts(part)
    bits = np.packbits(counts * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit, highest first.

    Eight hashes' bits at one place fit into a byte as counters: per shift, the bytes of the masked
    words are summed, which needs no array of single bits.
    """
    spread = np.uint64(0x0101010101010101)
    out = np.empty(64, dtype=np.int64)
    padded = np.zeros(-(-len(hashes) // 255) * 255, dtype=np.uint64)
    padded[: len(hashes)] = hashes
    groups = padded.reshape(-1, 255)
    for shift in range(8):
        # 255 ones at most per byte of the sum: no carry into the next byte
        sums = ((groups >> np.uint64(shift)) & spread).sum(axis=1, dtype=np.uint64)
        per_byte = sums.astype(">u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        out[7 - shift :: 8] = per_byte
    return out


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per input row: ``doc`` (the row, or its columns ``keep``) and ``fp`` as a signed long."""
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc", "fp"]
            )

    return rows.mapInArrow(run, T.StructType([rows.schema["doc"], T.StructField("fp", T.LongType())]))


def embedded(fp: Column) -> Column:
    """Bit counts of the two-bit segments, in unary: 0 is 00, 1 is 01, 2 is 11."""
    high = F.shiftrightunsigned(fp, 1)
    low = F.lit(_LOW)
    return fp.bitwiseOR(high).bitwiseAND(low).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(high).bitwiseAND(low), 1)
    )


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _kept() -> list[tuple[int, int]]:
    """Per block that is left out: the bits of the others, and a mark that names it.

    The mark is 10 in the block's first segment, which is no unary count.
    """
    out = []
    for first, end in zip(_BLOCKS, _BLOCKS[1:]):
        block = (1 << 2 * end) - (1 << 2 * first)
        out.append((_signed(~block & (1 << 64) - 1), _signed(2 << 2 * first)))
    return out


def _cells(rows: DataFrame) -> DataFrame:
    """For each fingerprint its cells: ``fp`` and ``cell``, the counts of two blocks and a mark for the third."""
    rows = rows.select("fp", embedded(F.col("fp")).alias("e"))
    low, high = F.lit(_LOW), F.shiftrightunsigned("e", 1).bitwiseAND(F.lit(_LOW))
    # a count moves up by setting the next bit of its unary code, down by clearing the last one:
    # 0 by its lower bit, 1 by either, 2 by its higher bit
    lower = low.bitwiseAND(F.bitwise_not(high))
    higher = F.shiftleft(F.col("e").bitwiseAND(low), 1)
    rows = rows.withColumn("moves", lower.bitwiseOR(higher))
    steps = []
    for kept, mark in _kept():
        bits = [0] + [_signed(1 << j) for j in range(64) if kept >> j & 1]
        steps += [F.struct(F.lit(m).alias("bit"), F.lit(kept).alias("kept"), F.lit(mark).alias("mark")) for m in bits]
    rows = rows.select("fp", "e", "moves", F.explode(F.array(*steps)).alias("step"))
    bit = F.col("step.bit")
    cell = F.col("e").bitwiseXOR(bit).bitwiseAND(F.col("step.kept")).bitwiseOR(F.col("step.mark"))
    return rows.where(F.col("moves").bitwiseAND(bit) == bit).select("fp", cell.alias("cell"))


def _own(fp: Column, cell: Column) -> Column:
    """The own cell of a fingerprint, of the same two blocks as ``cell``."""
    (kept, mark), *others = _kept()
    segment = F.lit(_signed(3 << 2 * _BLOCKS[0]))
    own = F.when(cell.bitwiseAND(segment) == mark, embedded(fp).bitwiseAND(F.lit(kept)).bitwiseOR(F.lit(mark)))
    for first, (kept, mark) in zip(_BLOCKS[1:], others):
        moved = embedded(fp).bitwiseAND(F.lit(kept)).bitwiseOR(F.lit(mark))
        own = own.when(cell.bitwiseAND(F.lit(3 << 2 * first)) == mark, moved)
    return own


def links(fps: DataFrame, reach: int = REACH, dense: int = DENSE) -> DataFrame:
    """Links ``a`` > ``b`` between different fingerprints of ``fps`` (column ``fp``, distinct).

    Every pair within ``reach`` (4 at most) is linked, or both are linked to one fingerprint.
    """
    if reach > 4:
        raise ValueError("two of three blocks with cells at distance 1 find at most 4 differing bits")
    place = Window.partitionBy("cell")
    cells = _cells(fps).select(
        "*", F.count("*").over(place).alias("size"), F.min("fp").over(place).alias("pivot")
    )
    by_pivot = (F.col("size") > dense) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot"))) <= reach)
    cells = cells.where("size > 1").select(
        "fp", "cell", "pivot", _own(F.col("fp"), F.col("cell")).alias("own"), by_pivot.alias("starred")
    )
    cells = materialise(cells, "cells")
    left = cells.where(~F.col("starred")).select(
        "cell", F.col("fp").alias("x"), F.col("own").alias("tx"), (F.col("own") != F.col("cell")).cast("int").alias("ox")
    )
    right = cells.select(
        F.col("cell").alias("at"),
        F.col("fp").alias("y"),
        F.col("own").alias("ty"),
        (F.col("own") != F.col("cell")).cast("int").alias("oy"),
        "starred",
    )
    apart = F.bit_count(F.col("tx").bitwiseXOR(F.col("ty")))
    verified = F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= reach
    # rows that are not on the left meet every left row here once; two left rows meet twice
    once = F.col("starred") | (F.col("x") > F.col("y"))
    pairs = left.join(
        right,
        (F.col("cell") == F.col("at"))
        & once
        & (F.col("x") != F.col("y"))
        & (F.col("ox") + F.col("oy") == apart)
        & verified,
    ).select("x", "y")
    stars = cells.where(F.col("starred") & (F.col("fp") != F.col("pivot"))).select(
        F.col("fp").alias("x"), F.col("pivot").alias("y")
    )
    return pairs.unionByName(stars).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))


def _rows(docs: DataFrame, text_col: str, keep: list[str] | None) -> DataFrame:
    """Rows with fingerprint and a number of their own, written so that both stay what they are."""
    found = fingerprints(docs, text_col, keep).withColumn("row", F.monotonically_increasing_id())
    return materialise(found, "fingerprints")


def _roots(fps: DataFrame, reach: int) -> DataFrame:
    """Of each distinct fingerprint the smallest one that it reaches."""
    roots = components(links(fps.select("fp"), reach))
    return fps.join(roots, fps.fp == roots.node, "left").select(*fps.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    reach: int = REACH,
) -> DataFrame:
    """Per input row: ``doc`` (the row, or its columns ``keep``), ``fp`` and ``component_id``."""
    rows = _rows(docs, text_col, keep)
    heads = rows.groupBy("fp").agg(F.min(F.col("doc")[id_col]).alias("head"))
    linked = _roots(materialise(heads, "fingerprint-heads"), reach)
    named = linked.groupBy("root").agg(F.min("head").alias("component_id"))
    members = linked.select("fp", "root").join(named, "root").select("fp", "component_id")
    return rows.join(members, "fp").select("doc", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH
) -> DataFrame:
    """One row of each component: that with the smallest id, and one of several such rows."""
    rows = _rows(docs, text_col, None)
    doc_id = F.col("doc")[id_col]
    first = F.min(F.struct(doc_id.isNull().alias("none"), doc_id.alias("id"), F.col("row")))
    heads = materialise(rows.groupBy("fp").agg(first.alias("head")), "fingerprint-heads")
    kept = _roots(heads, reach).groupBy("root").agg(F.min("head").alias("head")).select(F.col("head.row").alias("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")
