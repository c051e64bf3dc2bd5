"""Ranked lexical search over a K2-treap: a compressed quadtree of the term-document grid with impact maxima.

Documents are dealt into blocks as they lie, without a shuffle. A block is a grid of its terms by its documents; a
point is a term's impact in a document, the part of the score that doesn't depend on the query. The grid is cut
into quadrants again and again; a cell that holds points is a node of four bits, one per child, and the largest
impact in it. Nodes of a level lie in Morton order, so a child's place is a running count of bits, and no pointers
are kept; maxima are kept as the difference to the parent's. Terms are ordered by how many documents have them
and documents by their most frequent term, which puts like documents side by side.

A query walks down the rows of all its terms at once. The top levels, which only halve terms, are walked once for the
terms of all queries. A step is a range of documents with the node of each term there; the sum of weight times node
maximum bounds the score of every document in it. Ranges are taken best first, some hundred at a time, and halved; a
range of one document has its exact score. What can't reach the k-th score found so far is left. A task carries the
k-th scores from block to block, and the best k of all tasks are merged by rank.

The index is a table (one row per block, see ``INDEX``), written once and searched as often as wanted. Queries are
sent to the tasks in slices of bounded text, each slice searches the index once.

Defined results: a null or empty text has no terms, never matches, and doesn't count as a document of the
collection. Rows are documents each, also with equal ids. Equal scores go by id, a document without an id last.
Each row of the queries is ranked for itself, also with equal ids; queries without terms find nothing. Empty
tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.decontaminate import word_count, words_of
from creditloom.session import materialise

#: Documents, and about how many points, of a block.
BLOCK_DOCS = 2048
BLOCK_POINTS = 1 << 20
#: Words of documents that are counted at a time.
WORDS = 1 << 17
#: Query text that is sent to the tasks at a time.
SLICE_BYTES = 4 << 20
#: Ranges that are halved at a time.
RANGES = 256
#: Ranges from which on their bounds are looked at.
FEW = 32
#: Parts that the results of a query are ranked in before they are merged.
PARTS = 32

_LAST = np.iinfo(np.int64).max
_ONES = np.array([bin(i).count("1") for i in range(16)], dtype=np.int32)


class Treap:
    """Nodes of all levels in one row, level by level; the leaves are the points."""

    def __init__(self, height: int, masks: np.ndarray, maxima: np.ndarray):
        """``masks`` of all nodes but the leaves, ``maxima`` of all nodes and of one more without children, which
        stands for absent cells."""
        self.height, self.maxima = height, maxima
        self.none = len(maxima) - 1
        self.masks = np.zeros(len(maxima), dtype=np.uint8)
        self.masks[: len(masks)] = masks
        # children follow the root in the order of their parents
        self.first = np.zeros(len(maxima), dtype=np.int64)
        np.cumsum(_ONES.take(self.masks[:-1]), out=self.first[1:])
        self.first += 1
        # levels from the top that have no point in a right half, as more rows than columns leave them
        self.narrow, low, high = 0, 0, 1
        while self.narrow < height and not (self.masks[low:high] & 0b1010).any():
            low, high = high, int(self.first[high - 1] + _ONES[self.masks[high - 1]])
            self.narrow += 1

    @classmethod
    def of(cls, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> Treap:
        """From points; no two at the same place."""
        height = max(1, int(max(rows.max(), cols.max())).bit_length())
        codes = (_spread(rows) << 1) | _spread(cols)
        order = np.argsort(codes)
        codes, top = codes[order], values[order].astype(np.int64)
        masks, maxima = [], [top]
        for _ in range(height):
            parents = codes >> 2
            starts = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
            bits = np.left_shift(1, codes & 3).astype(np.uint8)
            masks.append(np.bitwise_or.reduceat(bits, starts))
            top = np.maximum.reduceat(top, starts)
            maxima.append(top)
            codes = parents[starts]
        return cls(height, np.concatenate(masks[::-1]), np.concatenate([*maxima[::-1], [0]]))

    def children(self, nodes: np.ndarray, row_bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The left and the right child of each node in its upper (0) or lower half, or the empty node."""
        masks, first = self.masks.take(nodes), self.first.take(nodes)
        upper = masks & 3
        first += (upper - (upper >> 1)) * row_bit  # a lower half follows what is in the upper one
        masks >>= row_bit << 1
        left = masks & 1
        return np.where(left, first, self.none), np.where(masks & 2, first + left, self.none)

    def row_bits(self, rows: np.ndarray) -> np.ndarray:
        """For each level which half of their node the rows are in."""
        return ((rows[None, :] >> np.arange(self.height - 1, -1, -1)[:, None]) & 1).astype(np.uint8)

    def entries(self, rows: np.ndarray) -> np.ndarray:
        """The node of each row below the narrow levels, to which all walks for it come."""
        nodes = np.zeros(len(rows), dtype=np.int64)
        for bit in self.row_bits(rows)[: self.narrow]:
            nodes, _ = self.children(nodes, bit)
        return nodes

    def to_bytes(self) -> bytes:
        inner = np.flatnonzero(self.masks[: self.none])
        # every node but the leaves has children, so these are the first ones
        masks = self.masks[: len(inner)]
        packed = masks[0::2].copy()
        packed[: len(masks) // 2] |= masks[1::2] << 4
        steps = np.empty(self.none, dtype="<u4")
        steps[0] = self.maxima[0]
        parents = np.repeat(self.maxima[: len(inner)], _ONES[masks])
        np.subtract(parents, self.maxima[1 : self.none], out=steps[1:], casting="unsafe")
        del parents
        head = np.array([self.height, len(masks), len(steps)], dtype="<u8")
        out = zlib.compressobj(1)
        return b"".join([*map(out.compress, (head, packed, steps)), out.flush()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Treap:
        data = zlib.decompress(data)
        height, inner, nodes = (int(x) for x in np.frombuffer(data, dtype="<u8", count=3))
        half = (inner + 1) // 2
        packed = np.frombuffer(data, dtype=np.uint8, count=half, offset=24)
        steps = np.frombuffer(data, dtype="<u4", count=nodes, offset=24 + half)
        masks = np.empty(2 * half, dtype=np.uint8)
        masks[0::2], masks[1::2] = packed & 15, packed >> 4
        out = cls(height, masks[:inner], np.zeros(nodes + 1, dtype=np.int64))
        maxima = out.maxima
        maxima[0] = steps[0]
        # a level's maxima need those of the level above
        low, high = 0, 1
        for _ in range(height):
            counts = _ONES[out.masks[low:high]]
            end = high + int(counts.sum())
            maxima[high:end] = np.repeat(maxima[low:high], counts) - steps[high:end]
            low, high = high, end
        return out

    def best(
        self, rows: np.ndarray, weights: np.ndarray, least: int, k: int, entries: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of all that may be among the ``k`` best, ``least`` being a score to reach.

        ``entries`` are those of the rows, where they are known.
        """
        nodes = (self.entries(rows) if entries is None else entries)[None, :]
        bits = self.row_bits(rows)
        column, depth = np.zeros(1, dtype=np.int64), self.narrow
        # a few ranges aren't worth a look at their bounds
        while depth < self.height and len(nodes) < FEW:
            nodes = np.concatenate(self.children(nodes, bits[depth]))
            column, depth = np.concatenate((2 * column, 2 * column + 1)), depth + 1
        bound = self.maxima.take(nodes) @ weights
        good = np.flatnonzero(bound >= least)
        bound, column, nodes = bound[good], column[good], nodes[good]
        level = np.full(len(good), depth)
        found_columns, found_scores = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        highest: list[int] = []
        while len(bound):
            if len(bound) > RANGES:
                split = np.argpartition(-bound, RANGES)
                now, later = split[:RANGES], split[RANGES:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, dtype=np.int64)
            leaf = level[now] == self.height
            if leaf.any():
                done = now[leaf]
                found_columns.append(column[done])
                found_scores.append(bound[done])
                highest = heapq.nlargest(k, [*highest, *bound[done].tolist()])
                if len(highest) == k:
                    least = max(least, highest[-1])
                now = now[~leaf]
            parts = []
            if len(now):
                for column_bit, below in enumerate(self.children(nodes[now], bits[level[now]])):
                    sums = self.maxima.take(below) @ weights
                    good = np.flatnonzero(sums >= least)
                    of = now[good]
                    parts.append((sums[good], level[of] + 1, 2 * column[of] + column_bit, below[good]))
            stay = later[bound[later] >= least]
            kept = (bound[stay], level[stay], column[stay], nodes[stay])
            bound, level, column, nodes = (np.concatenate(x) for x in zip(*parts, kept))
        return np.concatenate(found_columns), np.concatenate(found_scores)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2**31 at every other place."""
    x = x.astype(np.int64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF),
        (8, 0x00FF00FF00FF00FF),
        (4, 0x0F0F0F0F0F0F0F0F),
        (2, 0x3333333333333333),
        (1, 0x5555555555555555),
    ):
        x = (x | (x << shift)) & mask
    return x


# --- scores -----------------------------------------------------------------------------------------


def weight(n_docs: int, df: int) -> int:
    """Weight of a term that ``df`` of ``n_docs`` documents have."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term that a document holds ``tf`` times adds to a score, for each unit of weight. The documents of
    ``n`` terms each hold ``sizes`` different ones, which follow each other."""
    # the product may pass 64 bits, so it is taken in Python's whole numbers, once per length
    lengths, where = np.unique(n, return_inverse=True)
    m = np.array([50 + (50 * int(x) * n_docs) // n_terms for x in lengths], dtype=np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + np.repeat(20 * m[where], sizes))


# --- on Spark ---------------------------------------------------------------------------------------

#: A block of the index: its documents' ids, its terms and in how many documents each is, its quadtree.
INDEX = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("terms", T.ArrayType(T.BinaryType())),
        T.StructField("df", T.ArrayType(T.LongType())),
        T.StructField("treap", T.BinaryType()),
    ]
)


def statistics(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and terms of all documents."""
    schema = T.StructType([T.StructField("docs", T.LongType()), T.StructField("terms", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = total = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n = word_count(text)
                found, total = found + (n > 0), total + n
        yield pa.RecordBatch.from_pydict({"docs": [found], "terms": [total]})

    counts = docs.select(text_col).mapInArrow(run, schema).agg(F.sum("docs"), F.sum("terms")).first()
    return counts[0] or 0, counts[1] or 0


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Documents and their words, as many as have ``WORDS`` words together; a longer one comes alone."""
    some: list[tuple[int | None, list[bytes]]] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if words := words_of(text):
                if some and held + len(words) > WORDS:
                    yield some
                    some, held = [], 0
                some.append((doc_id, words))
                held += len(words)
    if some:
        yield some


def _counted(texts: list[list[bytes]]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The different words of some texts, of how many of them each text is made, which these are and how often."""
    if len(texts) == 1:
        counts = Counter(texts[0])
        words, n = pa.array(list(counts), pa.binary()), len(counts)
        return words, np.array([n]), np.arange(n), np.fromiter(counts.values(), np.int64, n)
    words = pa.array(list(chain.from_iterable(texts)), pa.binary()).dictionary_encode()
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    keys, tf = np.unique(text * len(words.dictionary) + words.indices.to_numpy(), return_counts=True)
    text, terms = np.divmod(keys, len(words.dictionary))
    return words.dictionary, np.bincount(text, minlength=len(texts)), terms, tf


class _Block:
    """Documents on their way into a block of the index."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.first: list[int] = []
        self.words: list[pa.Array] = []
        self.terms: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.points = 0

    def learn(self, words: pa.Array) -> int:
        """From which number on these words are numbered; a word may have several."""
        self.words.append(words)
        return sum(map(len, self.words[:-1]))

    def add(self, doc_id: int | None, length: int, terms: np.ndarray, tf: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.lengths.append(length)
        self.first.append(int(terms[np.argmax(tf)]))
        self.terms.append(terms)
        self.counts.append(tf)
        self.points += len(terms)

    def row(self, n_docs: int, n_terms: int) -> pa.RecordBatch:
        sizes = np.array([len(t) for t in self.terms])
        words = pa.concat_arrays(self.words).dictionary_encode()
        number = words.indices.to_numpy()
        terms, tf = number[np.concatenate(self.terms)], np.concatenate(self.counts)
        df = np.bincount(terms, minlength=len(words.dictionary))
        # words that only documents of another block have are left out
        by_df = np.argsort(-df, kind="stable")[: np.count_nonzero(df)]
        place = np.empty(len(df), dtype=np.int64)
        place[by_df] = np.arange(len(by_df))
        # like documents side by side
        order = np.lexsort((self.lengths, place[number[self.first]]))
        column = np.empty_like(order)
        column[order] = np.arange(len(order))
        value = impacts(tf, np.array(self.lengths), sizes, n_docs, n_terms)
        points = place[terms], np.repeat(column, sizes), value
        self.terms, self.counts = [], []  # their room is the treap's
        del terms, tf, value
        treap = Treap.of(*points).to_bytes()
        lists = [pa.array([self.ids[i] for i in order], pa.int64()), words.dictionary.take(pa.array(by_df)), pa.array(df[by_df])]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
        return pa.RecordBatch.from_arrays([*lists, pa.array([treap], pa.binary())], names=INDEX.names)


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    totals: tuple[int, int] | None = None,
    block_docs: int = BLOCK_DOCS,
    block_points: int = BLOCK_POINTS,
) -> DataFrame:
    """One row per block of documents (see ``INDEX``), with all terms of their whole texts.

    ``totals`` are the ``statistics`` of the documents, where they are known.
    """
    n_docs, n_terms = totals or statistics(docs, text_col)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for docs in _together(batches):
            known, sizes, terms, tf = _counted([words for _, words in docs])
            first, ends = block.learn(known), np.cumsum(sizes)
            for (doc_id, words), start, end in zip(docs, (ends - sizes).tolist(), ends.tolist()):
                block.add(doc_id, len(words), terms[start:end] + first, tf[start:end])
                if len(block.ids) >= block_docs or block.points >= block_points:
                    yield block.row(n_docs, n_terms)
                    block = _Block()
                    first = block.learn(known)
        if block.ids:
            yield block.row(n_docs, n_terms)

    return rows.mapInArrow(run, INDEX)


def _slices(queries: DataFrame, id_col: str, text_col: str, slice_bytes: int) -> Iterator[list[tuple]]:
    """The queries in parts of bounded size."""
    rows = queries.select(queries[id_col].cast("long").alias("id"), queries[text_col].alias("text"))
    rows = rows.where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-size // slice_bytes)
    for k in range(parts):
        part = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == k)
        yield [(r["id"], r["text"]) for r in part.collect()]


def _met(terms: pa.Array, asked: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a block whose terms are asked for, and which they are."""
    which = pc.index_in(terms, value_set=asked.cast(terms.type))
    rows = np.flatnonzero(which.is_valid().to_numpy(zero_copy_only=False))
    return rows, which.take(pa.array(rows)).to_numpy().astype(np.int64)


def _frequencies(index: DataFrame, wanted: set[bytes]) -> dict[bytes, int]:
    """In how many documents each of the wanted terms is."""
    sent = index.sparkSession.sparkContext.broadcast(sorted(wanted))
    schema = T.StructType([T.StructField("term", T.BinaryType()), T.StructField("df", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(sent.value, pa.binary())
        total = np.zeros(len(asked), dtype=np.int64)
        for batch in batches:
            for terms, df in zip(batch.column(0), batch.column(1)):
                rows, which = _met(terms.values, asked)
                total[which] += df.values.to_numpy()[rows]
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([asked.take(pa.array(some)), pa.array(total[some])], names=["term", "df"])

    found = index.select("terms", "df").mapInArrow(run, schema).groupBy("term").agg(F.sum("df").alias("df"))
    return {bytes(r["term"]): r["df"] for r in found.collect()}


class _Best:
    """The k best documents of one query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)
        self.named = np.empty(0, bool)

    def least(self) -> int:
        return max(1, int(self.scores[-1]) if len(self.scores) == self.k else 1)

    def add(self, scores: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        named = np.concatenate((self.named, named))
        order = np.lexsort((ids, ~named, -scores))[: self.k]
        self.scores, self.ids, self.named = scores[order], ids[order], named[order]


def search(
    index: DataFrame,
    queries: DataFrame,
    n_docs: int,
    k: int = 50,
    id_col: str = "item_id",
    text_col: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Per query its ``k`` best documents: the query's id, ``rank`` (from 1), ``doc_id`` and ``score`` above 0.

    ``n_docs`` is the number of documents with a term, the first of ``statistics``.
    """
    spark = index.sparkSession
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query", "asked", "doc_id", "score")])
    found = spark.createDataFrame([], "asked long, rank int, doc_id long, score long")
    for part in _slices(queries, id_col, text_col, slice_bytes):
        terms = [sorted(set(words_of(text))) for _, text in part]
        df = _frequencies(index, {t for ts in terms for t in ts})
        asked = []
        for i, ((own, _), ts) in enumerate(zip(part, terms)):
            weighted = [(t, w) for t in ts if t in df and (w := weight(n_docs, df[t])) > 0]
            if weighted:
                asked.append((i, own, weighted))
        if asked:
            one = _search_slice(index, spark.sparkContext.broadcast(asked), k, schema)
            found = found.unionByName(_ranked(one, k))
    return found.select(F.col("asked").alias(id_col), "rank", "doc_id", "score")


def _search_slice(index: DataFrame, sent, k: int, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        wanted = sorted({t for _, _, weighted in asked for t, _ in weighted})
        number = {t: i for i, t in enumerate(wanted)}
        terms_of = [np.array([(number[t], w) for t, w in weighted], dtype=np.int64).T for _, _, weighted in asked]
        known = pa.array(wanted, pa.binary())
        best = [_Best(k) for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                ids, data = (batch.column(c)[i].as_py() for c in (0, 2))
                named = np.array([x is not None for x in ids])
                ids = np.array([_LAST if x is None else x for x in ids], dtype=np.int64)
                met, which = _met(batch.column(1)[i].values, known)
                treap = Treap.from_bytes(data)
                place, entry = np.full(len(wanted), -1), np.empty(len(wanted), dtype=np.int64)
                place[which], entry[which] = met, treap.entries(met)
                for (terms, weights), kept in zip(terms_of, best):
                    there = terms[place[terms] >= 0]
                    if not len(there):
                        continue
                    weights = weights[place[terms] >= 0]
                    columns, scores = treap.best(place[there], weights, kept.least(), k, entry[there])
                    if len(columns):
                        kept.add(scores, ids[columns], named[columns])
        for (query, own, _), kept in zip(asked, best):
            n = len(kept.scores)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query] * n, pa.int64()),
                        pa.array([own] * n, pa.int64()),
                        pa.array([i if there else None for i, there in zip(kept.ids.tolist(), kept.named)], pa.int64()),
                        pa.array(kept.scores, pa.int64()),
                    ],
                    names=schema.names,
                )

    return index.select("ids", "terms", "treap").mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, first in parts so that no task needs all that the tasks found for one."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    by_part = Window.partitionBy("query", "part").orderBy(*order)
    some = found.withColumn("part", part).withColumn("rank", F.row_number().over(by_part)).where(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("asked", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id_col: str = "item_id",
    query_text_col: str = "text",
) -> DataFrame:
    """Index the documents, written to the shared folder, and search it for all queries."""
    totals = statistics(docs, text_col)
    index = materialise(build_index(docs, id_col, text_col, totals), "term-index")
    return search(index, queries, totals[0], k, query_id_col, query_text_col)
