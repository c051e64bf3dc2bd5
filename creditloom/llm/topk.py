"""Exact top-k inner products by aggregation of sorted lists without random access.

Candidates are dealt into blocks of bounded size. In a block each dimension is a sorted list, read from
the end that gives a query the most. The lists of a query are read in steps; what has been read of a
candidate and where the lists stand bounds its score from below and above. A candidate whose upper
bound is under the k-th lower bound can't qualify; reading stops once few can, and their final scores
are resolved. Some queries read the lists together, to the same depth: what is read of them is one table, and the
bounds of all these queries are products with it. The first steps, after which hardly any query of those before
had ended, aren't looked at. The best k of each block are merged per query, which is a small aggregation.

Queries are dealt into blocks as well, and each pair of a query block and a candidate block is numbered and
goes to the task of its number: a stated query set against all rows. A pair's candidates come first and
are held, its queries stream past them. Blocks of queries are large, so that candidates are copied seldom:
n rows with n/100 queries make n**2 / 100 * (1 / QUERIES + 1 / CANDIDATES) copies. The k-th score of a block
needs no row of another block, so the blocks run in any order and a lost one is run again alone.

Defined results: vectors that are null or hold a null or a component that isn't finite take no part, nor
do rows without an id. Shorter vectors count as padded with zeros. A query's own id is no candidate of
its own; other repeated rows are candidates each. Queries with the same id and the same vector are asked
once. Ties go to the smaller id. With fewer candidates than k all are returned. Products that may leave 64
bits are taken in whole numbers of any size and ranked by them; a score beyond 64 bits, which the column can't
hold, is returned as the nearest number that it can. A component beyond 64 bits counts as the nearest such.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a block of candidates and of a block of queries.
CANDIDATES = 4096
QUERIES = 8192
#: Tasks that pairs of blocks are dealt over, at most.
TASKS = 20_000
#: Shares of a list that are read before the bounds are looked at again.
STEPS = (0.1, 0.2, 0.3, 0.4, 0.55, 0.7, 0.85, 1.0)
#: Candidates left at which their scores are resolved.
FEW = 128
#: Queries that read the lists together, at most.
TOGETHER = 64
#: Sums of products below this fit 64 bits with room to spare.
SAFE = 2.0**62
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _ordered(score: int) -> bytes:
    """A score as bytes that sort like it, whatever its size."""
    return (score + (1 << 190)).to_bytes(24, "big")


class Block:
    """Sorted lists of a block of candidates (rows of ``values``, whole numbers)."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.widest = float(np.abs(values.astype(float)).max(initial=0))
        n = len(values)
        order = np.argsort(values, axis=0, kind="stable").T
        lists = np.take_along_axis(values.T, order, axis=1)
        # the ends of each list, and what it has where each step stops, read from its start and from its end
        self.ends = lists[:, [0, -1]].astype(np.float64) if n else np.zeros((values.shape[1], 2))
        self.depths = [max(1, math.ceil(step * n)) for step in STEPS]
        self.stops = [lists[:, [at - 1, n - at]].astype(np.float64) for at in self.depths if n]
        # where a row stands in each list, which tells whether it has been read there
        kind = np.int16 if n < 1 << 15 else np.int64
        self.place = np.empty(values.shape[::-1], dtype=kind)
        np.put_along_axis(self.place, order, np.arange(n, dtype=kind)[None, :], axis=1)
        # the step at which bounds are first looked at: one before that at which half of the last queries ended
        self.first = 0

    def survivors(self, query: np.ndarray, k: int, out: int | None = None) -> np.ndarray:
        """Rows that may be among the k best; ``out`` names a row that takes no part."""
        return self.survivors_of(query[None, :], [k], [out])[0]

    def survivors_of(self, queries: np.ndarray, ks: list[int], outs: list[int | None]) -> list[np.ndarray]:
        """``survivors`` of some queries. Lists are read to the same depth for all, so what is read of them is one
        table for all, and a step is a product of matrices."""
        n, dims = self.values.shape
        found = [np.arange(n)] * len(queries)
        weights = queries.astype(np.float64)
        most = np.abs(weights) @ np.abs(self.ends).max(axis=1)
        # short floats where they can hold the sums; the bounds have room for what is rounded
        short = (most < 1e30) & (dims < 4096)
        for kind, some in ((np.float32, short), (np.float64, ~short)):
            asked = [i for i in np.flatnonzero(some).tolist() if n > max(FEW, ks[i])]
            if asked:
                room = (1e-6 * max(10, dims) if kind is np.float32 else 1e-9) * most[asked]
                left = self._read(weights[asked], room, [ks[i] for i in asked], [outs[i] for i in asked], kind)
                for i, rows in zip(asked, left):
                    found[i] = rows
        return found

    def _read(self, weights: np.ndarray, room: np.ndarray, ks: list[int], outs: list[int | None], kind: type) -> list[np.ndarray]:
        n = len(self.values)
        found: list[np.ndarray] = [np.arange(n)] * len(weights)
        table = np.empty(self.place.shape, dtype=kind)
        forward = weights < 0
        worst = weights * np.where(forward, self.ends[:, 1], self.ends[:, 0])
        ended = np.full(len(weights), len(STEPS) - 1)
        live = np.arange(len(weights))
        for step in range(self.first, len(STEPS)):
            at, stops = self.depths[step], self.stops[step]
            ahead, weight, least = forward[live], weights[live], worst[live]
            gap = weight * np.where(ahead, stops[:, 0], stops[:, 1]) - least
            lower, upper = np.zeros((len(live), n), dtype=kind), np.zeros((len(live), n), dtype=kind)
            for backward in (False, True):
                side = ahead != backward
                read = self.place >= n - at if backward else self.place < at
                np.multiply(self.values.T, read, out=table, dtype=kind, casting="unsafe")
                lower += np.where(side, weight, 0).astype(kind) @ table
                if at < n:
                    table[:] = ~read
                    lower += np.where(side, least, 0).astype(kind) @ table
                    upper += np.where(side, gap, 0).astype(kind) @ table
            upper += lower
            for j, i in enumerate(live.tolist()):
                if outs[i] is not None:
                    lower[j, outs[i]] = -np.inf
            places = [n - ks[i] for i in live.tolist()]
            lower.partition(sorted(set(places)), axis=1)
            bound = lower[np.arange(len(live)), places].astype(np.float64) - 2 * room[live]
            still = []
            for j, i in enumerate(live.tolist()):
                left = np.flatnonzero(upper[j] >= bound[j])
                if len(left) <= FEW or at >= n:
                    found[i], ended[i] = left, step
                else:
                    still.append(i)
            if not still:
                break
            live = np.array(still)
        self.first = max(0, int(np.median(ended)) - 1)
        return found

    def best(self, query: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows whose id isn't ``own``."""
        return next(self.best_of(query[None, :], ids, [own], k))

    def best_of(
        self, queries: np.ndarray, ids: np.ndarray, owns: list[int], k: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``best`` of each query."""
        # the bounds of queries that are read together take no more room than the block
        together = max(16, min(TOGETHER, self.values.shape[1]))
        for at in range(0, len(queries), together):
            some, own = queries[at : at + together], owns[at : at + together]
            # with its own rows in the block, so many more survivors are asked for
            left = self.survivors_of(some, [k + int(np.count_nonzero(ids == i)) for i in own], [None] * len(own))
            for query, i, rows in zip(some, own, left):
                yield self._resolved(query, ids, i, k, rows)

    def _resolved(self, query: np.ndarray, ids: np.ndarray, own: int, k: int, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        left = left[ids[left] != own]
        values, found = self.values[left], ids[left]
        if float(np.abs(query.astype(float)).sum()) * self.widest >= SAFE:
            # Python's whole numbers don't wrap around
            scores = values.astype(object) @ query.astype(object)
            top = sorted(range(len(left)), key=lambda i: (-scores[i], found[i]))[:k]
        else:
            scores = values @ query
            top = np.lexsort((found, -scores))[:k]
        return found[top], scores[top]


def _whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def _dealt(usable: DataFrame, candidates: int, queries: int) -> tuple[DataFrame, int, int]:
    """Rows by numbered pair of blocks (``pair``), candidates before queries (``role``), and both numbers of blocks."""
    count = usable.agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    blocks, asking = max(1, -(-count.n // candidates)), max(1, -(-count.q // queries))

    def copies(frame: DataFrame, own: int, other: int, role: int) -> DataFrame:
        part = F.pmod(F.xxhash64("id", "v"), F.lit(own))
        each = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias("each")
        rows = frame.select("id", "v", part.alias("part"), each)
        block, asked = (F.col("each"), F.col("part")) if role else (F.col("part"), F.col("each"))
        return rows.select((block * asking + asked).cast("long").alias("pair"), F.lit(role).alias("role"), "id", "v")

    asked = usable.where("asks").dropDuplicates(["id", "v"])
    return copies(usable, blocks, asking, 0).unionByName(copies(asked, asking, blocks, 1)), blocks, asking


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best of each pair of blocks, from rows sorted by pair and role; holds one block of candidates."""
    pair, block, ids, held, asked = None, None, None, [], 0
    for batch in batches:
        pairs, roles = (batch.column(i).to_numpy() for i in (0, 1))
        cuts = np.flatnonzero((np.diff(pairs) != 0) | (np.diff(roles) != 0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pairs)]):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if pairs[start] != pair:
                pair, block, held, asked = pairs[start], None, [], 0
            if roles[start] == 0:
                held.append((part.column(2).to_numpy(), part.column(3)))
                continue
            if block is None and held:
                wide = max(pc.max(pc.list_value_length(v)).as_py() for _, v in held)
                ids = np.concatenate([i for i, _ in held])
                block, held = Block(np.concatenate([_matrix(v, wide) for _, v in held])), []
            if block is not None:
                yield _best(block, ids, part, asked, k)
            asked += len(part)


def _best(block: Block, ids: np.ndarray, queries: pa.RecordBatch, before: int, k: int) -> pa.RecordBatch:
    owns, keys, found, scores, places = [], [], [], [], []
    # what a query has beyond the block's width meets zeros only
    matrix = _matrix(queries.column(3), block.values.shape[1])
    asking = queries.column(2).to_pylist()
    for i, (own, (best, reached)) in enumerate(zip(asking, block.best_of(matrix, ids, asking, k))):
        whole = [int(s) for s in reached]
        owns += [own] * len(whole)
        keys += [before + i] * len(whole)
        found += best.tolist()
        scores += [min(max(s, _LEAST), _MOST) for s in whole]
        places += map(_ordered, whole)
    pairs = [queries.column(0)[0].as_py()] * len(owns)
    longs = [pa.array(c, type=pa.int64()) for c in (pairs, owns, keys, found, scores)]
    return pa.RecordBatch.from_arrays([*longs, pa.array(places, type=pa.binary())], names=_FOUND)


_FOUND = ["pair", "query_id", "key", "vec_id", "score", "place"]


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 1024,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """Per query: ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of its k best rows.

    ``is_query`` is a condition on the columns of ``rows``.
    """
    finite = F.forall(
        F.col("v"),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    usable = rows.select(
        rows[id_col].cast("long").alias("id"), rows[vector_col].alias("v"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    usable = usable.select("id", "asks", _whole(F.col("v"), scale).alias("v"))
    dealt, blocks, asking = _dealt(usable, candidates, queries)
    tasks = min(blocks * asking, TASKS)
    placed = dealt.repartitionById(tasks, F.pmod("pair", F.lit(tasks)).cast("int"))
    # queries come in one order in all blocks, so their numbers are the same in all
    placed = placed.sortWithinPartitions("pair", "role", "id", "v")
    schema = T.StructType(
        [*(T.StructField(c, T.LongType()) for c in _FOUND[:-1]), T.StructField(_FOUND[-1], T.BinaryType())]
    )
    best = placed.mapInArrow(lambda batches: _search(batches, k), schema)
    # the query's number inside its block tells queries with one id and different vectors apart
    best = best.withColumn("q", F.pmod("pair", F.lit(asking)))
    # a filter on a row number is applied per task before the rows are shuffled
    order = Window.partitionBy("query_id", "key", "q").orderBy(F.desc("place"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _matrix(vectors: pa.Array, wide: int) -> np.ndarray:
    """Whole numbers of a list column, each row cut or filled up with zeros to one width."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == wide).all():
        return flat.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide), dtype=np.int64)
    ends = np.cumsum(lengths)
    for i, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
        start, used = end - length, min(length, wide)
        out[i, :used] = flat[start : start + used]
    return out


def brute_force(rows: Iterator[tuple[int, list[int]]], queries: list[int], k: int) -> list[tuple]:
    """What ``top_k`` must return, for small tests."""
    rows = list(rows)
    out = []
    for own, q in rows:
        if own in queries:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != own)[:k]
            out += [(own, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out
