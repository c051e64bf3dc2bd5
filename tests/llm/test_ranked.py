"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditloom.llm import decontaminate, ranked

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def plain(docs, items, k):
    bags = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, total = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for doc, bag, n in bags:
            score = 0
            for t in set(terms(text)) & set(bag):
                m = 100 - 50 + (50 * n * n_docs) // total
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus(rng, n):
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)] + ["Straße", "ÉTÉ", "x1", "don", "t"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(n // 3)]  # a group of copies: many equal scores
    items = [(i, ", ".join(rng.choices(words, k=12))) for i in range(15)] + [(99, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("block", [7, 64, 2048])
def test_against_plain_scores(spark, block):
    rng = random.Random(block)
    docs, items = corpus(rng, 150)
    docs += [(None, "w1 w1 été"), (None, None), (5, "w1"), (5, "w2 w3"), (-4, ""), (-3, "..."), (7000, "w1 " * 30_000)]
    items += [(1, "w1 w2"), (None, "W1 nothing"), (100, None), (101, ""), (102, "unheard of")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    totals = ranked.statistics(frame)
    assert totals == (sum(bool(terms(t)) for _, t in docs), sum(len(terms(t)) for _, t in docs))
    index = ranked.build_index(frame, totals=totals, block_docs=block).cache()
    assert sum(len(r.ids) for r in index.select("ids").collect()) == totals[0]
    for k in (1, 10):
        for size in (1 << 20, 200):  # one slice of queries, and many
            got = ranked.search(index, asked, totals[0], k, slice_bytes=size).collect()
            assert sorted((tuple(r) for r in got), key=str) == plain(docs, items, k)
    index.unpersist()


def test_treap():
    rng = np.random.default_rng(4)
    for rows, cols, n in ((1, 1, 1), (1, 40, 30), (900, 3, 500), (60, 70, 1500)):
        cells = rng.choice(rows * cols, size=min(n, rows * cols), replace=False)
        r, c, v = cells // cols, cells % cols, rng.integers(1, 1000, len(cells))
        treap = ranked.Treap.from_bytes(ranked.Treap.of(r, c, v).to_bytes())
        grid = np.zeros((rows, cols), dtype=np.int64)
        grid[r, c] = v
        # every row by its path, each point by its weight
        for row in range(0, rows, max(1, rows // 20)):
            columns, scores = treap.best(np.array([row]), np.array([3]), 1, cols)
            assert sorted(zip(columns, scores)) == [(j, 3 * x) for j, x in enumerate(grid[row]) if x]
        picked = np.unique(rng.integers(0, rows, 6))
        weights = rng.integers(1, 50, len(picked))
        total = weights @ grid[picked]
        columns, scores = treap.best(picked, weights, 1, 5)
        assert all(total[j] == s for j, s in zip(columns, scores))
        assert sorted(scores, reverse=True)[:5] == sorted(total[total > 0], reverse=True)[:5]


def test_bounds_leave_ranges_out():
    """A walk for one document doesn't look at every cell."""
    rng = np.random.default_rng(8)
    n = 4096
    rows = np.repeat(np.arange(4), n)
    cols = np.tile(np.arange(n), 4)
    values = rng.integers(1, 50, 4 * n) + 10_000 * (cols == 77)
    treap = ranked.Treap.of(rows, cols, values)
    met = []
    children = treap.children
    treap.children = lambda nodes, q: met.append(nodes.size) or children(nodes, q)
    columns, _ = treap.best(np.arange(4), np.ones(4, dtype=np.int64), 1, 1)
    assert columns.tolist() == [77] and sum(met) < len(values)


def test_top_levels_are_walked_once():
    """More rows than columns: the levels that halve rows only are walked for all queries together."""
    rng = np.random.default_rng(2)
    cells = rng.choice(5000 * 20, size=9000, replace=False)
    rows, cols, values = cells // 20, cells % 20, rng.integers(1, 99, len(cells))
    treap = ranked.Treap.from_bytes(ranked.Treap.of(rows, cols, values).to_bytes())
    assert (treap.height, treap.narrow) == (13, 8)
    grid = np.zeros((5000, 20), dtype=np.int64)
    grid[rows, cols] = values
    asked = np.unique(rows)[::7]
    entries = treap.entries(asked)
    calls = []
    children = treap.children
    treap.children = lambda nodes, bits: calls.append(nodes.shape) or children(nodes, bits)
    for at in range(0, len(asked) - 5, 5):
        columns, scores = treap.best(asked[at : at + 5], np.arange(1, 6), 1, 20, entries[at : at + 5])
        total = np.arange(1, 6) @ grid[asked[at : at + 5]]
        assert sorted(zip(columns, scores)) == [(j, x) for j, x in enumerate(total) if x]
    assert len(calls) <= 5 * len(range(0, len(asked) - 5, 5))
    assert ranked.Treap.of(np.arange(9), np.arange(9), np.ones(9)).narrow == 0


def test_word_counts():
    rng = random.Random(3)
    texts = ["".join(rng.choices("aZ9 .,_-é日\n\t\x00~", k=rng.randrange(40))) for _ in range(500)]
    for text in [None, "", " ", "x", "a'b", "  Straße, x1 \x7f y", *texts]:
        assert decontaminate.word_count(text) == len(decontaminate.words_of(text)) == len(terms(text))


def test_documents_counted_together(monkeypatch):
    """Blocks don't depend on how many documents are counted at a time; a long text is counted alone."""
    rng = random.Random(4)
    docs, _ = corpus(rng, 60)
    docs += [(None, "w1 w1 été"), (7, None), (8, "w5 " * 300 + "zz"), (9, "...")]
    batches = [pa.RecordBatch.from_pydict({"id": pa.array([i for i, _ in part], pa.int64()), "text": [t for _, t in part]}) for part in (docs[:50], docs[50:])]
    found = []
    for words in (1, 90, 1 << 17):
        monkeypatch.setattr(ranked, "WORDS", words)
        parts = list(ranked._together(iter(batches)))
        assert [d for part in parts for d in part] == [(i, decontaminate.words_of(t)) for i, t in docs if terms(t)]
        assert all(len(part) == 1 or sum(len(w) for _, w in part) <= words for part in parts)
        points, block = [], ranked._Block()
        for part in parts:
            known, sizes, which, tf = ranked._counted([w for _, w in part])
            first = block.learn(known)
            for (doc_id, w), start, size in zip(part, np.cumsum(sizes) - sizes, sizes):
                mine = slice(start, start + size)
                points.append((doc_id, {known[int(t)].as_py(): int(n) for t, n in zip(which[mine], tf[mine])}))
                block.add(doc_id, len(w), which[mine] + first, tf[mine])
        assert points == [(i, Counter(decontaminate.words_of(t))) for i, t in docs if terms(t)]
        row = block.row(100, 1000).to_pylist()[0]
        assert sorted(map(str, row["ids"])) == sorted(str(i) for i, _ in points)
        found.append(sorted(zip(row["terms"], row["df"])))
        df = Counter(t for _, bag in points for t in bag)
        assert found[-1] == sorted(df.items()) and sorted(row["df"], reverse=True) == row["df"]


def test_edges(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked.rank_documents(docs, items).collect() == []
    some = spark.createDataFrame([(1, "a"), (2, "a b"), (3, "c")], "doc_id long, text string")
    assert ranked.rank_documents(some, items.limit(0)).collect() == []
    clashing = some.select("*", *(F.lit("z").alias(c) for c in ("id", "ids", "terms", "rank", "score", "treap", "query")))
    want = ranked.rank_documents(some, items).collect()
    assert ranked.rank_documents(clashing, items.withColumn("asked", F.lit(9))).collect() == want and len(want) == 2
    assert [r.doc_id for r in want] == [2, 1]
