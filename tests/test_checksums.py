"""Bucket checksums and cell differences against a plain comparison."""

import random
from collections import Counter

from creditloom.operators import checksums

SCHEMA = "k long, m int, x double, s string"


def rows(rng, n):
    for k in range(n):
        yield k, k % 6, rng.choice([None, 0.0, rng.random() * 100]), rng.choice([None, "a", "b"])


def cells(found):
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_equal_tables(spark):
    given = list(rows(random.Random(1), 500))
    a = spark.createDataFrame(given, SCHEMA)
    b = spark.createDataFrame([(k, m, -0.0 if x == 0 else x and x + 1e-9, s) for k, m, x, s in given[::-1]], SCHEMA)
    b = b.repartition(7)
    trees = [checksums.tree(t, ["k", "m"], ["x", "s"], buckets=256, fan=8) for t in (a, b)]
    assert trees[0].count() == trees[1].count() > 200
    assert checksums.differing_buckets(*trees, fan=8) == []
    assert cells(checksums.differing_cells(a, b, ["k", "m"], ["x", "s"])) == []
    root = trees[0].where("level = 0").first()
    assert root.rows == 500 and sum(r.rows for r in trees[0].where("level = 3").collect()) == 500


def test_planted_differences(spark):
    rng = random.Random(2)
    given = list(rows(rng, 800))
    other = [list(r) for r in given]
    want = []
    for k in (5, 77, 300):
        other[k][2] = 1000.0 + k
        want.append((k, k % 6, "x", None if given[k][2] is None else repr(given[k][2]), f"{1000.0 + k}"))
    other[9][3] = None if given[9][3] else "z"
    want.append((9, 3, "s", given[9][3], other[9][3]))
    del other[700]
    want.append((700, 700 % 6, None, "1", "0"))
    other += [other[50]] * 2 + [[9000, 1, None, None]]
    want += [(50, 50 % 6, None, "0", "2"), (9000, 1, None, "0", "1")]
    a, b = (spark.createDataFrame([tuple(r) for r in t], SCHEMA) for t in (given, other))
    found = checksums.differing_cells(a, b, ["k", "m"], ["x", "s"], digits=None)
    assert cells(found) == sorted(want, key=str)
    trees = [checksums.tree(t, ["k", "m"], ["x", "s"], digits=None) for t in (a, b)]
    assert len(checksums.differing_buckets(*trees)) == len({(w[0], w[1]) for w in want})


def test_null_and_repeated_keys(spark):
    a = [(None, 1, 1.0, "a"), (1, None, 1.0, None), (2, 2, None, "x"), (2, 2, None, "x"), (3, 3, 1.0, "p"), (3, 3, 2.0, "q")]
    b = [(1, None, 1.0, None), (None, 1, 1.0, "a"), (2, 2, None, "x"), (3, 3, 1.0, "p"), (3, 3, 2.0, "r")]
    left, right = (spark.createDataFrame(t, SCHEMA) for t in (a, b))
    got = cells(checksums.differing_cells(left, right, ["k", "m"], ["x", "s"]))
    assert got == [(2, 2, None, "1", "0"), (3, 3, "s", "q", "r")]
    # a NULL moved to the next column is another row
    one, two = ((None, 1, None, "a"),), ((None, 1, 1.0, None),)
    left, right = (spark.createDataFrame(list(t), SCHEMA) for t in (one, two))
    assert Counter(r.column for r in checksums.differing_cells(left, right, ["k", "m"], ["x", "s"]).collect()) == {"x": 1, "s": 1}
    empty = left.limit(0)
    assert cells(checksums.differing_cells(empty, empty, ["k", "m"], ["x", "s"])) == []
    assert cells(checksums.differing_cells(empty, left, ["k", "m"], ["x", "s"])) == [(None, 1, None, "0", "1")]


def test_equal_buckets_are_not_brought_together(spark):
    a = spark.range(20_000).selectExpr("id AS k", "CAST(id % 6 AS INT) AS m", "id / 7 AS x", "'s' AS s")
    b = a.selectExpr("k", "m", "CASE WHEN k = 77 THEN 0 ELSE x END AS x", "s")
    found = checksums.differing_cells(a, b, ["k", "m"], ["x", "s"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert [r.k for r in found.collect()] == [77]
    rows = checksums._in_buckets(a, ["k", "m"], checksums.differing_buckets(*[checksums.tree(t, ["k", "m"], ["x", "s"]) for t in (a, b)]), checksums.BUCKETS)
    assert rows.count() < 30
