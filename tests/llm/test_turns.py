"""Conversation repair against a plain search over all cheapest edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from creditloom.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = " \t\n\x0b\x0c\r"
ORDER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
WRITTEN = {"": "user", "s": "user", "u": "assistant", "a": "user"}


def cheapest(rows):
    """(cost, edits, repaired rows) of rows (role, text, fault): the least of all, by recursion from the end."""

    @lru_cache(None)
    def rest(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:  # a fourth in a row would only repeat the state of the second
            cost, edits, out = rest(i, WRITTEN[state][0], inserted + 1)
            ways.append((cost + 3, "I" + edits, ((WRITTEN[state], ""), *out)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, edits, out = rest(i + 1, state, 0)
            ways.append((cost + 4, "D" + edits, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] in ORDER[state]:
                    cost, edits, out = rest(i + 1, role[:1], 0)
                    ways.append((cost + more, "K" + edits, ((role, text), *out)))
                for new in {WRITTEN[state]}:
                    cost, edits, out = rest(i + 1, new[0], 0)
                    ways.append((cost + more + 3, "R" + edits, ((new, text), *out)))
        return min(ways) if ways else (10**9, "~", ())

    return rest(0, "", 0)


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = text.strip(BLANK)
        fault = None if said else "blank"
        if not fault and (role, text) in seen:
            fault = "duplicate"
        if not fault and said[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def expected(rows):
    """Plain report of rows (turn, role, text) of one conversation."""
    rows = sorted(
        ((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).hexdigest()),
    )
    found = faults([r[1:] for r in rows])
    cost, edits, out = cheapest(tuple(found))
    numbers = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        *(sum(f == kind for _, _, f in found) for kind in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost,
        edits,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    )


def compared(spark, rows, **options):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in turns.report(turns.repair(frame, **options)).collect()}
    by = {}
    for conv, *rest in rows:
        by.setdefault(conv, []).append(rest)
    assert set(got) == set(by)
    for conv, said in by.items():
        assert got[conv] == expected(said), conv
    return got


def talk(rng, n, null=0.0):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "uncle"]
    texts = ["Yes.", "No?", "so", " \n", "", "A, b.", "Well! \t", "é. ", "why"]
    for turn in range(n):
        row = [turn - n // 3 + rng.randrange(2), rng.choice(roles), rng.choice(texts) * rng.randrange(1, 3) + str(rng.randrange(40))]
        if rng.random() < 0.6:
            row[2] = f"{row[2]} {rng.randrange(10**6)}{rng.choice('.!? x')}"
        yield tuple(None if rng.random() < null else v for v in row)


@pytest.mark.parametrize("piece, fan", [(64, 32), (3, 2), (1, 2), (5, 3)])
def test_against_plain_search(spark, piece, fan):
    rng = random.Random(piece)
    rows = [(conv, *row) for conv in range(40) for row in talk(rng, rng.randrange(1, 9), 0.05)]
    rows += [(1000, *row) for row in talk(rng, 150)]  # a third of all rows in one conversation
    rows += [(None, *row) for row in talk(rng, 30, 0.3)]
    rows += [(2000, 1, "user", "Same again.")] * 70 + [(2001, None, "user", "same")] * 5
    compared(spark, rows, piece=piece, fan=fan)


def test_auction():
    """Prices and letters against the plain search, from every state and for every end."""
    rng = random.Random(3)
    for _ in range(150):
        codes = "".join(rng.choice("suaxSUAXdddua") for _ in range(rng.randrange(0, 24)))
        rows = tuple(
            ({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "x"), "t", "blank" if c == "d" else "truncated" if c.isupper() else None)
            for c in codes
        )
        edits, state = turns.edits_of(codes, turns.CLOSING, turns.START)
        cost, letters, _ = cheapest(rows)
        assert edits + turns.CLOSING_EDITS[state] == letters
        # the same from tables of pieces
        cuts = [codes[i : i + 5] for i in range(0, len(codes), 5)]
        tables = [turns.costs_of(c) for c in cuts]
        if tables:
            whole = turns.composed(tables)
            assert whole == turns.costs_of(codes)
            ends = [c + turns.CLOSING[s] for s, c in enumerate(whole[:4]) if c != turns.NONE]
            assert min(ends) == cost
    arcs = [[(0, 1, "K"), (3, 2, "I")], [(0, 3, "")], [(0, 3, "")], []]
    assert turns.auction(arcs, [0], 3)[0] == 0


def test_long_piece_is_bounded():
    rng = random.Random(9)
    codes = "".join(rng.choice("uaUAdsx") for _ in range(turns.PIECE))
    assert max(turns.costs_of(codes)) < 10 * turns.PIECE


def test_edges(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert turns.repair(frame).collect() == []
    ids = spark.createDataFrame([(1,), (None,), (1,)], "conv_id long")
    got = turns.report(turns.repair(frame, ids=ids), in_order=True).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sorted(map(str, got)) == sorted(
        f"Row(conv_id={c}, gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit='', repaired_sha256='{none}')"
        for c in (1, None)
    )
    big = 2**60
    rows = [(big, 1, "user", "x" * 300_000 + "."), (big, 2, None, None), (big + 1, None, None, None), (None, 3, "assistant", "Yes.")]
    clashing = spark.createDataFrame(rows, SCHEMA).select(
        "*", *(F.lit("z").alias(c) for c in ("pos", "piece", "codes", "kind", "copy", "edit", "step", "said", "of", "as", "head", "hash"))
    )
    got = {r[0]: tuple(r)[1:] for r in turns.report(turns.repair(clashing)).collect()}
    assert got == {c: expected([r[1:] for r in rows if r[0] == c]) for c in (big, big + 1, None)}
    edits = turns.repair(spark.createDataFrame(rows, SCHEMA)).where("conv_id is null").orderBy("step").collect()
    assert [(e.edit, e.role, e.text, e.fault, e.turn) for e in edits] == [
        ("I", "user", "", None, None), ("K", "assistant", "Yes.", None, 3)
    ]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    got = sorted(tuple(r) for r in turns.damaged(spark.createDataFrame(rows[:-1], SCHEMA)).collect())
    want = []
    for c, t, role, text in rows[:-1]:
        kind = zlib.crc32(f"{c}:{t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role, {1: "", 2: "One Two"}.get(kind, text))
        want += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want)
    kind = zlib.crc32(b" : ") % 20
    out = turns.damaged(spark.createDataFrame(rows[-1:], SCHEMA)).collect()
    assert kind > 4 and [tuple(r) for r in out] == [(None, None, " ", " ")]
