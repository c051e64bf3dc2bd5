"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation is a lattice: a column for each number of rows passed, and in it four states of the wanted role
order ``(s?(ua)+)?`` (nothing yet, after the system row, after a user row, after an assistant row). Keeping,
re-roling or deleting a row leads to the next column, inserting a row to another state of the same column; costs
are whole numbers. The cheapest path is found by the auction algorithm for shortest paths: a path grows from
the origin along arcs whose head's price pays for them; at a node where none does, the node's price is raised
to what its best arc asks and the path gives the node up. Prices never break ``price(a) <= cost(a, b) +
price(b)``, and when the path reaches the end all arcs of all cheapest paths are tight. Among the tight arcs that
lead on to the end the one with the least letter is followed, which gives the ASCII-least edit string: within a
state each letter leads to one node only.

No task needs a whole conversation in memory. Rows are numbered once over the whole table in order (written by
range, so that a conversation of a third of all rows is many ranges) and cut into pieces of ``PIECE`` rows. What
lies behind a piece counts only through four prices at its end. For conversations of several pieces these come
from a tree: pieces give 4 x 4 costs, ``FAN`` neighbours are composed to one table by the same auction, and on the
way back each piece gets the prices at its end. Conversations then stream by in order, one piece at a time, and
the state at the end of a piece is where the next one begins. (One task streams one conversation: its edits
have an order, and a SHA-256 over it can't be divided.)

Defined results: a null role or text is one space. Rows go by turn, nulls first; rows of one turn by role, the
text's first 64 code points and the text's MD5, so that equal rows are neighbours. Rows without a
conversation id are one conversation. A row is blank without a character other than 0x20 and 0x09-0x0D, a duplicate
if an earlier row has its role and text, truncated if its last such character is none of ``.!?``; the first that
holds is its fault. Only ``s``, ``u``, ``a`` as first character of a role are roles of the order. An empty table
has no edits. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import BLANKS
from creditloom.session import materialise

#: Costs of the edits; a truncated row that stays costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a piece, and pieces or tables that are composed at a time.
PIECE = 64
FAN = 32
#: States: nothing yet, after system, after user, after assistant; those in which a conversation may end.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
FINAL = (START, ASSISTANT)
#: The state that the next user or assistant row leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("user", "user", "assistant", "user")
#: Kept rows by the first character of the role: from state to state.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: No way to the end.
NONE = -1

Arcs = list[list[tuple[int, int, str]]]


def lattice(codes: str, exits: tuple[int, ...], open_end: bool = False) -> tuple[Arcs, int]:
    """Arcs (cost, head, letter) of each node, node 4 * column + state, and the node that is the end.

    ``codes`` has a character per row: ``s u a x`` for its role, in upper case if it is truncated, ``d`` if it has
    to go. ``exits`` are the prices behind the last column, where rows are inserted only with ``open_end``.
    """
    n = len(codes)
    end = 4 * (n + 1)
    arcs: Arcs = []
    for column in range(n + 1):
        for state in STATES:
            out = []
            if column < n or open_end:
                out.append((INSERT, 4 * column + NEXT[state], "I"))
            if column < n:
                below, code = 4 * (column + 1), codes[column]
                out.append((DELETE, below + state, "D"))
                if code != "d":
                    more = TRUNCATED * code.isupper()
                    kept = KEPT.get(code.lower(), {}).get(state)
                    if kept is not None:
                        out.append((more, below + kept, "K"))
                    out.append((more + REROLE, below + NEXT[state], "R"))
            elif exits[state] != NONE:
                out.append((exits[state], end, ""))
            arcs.append(out)
    arcs.append([])
    return arcs, end


def _back(arcs: Arcs, end: int) -> set[int]:
    """Nodes with a way to the end."""
    into: list[list[int]] = [[] for _ in arcs]
    for node, out in enumerate(arcs):
        for _, head, _ in out:
            into[head].append(node)
    seen, todo = {end}, [end]
    while todo:
        for node in into[todo.pop()]:
            if node not in seen:
                seen.add(node)
                todo.append(node)
    return seen


def auction(arcs: Arcs, origins: list[int], end: int) -> list[int]:
    """Prices at which the origins (each with a way to the end) have paid for their cheapest paths.

    Costs are not negative and no cycle costs nothing; nodes without a way to the end have no arcs to them.
    """
    price = [0] * len(arcs)
    for origin in origins:
        path = [origin]
        while path[-1] != end:
            node = path[-1]
            asked, head, _ = min((cost + price[head], head, letter) for cost, head, letter in arcs[node])
            if price[node] < asked:
                price[node] = asked
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
    return price


def _priced(arcs: Arcs, end: int, origins: list[int]) -> tuple[Arcs, list[int]]:
    """The arcs that have a way to the end, and their prices; NONE for origins without a way."""
    live = _back(arcs, end)
    arcs = [[a for a in out if a[1] in live] if node in live else [] for node, out in enumerate(arcs)]
    price = auction(arcs, [o for o in origins if o in live], end)
    return arcs, [p if node in live else NONE for node, p in enumerate(price)]


def trace(arcs: Arcs, price: list[int], origin: int, end: int) -> tuple[str, int]:
    """The ASCII-least letters of a cheapest path, and the last node before the end."""
    tight = [[a for a in out if price[node] == a[0] + price[a[1]]] for node, out in enumerate(arcs)]
    live = _back(tight, end)
    letters, node, last = [], origin, origin
    while node != end:
        last = node
        letter, node = min((letter, head) for _, head, letter in tight[node] if head in live)
        letters.append(letter)
    return "".join(letters), last


@lru_cache(maxsize=1 << 15)
def edits_of(codes: str, exits: tuple[int, ...], entry: int) -> tuple[str, int] | None:
    """Edit letters of a piece from a state on, and the state that they end in."""
    arcs, end = lattice(codes, exits)
    arcs, price = _priced(arcs, end, [entry])
    if price[entry] == NONE:
        return None
    letters, last = trace(arcs, price, entry, end)
    return letters, last % 4


def _closing() -> tuple[tuple[int, ...], list[str]]:
    arcs, end = lattice("", tuple(0 if s in FINAL else NONE for s in STATES), open_end=True)
    arcs, price = _priced(arcs, end, list(STATES))
    return tuple(price[s] for s in STATES), [trace(arcs, price, s, end)[0] for s in STATES]


#: What it costs to end a conversation in each state, and the rows inserted for it.
CLOSING, CLOSING_EDITS = _closing()


@lru_cache(maxsize=1 << 12)
def costs_of(codes: str) -> tuple[int, ...]:
    """4 x 4 costs of a piece, from each state to each state."""
    out = [NONE] * 16
    for last in STATES:
        arcs, end = lattice(codes, tuple(0 if s == last else NONE for s in STATES))
        _, price = _priced(arcs, end, list(STATES))
        for first in STATES:
            out[4 * first + last] = price[first]
    return tuple(out)


def _chained(tables: list[tuple[int, ...]], exits: tuple[int, ...]) -> tuple[Arcs, int, int]:
    """Lattice of several tables in a row; each loses its least cost, and their sum is returned too.

    What is left differs by a few edits at most, so prices stay small however long the conversation is.
    """
    arcs: Arcs = []
    end, base = 4 * (len(tables) + 1), 0
    for column, table in enumerate(tables):
        least = min(c for c in table if c != NONE)
        base += least
        for s in STATES:
            costs = ((t, table[4 * s + t]) for t in STATES)
            arcs.append([(c - least, 4 * (column + 1) + t, "") for t, c in costs if c != NONE])
    least = min(e for e in exits if e != NONE)
    arcs += [[(e - least, end, "")] if e != NONE else [] for e in exits]
    return [*arcs, []], end, base + least


def composed(tables: list[tuple[int, ...]]) -> tuple[int, ...]:
    """4 x 4 costs of several tables in a row."""
    out = [NONE] * 16
    for last in STATES:
        arcs, end, base = _chained(tables, tuple(0 if s == last else NONE for s in STATES))
        _, price = _priced(arcs, end, list(STATES))
        for first in STATES:
            if price[first] != NONE:
                out[4 * first + last] = price[first] + base
    return tuple(out)


def prices_between(tables: list[tuple[int, ...]], exits: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Prices at the end of each of several tables in a row, from those at the end of the last."""
    arcs, end, _ = _chained(tables, exits)
    _, price = _priced(arcs, end, list(range(end)))
    return [tuple(price[4 * k : 4 * k + 4]) for k in range(1, len(tables) + 1)]


# --- on Spark ---------------------------------------------------------------------------------------


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows written in order, each with its number ``pos`` over the whole table."""
    space = F.lit(" ")
    named = rows.select(
        rows[conv].alias("conv_id"),
        rows[turn].alias("turn"),
        F.coalesce(rows[role], space).alias("role"),
        F.coalesce(rows[text], space).alias("text"),
    )
    # the copy number lets a range end between equal rows
    named = named.withColumn("head", F.substring("text", 1, 64)).withColumn("hash", F.md5("text"))
    named = named.withColumn("copy", F.monotonically_increasing_id())
    order = ["conv_id", "turn", "role", "head", "hash"]
    placed = named.repartitionByRange(*order, "copy").sortWithinPartitions(*order, "copy")
    placed = materialise(
        placed.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("at")), "turns"
    )
    spark = rows.sparkSession
    # one row per partition of the sort
    part = F.shiftright("at", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).count().collect())
    before, total = [], 0
    for number, size in sizes:
        before.append((number, total - (number << 33)))
        total += size
    shift = F.broadcast(spark.createDataFrame(before, "part long, shift long"))
    return placed.join(shift, part == F.col("part")).select(
        "conv_id", "turn", "role", "text", (F.col("at") + F.col("shift")).alias("pos")
    )


def _pieces(ordered: DataFrame, size: int) -> DataFrame:
    """Per conversation and ``size`` rows of the table: ``conv_id``, ``piece``, first ``pos`` and ``codes``."""
    last = F.substring(_trimmed(F.col("text")), -1, 1)
    initial = F.substring("role", 1, 1)
    light = ordered.select(
        "conv_id",
        "pos",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        last.alias("last"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("said"),
    )
    repeated = (
        light.where("last <> ''")
        .groupBy("conv_id", "said")
        .agg(F.min("pos").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("of"), F.col("said").alias("as"), "first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("said") == F.col("as"))
    goes = (F.col("last") == "") | (F.col("pos") > F.col("first"))
    code = (
        F.when(goes, "d")
        .when(F.col("last").isin(".", "!", "?"), F.col("initial"))
        .otherwise(F.upper("initial"))
    )
    found = light.join(repeated, same, "left").select("conv_id", "pos", code.alias("code"))
    gathered = found.groupBy("conv_id", F.floor(F.col("pos") / size).alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "code"))).alias("rows")
    )
    codes = F.array_join(F.transform("rows", lambda r: r["code"]), "")
    return gathered.select("conv_id", "piece", F.col("rows")[0]["pos"].alias("pos"), codes.alias("codes"))


_TABLE = pa.list_(pa.int64())


def _lists(column: pa.Array) -> list[list]:
    return column.to_pylist()


def _behind(pieces: DataFrame, fan: int) -> DataFrame:
    """Prices at the end of each piece (``conv_id``, ``piece``, ``exits``) of conversations with several."""
    spread = pieces.groupBy("conv_id").agg(F.min("piece").alias("first"), F.count("*").alias("n")).where("n > 1")
    spread = materialise(spread.select(F.col("conv_id").alias("of"), "first", "n"), "several-pieces")
    most = spread.agg(F.max("n")).first()[0] or 0
    several = pieces.join(spread, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", (F.col("piece") - F.col("first")).alias("number"), "piece", "codes"
    )

    def costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([costs_of(c) for c in batch.column(3).to_pylist()], _TABLE)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), found], names=["conv_id", "number", "costs"]
            )

    kind = several.schema["conv_id"]
    number, table = T.StructField("number", T.LongType()), T.ArrayType(T.LongType())
    schema = T.StructType([kind, number, T.StructField("costs", table)])
    levels = [materialise(several.mapInArrow(costs, schema), "piece-costs")]

    def grouped(frame: DataFrame) -> DataFrame:
        up = F.floor(F.col("number") / fan).alias("up")
        members = F.array_sort(F.collect_list(F.struct("number", "costs"))).alias("members")
        return frame.groupBy("conv_id", up).agg(members)

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [composed([tuple(m["costs"]) for m in ms]) for ms in _lists(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, _TABLE)], names=["conv_id", "number", "costs"]
            )

    while fan ** len(levels) < most:
        levels.append(materialise(grouped(levels[-1]).mapInArrow(compose, schema), "piece-costs"))

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, prices = [], [], []
            for i, (members, exits) in enumerate(zip(_lists(batch.column(1)), _lists(batch.column(2)))):
                found = prices_between([tuple(m["costs"]) for m in members], tuple(exits))
                at += [i] * len(members)
                numbers += [m["number"] for m in members]
                prices += found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int64()), pa.array(prices, _TABLE)],
                names=["conv_id", "number", "exits"],
            )

    below = T.StructType([kind, number, T.StructField("exits", table)])
    behind = None
    for level in reversed(levels):
        groups = grouped(level)
        if behind is None:
            groups = groups.select("conv_id", "members", F.array(*map(F.lit, CLOSING)).cast(table).alias("exits"))
        else:
            above = behind.select(F.col("conv_id").alias("of"), F.col("number").alias("as"), "exits")
            groups = groups.join(above, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("up") == F.col("as")))
            groups = groups.select("conv_id", "members", "exits")
        behind = groups.mapInArrow(descend, below)
    named = behind.join(spread, F.col("conv_id").eqNullSafe(F.col("of")))
    return named.select("conv_id", (F.col("number") + F.col("first")).alias("piece"), "exits")


_EDIT = [
    ("step", T.LongType(), pa.int64()),
    ("edit", T.StringType(), pa.string()),
    ("fault", T.StringType(), pa.string()),
    ("was", T.StringType(), pa.string()),
    ("role", T.StringType(), pa.string()),
    ("text", T.StringType(), pa.string()),
]
#: Rows of a batch that is handed on.
_BATCH = 2048


class _Walk:
    """One conversation as it streams by: pieces, and the rows of the piece that is being edited."""

    def __init__(self) -> None:
        self.state, self.step, self.letters, self.codes = START, 0, "", ""

    def enter(self, codes: str, exits: list[int] | None) -> None:
        self.letters, self.state_after = edits_of(codes, tuple(exits or CLOSING), self.state)
        self.codes, self.row, self.letter = codes, 0, 0

    def _inserted(self) -> tuple:
        role, self.state = ROLES[self.state], NEXT[self.state]
        self.step += 1
        return self.step - 1, "I", None, None, role, ""

    def edited(self, role: str, text: str) -> Iterator[tuple]:
        while self.letters[self.letter] == "I":
            self.letter += 1
            yield self._inserted()
        letter, code = self.letters[self.letter], self.codes[self.row]
        fault = None
        if code == "d":
            fault = "duplicate" if text.strip(BLANKS) else "blank"
        elif code.isupper():
            fault = "truncated"
        self.letter, self.row, self.step = self.letter + 1, self.row + 1, self.step + 1
        if letter == "D":
            yield self.step - 1, "D", fault, role, None, None
        else:
            new = role if letter == "K" else ROLES[self.state]
            self.state = KEPT[new[0]][self.state]
            yield self.step - 1, letter, fault, role, new, text

    def closed(self) -> Iterator[tuple]:
        for _ in CLOSING_EDITS[self.state]:
            yield self._inserted()


def repair(
    rows: DataFrame,
    ids: DataFrame | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    piece: int = PIECE,
    fan: int = FAN,
) -> DataFrame:
    """The edits of every conversation: ``conv_id``, ``turn``, ``step`` (from 0), ``edit`` (K, R, D, I), ``fault``
    (of the row there was), ``was`` (its role), ``role`` and ``text`` (of the repaired row, null if deleted).

    The edits of a conversation come in order, in one partition. A conversation of ``ids`` that has no rows has
    one row with neither step nor edit.
    """
    ordered = _ordered(rows, conv_col, turn_col, role_col, text_col)
    pieces = materialise(_pieces(ordered, piece), "pieces")
    behind = _behind(pieces, fan).select(F.col("conv_id").alias("of"), F.col("piece").alias("as"), "exits")
    heads = pieces.join(
        behind, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("as")), "left"
    ).select("conv_id", "pos", F.lit(1).alias("kind"), "codes", "exits")
    stream = heads.unionByName(
        ordered.select("conv_id", "pos", F.lit(2).alias("kind"), "turn", "role", "text"), allowMissingColumns=True
    )
    if ids is not None:
        known = ids.select(ids[conv_col].cast(rows.schema[conv_col].dataType).alias("conv_id")).distinct()
        first = known.select("conv_id", F.lit(None).cast("long").alias("pos"), F.lit(0).alias("kind"))
        stream = stream.unionByName(first, allowMissingColumns=True)
    stream = stream.select("conv_id", "turn", "kind", "codes", "exits", "role", "text", "pos")
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, here, conv_type, turn_type = None, None, None, None
        done: list[tuple] = []

        def handed() -> pa.RecordBatch:
            columns = list(zip(*done))
            kinds = [conv_type, turn_type, *(a for _, _, a in _EDIT)]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "turn", *(n for n, _, _ in _EDIT)])

        def close() -> None:
            if now is not None and now.step:
                done.extend((here, None, *e) for e in now.closed())
            elif now is not None:
                done.append((here, None, *[None] * len(_EDIT)))

        for batch in batches:
            conv_type, turn_type = batch.column(0).type, batch.column(1).type
            columns = (batch.column(i).to_pylist() for i in range(7))
            for conv, turn, kind, codes, exits, role, text in zip(*columns):
                if now is None or conv != here:
                    close()
                    now, here = _Walk(), conv
                if kind == 1:
                    now.enter(codes, exits)
                elif kind == 2:
                    for edit in now.edited(role, text):
                        done.append((conv, None if edit[1] == "I" else turn, *edit))
                if len(done) >= _BATCH:
                    yield handed()
            if done:
                yield handed()
        close()
        if done:
            yield handed()

    schema = T.StructType(
        [stream.schema["conv_id"], stream.schema["turn"], *(T.StructField(n, t) for n, t, _ in _EDIT)]
    )
    return stream.mapInArrow(run, schema)


_REPORT = [
    ("gaps", T.LongType(), pa.int64()),
    ("blank", T.LongType(), pa.int64()),
    ("duplicate", T.LongType(), pa.int64()),
    ("truncated", T.LongType(), pa.int64()),
    ("illegal", T.LongType(), pa.int64()),
    ("cost", T.LongType(), pa.int64()),
    ("audit", T.StringType(), pa.string()),
    ("repaired_sha256", T.StringType(), pa.string()),
]
_PAIRS = {"su", "ua", "au"}
_COST = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}


class _Report:
    def __init__(self) -> None:
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.audit: list[str] = []
        self.digest, self.any = hashlib.sha256(), False

    def add(self, turn, edit: str, fault: str | None, was: str | None, role: str | None, text: str | None) -> None:
        self.audit.append(edit)
        self.cost += _COST[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
        if edit != "I":
            if fault:
                self.faults[fault] += 1
            if turn is not None:
                self.low = turn if self.low is None else self.low
                self.turns += turn != self.high
                self.high = turn
            if self.before is not None and self.before + was[:1] not in _PAIRS:
                self.illegal += 1
            self.before = was[:1]
        if edit != "D":
            self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True
        if len(self.audit) > 4096:
            self.audit = ["".join(self.audit)]

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def report(edits: DataFrame, in_order: bool = False) -> DataFrame:
    """Per conversation: gaps between turns, rows by fault, neighbours of wrong roles, cost, edits and a digest.

    ``in_order`` says that the edits come as ``repair`` gives them and need not be brought into order.
    """
    if not in_order:
        edits = edits.repartition("conv_id").sortWithinPartitions("conv_id", "step")
    edits = edits.select("conv_id", "turn", "edit", "fault", "was", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, here, kind = None, None, None
        for batch in batches:
            kind, done = batch.column(0).type, []
            for conv, turn, edit, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != here:
                    if now is not None:
                        done.append((here, *now.row()))
                    now, here = _Report(), conv
                if edit is not None:
                    now.add(turn, edit, *rest)
            if done:
                yield reported(done, kind)
        if now is not None:
            yield reported([(here, *now.row())], kind)

    def reported(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, *(a for _, _, a in _REPORT)]
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["conv_id", *(n for n, _, _ in _REPORT)])

    schema = T.StructType([edits.schema["conv_id"], *(T.StructField(n, t) for n, t, _ in _REPORT)])
    return edits.mapInArrow(run, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows with planted faults, decided by a checksum of their place; null cells are one space."""
    space = F.lit(" ")

    def plain(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), space)

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    times = F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))
    return rows.where(kind != 0).select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(plain("role")).alias("role"),
        text.alias("text"),
        F.explode(times).alias("copy"),
    ).drop("copy")
