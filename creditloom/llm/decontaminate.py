"""Benchmark decontamination: windows of benchmark words, looked up at every word of every document.

The windows' hashes go to all tasks as one broadcast set. A task turns a batch of documents into one
array of word hashes, rolls them into window hashes and asks a bit table first, so that nearly all
positions cost a few array operations; what is left is compared word by word with the benchmark. Hits
are spans of words; a document or just the spans are removed.

The broadcast is bounded by what a worker holds of it: text, words and windows are counted first, and a
benchmark over ``SLICE_BYTES`` is cut by a hash of its rows into slices of at most about that size, each
with a scan of its own; a document's spans from all slices are then merged by document. A worker keeps
arrays only: the words as one text, where they start, and the windows as sorted hashes with their places.

Defined results: a null text has no words, and neither documents nor items without words hit anything.
Documents are looked at row by row, so repeated rows give repeated rows. Items with equal ids count as
one item, items without an id are looked up but not listed. Further columns are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.session import materialise

#: Words of a window.
WINDOW = 10
#: Bytes that a worker may hold of the benchmark at a time: text twice, and so much for each word of it.
SLICE_BYTES = 128 << 20
WORD_BYTES = 40
#: Odd multiplier of the rolling hash (a fixed value).
FACTOR = 0x9E3779B97F4A7C15
TABLE_BITS = 20

#: A-Z in lower case, the other ASCII characters that are not 0-9 or a-z as a space.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
#: What stands in a word as x, all else as a space.
_MARK = bytes(32 if c == 32 else ord("x") for c in _FOLD)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

Benchmark = list[tuple[str | None, str | None]]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: runs of 0-9, a-z and all that is not ASCII, after A-Z is lower-cased."""
    return text.encode().translate(_FOLD).split() if text else []


def word_count(text: str | None) -> int:
    """How many ``words_of`` a text has, without cutting them out."""
    return (b" " + text.encode().translate(_MARK)).count(b" x") if text else 0


def _word_hashes(words: list[bytes]) -> np.ndarray:
    # hash() of bytes holds within one process, which is all that is asked of it: the set is built there
    return np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)


def _window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    total = np.zeros(max(0, len(words) - length + 1), dtype=np.uint64)
    factor = np.uint64(FACTOR)
    for j in range(length):
        total = total * factor + words[j : j + len(total)]
    return total


class WindowSet:
    """The windows of a benchmark: by length, a bit table and sorted hashes before the exact comparison."""

    def __init__(self, items: Benchmark, window: int):
        numbers: dict[str, int] = {}
        text, starts, at = [], [], 0
        hashes: dict[int, list[np.ndarray]] = {}
        places: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        n_words, words = 0, None
        for item_id, item_text in items:
            words = words_of(item_text)
            length = min(window, len(words))
            if not length:
                continue
            number = -1
            if item_id is not None:
                number = numbers.setdefault(item_id, len(numbers))
            found = _window_hashes(_word_hashes(words), length)
            hashes.setdefault(length, []).append(found)
            places.setdefault(length, []).append(np.arange(n_words, n_words + len(found), dtype=np.int32))
            owners.setdefault(length, []).append(np.full(len(found), number, dtype=np.int32))
            sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
            starts.append(at + np.cumsum(sizes) - sizes)
            text.append(b" ".join(words) + b" ")
            at += len(text[-1])
            n_words += len(words)
        self.ids = list(numbers)
        self.text = b"".join(text)
        self.starts = np.concatenate([*starts, [at]]).astype(np.int64)
        # windows asked for lately; a document that holds one is seldom alone
        self.recent = lru_cache(maxsize=1 << 12)(self._windows)
        del words
        self.lengths = {}
        for length in list(hashes):
            self.lengths[length] = self._sorted(
                np.concatenate(hashes.pop(length)), np.concatenate(places.pop(length)), np.concatenate(owners.pop(length))
            )

    @staticmethod
    def _sorted(hashes: np.ndarray, places: np.ndarray, owners: np.ndarray) -> tuple:
        order = np.lexsort((places, hashes))
        known, first = np.unique(hashes[order], return_index=True)
        table = np.zeros(1 << TABLE_BITS, dtype=bool)
        table[known >> np.uint64(64 - TABLE_BITS)] = True
        return known, np.append(first, len(order)).astype(np.int32), places[order], owners[order], table

    @property
    def nbytes(self) -> int:
        """Bytes of text and arrays."""
        return len(self.text) + self.starts.nbytes + sum(a.nbytes for v in self.lengths.values() for a in v)

    def candidates(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Positions of windows whose hash is in the set, their lengths, and the number of the hash."""
        for length, (known, _, _, _, table) in self.lengths.items():
            windows = _window_hashes(hashes, length)
            at = np.flatnonzero(table[windows >> np.uint64(64 - TABLE_BITS)])
            number = np.minimum(np.searchsorted(known, windows[at]), len(known) - 1)
            same = known[number] == windows[at]
            for i, k in zip(at[same].tolist(), number[same].tolist()):
                yield i, length, k

    def _windows(self, length: int, number: int) -> dict[bytes, frozenset[str]]:
        """The windows of one hash, nearly always one, and the ids of the items that hold them."""
        _, first, places, owners, _ = self.lengths[length]
        out: dict[bytes, set[str]] = {}
        for k in range(int(first[number]), int(first[number + 1])):
            place, owner = int(places[k]), int(owners[k])
            named = out.setdefault(self.text[self.starts[place] : self.starts[place + length] - 1], set())
            if owner >= 0:
                named.add(self.ids[owner])
        return {words: frozenset(named) for words, named in out.items()}

    def find(self, words: list[bytes], number: int) -> frozenset[str] | None:
        """Ids of the items that hold this window, word by word; None if it only has the hash of one."""
        return self.recent(len(words), number).get(b" ".join(words))


@lru_cache(maxsize=1)
def _window_set(items: tuple, window: int) -> WindowSet:
    return WindowSet(list(items), window)


def scan_texts(texts: list[str | None], known: WindowSet) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Per text: number of words, merged hit spans in words (end exclusive), ids of items found."""
    words: list[bytes] = []
    ends = []
    for text in texts:
        words += words_of(text)
        ends.append(len(words))
    hits: dict[int, list[tuple[int, int]]] = {}
    items: dict[int, set[str]] = {}
    bounds = np.array(ends, dtype=np.int64)
    for at, length, number in known.candidates(_word_hashes(words)):
        row = int(np.searchsorted(bounds, at, side="right"))
        named = known.find(words[at : at + length], number) if at + length <= ends[row] else None
        if named is not None:
            first = ends[row - 1] if row else 0
            hits.setdefault(row, []).append((at - first, at - first + length))
            items.setdefault(row, set()).update(named)
    return [
        (end - (ends[row - 1] if row else 0), merged(hits.get(row, [])), sorted(items.get(row, ())))
        for row, end in enumerate(ends)
    ]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the characters from the first to the last word of each span."""
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    places = [m.span() for m in _WORD.finditer(folded)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])


_HITS = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
            ),
        ),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
#: Documents that a task looks at together.
_CHUNK = 500
#: Words for counting, before A-Z is lower-cased.
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _slices(benchmark: DataFrame, id_col: str, text_col: str, slice_bytes: int) -> Iterator[tuple]:
    """The benchmark in parts of bounded size."""
    rows = benchmark.select(
        benchmark[id_col].cast("string").alias("item"), benchmark[text_col].alias("text")
    ).where(F.col("text").isNotNull())
    words = F.regexp_count("text", F.lit(_WORDS))
    size = rows.agg(F.sum(2 * F.octet_length("text") + WORD_BYTES * (words + 1))).first()[0] or 0
    parts = -(-size // slice_bytes) or 1
    for k in range(parts):
        part = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k)
        yield tuple((r["item"], r["text"]) for r in part.collect())


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
    keep: list[str] | None = None,
    drop_spans: bool = False,
) -> DataFrame:
    """Per input row: ``doc`` (the row, or its columns ``keep``) and ``hits``: n_words, spans in words, items.

    With ``drop_spans`` also ``kept``, the text without its hit spans.
    """
    spark = docs.sparkSession
    names = docs.columns if keep is None else keep
    found = docs.select(
        F.struct(*[docs[c] for c in names]).alias("doc"),
        docs[text_col].alias("text"),
        F.lit(None).cast(HITS).alias("hits"),
    )
    for k, items in enumerate(_slices(benchmark, item_col, item_text_col, slice_bytes)):
        if k:  # only a benchmark beyond the bound; its sets don't have to be in memory together
            found = materialise(found, "decontaminated")
        found = _scan_slice(found, spark.sparkContext.broadcast(items), window)
    if not drop_spans:
        return found.select("doc", "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(2).field("spans").to_pylist()
            kept = [
                without_spans(t, [(s["start"], s["end"]) for s in h]) if h else t
                for t, h in zip(batch.column(1).to_pylist(), hits)
            ]
            columns = [batch.column(0), batch.column(2), pa.array(kept, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "hits", "kept"])

    schema = T.StructType([found.schema["doc"], found.schema["hits"], T.StructField("kept", T.StringType())])
    return found.mapInArrow(cut, schema)


def _scan_slice(rows: DataFrame, items, window: int) -> DataFrame:
    """Adds the hits of one part of the benchmark to those of the parts before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _window_set(items.value, window)
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                hits = []
                found = scan_texts(part.column(1).to_pylist(), known)
                for (n_words, spans, named), old in zip(found, part.column(2).to_pylist()):
                    if old is not None:
                        spans = merged(spans + [(s["start"], s["end"]) for s in old["spans"]])
                        named = sorted({*named, *old["items"]})
                    spans = [{"start": a, "end": b} for a, b in spans]
                    hits.append({"n_words": n_words, "spans": spans, "items": named})
                columns = [part.column(0), part.column(1), pa.array(hits, type=_HITS)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc", "text", "hits"])

    return rows.mapInArrow(run, rows.schema)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, spans_only: bool = False, **options) -> DataFrame:
    """The documents without a hit; or all documents, their texts without the spans hit."""
    text_col = options.get("text_col", "text")
    out = scan(docs, benchmark, drop_spans=spans_only, **options)
    if not spans_only:
        return out.where(F.size("hits.spans") == 0).select("doc.*")
    return out.select(
        *(F.col("kept" if c == text_col else f"doc.{c}").alias(c) for c in docs.columns)
    )
