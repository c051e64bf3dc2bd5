"""Packing of token streams into windows of fixed length, online and in bounded space.

Each partition keeps ``OPEN`` open windows. A document is cut into full windows and a rest; the rest
goes to the open window that it fills best. Where none has room, the fullest is topped up with the
head of the rest, emitted, and the tail placed anew, so that no emitted window is padded. At the end of
the partition the leftovers are merged: their pieces are laid end to end and cut into full windows, and
one window at most per partition is short.

A partition's packing depends on the order of its rows only, so a task that is run again after a lost
executor gives the same windows. Nothing is shuffled; memory is the open windows and one batch.

Defined results: a null text is an empty one and becomes the end mark alone. Repeated rows are packed
each. Sequence numbers are unique over all partitions, ascending inside one, and not dense.

Ids come from the given vocabulary. A text is cut at spaces that follow a character which is no space,
where the vocabulary's own pre-tokenizer cuts as well, and the ids of each part are remembered, because
words repeat; the parts' ids in a row are those of the whole text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tokens of a window, and open windows of a partition.
LENGTH = 1024
OPEN = 32
#: The id that ends each document.
END = 0
#: Words whose ids a worker remembers.
REMEMBERED = 400_000
_CHUNK = 500

_CUT = re.compile(r"(?<=\S)(?= )")
#: Letters that every Unicode version knows alike: such parts can go through the faster encoder.
_COMMON = re.compile(r"[\t-\r -ÿ‘-”•…]*\Z")


class WordEncoder:
    """Ids of whole texts by the vocabulary file ``name``, as little-endian unsigned 32-bit bytes."""

    def __init__(self, name: str, ranks: str | None = None):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(name))
        self.fast = None
        if ranks:
            import tiktoken

            with open(public_tokenizers.path(ranks), "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )
        self.known: dict[str, bytes] = {}

    def _ids(self, part: str) -> bytes:
        # control strings of the vocabulary hold "<|": those parts go to the library that knows them
        if self.fast and "<|" not in part and _COMMON.match(part):
            ids = self.fast.encode_ordinary(part)
        else:
            ids = self.exact.encode(part, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        # a part that ends in white space would have shared it with the space after it
        words = text.split(" ")
        if all(words) and not any(w[-1].isspace() for w in words[:-1]):
            parts = [words[0], *[" " + w for w in words[1:]]]
        else:
            parts = _CUT.split(text)
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            for p in set(parts).difference(known):
                known[p] = self._ids(p)
            return b"".join([known[p] for p in parts])


_ENCODERS: dict[tuple[str, str | None], WordEncoder] = {}


def encoder(name: str, ranks: str | None = None) -> WordEncoder:
    """One encoder per worker process."""
    if (name, ranks) not in _ENCODERS:
        _ENCODERS[name, ranks] = WordEncoder(name, ranks)
    return _ENCODERS[name, ranks]


#: A piece: row of its document, first id, ids as bytes.
Piece = tuple[object, int, bytes]


class Packer:
    """Best fit over a bounded number of open windows. ``place`` and ``finish`` return full windows."""

    def __init__(self, length: int = LENGTH, windows: int = OPEN):
        self.length, self.windows = length, windows
        self.open: list[tuple[int, list[Piece]]] = []  # ids used, pieces

    def place(self, row: object, ids: bytes) -> list[list[Piece]]:
        full, at, step = [], 0, 4 * self.length
        while len(ids) - at >= step:
            full.append([(row, at // 4, ids[at : at + step])])
            at += step
        while at < len(ids):
            at += self._rest(row, at, ids, full)
        return full

    def _rest(self, row: object, at: int, ids: bytes, full: list) -> int:
        """Puts the ids from ``at`` into one window, as far as they fit; returns the bytes put."""
        need = (len(ids) - at) // 4
        fits = [i for i, (used, _) in enumerate(self.open) if used + need <= self.length]
        if fits:
            best = max(fits, key=lambda i: self.open[i][0])
        elif len(self.open) < self.windows:
            self.open.append((0, []))
            best = len(self.open) - 1
        else:
            best = max(range(len(self.open)), key=lambda i: self.open[i][0])
        used, pieces = self.open[best]
        put = min(need, self.length - used)
        pieces.append((row, at // 4, ids[at : at + 4 * put]))
        self.open[best] = (used + put, pieces)
        if used + put == self.length:
            full.append(self.open.pop(best)[1])
        return 4 * put

    def finish(self) -> list[list[Piece]]:
        """Merges the leftovers, fullest first; only the last window may be short."""
        out: list[list[Piece]] = []
        room = 0
        for _, pieces in sorted(self.open, key=lambda w: -w[0]):
            for row, start, ids in pieces:
                at = 0
                while at < len(ids):
                    if not room:
                        out.append([])
                        room = 4 * self.length
                    part = ids[at : at + room]
                    out[-1].append((row, start + at // 4, part))
                    at += len(part)
                    room -= len(part)
        self.open = []
        return out


def pack(
    docs: DataFrame,
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    ranks: str | None = "byte_bpe_50k.tiktoken",
    length: int = LENGTH,
    windows: int = OPEN,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per piece: ``doc`` (the row, or its columns ``keep``), ``start``, ``length``, ``ids`` (binary,
    little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence.

    ``ranks`` names the same vocabulary for a faster encoder of common text, None for none.
    """
    names = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[docs[c] for c in names]).alias("doc"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    schema = T.StructType(
        [
            rows.schema["doc"],
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks).encode
        packer = Packer(length, windows)
        sequence = TaskContext.get().partitionId() << 40
        end = np.array([END], dtype="<u4").tobytes()

        def table(sequences: list[list[Piece]], kind: pa.DataType) -> pa.RecordBatch:
            nonlocal sequence
            pieces, numbers, offsets = [], [], []
            for pieces_of in sequences:
                offset = 0
                for piece in pieces_of:
                    pieces.append(piece)
                    numbers.append(sequence)
                    offsets.append(offset)
                    offset += len(piece[2]) // 4
                sequence += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([p[0][0] for p in pieces], type=kind),
                    pa.array([p[1] for p in pieces], type=pa.int64()),
                    pa.array([len(p[2]) // 4 for p in pieces], type=pa.int64()),
                    pa.array([p[2] for p in pieces], type=pa.binary()),
                    pa.array([p[0][1] for p in pieces], type=pa.int64()),
                    pa.array(numbers, type=pa.int64()),
                    pa.array(offsets, type=pa.int64()),
                ],
                names=schema.names,
            )

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                full = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode(text) + end
                    full += packer.place((doc, len(ids) // 4), ids)
                if full:
                    yield table(full, kind)
        if kind is not None:
            yield table(packer.finish(), kind)

    return rows.mapInArrow(run, schema)
