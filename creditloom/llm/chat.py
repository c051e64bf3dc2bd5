"""Chat formatting: render conversations, encode once with offsets, mask the assistants' tokens.

Each turn is ``<|role|>``, a newline, the text, ``<|end|>`` and a newline. Control strings inside a text
or a role get a backslash after their first character, one more than they already have there, which is
undone by taking one away: formatting can be read back exactly.

A rendered conversation is encoded once; the tokens' offsets are sorted, the assistants' text spans are
sorted, and each span's tokens are found by binary search. A token that reaches over the edge of a span
is in the mask, and the text under the mask is the part inside the span.

A conversation is rendered in parts of ``PART_TURNS`` turn numbers and at most about ``PART_CHARS``
characters, so a very long one is encoded by many tasks and none holds it. Parts are cut between turns
and are numbered in order.

Defined results: turns are ordered by number, then role, then text, nulls first; repeated rows are turns
of their own. A null text or role is an empty one. Rows without a conversation id are one conversation.
Further columns are not looked at. No rows give no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Turn numbers, and characters, after which a conversation goes on in another part.
PART_TURNS = 256
PART_CHARS = 1_000_000
LEARNED_ROLE = "assistant"

# Control strings that never stand unescaped inside a text. The first one opens all marks
# of this template; the others are those of common templates.
_CONTROL = re.compile(r"(<)(\\*)(\||/?s>)|(\[)(\\*)(/?INST\])")
_ESCAPED = re.compile(r"(<)\\(\\*)(\||/?s>)|(\[)\\(\\*)(/?INST\])")
_TURN = re.compile(r"<\|(?!end\|>)(.*?)\|>\n(.*?)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: f"{m[1] or m[4]}\\{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"{m[1] or m[4]}{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def escape_role(role: str) -> str:
    """Roles end at ``|>``: that string and the name of the end mark are escaped as well."""
    out = re.sub(r"\|(\\*)>", r"|\\\1>", escape(role))
    return "\\" + out if out.lstrip("\\") == "end" else out


def unescape_role(role: str) -> str:
    out = role[1:] if role.startswith("\\") and role.lstrip("\\") == "end" else role
    return unescape(re.sub(r"\|\\(\\*)>", r"|\1>", out))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of all turns, and the span of each turn's text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head = f"<|{escape_role(role)}|>\n"
        body = escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        part = f"{head}{body}<|end|>\n"
        parts.append(part)
        at += len(part)
    return "".join(parts), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def mask_tokens(
    starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens touch a span, and the spans as far as tokens cover them."""
    mask = np.zeros(len(starts), dtype=np.int8)
    covered = []
    for begin, end in spans:
        first = int(np.searchsorted(ends, begin, side="right"))
        last = int(np.searchsorted(starts, end, side="left"))
        if first < last and begin < end:
            mask[first:last] = 1
            covered.append((max(begin, int(starts[first])), min(end, int(ends[last - 1]))))
    return mask, covered


FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("subpart", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("mask", T.ArrayType(T.ByteType())),
        T.StructField(
            "loss_spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
    ]
)
_FORMATTED = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("part", pa.int64()),
        ("subpart", pa.int64()),
        ("formatted", pa.string()),
        ("ids", pa.list_(pa.int32())),
        ("mask", pa.list_(pa.int8())),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)
_TOKENIZERS: dict[str, object] = {}


def _tokenizer(name: str):
    if name not in _TOKENIZERS:
        import public_tokenizers
        from tokenizers import Tokenizer, processors

        made = Tokenizer.from_file(public_tokenizers.path(name))
        made.encode_special_tokens = True  # a text can't make control tokens
        # offsets with the blanks that belong to a token, or a text's outer blanks would miss the mask
        made.post_processor = processors.ByteLevel(trim_offsets=False)
        _TOKENIZERS[name] = made
    return _TOKENIZERS[name]


def format_conversations(
    rows: DataFrame,
    vocabulary: str = "byte_bpe_50k.json",
    part_turns: int = PART_TURNS,
    part_chars: int = PART_CHARS,
    learned_role: str = LEARNED_ROLE,
) -> DataFrame:
    """From rows of conv_id, turn, role, text: per part its text, token ids, mask and loss spans.

    ``loss_spans`` are the characters of the learned role's texts that masked tokens cover.
    """
    part = F.coalesce(F.floor(F.col("turn") / part_turns).cast("long"), F.lit(-(2**62)))
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        part.alias("part"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = turns.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(vocabulary).encode
        here, subpart, held, chars = None, 0, [], 0

        def flush() -> dict:
            formatted, spans = render(held)
            encoding = encode(formatted, add_special_tokens=False)
            offsets = np.array(encoding.offsets, dtype=np.int64).reshape(-1, 2)
            learned = [s for s, (role, _) in zip(spans, held) if role == learned_role]
            mask, covered = mask_tokens(offsets[:, 0], offsets[:, 1], learned)
            return {
                "conv_id": here[0],
                "part": here[1],
                "subpart": subpart,
                "formatted": formatted,
                "ids": encoding.ids,
                "mask": mask.tolist(),
                "loss_spans": [{"start": a, "end": b} for a, b in covered],
            }

        for batch in batches:
            done = []
            columns = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for conv, number, role, text in zip(*columns):
                if here != (conv, number) or chars >= part_chars:
                    if held:
                        done.append(flush())
                    subpart = subpart + 1 if here == (conv, number) else 0
                    here, held, chars = (conv, number), [], 0
                held.append((role, text))
                chars += len(text)
                if len(done) >= 64:
                    yield pa.RecordBatch.from_pylist(done, schema=_FORMATTED)
                    done = []
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=_FORMATTED)
        if held:
            yield pa.RecordBatch.from_pylist([flush()], schema=_FORMATTED)

    return turns.mapInArrow(run, FORMATTED)


DIGEST = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


class _Reading:
    """What is read back of one conversation, part by part."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss_spans: list[dict]) -> None:
        for role, text in read_back(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for span in loss_spans:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id,
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation the digests of its turns and of its loss text, read back from the parts.

    A digest runs over a conversation's parts in order, one part in memory at a time.
    """
    arrow = pa.schema(
        [(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.int64()) for f in DIGEST]
    )
    parts = (
        formatted.select("conv_id", "part", "subpart", "formatted", "loss_spans")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "subpart")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            columns = (batch.column(i).to_pylist() for i in (0, 3, 4))
            for conv, text, spans in zip(*columns):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Reading(conv)
                now.add(text, spans)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row()], schema=arrow)

    return parts.mapInArrow(run, DIGEST)
