"""License notices in texts, exact and with a few errors: seeds by the pigeonhole rule, then bounded-error regexes.

A text becomes its words in lower case with one space between, so line breaks and punctuation inside a notice
count for nothing. A notice that may differ in ``k`` edits is cut into ``k + 1`` seeds: whatever is within
``k`` edits of it holds one of them unchanged, at most ``k`` characters off its place. One Aho-Corasick pass
finds the seeds of all notices; around each hit a window of the notice's length plus ``k`` on either side goes
to the regex library, which looks for the best match within ``k`` edits between word ends. Matches of a notice
that overlap are one; the one with the fewest edits, then the first, is kept. Matches without edits are always
kept, so the exact places of the base phrases are among them.

Work per text is one pass plus bounded work per seed found; no text is cut and no shuffle takes place.
Windows that come again (a notice pasted into many texts) are looked up, in a table of bounded size.

Defined results: a null text is an empty one; a text without words has no match and score 0. Rows are looked
at one by one, so repeated rows give repeated rows and an empty table gives none. Further columns are kept
inside ``doc``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further short notices, as words.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under the apache license version 2 0": "apache",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
}
#: Characters of a notice for each edit that it may differ in, and the most edits of all.
CHARS_PER_EDIT = 10
MOST_EDITS = 4
#: Words from which a notice counts fully; fewer words are weaker evidence.
FULL_WORDS = 4
#: Windows that a worker remembers.
REMEMBERED = 1 << 14

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class Match(NamedTuple):
    phrase: str
    edits: int
    first_word: int
    n_words: int


def edits_allowed(phrase: str) -> int:
    return min(MOST_EDITS, len(phrase) // CHARS_PER_EDIT)


def seeds(phrase: str) -> list[tuple[int, str]]:
    """The phrase in one piece more than it may have edits, each with its place."""
    parts = edits_allowed(phrase) + 1
    ends = [len(phrase) * i // parts for i in range(parts + 1)]
    return [(a, phrase[a:b]) for a, b in zip(ends, ends[1:])]


class Finder:
    """The notices' seeds in one automaton, and a bounded-error pattern for each notice."""

    def __init__(self, phrases: list[str]):
        places = defaultdict(list)
        for phrase in phrases:
            for at, seed in seeds(phrase):
                places[seed].append((phrase, at))
        self.automaton = ahocorasick.Automaton()
        for seed, found in places.items():
            self.automaton.add_word(seed, (len(seed), found))
        self.automaton.make_automaton()
        patterns = {
            p: regex.compile(rf"(?b)(?<= )(?:{regex.escape(p)}){{e<={edits_allowed(p)}}}(?= )") for p in phrases
        }

        @lru_cache(maxsize=REMEMBERED)
        def best(phrase: str, window: str) -> tuple[int, int, int] | None:
            m = patterns[phrase].search(window)
            return (sum(m.fuzzy_counts), m.start(), m.end()) if m else None

        self.best = best

    def matches(self, words: str) -> list[Match]:
        """Matches in words that are joined, led and followed by one space, in order."""
        found = defaultdict(set)
        seen = set()
        for last, (length, places) in self.automaton.iter(words):
            for phrase, at in places:
                edits = edits_allowed(phrase)
                from_ = last + 1 - length - at
                # one character more on either side shows whether words end there
                low, high = max(0, from_ - edits - 1), from_ + len(phrase) + edits + 1
                if (phrase, low) in seen:
                    continue
                seen.add((phrase, low))
                hit = self.best(phrase, words[low:high])
                if hit:
                    found[phrase].add((hit[0], low + hit[1], low + hit[2]))
        out = []
        for phrase, hits in found.items():
            for edits, start, end in _apart(hits):
                out.append((start, end, phrase, edits))
        return self._placed(words, sorted(out))

    @staticmethod
    def _placed(words: str, hits: list[tuple[int, int, str, int]]) -> list[Match]:
        out, at, before = [], 0, 0
        for start, end, phrase, edits in hits:
            before += words.count(" ", at, start)
            at = start
            out.append(Match(phrase, edits, before - 1, words.count(" ", start, end) + 1))
        return out


def _apart(hits: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of hits that overlap the one with the fewest edits, then the first, then the shortest."""
    kept: list[tuple[int, int, int]] = []
    group: list[tuple[int, int, int]] = []
    reach = -1

    def settle() -> None:
        chosen: list[tuple[int, int, int]] = []
        for hit in sorted(group):
            if all(hit[2] <= c[1] or c[2] <= hit[1] for c in chosen):
                chosen.append(hit)
        kept.extend(chosen)

    for hit in sorted(hits, key=lambda h: h[1:]):
        if hit[1] >= reach:
            settle()
            group = []
        group.append(hit)
        reach = max(reach, hit[2])
    settle()
    return kept


def joined_words(text: str | None) -> tuple[str, int]:
    """The words of a text in lower case, led, followed and separated by one space; and their number."""
    words = text.encode().translate(_FOLD).split() if text else []
    return (f" {b' '.join(words).decode()} " if words else ""), len(words)


def places(text: str, matches: list[Match]) -> list[tuple[int, int]]:
    """First and last code point (exclusive) of each match in the text itself."""
    wanted = {m.first_word for m in matches} | {m.first_word + m.n_words - 1 for m in matches}
    spans = {i: m.span() for i, m in enumerate(_WORD.finditer(text)) if i in wanted}
    return [(spans[m.first_word][0], spans[m.first_word + m.n_words - 1][1]) for m in matches]


def confidence(matches: list[Match]) -> float:
    """How sure it is that a notice is there: each notice counts with its best match, as independent evidence."""
    best: dict[str, float] = {}
    for m in matches:
        sure = min(1.0, len(m.phrase.split()) / FULL_WORDS) * (1 - m.edits / (edits_allowed(m.phrase) + 1))
        best[m.phrase] = max(best.get(m.phrase, 0.0), sure)
    missed = 1.0
    for phrase in sorted(best):
        missed *= 1 - best[phrase]
    return round(1 - missed, 9)


_MATCH = [
    ("label", pa.string(), T.StringType()),
    ("phrase", pa.string(), T.StringType()),
    ("base", pa.bool_(), T.BooleanType()),
    ("edits", pa.int64(), T.LongType()),
    ("first_word", pa.int64(), T.LongType()),
    ("n_words", pa.int64(), T.LongType()),
    ("start", pa.int64(), T.LongType()),
    ("end", pa.int64(), T.LongType()),
]
_MATCHES = pa.list_(pa.struct([(n, a) for n, a, _ in _MATCH]))
MATCHES = T.ArrayType(T.StructType([T.StructField(n, t) for n, _, t in _MATCH]))


def find_notices(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] | None = None,
    notices: dict[str, str] | None = None,
) -> DataFrame:
    """Per input row ``doc`` (the row, or its columns ``keep``), ``n_words``, ``matches`` and ``score``.

    ``notices`` maps further phrases (lower-case words, one space between) to labels; the base phrases are
    always looked for. A match has its label, phrase, edits, place in words and place in code points.
    """
    labels = (NOTICES if notices is None else notices) | BASE
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sorted(labels))
        for batch in batches:
            counts, found, scores = [], [], []
            for text in batch.column(1).to_pylist():
                words, n = joined_words(text)
                matches = finder.matches(words) if n else []
                spans = places(text, matches) if matches else []
                counts.append(n)
                scores.append(confidence(matches))
                found.append(
                    [
                        {
                            "label": labels[m.phrase],
                            "phrase": m.phrase,
                            "base": m.phrase in BASE,
                            "edits": m.edits,
                            "first_word": m.first_word,
                            "n_words": m.n_words,
                            "start": a,
                            "end": b,
                        }
                        for m, (a, b) in zip(matches, spans)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, _MATCHES), pa.array(scores, pa.float64())],
                names=["doc", "n_words", "matches", "score"],
            )

    schema = T.StructType(
        [
            rows.schema["doc"],
            T.StructField("n_words", T.LongType()),
            T.StructField("matches", MATCHES),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return rows.mapInArrow(run, schema)
