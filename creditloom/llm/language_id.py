"""Language identification: unigram pieces per language, summed over all segmentations.

A language is a probability for each piece of a fixed public vocabulary. A word's probability in a
language is the sum over all ways to cut it into pieces, by a forward pass; a text's is the product
over its words. Training is expectation maximisation on word counts, where the forward and backward
sums give each piece's expected use.

A word's score does not depend on the text it is in, so a worker scores each distinct word once, many
words per array operation, and texts are sums over their words. Long texts are read in parts, cut where no
letter is, so their words aren't all held together; only a run of letters is one part however long.

Words are runs of letters in lower case, with a space in front as the vocabulary writes them; other
characters carry no language here. Words over ``LONGEST`` letters are cut into stretches of that length,
which count as words of their own.

Learning takes a bounded sample of the labelled texts: about ``SAMPLE`` distinct texts per language that
have a word, chosen by a hash of the text, or all where there are fewer. A text's copies are not read
again but are its weight. Everything else covers all rows.

Defined results: a text that is null or has no letter is ``und`` with score 0. Rows without a language
are not learned from. Where no language can be learned, all texts are ``und``. Ties go to the language
that sorts first. Repeated rows are predicted each, and count once per row in learning. Letters are the
characters of the Unicode categories L; number characters such as circled digits are none.

A model holds at most ``LANGUAGES`` languages. Where there are more, they are learned and scored in blocks, in
order; a text's best language and the sum that its score is divided by go from block to block.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.session import materialise

UNKNOWN = "und"
#: Distinct labelled texts per language that are learned from, about.
SAMPLE = 1000
#: Languages of a block; each block is a pass over the text.
LANGUAGES = 200
LONGEST = 24
#: Longest piece in letters, the space counted.
PIECE = 10
ROUNDS = 4
#: Share of probability that every piece has in every language.
SMOOTHING = 0.02
#: Words whose scores a worker remembers.
REMEMBERED = 400_000
#: Words learned together, and words scored together.
_TOGETHER = 20_000
_SCORED = 4_000
_CHUNK = 500
#: Characters, about, after which a long text is cut, and words of texts that are looked up together, about.
_PART = 500_000
_HELD = 200_000

_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\W\d_]")
#: Letters for Spark; what its Unicode tables don't know yet may be one.
_LETTER = r"[\p{L}\p{Cn}]"


def words_of(text: str | None) -> list[str]:
    """Runs of letters in lower case."""
    return _words(text.lower()) if text else []


def _words(lowered: str) -> list[str]:
    found = _WORD.findall(lowered)
    if all(map(str.isalpha, found)):
        return found
    # the pattern takes number characters that aren't digits for letters
    return ["".join(run) for w in found for letters, run in groupby(w, str.isalpha) if letters]


def _stretches(word: str) -> list[str]:
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def parts_of(text: str | None) -> Iterator[list[str]]:
    """The words of a text, none over ``LONGEST``, a part of the text at a time; nothing if it has none."""
    # lower case depends on what surrounds a letter, so it comes before the cuts
    lowered, at = text.lower() if text else "", 0
    while at < len(lowered):
        found = _BREAK.search(lowered, at + _PART)
        end = found.start() if found else len(lowered)
        # the text is not copied if it is one part
        words = _words(lowered[at:end])
        if max(map(len, words), default=0) > LONGEST:
            words = [x for w in words for x in _stretches(w)]
        if words:
            yield words
        at = end


def vocabulary_pieces(name: str) -> list[str]:
    """Pieces of the vocabulary that are letters, with a space in front or not, at most ``PIECE`` long."""
    import public_tokenizers

    pieces = set()
    with open(public_tokenizers.path(name), "rb") as lines:
        for line in lines:
            try:
                piece = base64.b64decode(line.split()[0]).decode().lower()
            except UnicodeDecodeError:
                continue
            if len(piece) <= PIECE and _WORD.fullmatch(piece.removeprefix(" ")):
                pieces.add(piece)
    return sorted(pieces)


class Lattice:
    """Looks up which stretches of words are pieces, for many words at once.

    Stretches are found by a rolling hash of their letters. A stretch of one letter, or the space, that
    is no piece counts as the piece ``unknown``, so every word has a segmentation.
    """

    FACTOR = np.uint64(0x100000001B3)

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.unknown = len(pieces)
        hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order
        self.table = np.zeros(1 << 20, dtype=bool)
        self.table[hashes >> np.uint64(44)] = True

    @classmethod
    def _mixed(cls, total: np.ndarray) -> np.ndarray:
        total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return total ^ (total >> np.uint64(29))

    def _hash(self, piece: str) -> int:
        total = np.zeros(1, dtype=np.uint64)
        for c in piece:
            total = total * self.FACTOR + np.uint64(ord(c) + 1)
        return int(self._mixed(total)[0])

    def letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code points, one row per word, after a space; lengths with the space."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        out = np.zeros((len(words), int(lengths.max())), dtype=np.uint32)
        flat = np.frombuffer("".join(" " + w for w in words).encode("utf-32-le"), dtype="<u4")
        out[np.arange(out.shape[1]) < lengths[:, None]] = flat
        return out, lengths

    def arcs(self, letters: np.ndarray, lengths: np.ndarray):
        """For each end position: (length of the stretch, rows where it is a piece, their numbers)."""
        n, wide = letters.shape
        codes = letters.astype(np.uint64) + np.uint64(1)
        for end in range(1, wide + 1):
            found = []
            total = np.zeros(n, dtype=np.uint64)
            power = np.ones(1, dtype=np.uint64)  # arrays wrap around in silence
            inside = lengths >= end
            for size in range(1, min(PIECE, end) + 1):
                # one letter more at the front of the stretch
                total = total + codes[:, end - size] * power
                power = power * self.FACTOR
                mixed = self._mixed(total)
                rows = np.flatnonzero(inside & self.table[mixed >> np.uint64(44)])
                at = np.minimum(np.searchsorted(self.hashes, mixed[rows]), len(self.hashes) - 1)
                hit = self.hashes[at] == mixed[rows]
                rows, numbers = rows[hit], self.numbers[at[hit]]
                if size == 1:
                    one = np.where(inside, self.unknown, -1)
                    one[rows] = numbers
                    rows = np.flatnonzero(inside)
                    numbers = one[rows]
                if len(rows):
                    found.append((size, rows, numbers))
            yield end, found


@dataclass
class Model:
    languages: list[str]
    pieces: list[str]
    #: Probability of each piece (and of the unknown one) per language.
    probability: np.ndarray
    #: log of the share of each language in learning.
    prior: np.ndarray
    key: str = field(default_factory=lambda: uuid.uuid4().hex)
    #: Further blocks of languages, all of which sort after these.
    more: list[Model] = field(default_factory=list)


def forward(lattice: Lattice, probability: np.ndarray, letters: np.ndarray, lengths: np.ndarray):
    """Sums over all segmentations of each word's beginnings: [position, word, language], and the arcs.

    Words are short, so plain probabilities stay far above the smallest double.
    """
    n, wide = letters.shape
    sums = np.zeros((wide + 1, n, probability.shape[1]))
    sums[0] = 1
    arcs = []
    for end, found in lattice.arcs(letters, lengths):
        for size, rows, numbers in found:
            sums[end, rows] += sums[end - size, rows] * probability[numbers]
        arcs.append((end, found))
    return sums, arcs


def word_scores(lattice: Lattice, probability: np.ndarray, words: list[str]) -> np.ndarray:
    """log probability of each word in each language."""
    letters, lengths = lattice.letters(words)
    # as ``forward``, but only the positions that a piece can reach back to are kept
    recent = np.zeros((PIECE + 1, len(words), probability.shape[1]))
    recent[0] = 1
    whole = np.empty(recent.shape[1:])
    for end, found in lattice.arcs(letters, lengths):
        here = recent[end % (PIECE + 1)]
        here[:] = 0
        for size, rows, numbers in found:
            here[rows] += recent[(end - size) % (PIECE + 1), rows] * probability[numbers]
        ending = lengths == end
        whole[ending] = here[ending]
    return np.log(np.maximum(whole, 1e-300))


def _expected(lattice: Lattice, probability: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected use of each piece in one language (a column of ``probability``) over counted words."""
    letters, lengths = lattice.letters(words)
    sums, arcs = forward(lattice, probability, letters, lengths)
    rows = np.arange(len(words))
    whole = np.maximum(sums[lengths, rows], 1e-300)
    back = np.zeros_like(sums)
    back[lengths, rows] = 1
    used = np.zeros((len(probability), 1))
    for end, found in reversed(arcs):
        for size, at, numbers in found:
            back[end - size, at] += back[end, at] * probability[numbers]
            share = sums[end - size, at] * probability[numbers] * back[end, at] / whole[at] * counts[at, None]
            np.add.at(used, numbers, share)
    return used


def fit(counts: dict[str, dict[str, int]], rows: dict[str, int], pieces: list[str], rounds: int = ROUNDS) -> Model:
    """Piece probabilities from word counts per language; ``rows`` are labelled rows per language."""
    languages = sorted(counts)
    lattice = Lattice(pieces)
    columns = []
    for language in languages:
        found: Counter = Counter()
        for word, n in counts[language].items():
            for stretch in _stretches(word):
                found[stretch] += n
        words = sorted(found)
        weights = np.array([found[w] for w in words], dtype=float)
        column = np.full((len(pieces) + 1, 1), 1 / (len(pieces) + 1))
        for _ in range(rounds):
            used = np.zeros_like(column)
            for at in range(0, len(words), _TOGETHER):
                used += _expected(lattice, column, words[at : at + _TOGETHER], weights[at : at + _TOGETHER])
            column = used / max(used.sum(), 1e-300)
            column = (1 - SMOOTHING) * column + SMOOTHING / len(column)
        columns.append(column)
    shares = np.array([rows[x] for x in languages], dtype=float)
    return Model(languages, pieces, np.hstack(columns), np.log(shares / shares.sum()))


def learn(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    vocabulary: str = "byte_bpe_multi_50k.tiktoken",
    sample: int = SAMPLE,
) -> Model | None:
    """Learns from rows with a language; None where there are none.

    The word counts of the sample come to the driver; its size is about ``sample`` distinct texts per
    language, however many copies they have.
    """
    rows = labelled.select(labelled[text_col].alias("text"), labelled[lang_col].alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    worded = F.col("text").rlike(_LETTER)
    # copies of a text are one group, so that the share of a language is one of distinct texts
    texts = rows.groupBy("lang", F.xxhash64("text").alias("hash"), worded.alias("worded")).agg(F.count("*").alias("n"))
    found = texts.groupBy("lang").agg(F.sum("n").alias("n"), F.count_if("worded").alias("texts"))
    block = found.take(LANGUAGES + 1)
    pieces = vocabulary_pieces(vocabulary)
    if len(block) <= LANGUAGES:
        return _learn_block(rows.where(worded), block, sample, pieces)
    # more than one block: in order, so that ties still go to the language that sorts first
    found = materialise(found, "languages")
    total, last, models = found.agg(F.sum("n")).first()[0], None, []
    while True:
        rest = found if last is None else found.where(F.col("lang") > last)
        block = rest.orderBy("lang").limit(LANGUAGES).collect()
        if not block:
            break
        last = block[-1]["lang"]
        models.append(_learn_block(rows.where(worded), block, sample, pieces, total))
    models = [m for m in models if m is not None]
    if models:
        models[0].more = models[1:]
    return models[0] if models else None


def _learn_block(rows: DataFrame, block: list, sample: int, pieces: list[str], total: int | None = None) -> Model | None:
    """A model of the languages of ``block`` (with their rows and distinct texts), from rows with a word."""
    sizes = {r["lang"]: r["n"] for r in block}
    if not sizes:
        return None
    shares = F.create_map(*[F.lit(x) for r in block for x in (r["lang"], min(1.0, sample / max(r["texts"], 1)))])
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
    chosen = rows.where(place < F.try_element_at(shares, F.col("lang")))
    chosen = chosen.groupBy("text", "lang").agg(F.count("*").alias("n"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(found: dict[str, Counter]) -> pa.RecordBatch:
            flat = [(lang, w, n) for lang, words in found.items() for w, n in words.items()]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in flat], type=pa.string()),
                    pa.array([x[1] for x in flat], type=pa.string()),
                    pa.array([x[2] for x in flat], type=pa.int64()),
                ],
                names=["lang", "word", "n"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                found: dict[str, Counter] = {}
                held = 0
                for text, lang, n in zip(*(c.to_pylist() for c in part.columns)):
                    for words in parts_of(text):
                        of = found.setdefault(lang, Counter())
                        for word, times in Counter(words).items():
                            of[word] += times * n
                        held += len(words)
                        if held >= _HELD:
                            yield counted(found)
                            found, held = {}, 0
                yield counted(found)

    counted = chosen.mapInArrow(split, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[str, int]] = {lang: {} for lang in sizes}
    for lang, word, n in zip(*(c.to_pylist() for c in counted.select("lang", "word", "n").toArrow().columns)):
        counts[lang][word] = n
    counts = {lang: words for lang, words in counts.items() if words}
    if not counts:
        return None
    model = fit(counts, sizes, pieces)
    if total:  # shares of all blocks, not of this one
        model.prior = model.prior + np.log(sum(sizes[x] for x in model.languages) / total)
    return model


class Scorer:
    """Scores texts in one worker; remembers the words it has scored."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))
        # the room of both is that of four languages, however many there are
        self.together = max(256, 4 * _SCORED // len(model.languages))
        self.remembered = max(10_000, 4 * REMEMBERED // len(model.languages))

    def _learn(self, words: list[str]) -> None:
        made = [
            word_scores(self.lattice, self.model.probability, words[i : i + self.together])
            for i in range(0, len(words), self.together)
        ]
        base = len(self.scores)
        self.scores = np.concatenate([self.scores, *made])
        self.known.update(zip(words, range(base, base + len(words))))

    def _add(self, parts: list[tuple[int, list[str]]], totals: dict[int, np.ndarray]) -> None:
        """Adds to each text's total the scores of the words of its parts."""
        if len(self.known) > self.remembered:
            self.known, self.scores = {}, self.scores[:0].copy()
        new = set().union(*(words for _, words in parts)).difference(self.known)
        if new:
            self._learn(sorted(new, key=len))  # words of like length share an array
        for number, words in parts:
            at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
            found = self.scores[at].sum(axis=0)
            totals[number] = totals[number] + found if number in totals else found

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The likeliest language of each text, and its share of all."""
        languages, _, sums = self.weigh(texts)
        return languages, [1 / s if s else 0.0 for s in sums]

    def weigh(self, texts: list[str | None]) -> tuple[list[str], list[float], list[float]]:
        """The likeliest language of each text, its log weight, and the sum of all weights in units of that.

        A text without a letter is unknown, and its sum 0.
        """
        totals: dict[int, np.ndarray] = {}
        parts: list[tuple[int, list[str]]] = []
        held = 0
        for number, text in enumerate(texts):
            for words in parts_of(text):
                parts.append((number, words))
                held += len(words)
                if held >= _HELD:
                    self._add(parts, totals)
                    parts, held = [], 0
        self._add(parts, totals)
        languages, logs, sums = [], [], []
        for number in range(len(texts)):
            if number not in totals:
                languages.append(UNKNOWN)
                logs.append(0.0)
                sums.append(0.0)
                continue
            total = totals[number] + self.model.prior
            best = int(np.argmax(total))
            languages.append(self.model.languages[best])
            logs.append(float(total[best]))
            sums.append(float(np.exp(total - total[best]).sum()))
        return languages, logs, sums


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """One scorer per worker process, which tasks share."""
    if model.key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.key] = Scorer(model)
    return _SCORERS[model.key]


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per input row: ``doc`` (the row, or its columns ``keep``), ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), docs[text_col].alias("text"))
    # a text that is kept is not sent to the workers a second time
    kept = names.index(text_col) if text_col in names else None
    if model is None:
        return rows.select("doc", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if kept is not None:
        rows = rows.select("doc")
    if model.more:
        return _predict_blocks(rows, [model, *model.more], kept)
    # pieces times languages: bounded by the vocabulary and LANGUAGES
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                languages, scores = scorer.predict(_texts(part, kept))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(languages, type=pa.string()), pa.array(scores, type=pa.float64())],
                    names=["doc", "lang_pred", "score"],
                )

    schema = T.StructType(
        [rows.schema["doc"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    return rows.mapInArrow(run, schema)


def _texts(part: pa.RecordBatch, kept: int | None) -> list[str | None]:
    """The texts to score: the column after the kept row, or the place ``kept`` in it."""
    return (part.column(1) if kept is None else part.column(0).field(kept)).to_pylist()


def _predict_blocks(rows: DataFrame, models: list[Model], kept: int | None) -> DataFrame:
    """The same over several blocks of languages, one pass for each, written in between."""
    spark = rows.sparkSession
    empty = {"lang_pred": F.lit(UNKNOWN), "log": F.lit(0.0), "sum": F.lit(0.0)}
    rows = rows.select("*", *[c.alias(n) for n, c in empty.items()])
    for number, model in enumerate(models):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            scorer = _scorer(shared.value)
            for batch in batches:
                for at in range(0, batch.num_rows, _CHUNK):
                    part = batch.slice(at, _CHUNK)
                    found = scorer.weigh(_texts(part, kept))
                    old = (c.to_pylist() for c in part.columns[-3:])
                    joint = [_heavier(a, b) for a, b in zip(zip(*old), zip(*found))]
                    columns = [pa.array([j[i] for j in joint], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-3], *columns], names=part.schema.names)

        rows = rows.mapInArrow(run, rows.schema)
        if number < len(models) - 1:
            rows = materialise(rows, "languages-so-far")
    score = F.when(F.col("sum") > 0, 1 / F.col("sum")).otherwise(0.0)
    return rows.select("doc", "lang_pred", score.alias("score"))


def _heavier(a: tuple[str, float, float], b: tuple[str, float, float]) -> tuple[str, float, float]:
    """Of two blocks' results that with the likelier language, the sum over both in its units."""
    if not a[2] or not b[2]:
        return b if b[2] else a
    best, other = (b, a) if b[1] > a[1] else (a, b)
    return best[0], best[1], best[2] + other[2] * float(np.exp(other[1] - best[1]))


def rejected() -> Column:
    """Condition on ``predict``'s rows: no language could be named."""
    return F.col("lang_pred") == UNKNOWN
