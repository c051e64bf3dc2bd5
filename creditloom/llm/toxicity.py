"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters are lexicons and patterns. Besides a small fixed lexicon, lexicons are mined from labelled rows:
words, and stems by how often words begin with them, that toxic texts have and others have not, dealt
out over ``GROUPS`` voters by rank. A voter fires on a text or doesn't.

The label model says how often each voter fires on either class. It is estimated by expectation
maximisation over the counts of vote patterns of all documents, with the vote patterns of labelled rows
as an anchor, so that the class it finds is the labelled one. Voters that agree beyond what the classes
explain are counted as less than one voter each: the correlations left inside the classes give the
weights of the next estimation. The posterior labels then train a logistic classifier over the mined and
fixed entries and the pattern voters, and it scores whole texts.

What is learned from labels takes a bounded sample of about ``SAMPLE`` labelled rows, chosen by a hash
of the id; the classifier takes posterior labels of about as many documents. Vote patterns are counted
over all documents; their number is bounded by the number of voters, not by the data.

Defined results: a null text is an empty one, which no voter fires on; it gets the score of the bias
alone. Repeated rows are scored each. A label that is null is none; an id with several labels is toxic if
one of them is. Without toxic labels only the fixed voters speak.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled rows that are learned from, and documents whose posterior labels train the classifier, about.
SAMPLE = 20_000
#: Mined entries, and the voters they are dealt out over.
ENTRIES = 3000
GROUPS = 8
#: An entry is in at least so many toxic texts of the sample, and toxic texts are this share of its texts.
LEAST = 3
SHARE = 0.6
#: Lengths of word beginnings that can be entries.
STEMS = (4, 5, 6)
#: Shares of a text's words from which on a stem is there often, and very often.
OFTEN = (0.005, 0.02)
#: Estimations of the label model, each with the correlations of the last, and their rounds.
PASSES = 3
ROUNDS = 20
#: Words whose entries a worker remembers.
REMEMBERED = 400_000
_CHUNK = 500

# Common insults, mild and strong, and patterns of hostile writing.
MILD = "clown fool idiot lame loser moron pathetic silly stupid dumb".split()
STRONG = "disgusting filth garbage hate scum trash vermin worthless despise kill".split()
_INSULT = re.compile(r"\byou(?:'re| are)? (?:an? |such an? |so )?(?:" + "|".join(MILD + STRONG) + r")\b", re.I)
_MASKED = re.compile(r"\b[A-Za-z][*@#$]{2,}[A-Za-z]*\b")
_WORD = re.compile(r"[^\W\d_]+")
_NO_UPPER = bytes(c for c in range(256) if not 65 <= c <= 90)
_NO_LETTER = bytes(c for c in range(256) if not (65 <= c <= 90 or 97 <= c <= 122))
PATTERNS = ("insult", "masked", "shouting", "exclaiming")
VOTERS = 2 + GROUPS + len(PATTERNS)


def stems_of(word: str) -> list[str]:
    return [word[:n] for n in STEMS if len(word) > n]


def stem_entries(stem: str, times: int, words: int) -> list[str]:
    """Entries of a stem that ``times`` of ``words`` words begin with: it is there, often, very often."""
    often = [times >= max(2, share * words) for share in OFTEN]
    return [stem + "*" * i for i, yes in enumerate([True, *often], 1) if yes]


def entries_of(words: list[str]) -> set[str]:
    counts, stems = Counter(words), Counter()
    for word, n in counts.items():
        for stem in stems_of(word):
            stems[stem] += n
    return {*counts, *(e for stem, n in stems.items() for e in stem_entries(stem, n, len(words)))}


def patterns_of(text: str) -> list[bool]:
    raw = text.encode()
    upper, letters = len(raw.translate(None, _NO_UPPER)), len(raw.translate(None, _NO_LETTER))
    return [
        bool(_INSULT.search(text)) if "you" in text or "You" in text or "YOU" in text else False,
        bool(_MASKED.search(text)) if "*" in text or "@" in text or "#" in text or "$" in text else False,
        letters >= 20 and upper > 0.6 * letters,
        "!!!" in text,
    ]


@dataclass
class Lexicon:
    """Entries by number: the fixed words first, then the mined ones, best first."""

    mined: list[str]
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def __post_init__(self):
        fixed = MILD + STRONG
        self.numbers = {w: i for i, w in enumerate(fixed)}
        for entry in self.mined:
            self.numbers.setdefault(entry, len(self.numbers))
        self.stems = {e.rstrip("*") for e in self.mined if e.endswith("*")}
        self.voters = np.array(
            [i // len(MILD) for i in range(len(fixed))]
            + [2 + i % GROUPS for i in range(len(self.numbers) - len(fixed))]
        )
        self.features = len(self.numbers) + len(PATTERNS)


class Reader:
    """Finds a text's entries in one worker; remembers each word's."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.known = lexicon, {}

    def features(self, text: str | None) -> list[int]:
        """Numbers of the entries and patterns that the text has, ascending."""
        if not text:
            return []
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, numbers = self.known, self.lexicon.numbers
        words = _WORD.findall(text.lower())
        found: set[int] = set()
        stems: Counter = Counter()
        for word, n in Counter(words).items():
            has = known.get(word)
            if has is None:
                useful = tuple(s for s in stems_of(word) if s in self.lexicon.stems)
                has = known[word] = (numbers[word], useful) if word in numbers else useful and (None, useful)
            if has:
                if has[0] is not None:
                    found.add(has[0])
                for stem in has[1]:
                    stems[stem] += n
        for stem, n in stems.items():
            found.update(numbers[e] for e in stem_entries(stem, n, len(words)) if e in numbers)
        found.update(len(numbers) + i for i, yes in enumerate(patterns_of(text)) if yes)
        return sorted(found)

    def votes(self, features: list[int]) -> int:
        """The voters that fire, as bits."""
        out, entries = 0, len(self.lexicon.numbers)
        for f in features:
            out |= 1 << (int(self.lexicon.voters[f]) if f < entries else 2 + GROUPS + f - entries)
        return out


_READERS: dict[str, Reader] = {}


def _reader(lexicon: Lexicon) -> Reader:
    if lexicon.key not in _READERS:
        _READERS.clear()
        _READERS[lexicon.key] = Reader(lexicon)
    return _READERS[lexicon.key]


# --- label model ------------------------------------------------------------------------------------


@dataclass
class LabelModel:
    """Share of toxic texts, how often each voter fires on [clean, toxic] ones, and what it counts for."""

    prior: float
    fires: np.ndarray
    weights: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        on = np.log(self.fires[:, 1] / self.fires[:, 0])
        off = np.log((1 - self.fires[:, 1]) / (1 - self.fires[:, 0]))
        odds = math.log(self.prior / (1 - self.prior)) + votes @ (self.weights * (on - off)) + self.weights @ off
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def vote_matrix(masks: np.ndarray) -> np.ndarray:
    return (masks[:, None] >> np.arange(VOTERS) & 1).astype(float)


def fit_label_model(
    masks: np.ndarray, counts: np.ndarray, labelled: list[tuple[int, int, int]]
) -> LabelModel:
    """From counts of vote patterns, and of (pattern, label) among labelled rows."""
    votes = vote_matrix(masks)
    anchor = np.array(labelled, dtype=np.int64).reshape(-1, 3)
    known, label, times = vote_matrix(anchor[:, 0]), anchor[:, 1], anchor[:, 2].astype(float)
    total = max(times.sum(), 1.0)
    prior = float(np.clip(times[label == 1].sum() / total if len(anchor) else 0.05, 1e-4, 0.9))
    # the labelled rows weigh as much as all others together
    scale = counts.sum() / total if len(anchor) else 0.0
    model = LabelModel(prior, np.tile([0.02, 0.5], (VOTERS, 1)), np.ones(VOTERS))
    own = scale * times

    def estimate(toxic: np.ndarray, clean: np.ndarray) -> None:
        fires = []
        for share, mine in ((clean, own * (label == 0)), (toxic, own * (label == 1))):
            # as if one clean and one toxic text more had been seen, with half a vote each
            fires.append((share @ votes + mine @ known + 0.5) / (share.sum() + mine.sum() + 1.0))
        model.fires = np.clip(np.array(fires).T, 1e-5, 1 - 1e-5)

    if len(anchor):  # the labelled rows alone to begin with
        estimate(np.zeros(len(counts)), np.zeros(len(counts)))
        model.weights = _weights(known, times, label.astype(float))
    for _ in range(PASSES):
        for _ in range(ROUNDS):
            toxic = counts * model.posterior(votes)
            estimate(toxic, counts - toxic)
        model.weights = _weights(votes, counts, model.posterior(votes))
    return model


def _weights(votes: np.ndarray, counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """One over the sum of a voter's correlations inside the classes, its own 1 included."""
    shared = np.zeros((VOTERS, VOTERS))
    for weight in (counts * (1 - toxic), counts * toxic):
        if weight.sum() > 0:
            off = votes - weight @ votes / weight.sum()
            cov = (off * weight[:, None]).T @ off / weight.sum()
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))  # a voter that never fires goes with no other
            shared += weight.sum() / counts.sum() * np.clip(cov / np.outer(sd, sd), -1, 1)
    np.fill_diagonal(shared, 1)
    return 1 / np.maximum(shared, 0).sum(axis=1)


# --- linear classifier ------------------------------------------------------------------------------


def fit_linear(rows: list[list[int]], labels: np.ndarray, counts: np.ndarray, features: int) -> np.ndarray:
    """Logistic weights, the bias last. ``rows`` are feature numbers, ``labels`` shares, ``counts`` times."""
    index = np.fromiter((f for r in rows for f in r), dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    weights = np.zeros(features + 1)
    toxic = float(np.clip((labels * counts).sum() / max(counts.sum(), 1), 1e-3, 0.999))
    weights[-1] = math.log(toxic / (1 - toxic))
    # both classes weigh the same, so that a rare class is learned as well
    balance = counts * np.where(labels > 0.5, 0.5 / toxic, 0.5 / (1 - toxic))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    total = max(balance.sum(), 1e-9)
    for step in range(1, 301):
        odds = np.bincount(row, weights=weights[index], minlength=len(rows)) + weights[-1]
        error = balance * (1 / (1 + np.exp(-np.clip(odds, -40, 40))) - labels) / total
        slope = np.append(np.bincount(index, weights=error[row], minlength=features), error.sum())
        slope[:-1] += 1e-6 * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


@dataclass
class Model:
    lexicon: Lexicon
    labels: LabelModel
    weights: np.ndarray


# --- Spark ------------------------------------------------------------------------------------------


def _mine(sample: DataFrame, entries: int) -> list[str]:
    """Best entries of the sample (text, toxic): those of toxic texts, by how far the odds differ."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                found = (Counter(), Counter())
                for text, toxic in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found[toxic].update(entries_of(_WORD.findall((text or "").lower())))
                names = list(found[0] | found[1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, type=pa.string()),
                        pa.array([found[1][e] for e in names], type=pa.int64()),
                        pa.array([found[0][e] for e in names], type=pa.int64()),
                    ],
                    names=["entry", "t", "c"],
                )

    sizes = sample.agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).first()
    toxic, clean = float(sizes.t or 0), float(sizes.c or 0)
    counted = sample.mapInArrow(count, "entry string, t long, c long").groupBy("entry")
    counted = counted.agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    # the share is taken as if both classes had as many texts
    rate_t, rate_c = F.col("t") / max(toxic, 1.0), F.col("c") / max(clean, 1.0)
    odds = F.log(F.col("t") + 0.5) - F.log(F.lit(toxic) - F.col("t") + 0.5)
    odds -= F.log(F.col("c") + 0.5) - F.log(F.lit(clean) - F.col("c") + 0.5)
    score = odds / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    usable = counted.where((F.col("t") >= LEAST) & (rate_t >= 4 * rate_c) & (F.col("t") >= SHARE * (F.col("t") + F.col("c"))))
    return [r["entry"] for r in usable.orderBy(score.desc(), "entry").limit(entries).collect()]


def _features(rows: DataFrame, lexicon, *names: str) -> DataFrame:
    """Columns ``names`` of ``rows`` (which has ``text``), with ``features`` and ``votes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(lexicon.value)
        for batch in batches:
            found = [reader.features(t) for t in batch.column(0).to_pylist()]
            columns = [batch.column(i + 1) for i in range(len(names))]
            columns.append(pa.array(found, type=pa.list_(pa.int64())))
            columns.append(pa.array([reader.votes(f) for f in found], type=pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    picked = rows.select("text", *names)
    schema = T.StructType(
        [
            *picked.schema.fields[1:],
            T.StructField("features", T.ArrayType(T.LongType())),
            T.StructField("votes", T.LongType()),
        ]
    )
    return picked.mapInArrow(run, schema)


def _sampled(size: int, total: int, *keys: str):
    """About ``size`` of ``total`` rows, by a hash of ``keys``."""
    return F.pmod(F.xxhash64(*keys), F.lit(1_000_000)) < int(1_000_000 * min(1.0, size / max(total, 1)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    entries: int = ENTRIES,
) -> Model:
    """Learns from all rows of ``labels`` whose id is in ``docs``; leave held-out rows out of ``labels``."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    given = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("toxic"))
    given = given.where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1))
    chosen = given.where(_sampled(sample, given.count(), "id")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    # about ``sample`` ids and labels
    joined = texts.join(F.broadcast(chosen), "id").select("text", "toxic")
    lexicon = Lexicon(_mine(joined, entries))
    shared = spark.sparkContext.broadcast(lexicon)

    anchor = _features(joined, shared, "toxic").groupBy("votes", "toxic").agg(F.count("*").alias("n")).collect()
    # one pass over all texts: their vote patterns, and the features of a sample to train on
    all_features = _features(texts, shared, "id")
    seen = texts.count()
    taken = _sampled(sample, seen, "id")
    grouped = (
        all_features.select("votes", F.when(taken, F.array_join("features", " ")).alias("features"))
        .groupBy("votes", "features")
        .agg(F.count("*").alias("n"))
    )
    rows = grouped.collect()
    by_votes: Counter = Counter()
    for r in rows:
        by_votes[r["votes"]] += r["n"]
    masks = np.array(list(by_votes), dtype=np.int64)
    counts = np.array(list(by_votes.values()), dtype=float)
    label_model = fit_label_model(
        masks, counts, [(r["votes"], r["toxic"], r["n"]) for r in anchor]
    ) if len(masks) else LabelModel(0.05, np.tile([0.02, 0.5], (VOTERS, 1)), np.ones(VOTERS))
    train = [r for r in rows if r["features"] is not None]
    posterior = label_model.posterior(vote_matrix(np.array([r["votes"] for r in train], dtype=np.int64)))
    weights = fit_linear(
        [list(map(int, r["features"].split())) for r in train],
        posterior,
        np.array([r["n"] for r in train], dtype=float),
        lexicon.features,
    )
    return Model(lexicon, label_model, weights)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Per input row: ``doc`` (the row, or its columns ``keep``) and ``score``, the classifier's probability."""
    names = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("doc"), docs[text_col].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(shared.value.lexicon)
        weights = shared.value.weights
        for batch in batches:
            odds = np.array([weights[f].sum() for f in map(reader.features, batch.column(1).to_pylist())])
            out = 1 / (1 + np.exp(-np.clip(odds + weights[-1], -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc", "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())]))
