"""License notices against a plain scan of all word spans, edit distances and a plain search of the base phrases."""

import os
import random
import re

import pytest

from creditloom.llm import licenses
from creditloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LABELS = licenses.NOTICES | licenses.BASE


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def base_places(words):
    out = []
    for phrase, label in licenses.BASE.items():
        part = phrase.split()
        out += [(i, label) for i in range(len(words) - len(part) + 1) if words[i : i + len(part)] == part]
    return sorted(out)


def damaged(rng, phrase, edits):
    chars = list(phrase)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0 and len(chars) > 1:
            del chars[at]
        elif kind == 1:
            chars[at] = rng.choice("abcxyz 1")
        else:
            chars.insert(at, rng.choice("abcxyz 1"))
    return "".join(chars)


def rows(rng, n):
    filler = "the public license of free software gnu mit cc by use any".split()
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += rng.choices(filler, k=rng.randrange(6))
            phrase = rng.choice(sorted(LABELS))
            parts.append(damaged(rng, phrase, rng.randrange(licenses.edits_allowed(phrase) + 2)))
        joint = rng.choice([" ", "\n", ", ", " -- "])
        text = joint.join(parts)
        yield i, "".join(c.upper() if rng.random() < 0.1 else c for c in text)


def test_against_all_spans(spark):
    given_rows = list(rows(random.Random(5), 150))
    found = licenses.find_notices(spark.createDataFrame(given_rows, "doc_id long, text string")).collect()
    texts = dict(given_rows)
    assert sorted(r.doc.doc_id for r in found) == sorted(texts)
    met = 0
    for r in found:
        text = texts[r.doc.doc_id]
        words = WORD.findall(lowered(text))
        assert r.n_words == len(words) and 0 <= r.score <= 1 and bool(r.score) == bool(r.matches)
        by = {}
        for m in r.matches:
            span = " ".join(words[m.first_word : m.first_word + m.n_words])
            assert m.edits == distance(span, m.phrase) <= licenses.edits_allowed(m.phrase)
            assert " ".join(WORD.findall(lowered(text[m.start : m.end]))) == span
            assert m.label == LABELS[m.phrase]
            by.setdefault(m.phrase, []).append((m.first_word, m.first_word + m.n_words))
        for phrase in LABELS:
            k, usual = licenses.edits_allowed(phrase), len(phrase.split())
            for i in range(len(words)):
                for n in range(max(1, usual - k), usual + k + 1):
                    span = " ".join(words[i : i + n])
                    if i + n <= len(words) and abs(len(span) - len(phrase)) <= k and distance(span, phrase) <= k:
                        met += 1
                        # it is reported, or one of the same notice that overlaps it is
                        assert any(a < i + n and i < b for a, b in by[phrase])
        exact = sorted((m.first_word, m.label) for m in r.matches if m.base and not m.edits)
        assert exact == base_places(words)
    assert met > 200


@given
def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op13_license_scans"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        words = WORD.findall(lowered(docs[r.doc_id]))
        places = base_places(words)
        assert r.n_words == len(words) and r.n_base == len(places)
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
    assert any(r.n_base for r in got)


def test_edges(spark):
    schema = "doc_id long, text string, score double, matches string, n_words string"
    long = "word " * 60_000 + "GNU\nGeneral * Public-License"
    frame = spark.createDataFrame(
        [
            (1, None, 1.0, "a", "b"),
            (2, "", None, None, None),
            (3, long, None, None, None),
            (3, long, None, None, None),
            (None, "MIT License MIT license, mit licence ", 0.0, None, None),
            (4, "permit license; limité license; cc bye", 0.0, None, None),
            (5, "...", 0.0, None, None),
        ],
        schema,
    )
    got = licenses.find_notices(frame).collect()
    assert len(got) == 7
    by = {r.doc.doc_id: r for r in got}
    assert by[1].n_words == by[2].n_words == by[5].n_words == 0 and by[1].score == 0.0 and by[1].matches == []
    assert by[1].doc.score == 1.0 and by[1].doc.matches == "a"
    gpl = by[3].matches[0]
    assert (gpl.label, gpl.edits, gpl.first_word, gpl.n_words) == ("gpl", 0, 60_000, 4)
    assert long[gpl.start : gpl.end] == "GNU\nGeneral * Public-License"
    assert [(m.first_word, m.edits) for m in by[None].matches if m.phrase == "mit license"] == [(0, 0), (2, 0)]
    assert by[4].matches == []
    assert licenses.find_notices(frame.limit(0)).collect() == []
    only = licenses.find_notices(frame, notices={"limit license": "x"}).where("doc.doc_id = 4").first()
    assert [m.label for m in only.matches] == ["x"]
