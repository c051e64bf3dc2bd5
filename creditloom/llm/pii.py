"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

DataFrame functions only. A pattern is run twice over a text, once for its matches and once for the
gaps between them; the running length of both gives each match its place in code points. The gaps next
to a match are the context that is searched for words of its kind.

The patterns of the base kinds find what a plain leftmost search finds, and are written so that each
start costs time in proportion to the text: runs are possessive, and a search starts at the beginning
of a run or where the last match ended.

Base kinds are kept whatever their score. ``iban`` (mod 97) and ``ssn`` (no checksum, so it needs words
nearby) are added by score.

An ``iban`` is proposed at every place where a country code begins, with the length of that country and
no letter or digit right after it; of those that mod 97 confirms, the leftmost stays where two overlap.

Defined results: a null text is an empty one and has no spans. Equal rows give equal rows. Further
columns are kept in ``doc`` and never looked at. There is no join and no grouping.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import packed

#: Code points of context on each side of a match.
CONTEXT = 40
#: Added to the score of a span that has a word of its kind nearby.
CONTEXT_BONUS = 0.4
#: Spans of the added kinds need at least this score.
THRESHOLD = 0.7

SPAN = "array<struct<start:int,end:int,hit:string,before:string,after:string>>"

# The shapes and bounds of each kind.
MAIL_CHARS = "A-Za-z0-9._%+-"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IBAN = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}"
#: Countries of the IBAN registry, and those that use the same form without being in it, by length.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
#: Matches whose lengths are added up together.
BLOCK = 128
SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
WORDS = {
    "email": "e-?mail|contact|kontakt|correo|courriel|write to",
    "ip": "ip|host|server|address|adresse|login",
    "card": "card|visa|credit|karte|carte|tarjeta|payment",
    "phone": "phone|call|tel|mobile|fax|telefon",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social security|tax id",
}


@dataclass(frozen=True)
class Kind:
    name: str
    #: A cheap test that every text with a match passes.
    hint: str
    pattern: str
    score: float
    base: bool


KINDS = (
    Kind(
        "email",
        "@[A-Za-z0-9-]",
        rf"(?:(?<![{MAIL_CHARS}])|\G)[{MAIL_CHARS}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.8,
        True,
    ),
    Kind(
        "ip",
        r"[0-9]\.[0-9]",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.6,
        True,
    ),
    Kind("card", "[0-9][ -]?[0-9]", "[0-9](?:[ -]?[0-9])++", 0.9, True),
    Kind("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]", 0.6, True),
    Kind("iban", "[A-Z]{2}[0-9]{2}", IBAN, 0.9, False),
    Kind("ssn", "[0-9]-[0-9]{2}-[0-9]", SSN, 0.4, False),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often a lambda inside looks at it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, x: total + x)


def running_totals(numbers: Column) -> Column:
    """What comes before each number of an array that isn't empty.

    Blocks of ``BLOCK`` numbers are summed, then the blocks before a number's own and what is before it there:
    the work grows with the length, where an array built entry by entry is copied for each.
    """
    places = F.sequence(F.lit(0), F.size(numbers) - 1)
    blocks = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda b: _total(F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK))))
    before = F.aggregate(
        sums, F.array(F.lit(0)), lambda out, x: F.concat(out, F.array(F.element_at(out, F.lit(-1)) + x))
    )

    def at(known: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        return F.get(known, block) + _total(F.slice(numbers, block * BLOCK + 1, i % BLOCK))

    return _let(before, lambda known: F.transform(places, lambda i: at(known, i)))


def matches(text: Column, kind: Kind) -> Column:
    """The places of all matches, left to right, each with the text around it."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)

    def spans(hits: Column, gaps: Column) -> Column:
        lengths = F.zip_with(
            hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda hit, gap: F.char_length(hit) + F.char_length(gap)
        )
        # the gap after a match is the gap before the next one
        return _let(lengths, lambda n: _let(running_totals(n), lambda at: F.transform(hits, lambda hit, i: span(hit, i, gaps, at))))

    def span(hit: Column, i: Column, gaps: Column, at: Column) -> Column:
        begin = F.get(at, i) + F.char_length(F.get(gaps, i))
        return F.struct(
            begin.alias("start"),
            (begin + F.char_length(hit)).alias("end"),
            hit.alias("hit"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"),
        )

    none = F.array().cast(SPAN)
    found = _let(hits, lambda h: F.when(F.size(h) == 0, none).otherwise(_let(gaps, lambda g: spans(h, g))))
    return F.when(text.rlike(kind.hint), found).otherwise(none)


def iban_matches(text: Column) -> Column:
    """The right account codes, left to right, each with the text around it."""
    whole = "|".join(
        f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, codes in IBAN_LENGTHS.items()
    )
    # a match is one letter, and what may be a code from there on is its group: codes may overlap
    pattern = rf"(?=[A-Z]{{2}}[0-9]{{2}})(?=({whole})(?![\p{{L}}\p{{N}}]))[A-Z]"
    codes, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        begin = acc["at"] + F.char_length(piece["before"])
        end = begin + F.char_length(piece["hit"])
        found = F.struct(
            begin.alias("start"),
            end.alias("end"),
            piece["hit"].alias("hit"),
            F.right(F.left(text, begin), F.lit(CONTEXT)).alias("before"),
            F.substr(text, end + 1, F.lit(CONTEXT)).alias("after"),
        )
        sure = (begin >= acc["free"]) & confirmed("iban", piece["hit"])
        return F.when(piece["hit"].isNull(), acc).otherwise(
            F.struct(
                (begin + 1).alias("at"),
                F.when(sure, end).otherwise(acc["free"]).alias("free"),
                F.when(sure, F.concat(acc["out"], F.array(found))).otherwise(acc["out"]).alias("out"),
            )
        )

    found = F.aggregate(F.arrays_zip(codes.alias("hit"), gaps.alias("before")), start, step)["out"]
    return F.when(text.rlike("[A-Z]{2}[0-9]{2}"), found).otherwise(F.array().cast(SPAN))


def luhn(digits: Column) -> Column:
    """Whether a text of digits has a right check digit."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, F.lit(9)).otherwise(F.lit(0))
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code (A-Z, 0-9) is right: moved by four, letters as 10 to 35, rest 1."""
    moved = F.concat(F.substr(code, F.lit(5)), F.left(code, F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        c = F.ascii(F.substr(moved, i, F.lit(1)))
        return F.when(c >= 65, (rest * 100 + c - 55) % 97).otherwise((rest * 10 + c - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), add) == 1


def confirmed(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(hit, " ", ""))
    return F.lit(True)


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per input row: ``doc`` (the row) and ``spans``, an array of kind, start, end, score, base.

    Sorted by kind as in ``KINDS``, then by start; ``end`` is exclusive.
    """
    rows = packed(docs)
    text = F.coalesce(F.col("doc")[text_col], F.lit(""))
    found = {k.name: iban_matches(text) if k.name == "iban" else matches(text, k) for k in KINDS}
    rows = rows.select("doc", *(m.alias(f"_{name}") for name, m in found.items()))

    def scored(kind: Kind) -> Column:
        near = rf"(?i)(^|[^a-z])({WORDS[kind.name]})([^a-z]|$)"

        def score(m: Column) -> Column:
            close = m["before"].rlike(near) | m["after"].rlike(near)
            total = F.lit(kind.score) + F.when(close, F.lit(CONTEXT_BONUS)).otherwise(F.lit(0.0))
            return F.struct(
                F.lit(kind.name).alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                F.least(total, F.lit(1.0)).alias("score"),
                F.lit(kind.base).alias("base"),
            )

        sure = F.filter(F.col(f"_{kind.name}"), lambda m: confirmed(kind.name, m["hit"]))
        spans = F.transform(sure, score)
        return spans if kind.base else F.filter(spans, lambda s: s["score"] >= THRESHOLD)

    return rows.select("doc", F.concat(*(scored(k) for k in KINDS)).alias("spans"))
