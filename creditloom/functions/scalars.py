"""Column expressions. All of them compile to built-in functions inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditloom.vocabulary import (
    AGE_BANDS,
    MISSING_MARKER,
    MONTH_NAMES,
    OPEN_AGE_BAND,
    UNKNOWN,
)


def sql_literal(value) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else str(value)


def literal_map(mapping: Mapping) -> Column:
    """Constant map as one expression text, which is one call into the JVM."""
    entries = ", ".join(sql_literal(x) for pair in mapping.items() for x in pair)
    return F.expr(f"map({entries})")


def decode(code: Column, labels: Mapping[int, str], other: str = UNKNOWN) -> Column:
    """Label of a code; codes outside the dictionary and NULL give ``other``."""
    return F.coalesce(F.element_at(literal_map(labels), code.cast("int")), F.lit(other))


def banded(value: Column, bands=AGE_BANDS, open_label: str = OPEN_AGE_BAND) -> Column:
    """Label of the first band whose upper bound exceeds ``value``; NULL falls to the open band."""
    hits = [F.when(value < upper, F.lit(label)) for upper, label in bands]
    return F.coalesce(*hits, F.lit(open_label))


def ratio(num: Column, den: Column, digits: int = 4, zero: float | None = None) -> Column:
    """Rounded quotient; NULL for a zero denominator unless ``zero`` names another value."""
    quotient = F.round(num / F.nullif(den, F.lit(0)), digits)
    return quotient if zero is None else F.coalesce(quotient, F.lit(float(zero)))


def clamp(value: Column, low, high) -> Column:
    """Restrict to [low, high]; NULL stays NULL, which ``greatest`` and ``least`` would drop."""
    low, high = F.lit(low), F.lit(high)
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def steady_round(value: Column, digits: int) -> Column:
    """Round a float so that the order of its summation cannot decide a tie."""
    return F.round(F.round(value, digits + 6), digits)


def total(columns: Iterable[Column]) -> Column:
    return reduce(add, columns)


def count_positive(columns: Iterable[Column]) -> Column:
    return total(F.when(c > 0, 1).otherwise(0) for c in columns)


def month_key(date: Column) -> Column:
    """``yyyymm`` of a date or timestamp."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def month_key_of_text(text: Column) -> Column:
    """``yyyymm`` of an ISO date kept as text; NULL when it is not one."""
    return F.substring(text, 1, 4).try_cast("int") * 100 + month_of_text(text)


def month_of_text(text: Column) -> Column:
    return F.substring(text, 6, 2).try_cast("int")


def month_name(month: Column) -> Column:
    return F.element_at(literal_map(MONTH_NAMES), month.cast("int"))


def month_name_of_key(key: Column) -> Column:
    """Month name of a ``yyyymm`` key; every key outside 1..11 counts as the last month."""
    last = MONTH_NAMES[12]
    named = {m: n for m, n in MONTH_NAMES.items() if n != last}
    return F.coalesce(F.element_at(literal_map(named), (key % 100).cast("int")), F.lit(last))


def parse_number(text: Column, marker: str = MISSING_MARKER) -> Column:
    """Number held as text; the missing marker, blanks and unparsable text give NULL."""
    return F.nullif(F.trim(text), F.lit(marker)).try_cast("double")


def observed(text: Column, marker: str = MISSING_MARKER) -> Column:
    """True for rows that carry a value; the marker is text, so NULL needs its own test."""
    return text.isNotNull() & (text != marker)


def number_or_text(text: Column) -> Column:
    """Text in normal form: numbers as Spark writes them, whole ones without a fraction.

    Numbers from 1e15 on and all other text stay as they are.
    """
    plain = F.trim(text)
    number = F.when(
        plain.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), plain.try_cast("double")
    )
    small = F.abs(number) < F.lit(1e15)
    whole = number.cast("bigint").cast("string")
    shown = F.when(number == F.floor(number), whole).otherwise(number.cast("string"))
    return F.when(small, shown).otherwise(text)


# Fixed value: the line terminators of Unicode text, each a single character.
LINE_END_CHARS = [chr(c) for c in (10, 11, 12, 13, 28, 29, 30, 0x85, 0x2028, 0x2029)]
LINE_ENDS = "\\r\\n|[" + "".join(f"\\x{{{ord(c):x}}}" for c in LINE_END_CHARS) + "]"


def line_count(text: Column) -> Column:
    """Lines of a text; a last line counts whether or not it is terminated."""
    ends = F.regexp_count(text, F.lit(LINE_ENDS))
    open_line = (F.length(text) > 0) & ~F.substring(text, -1, 1).isin(*LINE_END_CHARS)
    return (ends + open_line.cast("int")).cast("bigint")


def normalised_text(text: Column) -> Column:
    """Lower-case words joined by single underscores, for data rather than names."""
    return F.lower(F.regexp_replace(F.trim(text), r"[\s.\-_]+", "_"))
