"""Column-name rules. Pure functions on names plus one projection to apply them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from creditloom.vocabulary import TARGET, TARGET_SPELLINGS


def snake_case(name: str) -> str:
    """Dots, dashes and blanks become single underscores; the result is lower case."""
    blank_free = "_".join(re.split(r"[\s.\-]+", name.strip()))
    return re.sub("_{2,}", "_", blank_free).lower()


def warehouse_name(name: str) -> str:
    """Keep word characters only, joined by single underscores, lower case, none at the ends."""
    words = [w for w in re.split(r"[\W_]+", name) if w]
    return "_".join(words).lower()


def rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    """Apply ``rule`` to every column in one projection; refuses a rule that merges columns."""
    names = [rule(c) for c in df.columns]
    clashes = {n for n in names if names.count(n) > 1}
    if clashes:
        raise ValueError(f"renaming would merge columns: {sorted(clashes)}")
    return df.toDF(*names)


def canonical_target(df: DataFrame, spellings: Iterable[str] = TARGET_SPELLINGS) -> DataFrame:
    """Give the label column its canonical name where one of the known spellings is present."""
    if TARGET in df.columns:
        return df
    return df.withColumnsRenamed({s: TARGET for s in spellings if s in df.columns})


def standardise_columns(df: DataFrame) -> DataFrame:
    return canonical_target(rename_all(df, snake_case))


def find_target(columns: Iterable[str], spellings: Iterable[str] = TARGET_SPELLINGS) -> str:
    """The label column among ``columns``: a known spelling, else any name with 'default' in it."""
    columns = list(columns)
    by_rule = {snake_case(c): c for c in reversed(columns)}
    known = [by_rule[s] for s in map(snake_case, spellings) if s in by_rule]
    loose = [c for c in columns if "default" in c.lower()]
    for match in [*known, *loose]:
        return match
    raise KeyError(f"no label column among {columns}")
