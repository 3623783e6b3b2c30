"""String cleaning and recoding."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

from trendloom.functions.nulls import as_col


def remove_all(c: Column | str, text: str) -> Column:
    return F.replace(as_col(c), F.lit(text), F.lit(""))


def replace_first(c: Column | str, text: str, new: str) -> Column:
    """Replace only the first occurrence of a literal text."""
    c = as_col(c)
    at = F.instr(c, text)
    return F.when(at > 0, F.overlay(c, F.lit(new), at, F.lit(len(text)))).otherwise(c)


def recode_chain(c: Column | str, steps: Iterable[tuple[str, str]]) -> Column:
    """Apply literal replacements one after another; later steps see earlier results."""
    return reduce(lambda acc, s: F.replace(acc, F.lit(s[0]), F.lit(s[1])), steps, as_col(c))


def recode_map(c: Column | str, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Exact-match recode; an unlisted value becomes ``default`` (NULL if none)."""
    c = as_col(c)
    branches = reduce(lambda acc, kv: acc.when(c == kv[0], F.lit(kv[1])), mapping.items(), F)
    return branches if default is None else branches.otherwise(default)


def case_contains(c: Column | str, branches: Iterable[tuple[str, str]]) -> Column:
    """First branch whose text occurs in the value wins; no match gives NULL."""
    c = as_col(c)
    return reduce(lambda acc, b: acc.when(c.contains(b[0]), F.lit(b[1])), branches, F)


def trim_blank(c: Column | str) -> Column:
    """Strip spaces, tabs and line ends from both sides."""
    return F.btrim(as_col(c), F.lit(" \t\r\n"))


def pad_left(c: Column | str, width: int) -> Column:
    """Zero-pad on the left; a longer text is kept whole, where ``lpad`` would cut it."""
    c = as_col(c).cast("string")
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def geoid(state: Column | str, county: Column | str) -> Column:
    """County GEOID: two digits of state code, three of county code."""
    return F.concat(pad_left(state, 2), pad_left(county, 3))
