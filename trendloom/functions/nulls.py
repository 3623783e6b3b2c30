"""NULL, division and cast rules shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def na_sum(c: Column | str) -> Column:
    """Sum that is NULL as soon as one input is NULL.

    Two counters and a sum, so map-side partial aggregation still applies, and summing
    already summed groups gives the same answer as summing the rows.
    """
    c = as_col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def na_sum_if(condition: Column, c: Column | str) -> Column:
    """``na_sum`` over the rows meeting ``condition``; NULL when none does."""
    c = as_col(c)
    kept = F.when(condition, c)
    return F.when(F.count(kept) == F.count_if(condition), F.sum(kept))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; a zero denominator gives NULL instead of an ANSI error."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def to_number(c: Column | str) -> Column:
    """Text to double; text that is no number becomes NULL."""
    return as_col(c).try_cast("double")


def not_in(c: Column | str, values) -> Column:
    """Outside a fixed list; a NULL is outside every list."""
    return ~F.coalesce(as_col(c).isin(*values), F.lit(False))
