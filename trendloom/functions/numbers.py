"""Unit conversion and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from trendloom.functions.nulls import as_col, safe_ratio

TONS_PER_POUND = 0.00045359


def pounds_to_tons(c: Column | str) -> Column:
    """Pounds to whole metric tons, halves to the even neighbour."""
    return F.rint(as_col(c) * F.lit(TONS_PER_POUND))


def guarded_ratio(numerator: Column | str, denominator: Column | str, digits: int = 2) -> Column:
    """Rounded ratio, NULL unless the denominator is positive."""
    return F.when(as_col(denominator) > 0, F.bround(safe_ratio(numerator, denominator), digits))
