"""Date parsing and period stamps. Text that is no date, or whose year has no four digits, becomes NULL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from trendloom.functions.nulls import as_col


def parse_ymd(c: Column | str) -> Column:
    return F.try_to_date(as_col(c), "yyyy-M-d")


def parse_mdy(c: Column | str) -> Column:
    return F.try_to_date(as_col(c), "M/d/yyyy")


def parse_my(c: Column | str) -> Column:
    """``M/yyyy`` to the first of that month."""
    return F.try_to_date(as_col(c), "M/yyyy")


def excel_date(serial: Column | str) -> Column:
    """Spreadsheet day serial (day 0 is 1899-12-30) to a date."""
    return F.date_add(F.lit(dt.date(1899, 12, 30)), as_col(serial).try_cast("int"))


def stamp(year: Column | str, month, day: int = 1) -> Column:
    """Date a period is filed under: its year, a month, the first day."""
    month = F.lit(month) if isinstance(month, int) else as_col(month)
    return F.make_date(as_col(year).cast("int"), month.cast("int"), F.lit(day))


def last_complete_year(latest: Column | str) -> Column:
    """Year of the latest month when that month is December, else the year before."""
    latest = as_col(latest)
    return F.year(latest) - F.when(F.month(latest) == 12, 0).otherwise(1)


def reporting_cutoff(as_of: dt.date, lag_months: int = 2) -> tuple[int, int]:
    """(year, month) of the newest published month at ``as_of``."""
    months = as_of.year * 12 + as_of.month - 1 - lag_months
    return months // 12, months % 12 + 1


def header_month(text: str) -> dt.date | None:
    """A ``M/yyyy`` column header as the first of that month."""
    month, _, year = text.partition("/")
    if month.isdigit() and year.isdigit() and 1 <= int(month) <= 12:
        return dt.date(int(year), int(month), 1)
    return None


def header_serial(text: str) -> dt.date | None:
    """A spreadsheet day serial used as column header."""
    try:
        return dt.date(1899, 12, 30) + dt.timedelta(days=int(float(text)))
    except ValueError:
        return None
