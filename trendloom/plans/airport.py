"""Airport passengers and cargo: monthly for one airport, yearly for the nation's."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions.dates import reporting_cutoff
from trendloom.functions.nulls import to_number
from trendloom.functions.numbers import pounds_to_tons
from trendloom.functions.text import recode_map
from trendloom.operators.periods import missing_months, period_summary
from trendloom.schema import conform, union_trends
from trendloom.sources.lookups import AIRPORT, AIRPORT_CATEGORIES


def _month(key: str) -> Column:
    """Date of a ``MMYYYY`` file key."""
    return F.make_date(
        F.substring(key, 3, 4).try_cast("int"), F.substring(key, 1, 2).try_cast("int"), F.lit(1)
    )


def airport_monthly(rows: DataFrame, as_of: dt.date, yr1: int = 2019) -> DataFrame:
    """Months, complete years and years to date of the home airport.

    ``rows``: variable, estimate and month_key (MMYYYY). Figures appear two months late,
    so the newest month used lies two months before ``as_of``.
    """
    year, month = reporting_cutoff(as_of)
    listed = [category for category, _, _ in AIRPORT_CATEGORIES]
    monthly = (
        rows.select(
            F.col("variable").alias("category"),
            to_number("estimate").alias("estimate"),
            _month("month_key").alias("date"),
        )
        .dropna("any")
        .filter(
            F.col("category").isin(*listed)
            & F.col("date").between(F.lit(dt.date(yr1, 1, 1)), F.lit(dt.date(year, month, 1)))
        )
        .select(
            "date",
            recode_map("category", {c: v for c, _, v in AIRPORT_CATEGORIES}).alias("variable"),
            recode_map("category", {c: m for c, m, _ in AIRPORT_CATEGORIES}).alias("metric"),
            "estimate",
        )
    )
    periods = period_summary(
        monthly, ["variable", "metric"], complete_through=year if month == 12 else year - 1, cutoff_month=month
    )
    return conform(
        union_trends(monthly.withColumn("grouping", F.lit("Monthly")), periods),
        year=F.year("date"),
        geography=AIRPORT,
        geography_type="Region",
    )


def missing_airport_months(rows: DataFrame, as_of: dt.date, yr1: int = 2019) -> DataFrame:
    """Months that should have been published by ``as_of`` but are not among the files."""
    newest = dt.date(*reporting_cutoff(as_of), 1)
    return missing_months(rows.select(_month("month_key").alias("date")), dt.date(yr1, 1, 1), newest)


def airport_national(rows: DataFrame, metric: str = "passengers", yr1: int = 2019) -> DataFrame:
    """Yearly enplanements or landed cargo (metric tons) of the metro airports.

    ``rows``: geography, estimate and file_key (the year).
    """
    estimate = to_number("estimate")
    yearly = rows.select(
        "geography",
        (pounds_to_tons(estimate) if metric == "cargo" else estimate).alias("estimate"),
        F.col("file_key").alias("year"),
    ).dropna("any", subset=["geography", "estimate"])
    return conform(
        yearly.filter(F.col("year") >= str(yr1)),
        date=F.make_date(F.col("year").cast("int"), F.lit(12), F.lit(1)),
        geography_type="Metro Airports",
        variable="Total",
        metric=metric.title(),
        grouping="Annual",
    )


def airport_trends(
    monthly: DataFrame, passengers: DataFrame, cargo: DataFrame, as_of: dt.date, yr1: int = 2019
) -> DataFrame:
    """The home airport's months and periods with national passengers and cargo."""
    return union_trends(
        airport_monthly(monthly, as_of, yr1),
        airport_national(passengers, "passengers", yr1),
        airport_national(cargo, "cargo", yr1),
    )
