"""Monthly wage and salary jobs, covered employment and its forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trendloom.functions.dates import header_serial
from trendloom.functions.nulls import not_in
from trendloom.functions.text import recode_map, trim_blank
from trendloom.operators.aggregate import region_rollup, residual_category, sum_by
from trendloom.operators.periods import period_summary
from trendloom.operators.reshape import melt_headers
from trendloom.operators.series import forecast_series
from trendloom.plans.near_transit import near_transit_jobs
from trendloom.schema import conform, union_trends
from trendloom.sources.lookups import JOB_AREAS, PRIVATE_SERVICES

STATE_AREA = "Washington State"
MERGED_AREA = "Bremerton MSA"
RESIDUAL = "Other Services"
_IDS = ("NAICS CELL", "NAICS INDUSTRY", "area")


def jobs_long(wide: DataFrame) -> DataFrame:
    """Sheets of industry rows and day-serial month columns as one long table.

    The smallest area publishes neither Other Services nor Construction on its own: the
    first is the private-service subtotal less its listed parts, the second is read from
    the combined mining label.
    """
    months = [c for c in wide.columns if c not in _IDS]
    long = melt_headers(
        wide.withColumns({"variable": trim_blank("NAICS INDUSTRY"), "geography": F.col("area")}),
        ["geography", "variable"],
        months,
        lambda header: {"date": header_serial(header)},
    )
    merged = F.col("geography") == MERGED_AREA
    listed = [s for s in PRIVATE_SERVICES if s != RESIDUAL]
    residual = residual_category(
        long.filter(merged), ["geography", "date"], "variable", "Private Service Providing", listed, RESIDUAL
    )
    renamed = F.when(
        merged,
        F.replace("variable", F.lit("Mining, Logging, and Construction"), F.lit("Construction")),
    ).otherwise(F.col("variable"))
    # A published residual would be counted twice beside the computed one.
    kept = long.filter(~F.coalesce(merged & (F.col("variable") == RESIDUAL), F.lit(False)))
    return kept.withColumn("variable", renamed).unionByName(residual)


def monthly_jobs(wide: DataFrame, yr: int, mo: int, filter_months: bool = False) -> DataFrame:
    """Jobs by area and industry per month, year to date and year.

    Year-to-date sums cover every published month of a year and are filed under ``mo``;
    ``filter_months`` limits earlier years to the same months.
    """
    in_region = not_in("geography", [STATE_AREA])
    areas = jobs_long(wide)
    keys = ["geography", "variable"]
    monthly = region_rollup(areas, ["variable", "date"], members=in_region).withColumn(
        "grouping", F.lit("Monthly")
    )
    yearly = period_summary(
        areas, keys, complete_through=yr if mo == 12 else yr - 1, cutoff_month=mo, filter_months=filter_months
    )
    periods = region_rollup(yearly, ["variable", "year", "grouping", "date"], members=in_region)
    return conform(
        union_trends(monthly, periods),
        year=F.year("date"),
        geography_type=recode_map("geography", JOB_AREAS),
        metric="Wage and Salary Employment",
    )


def covered_employment(
    station_jobs: DataFrame,
    forecast: DataFrame,
    forecast_base_yr: int = 2018,
    first_year: int = 2010,
    sector: int = 8,
) -> DataFrame:
    """Observed covered jobs of the region and their forecast, levels and changes.

    ``forecast``: employment_sector_dim_id, data_year, jobs. The year before the base year
    only serves the first change.
    """
    keys = ["year", "date", "geography", "geography_type", "grouping"]
    observed = conform(
        sum_by(near_transit_jobs(station_jobs, first_year), keys),
        variable="Observed",
        metric="Covered Employment",
    )
    future = forecast.filter(
        (F.col("employment_sector_dim_id") == sector) & (F.col("data_year") >= forecast_base_yr - 1)
    )
    return union_trends(
        observed,
        conform(forecast_series(future, "data_year", "jobs", "Covered Employment", level_label="Total")),
    )


def jobs_trends(
    wide: DataFrame,
    station_jobs: DataFrame,
    forecast: DataFrame,
    yr: int,
    mo: int,
    start_year: int = 2010,
    forecast_base_yr: int = 2018,
) -> DataFrame:
    """Monthly jobs, jobs near transit and covered employment."""
    return union_trends(
        monthly_jobs(wide, yr, mo),
        near_transit_jobs(station_jobs, start_year),
        covered_employment(station_jobs, forecast, forecast_base_yr, start_year),
    )
