"""Growth inside and outside high-capacity transit station areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from trendloom.operators.aggregate import latest_vintage, latest_vintage_sums, sum_by, sum_whole
from trendloom.operators.joins import lookup_join
from trendloom.operators.reshape import melt, spread
from trendloom.operators.series import complement, level_and_change, share_of_total
from trendloom.schema import conform
from trendloom.sources.buckets import SALT

INSIDE, OUTSIDE = "in station area", "not in station area"


def _regional_shares(series: DataFrame) -> DataFrame:
    shared = share_of_total(series, ["year", "metric", "grouping"])
    return conform(
        shared.withColumn("year", F.col("year").cast("int")),
        date=F.make_date(F.col("year").cast("int"), F.lit(4), F.lit(1)),
        geography="Region",
        geography_type="Region",
    )


def near_transit_population(
    facts: DataFrame, parcels: DataFrame, vintage_from: int = 2020, bucketed: bool = False
) -> DataFrame:
    """Population and housing units by station-area flag, with changes and shares.

    ``facts``: parcel_dim_id, estimate_year, total_pop, housing_units, ofm_vintage.
    ``parcels``: parcel_dim_id, hct_station_area_vision_2050. Facts are summed by parcel and year in one
    scan and the vintage is picked before the join, so a parcel that holds a large part of them
    reaches the join as one row a year. Sums are cut to whole numbers at the end.

    ``bucketed``: both are tables of ``buckets.write_pair`` by parcel. They are summed and joined where they
    lie, without a shuffle; the newest vintage then costs a scan of its column.
    """
    measures = ["total_pop", "housing_units"]
    dated = facts.withColumnRenamed("estimate_year", "year")
    keys = ["parcel_dim_id", SALT] if bucketed else ["parcel_dim_id"]
    if bucketed:
        current = latest_vintage(dated, "year", "ofm_vintage", vintage_from)
        by_parcel = sum_by(current, [*keys, "year"], *measures)
    else:
        by_parcel = latest_vintage_sums(dated, keys, "year", "ofm_vintage", vintage_from, *measures)
    flags = parcels.select(*keys, F.col("hct_station_area_vision_2050").alias("variable"))
    yearly = sum_whole(lookup_join(by_parcel, flags, keys), ["year", "variable"], *measures)
    return _regional_shares(
        level_and_change(
            yearly,
            ["variable"],
            "year",
            {"total_pop": "Population near HCT", "housing_units": "Housing Units near HCT"},
        )
    )


def near_transit_jobs(jobs: DataFrame, start_year: int = 2010) -> DataFrame:
    """Jobs inside and outside station areas, with changes and shares.

    ``jobs``: data_year, geo (``Inside HCT Area`` or ``Region``), total_emp.
    """
    inside, region = "Inside HCT Area", "Region"
    yearly = spread(
        jobs.filter((F.col("data_year") >= start_year) & F.col("geo").isin(inside, region)),
        ["data_year"],
        "geo",
        [inside, region],
        "total_emp",
    )
    parts = complement(yearly, region, inside, OUTSIDE).select(
        F.col("data_year").alias("year"), F.col(f"`{inside}`").alias(INSIDE), OUTSIDE
    )
    long = melt(parts, ["year"])
    return _regional_shares(
        level_and_change(long, ["variable"], "year", {"estimate": "Jobs near HCT"}, level_label="Total")
    )
