"""Transit boardings, revenue miles and hours.

Input: one row per operator, mode and type of service with columns agency_id, agency,
mode, tos, metric (UPT, VRM, VRH) and one column per month named ``M/yyyy``; and the
operator list with NTDID, MPO_AREA and AGENCY_NAME.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions.dates import header_month, last_complete_year
from trendloom.functions.numbers import guarded_ratio
from trendloom.functions.text import pad_left, recode_map
from trendloom.operators.aggregate import grouped_levels, sum_by
from trendloom.operators.joins import keep_known, lookup_join
from trendloom.operators.periods import period_summary
from trendloom.operators.reshape import melt_headers, spread
from trendloom.schema import conform
from trendloom.sources.lookups import DEMAND_RESPONSE_SERVICES, TRANSIT_METRICS, TRANSIT_MODES

ALL_MODES = "All Transit Modes"
RATIO = "Boardings-per-Hour"
_IDS = ("agency_id", "agency", "mode", "tos", "metric")


def split_demand_response(mode: str = "mode", tos: str = "tos") -> Column:
    """Demand response split by type of service; any other mode unchanged."""
    split = (F.col(mode) == "DR") & F.col(tos).isin(*DEMAND_RESPONSE_SERVICES)
    return F.when(split, F.concat_ws("-", F.col(mode), F.col(tos))).otherwise(F.col(mode))


def transit_monthly(wide: DataFrame, agencies: DataFrame) -> DataFrame:
    """Known operators by month and mode, once for each metro area they serve."""
    operators = agencies.select(
        pad_left("NTDID", 5).alias("NTDID"),
        F.col("MPO_AREA").alias("area"),
        F.col("AGENCY_NAME").alias("operator"),
    )
    known = keep_known(wide.withColumn("agency_id", pad_left("agency_id", 5)), operators, "agency_id", "NTDID")
    months = [c for c in wide.columns if c not in _IDS]
    long = melt_headers(
        known.withColumn("variable", recode_map(split_demand_response(), TRANSIT_MODES)),
        ["agency_id", "agency", "variable", "metric"],
        months,
        lambda header: {"date": header_month(header)},
        drop_null=True,
    )
    by_operator = sum_by(long, ["agency_id", "agency", "metric", "date", "variable"])
    return lookup_join(by_operator, operators, "agency_id", "NTDID").select(
        recode_map("metric", TRANSIT_METRICS).alias("metric"),
        "date", "variable", "area", "operator", "estimate",
    )


def transit_trends(wide: DataFrame, agencies: DataFrame, home_area: str = "Seattle") -> DataFrame:
    """Annual and year-to-date totals for metro areas, the region and its operators."""
    monthly = transit_monthly(wide, agencies)
    # Each metric has its own newest month.
    newest = monthly.groupBy("metric").agg(F.max("date").alias("newest"))
    periods = period_summary(
        # One row per metric, of three: a shuffle by metric would make three partitions.
        monthly.join(F.broadcast(newest), "metric"),
        ["metric", "area", "variable", "operator"],
        complete_through=last_complete_year("newest"),
        cutoff_month=F.month("newest"),
    )
    levels = grouped_levels(
        periods,
        ["metric", "grouping", "date"],
        {
            "area": ["area"],
            "area mode": ["area", "variable"],
            "operator": ["area", "operator"],
            "operator mode": ["area", "operator", "variable"],
        },
    )
    home = F.col("area") == home_area

    def row(applies: Column, geography, geography_type: str, variable) -> Column:
        return F.when(
            applies,
            F.struct(
                geography.alias("geography"),
                F.lit(geography_type).alias("geography_type"),
                variable.alias("variable"),
            ),
        )

    level, region = F.col("level"), F.lit("Region")
    placed = levels.select(
        "metric", "grouping", "date", "estimate",
        F.explode(
            F.array(
                row(level == "area", F.col("area"), "Metro Areas", F.lit(ALL_MODES)),
                row((level == "area") & home, region, "Region", F.lit(ALL_MODES)),
                row((level == "area mode") & home, region, "Region", F.col("variable")),
                row((level == "operator") & home, F.col("operator"), "Transit Operator", F.lit(ALL_MODES)),
                row((level == "operator mode") & home, F.col("operator"), "Transit Operator", F.col("variable")),
            )
        ).alias("placed"),
    ).filter(F.col("placed").isNotNull()).select("metric", "grouping", "date", "estimate", "placed.*")

    ids = ["date", "geography", "geography_type", "variable", "grouping"]
    names = list(TRANSIT_METRICS.values())
    wide_metrics = spread(placed, ids, "metric", names).withColumn(
        RATIO, guarded_ratio("Boardings", "Revenue-Hours")
    )
    long = melt_headers(wide_metrics, ids, [*names, RATIO], lambda name: {"metric": name})
    return conform(long.dropna("any").filter(F.col("estimate") > 0))
