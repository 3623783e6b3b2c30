"""Census survey indicators for counties, cities, the region and metro areas.

``acs`` columns: name, variable, estimate, moe, census_geography, year. ``metro`` holds
county rows with GEOID, variable, estimate, moe, year. ``counties`` lists the counties of
each metro area with MPO_AREA, STATE_FIPS and COUNTY_FIPS.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from trendloom.functions.text import geoid
from trendloom.operators.aggregate import moe_sum
from trendloom.operators.series import share_of_label
from trendloom.schema import conform, union_trends
from trendloom.sources.lookups import ACS_TOPICS, acs_lookup

_PLACE = ["topic", "year", "census_geography", "name"]
_CELL = ["year", "census_geography", "name", "variable", "estimate", "moe"]


def label_and_consolidate(
    df: DataFrame, lookup: DataFrame, keys: Sequence[str], mode: str = "total"
) -> DataFrame:
    """Keep the variables a lookup lists and sum them, with margins, under its labels.

    A variable is listed once per topic, so the inner join is at once the filter and the
    label join.
    """
    labelled = df.join(lookup.withColumnRenamed("simple_label", "label"), "variable")
    return moe_sum(labelled, [*keys, "label"], mode=mode)


def _with_years(counties: DataFrame, years: Iterable[int]) -> DataFrame:
    return counties.select(
        F.col("MPO_AREA").alias("name"),
        geoid("STATE_FIPS", "COUNTY_FIPS").alias("GEOID"),
        F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("year"),
    )


def acs_trends(
    acs: DataFrame,
    metro: DataFrame,
    counties: DataFrame,
    years: Iterable[int],
    topics: Iterable[str] | None = None,
    lookup: DataFrame | None = None,
) -> DataFrame:
    """All topics, years and geographies in one aggregation; the topic is the metric.

    A metro area with a county that has no data keeps a row without label and estimate.
    """
    years = list(years)
    topics = list(topics) if topics is not None else list(ACS_TOPICS)
    if lookup is None:
        # At most 147 rows, stated in code. Spark knows no size for them and would else
        # plan to shuffle the cells by variable.
        lookup = F.broadcast(acs_lookup(acs.sparkSession, topics))
    lookup = lookup.filter(F.col("topic").isin(*topics))

    wanted = F.col("year").isin(*years)
    places = acs.filter(wanted & F.col("census_geography").isin("County", "Region", "City"))
    members = _with_years(counties, years)
    areas = metro.join(members, ["GEOID", "year"]).withColumn("census_geography", F.lit("Metro Areas"))
    summed = label_and_consolidate(
        places.select(*_CELL).unionByName(areas.select(*_CELL)), lookup, _PLACE
    )
    seen = metro.filter(wanted).join(lookup, "variable").select("GEOID", "year", "topic").distinct()
    unseen = (
        members.withColumn("topic", F.explode(F.array(*[F.lit(t) for t in topics])))
        .join(seen, ["GEOID", "year", "topic"], "left_anti")
        .select("topic", "year", F.lit("Metro Areas").alias("census_geography"), "name")
        .distinct()
    )
    return conform(
        union_trends(share_of_label(summed, _PLACE, "label"), unseen),
        date=F.make_date(F.col("year").cast("int"), F.lit(12), F.lit(1)),
        geography=F.col("name"),
        geography_type=F.col("census_geography"),
        variable=F.col("label"),
        grouping="All",
        metric=F.col("topic"),
    )


def acs_indicator(
    acs: DataFrame,
    metro: DataFrame,
    counties: DataFrame,
    years: Iterable[int] = (2021,),
    topic: str = "commute-modes",
    lookup: DataFrame | None = None,
) -> DataFrame:
    """One census topic; ``lookup`` brings labels for a topic that is not built in."""
    return acs_trends(acs, metro, counties, years, [topic], lookup)
