"""Population and housing by jurisdiction, from wide year-by-column tables.

Filter codes: 1 county, 2 its unincorporated part, 3 its incorporated part, 4 city.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions.nulls import as_col, to_number
from trendloom.functions.text import recode_chain, remove_all, replace_first, trim_blank
from trendloom.operators.aggregate import region_rollup, sum_by
from trendloom.operators.joins import lookup_join
from trendloom.operators.reshape import columns_containing, drop_containing, melt_headers
from trendloom.operators.series import forecast_series, level_and_change
from trendloom.schema import conform, union_trends
from trendloom.sources.lookups import (
    HOME_COUNTIES,
    HOUSING_METRICS,
    JURISDICTION_NAMES,
    REGIONAL_CLASSES,
)

_CITY_NAMES_1990S = (("Beaux Arts", "Beaux Arts Village"), ("Du Pont", "DuPont"))


def _header_year(header: str) -> str | None:
    """The year a column header starts with."""
    found = re.match(r"\s*(\d{4})(?!\d)", header)
    return found.group(1) if found else None


def population_segment(
    wide: DataFrame,
    layout: str,
    counties: Sequence[str] = HOME_COUNTIES,
    boundary_year: int | None = None,
) -> DataFrame:
    """One vintage of the population table as level, place, year and estimate.

    ``layout`` is '1990s', 'intercensal' (2000s and 2010s) or 'latest'. The boundary year
    also opens the next vintage, which owns it, and is dropped here.
    """
    latest = layout == "latest"
    county, place = ("County", "Jurisdiction") if latest else ("County.Name", "City.Name")
    ids = wide.filter(as_col(county).isin(*counties))
    ids = ids.withColumns(
        {
            "level": to_number("Filter"),
            "place": _segment_place(layout, as_col(county), replace_first(place, " (part)", "")),
        }
    )
    long = melt_headers(
        ids,
        ["level", "place"],
        columns_containing(wide, "Population"),
        lambda header: {"year": _header_year(header)},
    )
    return long if boundary_year is None else long.filter(F.col("year") != str(boundary_year))


def _segment_place(layout: str, county: Column, place: Column) -> Column:
    if layout == "latest":
        return trim_blank(place)
    level = to_number("Filter")
    # Only the oldest tables leave the county row's place empty.
    county_row = F.concat(county, F.lit(" County")) if layout == "1990s" else place
    named = (
        F.when(level == 1, county_row)
        .when(level.isin(2, 3), F.concat(place, F.lit(" "), county, F.lit(" County")))
        .when(level == 4, place)
    )
    if layout == "1990s":
        for old, new in _CITY_NAMES_1990S:
            named = replace_first(named, old, new)
    return trim_blank(named)


def vintage_union(*segments: DataFrame, keys: Sequence[str] = ("level", "place", "year")) -> DataFrame:
    """Stack cleaned vintages and sum again, which merges places split over counties."""
    return sum_by(union_trends(*segments), list(keys))


def clean_jurisdictions(jurisdictions: DataFrame) -> DataFrame:
    """Jurisdiction name and regional class, one row per pair."""
    return jurisdictions.select(
        recode_chain("juris_name", JURISDICTION_NAMES).alias("juris_name"),
        recode_chain("regional_geography", REGIONAL_CLASSES).alias("regional_geography"),
    ).distinct()


def with_region_levels(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the region's total, unincorporated and incorporated rows."""
    level = F.col("level")
    label = (
        F.when(level == 2, "Unincorporated Region").when(level == 3, "Incorporated Region").otherwise("Region")
    )
    return region_rollup(df, ["level", *keys], geography="place", members=level <= 3, label=label)


def geography_hierarchy(df: DataFrame, jurisdictions: DataFrame) -> DataFrame:
    """Type each place by its level code, class it, then strip the level from its name."""
    level, place = F.col("level"), F.col("place")
    kind = (
        F.when(level.isin(1, 2, 3) & place.contains("Region"), "Region")
        .when(level.isin(1, 2, 3) & place.contains("County"), "County")
        .when(level == 4, "City")
    )
    variable = (
        F.when(level == 1, "County")
        .when(level == 2, "Unincorporated")
        .when(level == 3, "Incorporated")
        .when(level == 4, F.col("regional_geography"))
    )
    name = place
    for text in ("Incorporated ", "Unincorporated ", " County"):
        name = remove_all(name, text)
    typed = lookup_join(df, jurisdictions, "place", "juris_name")
    return typed.select(
        *[c for c in df.columns if c not in ("level", "place")],
        name.alias("geography"),
        kind.alias("geography_type"),
        F.replace(variable, F.lit("County"), F.lit("Total")).alias("variable"),
    )


def _levels_and_changes(
    rows: DataFrame, jurisdictions: DataFrame, metric: Column, keys: Sequence[str] = ()
) -> DataFrame:
    """Annual rows of every year, change rows of every year but the first."""
    first_year = rows.agg(F.min("year")).scalar()
    places = with_region_levels(sum_by(rows, ["level", "place", "year", *keys]), ["year", *keys])
    series = level_and_change(
        places, ["level", "place", *keys], "year", {"estimate": "estimate"}, drop=None
    ).filter((F.col("grouping") == "Annual") | (F.col("year") > first_year))
    return conform(
        geography_hierarchy(series.withColumn("metric", metric), clean_jurisdictions(jurisdictions)),
        date=F.make_date(F.col("year").cast("int"), F.lit(4), F.lit(1)),
    )


def population_trends(
    segments: Sequence[DataFrame],
    jurisdictions: DataFrame,
    forecast: DataFrame,
    forecast_group: int = 7,
    forecast_after: int = 2010,
) -> DataFrame:
    """Population levels and changes by jurisdiction, and the region's forecast.

    ``segments`` come from ``population_segment``; ``forecast`` has pop_group_dim_id,
    data_year and population.
    """
    observed = _levels_and_changes(union_trends(*segments), jurisdictions, F.lit("Population"))
    future = forecast.filter(
        (F.col("pop_group_dim_id") == forecast_group) & (F.col("data_year") > forecast_after)
    )
    return union_trends(
        observed, conform(forecast_series(future, "data_year", "population", "Population"))
    )


def housing_long(wide: DataFrame, counties: Sequence[str] = HOME_COUNTIES) -> DataFrame:
    """Housing units by level, place, year and structure type; 1980 is not used."""

    def keys(header: str) -> dict:
        return {
            "year": _header_year(header),
            "unit_type": next((metric for text, metric in HOUSING_METRICS if text in header), None),
        }

    used = drop_containing(wide, "1980")
    return melt_headers(
        used.filter(F.col("County").isin(*counties)).withColumns(
            {
                "level": to_number("Filter"),
                "place": trim_blank(replace_first("Jurisdiction", " (part)", "")),
            }
        ),
        ["level", "place"],
        columns_containing(used, "Housing"),
        keys,
    )


def housing_trends(
    wide: DataFrame,
    jurisdictions: DataFrame,
    forecast: DataFrame,
    counties: Sequence[str] = HOME_COUNTIES,
) -> DataFrame:
    """Housing levels and changes by jurisdiction and type, and the region's forecast.

    ``forecast`` has Year and Forecast; its first year keeps its level.
    """
    observed = _levels_and_changes(
        housing_long(wide, counties), jurisdictions, F.col("unit_type"), ["unit_type"]
    )
    return union_trends(
        observed,
        conform(forecast_series(forecast, "Year", "Forecast", "Housing Units", drop_first=False)),
    )
