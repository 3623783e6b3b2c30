"""Vehicle registrations and title transactions.

Titles columns: transaction_month (M/d/yyyy text), new_or_used, transaction_type,
electrification_level, make, county, tract, transactions. Raw labels and date text are
summed first and cleaned afterwards, so cleaning runs on groups instead of title rows.

Plans that need several parts of the titles take them all from one sum: which titles count is
decided inside the aggregates over it, since a filter would sink below the sum and make it
another one for each part. Spark then reads the titles once and reuses the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from trendloom.functions.dates import parse_mdy
from trendloom.functions.nulls import na_sum_if, to_number
from trendloom.functions.text import recode_chain
from trendloom.operators.aggregate import region_rollup, sum_by
from trendloom.operators.periods import stamp_latest_month
from trendloom.operators.series import share_of_total, wide_shares
from trendloom.schema import conform, union_trends
from trendloom.session import stage
from trendloom.sources.lookups import ENGINE_LABELS, HOME_COUNTIES, REGISTRATION_COUNTS

ENGINES = ("Battery Electric Vehicle", "Hybrid Electric Vehicle", "Plug-in Hybrid Electric Vehicle")


def _county_or_region() -> Column:
    geography = F.col("geography")
    return F.when(geography == "Region", "Region").when(geography.isNotNull(), "County")


def _listed(values: str | Sequence[str]) -> list[str]:
    return [values] if isinstance(values, str) else list(values)


def registrations_by_fuel(
    registrations: DataFrame, state: str = "WA", counties: Sequence[str] = HOME_COUNTIES
) -> DataFrame:
    """Registered vehicles by powertrain, month and county, with the region's sum."""
    counts = [short for _, short, _ in REGISTRATION_COUNTS]
    by_county = sum_by(
        registrations.filter((F.col("state") == state) & F.col("county").isin(*counties)).select(
            F.to_date("date").alias("date"),
            F.col("county").alias("geography"),
            *[to_number(landed).alias(short) for landed, short, _ in REGISTRATION_COUNTS],
        ),
        ["date", "geography"],
        *counts,
    )
    labels = {short: label for _, short, label in REGISTRATION_COUNTS}
    long = wide_shares(
        region_rollup(by_county, ["date"], *counts), ["date", "geography"], labels, "total_vehicles"
    )
    return conform(
        long, geography_type=_county_or_region(), grouping="All", metric="total-vehicle-registrations"
    )


def title_cube(titles: DataFrame) -> DataFrame:
    """Titles summed to the columns the county and make plans read.

    It can stand in for the titles themselves there. ``stage`` it (or write it) to feed
    several plans from one scan of the source.
    """
    keys = [
        "transaction_month", "new_or_used", "transaction_type", "electrification_level", "make", "county",
    ]
    return sum_by(titles, keys, "transactions")


def title_transactions(
    titles: DataFrame,
    title_type: str = "Original Title",
    vehicle_type: str | Sequence[str] = "New",
) -> DataFrame:
    """Titles by powertrain, month and county, with the region's sum and shares.

    Several vehicle types share one pass; the type is a key.
    """
    wanted = titles.filter(_wanted(title_type, vehicle_type))
    raw = sum_by(
        wanted, ["transaction_month", "electrification_level", "county", "new_or_used"], "transactions"
    )
    return _county_trends(raw, F.lit(True))


def _wanted(title_type: str, vehicle_type: str | Sequence[str]) -> Column:
    return F.col("new_or_used").isin(*_listed(vehicle_type)) & (F.col("transaction_type") == title_type)


def _county_trends(sums: DataFrame, kept: Column) -> DataFrame:
    """County and region titles of the ``kept`` rows of summed titles."""
    by_county = _sums_of_kept(
        sums,
        kept,
        date=parse_mdy("transaction_month"),
        variable=recode_chain("electrification_level", ENGINE_LABELS),
        geography=F.col("county"),
        grouping=F.col("new_or_used"),
    )
    rolled = region_rollup(by_county, ["date", "variable", "grouping"])
    return conform(
        share_of_total(rolled, ["date", "geography", "grouping"]),
        geography_type=_county_or_region(),
        metric="vehicle-registrations",
    )


def _sums_of_kept(sums: DataFrame, kept: Column, **keys: Column) -> DataFrame:
    """``estimate`` by ``keys`` over the rows that are kept; keys without any do not appear."""
    return (
        sums.groupBy(*[c.alias(name) for name, c in keys.items()])
        .agg(na_sum_if(kept, "transactions").alias("estimate"), F.count_if(kept).alias("__kept"))
        .filter(F.col("__kept") > 0)
        .drop("__kept")
    )


def _newest_months(sums: DataFrame) -> DataFrame:
    """``year`` and its newest month over all titles that went into ``sums``.

    The count, which holds for every year, makes this part read the sums too, and so the same shuffle as the others.
    """
    date = parse_mdy("transaction_month")
    months = sums.groupBy(F.year(date).alias("year")).agg(F.max(F.month(date)).alias("max_month"), F.count("transactions").alias("__known"))
    return months.filter(F.col("__known") >= 0).drop("__known")


def _is_engine(engines: Sequence[str]) -> Column:
    """The raw label is one of the powertrains; an unlisted label passes the recoding unchanged, so no others can match."""
    return F.col("electrification_level").isin(*engines, *[raw for raw, plain in ENGINE_LABELS if plain in engines])


def titles_by_make(titles: DataFrame, engine_type: str | Sequence[str] = ENGINES[0]) -> DataFrame:
    """Titles of one or several powertrains by make and year, with each make's share."""
    engine = _is_engine(_listed(engine_type))
    named = titles.withColumn("make", F.when(engine, F.col("make")))
    return _make_trends(sum_by(named, ["transaction_month", "electrification_level", "make"], "transactions"), engine)


def _make_trends(sums: DataFrame, kept: Column) -> DataFrame:
    by_make = _sums_of_kept(
        sums,
        kept,
        year=F.year(parse_mdy("transaction_month")),
        variable=recode_chain("electrification_level", ENGINE_LABELS),
        grouping=F.col("make"),
    )
    dated = stamp_latest_month(share_of_total(by_make, ["year", "variable"]), _newest_months(sums))
    return conform(dated, geography="Region", geography_type="Region", metric="vehicle-manufacturers")


def titles_by_tract(
    titles: DataFrame, title_type: str = "Original Title", vehicle_type: str = "New"
) -> DataFrame:
    """Titles by powertrain, year and census tract, with shares within the tract."""
    # Titles that do not count only tell the months; they take one group a month and label.
    wanted = F.coalesce(_wanted(title_type, vehicle_type), F.lit(False))
    named = titles.select(
        "transaction_month", "electrification_level", "transactions",
        wanted.alias("wanted"), F.when(wanted, F.col("tract")).alias("tract"),
    )
    sums = sum_by(named, ["transaction_month", "electrification_level", "wanted", "tract"], "transactions")
    keys = {
        "year": F.year(parse_mdy("transaction_month")),
        "variable": recode_chain("electrification_level", ENGINE_LABELS),
        "geography": F.col("tract").cast("string"),
    }
    known = reduce(and_, [c.isNotNull() for c in keys.values()])
    by_tract = _sums_of_kept(sums, F.col("wanted") & known, **keys).dropna(subset=["estimate"])
    dated = stamp_latest_month(share_of_total(by_tract, ["year", "geography"]), _newest_months(sums))
    return conform(dated, geography_type="Tract", grouping=vehicle_type, metric="vehicle-registrations")


def vehicle_trends(registrations: DataFrame, titles: DataFrame, staged: bool = False) -> DataFrame:
    """Registrations, new and used titles, and makes of the electrified powertrains.

    The titles are read once, for sums whose shuffle all parts reuse. ``staged`` writes a cube of
    the titles to the shared folder first, so that losing an executor later does not repeat the scan.
    """
    if staged:
        titles = stage(title_cube(titles))
    return union_trends(registrations_by_fuel(registrations), title_trends(titles))


def title_trends(titles: DataFrame, title_type: str = "Original Title", engines: Sequence[str] = ENGINES) -> DataFrame:
    """New and used titles by county and region, and makes of the given powertrains, from one scan of the titles.

    A title counts once for its make and, if it is of the wanted type, once for its county, so the groups
    are as many as both have, not their product. (GROUPING SETS would do the same, but Spark does not
    recognise the shuffles of two copies of such a plan as equal.)
    """
    wanted = _wanted(title_type, ["New", "Used"])
    none = F.lit(None).cast("string")
    as_county = F.struct(F.lit("county").alias("level"), F.col("county").alias("name"), F.col("new_or_used").alias("kind"))
    as_make = F.struct(
        F.lit("make").alias("level"), F.when(_is_engine(engines), F.col("make")).alias("name"), none.alias("kind")
    )
    counted = titles.select(
        "transaction_month", "electrification_level", "transactions",
        F.inline(F.array_compact(F.array(as_make, F.when(wanted, as_county)))),
    )
    sums = sum_by(counted, ["transaction_month", "electrification_level", "level", "name", "kind"], "transactions")
    at = F.col("level")
    named = sums.withColumns({"county": F.col("name"), "make": F.col("name"), "new_or_used": F.col("kind")})
    return union_trends(
        _county_trends(named, at == "county"),
        _make_trends(named, (at == "make") & _is_engine(engines)),
    )
