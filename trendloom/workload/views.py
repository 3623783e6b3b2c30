"""Domain inputs derived from the retail tables.

Each view is one SQL text that Spark runs over DataFrames and the SQL check runs over its
own tables, so both sides start from the same whole input. ``{name}`` stands for a table
or for another view. Wide inputs are pivoted from a long view on the Spark side only.
"""

from __future__ import annotations

import datetime as dt
import functools
import string

from pyspark.sql import DataFrame, SparkSession, functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

#: The years that the SQL checks list; wide inputs hold these and all between them and the tables' own.
FIRST_YEAR, LAST_YEAR = 1995, 2001
YEARS = range(FIRST_YEAR, LAST_YEAR + 1)

VIEWS = {
    # Title transactions: one per line item.
    "titles": """
        SELECT CAST(month(l_shipdate) AS STRING) || '/1/' || CAST(year(l_shipdate) AS STRING) AS transaction_month,
               CASE l_linestatus WHEN 'O' THEN 'New' ELSE 'Used' END AS new_or_used,
               CASE l_returnflag WHEN 'N' THEN 'Transfer Title' ELSE 'Original Title' END AS transaction_type,
               CASE p_type WHEN 'ECONOMY' THEN 'BEV (Battery Electric Vehicle)'
                           WHEN 'STANDARD' THEN 'HEV (Hybrid Electric Vehicle) - Level Unknown'
                           WHEN 'LARGE' THEN 'ICE (Internal Combustion Engine)'
                           WHEN 'SMALL' THEN 'Mild HEV (Hybrid Electric Vehicle)'
                           WHEN 'MEDIUM' THEN 'Strong HEV (Hybrid Electric Vehicle)'
                           WHEN 'PROMO' THEN 'PHEV (Plug-in Hybrid Electric Vehicle)'
                           ELSE p_type END AS electrification_level,
               p_brand AS make,
               n_name AS county,
               CASE WHEN l_discount = 0 THEN NULL ELSE CAST(53033000000 + s_suppkey AS STRING) END AS tract,
               l_quantity AS transactions
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
             JOIN {supplier} ON l_suppkey = s_suppkey
             JOIN {nation} ON s_nationkey = n_nationkey
    """,
    # Registration counts per month and county, as the feed's numeric text.
    "registrations": """
        SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS date,
               CASE WHEN o_orderstatus = 'P' AND r_regionkey = 4 THEN 'OR' ELSE 'WA' END AS state,
               CASE r_regionkey WHEN 0 THEN 'King' WHEN 1 THEN 'Kitsap' WHEN 2 THEN 'Pierce'
                                WHEN 3 THEN 'Snohomish' ELSE 'Clark' END AS county,
               CASE WHEN o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END AS battery_electric_vehicles_bevs_,
               CASE WHEN o_orderpriority = '2-HIGH' THEN '1' ELSE '0' END AS plug_in_hybrid_electric_vehicles_phevs_,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '1' ELSE '0' END AS electric_vehicle_ev_total,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '0' ELSE '1' END AS non_electric_vehicles,
               '1' AS total_vehicles
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey
             JOIN {region} ON n_regionkey = r_regionkey
    """,
    # Transit service per operator, mode, type of service, month and metric.
    "transit_long": """
        SELECT agency_id, agency, mode, tos, date, metric, sum(v) AS estimate
        FROM (
            SELECT agency_id, agency, mode, tos, date, 'UPT' AS metric, upt AS v FROM {transit_service}
            UNION ALL
            SELECT agency_id, agency, mode, tos, date, 'VRM' AS metric, vrm AS v FROM {transit_service}
            UNION ALL
            SELECT agency_id, agency, mode, tos, date, 'VRH' AS metric, vrh AS v FROM {transit_service}
        ) t
        GROUP BY agency_id, agency, mode, tos, date, metric
    """,
    "transit_service": """
        SELECT CAST(n_nationkey AS STRING) AS agency_id, n_name AS agency,
               CASE p_type WHEN 'ECONOMY' THEN 'DR' WHEN 'MEDIUM' THEN 'MB' WHEN 'PROMO' THEN 'LR'
                           WHEN 'LARGE' THEN 'CR' WHEN 'SMALL' THEN 'FB' ELSE 'ZZ' END AS mode,
               CASE l_returnflag WHEN 'A' THEN 'DO' WHEN 'N' THEN 'PT' ELSE 'QQ' END AS tos,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
               l_quantity AS upt, CAST(l_linenumber AS DOUBLE) AS vrm,
               CASE WHEN l_discount < 0.05 THEN 1.0 ELSE 0.0 END AS vrh
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
             JOIN {supplier} ON l_suppkey = s_suppkey
             JOIN {nation} ON s_nationkey = n_nationkey
    """,
    # Every operator serves its region's metro area and one that covers all of them;
    # the operators of one region are not followed.
    "agencies": """
        SELECT CAST(n_nationkey AS STRING) AS NTDID, r_name AS MPO_AREA, n_name AS AGENCY_NAME
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name <> 'EUROPE'
        UNION ALL
        SELECT CAST(n_nationkey AS STRING) AS NTDID, 'WORLD' AS MPO_AREA, n_name AS AGENCY_NAME
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE r_name <> 'EUROPE'
    """,
    # Census cells: 50 lines for each of eight tables.
    "acs_cells": """
        SELECT CASE p_type WHEN 'ECONOMY' THEN CASE l_linestatus WHEN 'O' THEN 'B08301' ELSE 'B08303' END
                           WHEN 'MEDIUM' THEN CASE l_linestatus WHEN 'O' THEN 'B08011' ELSE 'B03002' END
                           WHEN 'PROMO' THEN 'B25003' WHEN 'LARGE' THEN 'B15002'
                           WHEN 'SMALL' THEN 'B01001' ELSE 'B19001' END
               || '_' || lpad(CAST(p_size AS STRING), 3, '0') AS variable,
               n_nationkey, n_regionkey, n_name, r_name, year(l_shipdate) AS year,
               CASE WHEN l_discount = 0 THEN 0.0 ELSE l_quantity END AS estimate,
               round(l_tax * 100) AS moe
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
             JOIN {supplier} ON l_suppkey = s_suppkey
             JOIN {nation} ON s_nationkey = n_nationkey
             JOIN {region} ON n_regionkey = r_regionkey
    """,
    "acs_estimates": """
        SELECT n_name AS name, variable, sum(estimate) AS estimate, max(moe) AS moe,
               CASE WHEN n_regionkey = 0 THEN 'County' WHEN n_regionkey = 1 THEN 'CDP' ELSE 'City' END
                   AS census_geography, year
        FROM {acs_cells} GROUP BY n_name, n_regionkey, variable, year
    """,
    "acs_metro": """
        SELECT lpad(CAST(n_regionkey AS STRING), 2, '0') || lpad(CAST(n_nationkey AS STRING), 3, '0') AS GEOID,
               variable, sum(estimate) AS estimate, max(moe) AS moe, year
        FROM {acs_cells} GROUP BY n_regionkey, n_nationkey, variable, year
    """,
    # One listed county, 999, has no data.
    "acs_counties": """
        SELECT r_name AS MPO_AREA, CAST(r_regionkey AS STRING) AS STATE_FIPS,
               CAST(n_nationkey AS STRING) AS COUNTY_FIPS
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
        UNION ALL
        SELECT r_name AS MPO_AREA, CAST(r_regionkey AS STRING) AS STATE_FIPS, '999' AS COUNTY_FIPS
        FROM {region} WHERE r_name = 'ASIA'
    """,
    # Places at the four level codes; urgent orders fall in the part of a city.
    "place_orders": """
        SELECT year(o_orderdate) AS year,
               CASE r_regionkey WHEN 0 THEN 'King' WHEN 1 THEN 'Kitsap' WHEN 2 THEN 'Pierce'
                                WHEN 3 THEN 'Snohomish' ELSE 'Clark' END AS county,
               n_name AS city, o_orderstatus AS status, o_orderpriority AS priority
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey
             JOIN {region} ON n_regionkey = r_regionkey
    """,
    "place_levels": """
        SELECT 1 AS level, county, CAST('' AS STRING) AS place, year, priority FROM {place_orders}
        UNION ALL
        SELECT 2 AS level, county, 'Unincorporated' AS place, year, priority FROM {place_orders} WHERE status = 'P'
        UNION ALL
        SELECT 3 AS level, county, 'Incorporated' AS place, year, priority FROM {place_orders} WHERE status <> 'P'
        UNION ALL
        SELECT 4 AS level, county, CASE priority WHEN '1-URGENT' THEN city || ' (part)' ELSE city END AS place,
               year, priority FROM {place_orders} WHERE status <> 'P'
    """,
    "jurisdictions": """
        SELECT n_name AS juris_name,
               CASE n_nationkey WHEN 0 THEN 'Metro' WHEN 1 THEN 'Core' WHEN 2 THEN 'HCT' ELSE 'CitiesTowns' END
                   AS regional_geography,
               CASE WHEN s_acctbal < 0 THEN 1 ELSE 0 END AS airport_affected
        FROM {nation} JOIN {supplier} ON s_nationkey = n_nationkey WHERE n_regionkey <> 3
    """,
    # Forecast facts by group and year.
    "forecast_facts": """
        SELECT l_linenumber AS group_id, year(l_shipdate) AS data_year, sum(l_quantity) AS amount
        FROM {lineitem} GROUP BY l_linenumber, year(l_shipdate)
    """,
    # Parcel facts with vintages; parcels of one type have no dimension row.
    "parcel_facts": """
        SELECT l_partkey AS parcel_dim_id, year(l_shipdate) AS estimate_year, l_quantity + 0.5 AS total_pop,
               CAST(l_linenumber AS DOUBLE) AS housing_units, l_linenumber AS ofm_vintage
        FROM {lineitem}
    """,
    "parcel_dims": """
        SELECT p_partkey AS parcel_dim_id, p_partkey AS parcel_id, p_size AS base_year,
               CASE WHEN p_size > 30 THEN 'not in station area' ELSE 'in station area' END
                   AS hct_station_area_vision_2050
        FROM {part} WHERE p_type <> 'PROMO'
    """,
    "station_jobs": """
        SELECT year(o_orderdate) AS data_year, 'Inside HCT Area' AS geo,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS total_emp
        FROM {orders} GROUP BY year(o_orderdate)
        UNION ALL
        SELECT year(o_orderdate) AS data_year, 'Outside HCT Area' AS geo,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS DOUBLE) AS total_emp
        FROM {orders} GROUP BY year(o_orderdate)
        UNION ALL
        SELECT year(o_orderdate) AS data_year, 'Region' AS geo, CAST(count(*) AS DOUBLE) AS total_emp
        FROM {orders} GROUP BY year(o_orderdate)
    """,
    # Monthly jobs: listed industries, and the private subtotal that also holds PROMO.
    "job_rows": """
        SELECT CASE n_regionkey WHEN 0 THEN 'Washington State' WHEN 1 THEN 'Seattle MSA'
                                WHEN 2 THEN 'Tacoma MSA' ELSE 'Bremerton MSA' END AS area,
               p_type, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_quantity AS jobs
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
             JOIN {supplier} ON l_suppkey = s_suppkey
             JOIN {nation} ON s_nationkey = n_nationkey
    """,
    "jobs_by_industry": """
        SELECT area, industry, date, sum(jobs) AS estimate
        FROM (
            SELECT area, date, jobs,
                   CASE p_type WHEN 'ECONOMY' THEN ' Information' WHEN 'MEDIUM' THEN 'Financial Activities '
                               WHEN 'LARGE' THEN 'Leisure and Hospitality' WHEN 'SMALL' THEN 'Government'
                               WHEN 'STANDARD' THEN 'Mining, Logging, and Construction' END AS industry
            FROM {job_rows} WHERE p_type <> 'PROMO'
            UNION ALL
            SELECT area, date, jobs, 'Private Service Providing' AS industry
            FROM {job_rows} WHERE p_type IN ('ECONOMY', 'MEDIUM', 'LARGE', 'PROMO')
        ) t
        GROUP BY area, industry, date
    """,
    # Airport rows: one per published category and month; one category is not used.
    "airport_rows": """
        SELECT variable, estimate,
               lpad(CAST(month(date) AS STRING), 2, '0') || CAST(year(date) AS STRING) AS month_key
        FROM (
            SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Subtotal - Domestic Passengers'
                        WHEN '2-HIGH' THEN 'Subtotal - International Passengers'
                        WHEN '3-MEDIUM' THEN 'Subtotal - Domestic Air Freight'
                        WHEN '4-NOT SPECIFIED' THEN 'Subtotal - International Air Freight'
                        ELSE 'Other Operations' END AS variable,
                   CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
                   CAST(count(*) AS DOUBLE) AS estimate
            FROM {orders} GROUP BY 1, 2
            UNION ALL
            SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PASSENGER GRAND TOTAL'
                        ELSE 'CARGO GRAND TOTAL' END AS variable,
                   CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
                   CAST(count(*) AS DOUBLE) AS estimate
            FROM {orders} WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2
        ) t
    """,
    "airport_national": """
        SELECT n_name AS geography, sum(l_quantity) * 500 AS estimate, CAST(year(l_shipdate) AS STRING) AS file_key
        FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey JOIN {nation} ON s_nationkey = n_nationkey
        GROUP BY n_name, year(l_shipdate)
    """,
}


def tables_in(text: str) -> list[str]:
    """Names a text refers to, in order of first use."""
    return list(dict.fromkeys(name for _, name, _, _ in string.Formatter().parse(text) if name))


@functools.lru_cache(maxsize=256)
def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; the footers behind its schema are read once per session."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


@functools.lru_cache(maxsize=256)
def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table or view as a DataFrame."""
    if name in TABLES:
        return table(spark, folder, name)
    if name in ONE_SCAN:
        return ONE_SCAN[name](spark, folder)
    return query(spark, folder, VIEWS[name])


@functools.lru_cache(maxsize=256)
def years(spark: SparkSession, folder: str, name: str) -> range:
    """The years of ``lineitem`` or ``orders``, from the first to the last in the data and those of ``YEARS``; one row comes to the driver."""
    year = F.year({"lineitem": "l_shipdate", "orders": "o_orderdate"}[name])
    first, last = table(spark, folder, name).agg(F.min(year), F.max(year)).first()
    return YEARS if first is None else range(min(first, FIRST_YEAR), max(last, LAST_YEAR) + 1)


def months(spark: SparkSession, folder: str, name: str) -> list[dt.date]:
    return [dt.date(y, m, 1) for y in years(spark, folder, name) for m in range(1, 13)]


def query(spark: SparkSession, folder: str, text: str) -> DataFrame:
    return spark.sql(text, **{n: view(spark, folder, n) for n in tables_in(text)})


def _place_levels(spark: SparkSession, folder: str) -> DataFrame:
    orders = view(spark, folder, "place_orders")
    unincorporated, city = F.col("status") == "P", F.col("city")
    part = F.when(F.col("priority") == "1-URGENT", F.concat(city, F.lit(" (part)"))).otherwise(city)

    def row(level: int, place, applies=None):
        made = F.struct(F.lit(level).alias("level"), place.alias("place"))
        return made if applies is None else F.when(applies, made)

    rows = F.array(
        row(1, F.lit("")),
        row(2, F.lit("Unincorporated"), unincorporated),
        row(3, F.lit("Incorporated"), ~unincorporated),
        row(4, part, ~unincorporated),
    )
    return (
        orders.select("county", "year", "priority", F.explode(rows).alias("at"))
        .filter(F.col("at").isNotNull())
        .select("at.level", "county", "at.place", "year", "priority")
    )


def _jobs_by_industry(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("p_type")
    names = {
        "ECONOMY": " Information", "MEDIUM": "Financial Activities ", "LARGE": "Leisure and Hospitality",
        "SMALL": "Government", "STANDARD": "Mining, Logging, and Construction",
    }
    listed = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), kind)
    private = F.when(kind.isin("ECONOMY", "MEDIUM", "LARGE", "PROMO"), F.lit("Private Service Providing"))
    return (
        view(spark, folder, "job_rows")
        .groupBy("area", "p_type", "date")
        .agg(F.sum("jobs").alias("jobs"))
        .select("area", "date", "jobs", F.explode(F.array_compact(F.array(listed, private))).alias("industry"))
        .groupBy("area", "industry", "date")
        .agg(F.sum("jobs").alias("estimate"))
    )


# Views whose SQL stacks several scans of one table, built from a single scan instead.
ONE_SCAN = {"place_levels": _place_levels, "jobs_by_industry": _jobs_by_industry}


def with_views(text: str) -> str:
    """A check query with the views it needs as common table expressions in front."""
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in needed:
            for inner in tables_in(VIEWS[name]):
                visit(inner)
            needed.append(name)

    for name in tables_in(text):
        visit(name)
    plain = {n: n for n in (*TABLES, *VIEWS)}
    body = text.format(**plain)
    if not needed:
        return body
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in needed)
    lead = body.lstrip()
    if lead[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{lead[5:]}"
    return f"WITH {ctes}\n{body}"


def transit_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Transit service with one column per month, named ``M/yyyy``."""
    ids = ["agency_id", "agency", "mode", "tos"]
    metrics = {"UPT": "upt", "VRM": "vrm", "VRH": "vrh"}
    service = view(spark, folder, "transit_service").groupBy(*ids, "date").agg(
        *[F.sum(c).alias(c) for c in metrics.values()]
    )
    cells = [F.struct(F.lit(m).alias("metric"), F.col(c).alias("v")) for m, c in metrics.items()]
    long = service.select(*ids, "date", F.inline(F.array(*cells)))
    listed = months(spark, folder, "lineitem")
    wide = long.groupBy(*ids, "metric").pivot("date", listed).agg(F.sum("v"))
    return wide.withColumnsRenamed({str(m): f"{m.month}/{m.year}" for m in listed})


def jobs_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly jobs with one column per month, named by its day serial."""
    long = view(spark, folder, "jobs_by_industry")
    listed = months(spark, folder, "lineitem")
    wide = long.groupBy("area", F.col("industry").alias("NAICS INDUSTRY")).pivot("date", listed).agg(F.sum("estimate"))
    epoch = dt.date(1899, 12, 30)
    return wide.withColumn("NAICS CELL", F.lit(None).cast("string")).withColumnsRenamed(
        {str(m): str((m - epoch).days) for m in listed}
    )


def population_wide(spark: SparkSession, folder: str, layout: str, first: int, last: int) -> DataFrame:
    """One vintage of the population table in its publisher's layout."""
    places = view(spark, folder, "place_levels").filter(F.col("year").between(first, last))
    county, place = F.col("county"), F.col("place")
    if layout == "latest":
        named = F.when(F.col("level") == 1, F.concat(county, F.lit(" County"))).when(
            F.col("level").isin(2, 3), F.concat(place, F.lit(" "), county, F.lit(" County"))
        ).otherwise(place)
        ids = {"County": county, "Jurisdiction": named}
        header = "{}.Population.Estimate"
    else:
        if layout == "intercensal":
            place = F.when(F.col("level") == 1, F.concat(county, F.lit(" County"))).otherwise(place)
        ids = {"County.Name": county, "City.Name": place}
        header = "{}.Total.Population" if layout == "1990s" else "{}.Intercensal.Total.Population"
    years = list(range(first, last + 1))
    wide = (
        places.select(F.col("level").cast("string").alias("Filter"), "year", *[c.alias(n) for n, c in ids.items()])
        .groupBy("Filter", *[f"`{n}`" for n in ids])
        .pivot("year", years)
        .agg(F.count(F.lit(1)))
    )
    return wide.withColumnsRenamed({str(y): header.format(y) for y in years})


def housing_wide(spark: SparkSession, folder: str) -> DataFrame:
    """Housing units by year and structure type in the publisher's layout."""
    kinds = {
        "Total.Housing.Units": F.lit(True),
        "One.Unit.Housing.Units": F.col("priority") == "1-URGENT",
        "Two.or.More.Unit.Housing.Units": F.col("priority").isin("2-HIGH", "3-MEDIUM"),
        "Mobile.Home.Housing.Units": F.col("priority").isin("4-NOT SPECIFIED", "5-LOW"),
    }
    county, place, level = F.col("county"), F.col("place"), F.col("level")
    named = F.when(level == 1, F.concat(county, F.lit(" County"))).when(
        level.isin(2, 3), F.concat(place, F.lit(" "), county, F.lit(" County"))
    ).otherwise(place)
    cells = [
        F.count_if((F.col("year") == y) & kind).alias(f"{y}.Postcensal.Estimate.of.{name}")
        for y in years(spark, folder, "orders")
        for name, kind in kinds.items()
    ]
    return (
        view(spark, folder, "place_levels")
        .groupBy(level.cast("string").alias("Filter"), county.alias("County"), named.alias("Jurisdiction"))
        .agg(*cells)
        .withColumns({"Line": F.lit("0"), "1980.Census.Total.Housing.Units": F.lit(0)})
    )
