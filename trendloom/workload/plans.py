"""One query per published indicator, each with the SQL that checks it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from trendloom.plans import airport, census, jobs, near_transit, population, transit, vehicles
from trendloom.schema import union_trends
from trendloom.session import stage
from trendloom.sources import buckets
from trendloom.sources.lookups import ACS_TOPICS, ENGINE_LABELS, REGISTRATION_COUNTS, TRANSIT_MODES
from trendloom.workload import views
from trendloom.workload.operators import HIERARCHY_CHECK, HIERARCHY_COLUMNS
from trendloom.workload.views import FIRST_YEAR, LAST_YEAR, view

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def registered(check: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        CHECKS[fn.__name__] = check
        return fn

    return add


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join("'" + str(c).replace("'", "''") + "'" for c in r) + ")" for r in rows)


def trend(select: str, **columns: str) -> str:
    """A SELECT of the trend columns over the relation in ``select``."""
    fields = {
        "year": "CAST(year(date) AS STRING)",
        "date": "date",
        "geography": "geography",
        "geography_type": "geography_type",
        "variable": "variable",
        "grouping": "grouping",
        "metric": "metric",
        "estimate": "estimate",
        "share": "CAST(NULL AS DOUBLE)",
        "moe": "CAST(NULL AS DOUBLE)",
    } | columns
    return "SELECT " + ", ".join(f"{v} AS {k}" for k, v in fields.items()) + f" FROM ({select}) x"


# --- vehicles -----------------------------------------------------------------------

_DATED_TITLES = f"""
    SELECT t.*, CAST(strptime(transaction_month, '%m/%d/%Y') AS DATE) AS date, engine
    FROM {{titles}} t LEFT JOIN ({_values(ENGINE_LABELS)}) e(raw, engine) ON electrification_level = raw
"""
_TITLE_SHARES = """
    SELECT *, estimate / NULLIF(sum(estimate) OVER (PARTITION BY {keys}), 0) AS s FROM ({rows}) r
"""
_COUNTY_TITLES = f"""
    SELECT date, engine AS variable, county AS geography, 'County' AS geography_type, new_or_used AS grouping,
           sum(transactions) AS estimate
    FROM ({_DATED_TITLES}) d WHERE transaction_type = 'Original Title' AND new_or_used IN (%s)
    GROUP BY date, engine, county, new_or_used
    UNION ALL
    SELECT date, engine, 'Region', 'Region', new_or_used, sum(transactions)
    FROM ({_DATED_TITLES}) d WHERE transaction_type = 'Original Title' AND new_or_used IN (%s)
    GROUP BY date, engine, new_or_used
"""


def _title_transactions(kinds: str) -> str:
    rows = _COUNTY_TITLES.replace("%s", kinds)
    shared = _TITLE_SHARES.replace("{keys}", "date, geography, grouping").replace("{rows}", rows)
    return trend(shared, share="s", metric="'vehicle-registrations'")


def _titles_by_make(engines: str) -> str:
    rows = f"""
        SELECT make_date(y, mm, 1) AS date, engine AS variable, make AS grouping, estimate FROM (
            SELECT year(date) AS y, engine, make, sum(transactions) AS estimate
            FROM ({_DATED_TITLES}) d WHERE engine IN ({engines}) GROUP BY 1, 2, 3
        ) g JOIN (SELECT year(date) AS my, max(month(date)) AS mm FROM ({_DATED_TITLES}) d GROUP BY 1) m ON y = my
    """
    shared = _TITLE_SHARES.replace("{keys}", "date, variable").replace("{rows}", rows)
    return trend(
        shared, share="s", geography="'Region'", geography_type="'Region'", metric="'vehicle-manufacturers'"
    )


_TRACT_TITLES = f"""
    SELECT make_date(y, mm, 1) AS date, engine AS variable, tract AS geography, 'New' AS grouping, estimate FROM (
        SELECT year(date) AS y, engine, tract, sum(transactions) AS estimate
        FROM ({_DATED_TITLES}) d
        WHERE transaction_type = 'Original Title' AND new_or_used = 'New' AND tract IS NOT NULL GROUP BY 1, 2, 3
    ) g JOIN (SELECT year(date) AS my, max(month(date)) AS mm FROM ({_DATED_TITLES}) d GROUP BY 1) m ON y = my
"""
_HOME = "'King', 'Kitsap', 'Pierce', 'Snohomish'"
_FUEL_SUMS = ", ".join(f"sum(CAST({c} AS DOUBLE)) AS {n}" for c, n, _ in REGISTRATION_COUNTS)
_FUEL_ROWS = f"""
    fuel_rows AS (
        SELECT CAST(date AS DATE) AS date, county AS geography, {_FUEL_SUMS}
        FROM {{registrations}} WHERE state = 'WA' AND county IN ({_HOME}) GROUP BY 1, 2
        UNION ALL
        SELECT CAST(date AS DATE), 'Region', {_FUEL_SUMS}
        FROM {{registrations}} WHERE state = 'WA' AND county IN ({_HOME}) GROUP BY 1, 2
    )
"""
_FUEL = " UNION ALL ".join(
    f"SELECT date, geography, '{label}' AS variable, {n} AS estimate, "
    + ("1.0" if n == "total_vehicles" else f"{n} / NULLIF(total_vehicles, 0)")
    + " AS s FROM fuel_rows"
    for _, n, label in REGISTRATION_COUNTS
)
_REGISTRATIONS = trend(
    f"WITH {_FUEL_ROWS} {_FUEL}",
    share="s",
    geography_type="CASE geography WHEN 'Region' THEN 'Region' ELSE 'County' END",
    grouping="'All'",
    metric="'total-vehicle-registrations'",
)
_ENGINES = ", ".join(f"'{e}'" for e in vehicles.ENGINES)


@registered(_REGISTRATIONS)
def registrations_by_fuel(spark, sf):
    return vehicles.registrations_by_fuel(view(spark, sf, "registrations"))


@registered(_title_transactions("'New'"))
def title_transactions(spark, sf):
    return vehicles.title_transactions(view(spark, sf, "titles"))


@registered(_title_transactions("'Used'"))
def title_transactions_used(spark, sf):
    return vehicles.title_transactions(view(spark, sf, "titles"), vehicle_type="Used")


@registered(_titles_by_make("'Battery Electric Vehicle'"))
def titles_by_make(spark, sf):
    return vehicles.titles_by_make(view(spark, sf, "titles"))


@registered(trend(
    _TITLE_SHARES.replace("{keys}", "date, geography").replace("{rows}", _TRACT_TITLES),
    share="s", geography_type="'Tract'", metric="'vehicle-registrations'",
))
def titles_by_tract(spark, sf):
    return vehicles.titles_by_tract(view(spark, sf, "titles"))


_VEHICLES = f"""
    {_REGISTRATIONS} UNION ALL {_title_transactions("'New', 'Used'")} UNION ALL {_titles_by_make(_ENGINES)}
"""


@registered(_VEHICLES)
def vehicle_trends(spark, sf):
    return vehicles.vehicle_trends(view(spark, sf, "registrations"), view(spark, sf, "titles"))


@registered(_VEHICLES)
def vehicle_trends_staged(spark, sf):
    """All vehicle indicators from one staged scan of the titles."""
    return vehicles.vehicle_trends(view(spark, sf, "registrations"), view(spark, sf, "titles"), staged=True)


@registered(_title_transactions("'New', 'Used'") + " UNION ALL " + _titles_by_make(_ENGINES))
def titles_from_staged_cube(spark, sf):
    """County and make plans fed from one staged scan of the titles."""
    cube = stage(vehicles.title_cube(view(spark, sf, "titles")))
    return union_trends(
        vehicles.title_transactions(cube, vehicle_type=["New", "Used"]),
        vehicles.titles_by_make(cube, vehicles.ENGINES),
    )


# --- transit ------------------------------------------------------------------------

_TRANSIT = trend(f"""
    WITH modes(code, name) AS ({_values(TRANSIT_MODES.items())}),
    t AS (
        SELECT l.agency_id, l.date, m.name AS variable, a.MPO_AREA AS area, a.AGENCY_NAME AS operator, l.metric,
               sum(l.estimate) AS estimate
        FROM {{transit_long}} l
        LEFT JOIN modes m ON m.code = CASE WHEN mode = 'DR' AND tos IN ('DO', 'PT', 'TN', 'TX') THEN mode || '-' || tos ELSE mode END
        JOIN {{agencies}} a ON a.NTDID = l.agency_id
        GROUP BY 1, 2, 3, 4, 5, 6
    ),
    c AS (SELECT metric, max(date) AS newest FROM t GROUP BY metric),
    p AS (
        SELECT t.metric, 'Annual' AS grouping, make_date(year(date), 12, 1) AS date, variable, area, operator, estimate
        FROM t JOIN c ON t.metric = c.metric
        WHERE year(date) <= CASE month(newest) WHEN 12 THEN year(newest) ELSE year(newest) - 1 END
        UNION ALL
        SELECT t.metric, 'YTD', make_date(year(date), month(newest), 1), variable, area, operator, estimate
        FROM t JOIN c ON t.metric = c.metric WHERE month(date) <= month(newest)
    ),
    u AS (
        SELECT metric, grouping, date, area AS geography, 'Metro Areas' AS geography_type, 'All Transit Modes' AS variable, sum(estimate) AS estimate
        FROM p GROUP BY metric, grouping, date, area
        UNION ALL
        SELECT metric, grouping, date, 'Region', 'Region', variable, sum(estimate) FROM p WHERE area = 'ASIA' AND variable IS NOT NULL GROUP BY metric, grouping, date, variable
        UNION ALL
        SELECT metric, grouping, date, 'Region', 'Region', 'All Transit Modes', sum(estimate) FROM p WHERE area = 'ASIA' GROUP BY metric, grouping, date
        UNION ALL
        SELECT metric, grouping, date, operator, 'Transit Operator', variable, sum(estimate) FROM p WHERE area = 'ASIA' AND variable IS NOT NULL GROUP BY metric, grouping, date, operator, variable
        UNION ALL
        SELECT metric, grouping, date, operator, 'Transit Operator', 'All Transit Modes', sum(estimate) FROM p WHERE area = 'ASIA' GROUP BY metric, grouping, date, operator
    ),
    w AS (
        SELECT date, geography, geography_type, variable, grouping,
               max(CASE metric WHEN 'UPT' THEN estimate END) AS upt, max(CASE metric WHEN 'VRM' THEN estimate END) AS vrm,
               max(CASE metric WHEN 'VRH' THEN estimate END) AS vrh
        FROM u GROUP BY date, geography, geography_type, variable, grouping
    )
    SELECT *, 'Boardings' AS metric, upt AS estimate FROM w WHERE upt > 0
    UNION ALL SELECT *, 'Revenue-Miles', vrm FROM w WHERE vrm > 0
    UNION ALL SELECT *, 'Revenue-Hours', vrh FROM w WHERE vrh > 0
    UNION ALL SELECT *, 'Boardings-per-Hour', round_even(upt / NULLIF(vrh, 0), 2) FROM w WHERE vrh > 0 AND upt > 0
""")


@registered(_TRANSIT)
def transit_trends(spark, sf):
    return transit.transit_trends(views.transit_wide(spark, sf), view(spark, sf, "agencies"), home_area="ASIA")


# --- census -------------------------------------------------------------------------

_ACS_YEARS = tuple(views.YEARS)


def _acs(topics) -> str:
    codes = [(topic, code, label) for topic, labels in ACS_TOPICS.items() if topic in topics for code, label in labels]
    years = ", ".join(map(str, _ACS_YEARS))
    return trend(f"""
        WITH codes(topic, code, label) AS ({_values(codes)}),
        cells AS (
            SELECT topic, year, census_geography AS kind, name, label, estimate, moe
            FROM {{acs_estimates}} JOIN codes ON variable = code WHERE year IN ({years}) AND census_geography IN ('County', 'City')
            UNION ALL
            SELECT topic, y.year, 'Metro Areas', MPO_AREA, label, estimate, moe
            FROM {{acs_counties}} c
            CROSS JOIN ({_values((y,) for y in _ACS_YEARS)}) yy(ytext) CROSS JOIN LATERAL (SELECT CAST(ytext AS BIGINT) AS year) y
            CROSS JOIN (SELECT DISTINCT topic FROM codes) tp(t)
            LEFT JOIN (SELECT GEOID, year AS my, topic, label, estimate, moe FROM {{acs_metro}} JOIN codes ON variable = code) m
                ON m.GEOID = lpad(STATE_FIPS, 2, '0') || lpad(COUNTY_FIPS, 3, '0') AND m.my = y.year AND m.topic = tp.t
            WHERE m.GEOID IS NOT NULL
            UNION ALL
            SELECT tp.t, CAST(ytext AS BIGINT), 'Metro Areas', MPO_AREA, NULL, NULL, NULL
            FROM {{acs_counties}} c CROSS JOIN ({_values((y,) for y in _ACS_YEARS)}) yy(ytext) CROSS JOIN (SELECT DISTINCT topic FROM codes) tp(t)
            WHERE NOT EXISTS (SELECT 1 FROM {{acs_metro}} m JOIN codes k ON m.variable = k.code
                              WHERE m.GEOID = lpad(STATE_FIPS, 2, '0') || lpad(COUNTY_FIPS, 3, '0')
                                AND m.year = CAST(ytext AS BIGINT) AND k.topic = tp.t)
        ),
        g AS (
            SELECT topic, year, kind, name, label, CASE WHEN count(estimate) = count(*) THEN sum(estimate) END AS estimate,
                   CASE WHEN count(moe) = count(*) THEN CASE WHEN sum(estimate) = 0 THEN max(moe) ELSE sqrt(sum(moe * moe)) END END AS m
            FROM cells GROUP BY topic, year, kind, name, label
        )
        SELECT make_date(year, 12, 1) AS date, name AS geography, kind AS geography_type, label AS variable, 'All' AS grouping,
               topic AS metric, estimate, m,
               estimate / NULLIF(max(CASE label WHEN 'Total' THEN estimate END) OVER (PARTITION BY topic, year, kind, name), 0) AS s
        FROM g
    """, share="s", moe="m")


def _acs_inputs(spark, sf):
    return [view(spark, sf, n) for n in ("acs_estimates", "acs_metro", "acs_counties")]


@registered(_acs(["commute-modes"]))
def acs_indicator(spark, sf):
    return census.acs_indicator(*_acs_inputs(spark, sf), views.years(spark, sf, "lineitem"))


@registered(_acs(list(ACS_TOPICS)))
def acs_trends(spark, sf):
    return census.acs_trends(*_acs_inputs(spark, sf), views.years(spark, sf, "lineitem"))


# --- population and housing ---------------------------------------------------------


def _observed(places: str, metric: str, more: str = "") -> str:
    keys = f", {more}" if more else ""
    return f"""
        WITH p0 AS ({places}),
        p AS (SELECT level, year, place{keys}, CASE WHEN count(estimate) = count(*) THEN sum(estimate) END AS estimate FROM p0 GROUP BY level, year, place{keys}),
        {HIERARCHY_CHECK.replace('level, year', f'level, year{keys}')},
        c AS (
            SELECT *, estimate - lag(estimate) OVER (PARTITION BY level, place{keys} ORDER BY year) AS d FROM r
        )
        SELECT make_date(year, 4, 1) AS date, 'Annual' AS grouping, {metric} AS metric, estimate, {HIERARCHY_COLUMNS}
        FROM c LEFT JOIN j ON place = juris_name
        UNION ALL
        SELECT make_date(year, 4, 1), 'Change', {metric}, d, {HIERARCHY_COLUMNS}
        FROM c LEFT JOIN j ON place = juris_name WHERE year > (SELECT min(year) FROM r)
    """


_PLACE_NAME = """
    CASE level WHEN 1 THEN county || ' County' WHEN 4 THEN replace(place, ' (part)', '')
               ELSE place || ' ' || county || ' County' END AS place
"""
# Each vintage has a cell for every row it lists and every year it owns, blank if unknown.
_PLACE_COUNTS = f"""
    SELECT CAST(level AS DOUBLE) AS level, year, {_PLACE_NAME}, n AS estimate FROM (
        SELECT w.level, w.county, w.place, w.year, c.n
        FROM (
            SELECT DISTINCT level, county, place, CAST(unnest(range(opens, owns + 1)) AS BIGINT) AS year
            FROM {{place_levels}}
            JOIN (VALUES (1995, 1997, 1996), (1997, 1999, 1998), (1999, 2000, 1999), (2000, 2001, 2001)) v(opens, ends, owns)
              ON year BETWEEN opens AND ends
            WHERE county IN ({_HOME})
        ) w
        LEFT JOIN (SELECT level, county, place, year, CAST(count(*) AS DOUBLE) AS n FROM {{place_levels}} GROUP BY 1, 2, 3, 4) c
          ON c.level = w.level AND c.county = w.county AND c.place = w.place AND c.year = w.year
    ) cells
"""


def _forecast(condition: str, metric: str, level: str, keep_first: bool = False) -> str:
    first = "" if keep_first else "WHERE d IS NOT NULL"
    return f"""
        WITH f AS (SELECT data_year, amount, amount - lag(amount) OVER (ORDER BY data_year) AS d
                   FROM {{forecast_facts}} WHERE {condition})
        SELECT make_date(data_year, 4, 1) AS date, '{level}' AS grouping, '{metric}' AS metric, amount AS estimate,
               'Region' AS geography, 'Region' AS geography_type, 'Forecast' AS variable FROM f {first}
        UNION ALL
        SELECT make_date(data_year, 4, 1), 'Change', '{metric}', d, 'Region', 'Region', 'Forecast' FROM f WHERE d IS NOT NULL
    """


@registered(
    trend(_observed(_PLACE_COUNTS, "'Population'"))
    + " UNION ALL "
    + trend(_forecast("group_id = 7 AND data_year > 1996", "Population", "Annual"))
)
def population_trends(spark, sf):
    """Four vintages that overlap in 1997, 1999 and 2000; the first and the last reach as far as the data."""
    segment, listed = population.population_segment, views.years(spark, sf, "orders")
    segments = [
        segment(views.population_wide(spark, sf, "1990s", listed[0], 1997), "1990s", boundary_year=1997),
        segment(views.population_wide(spark, sf, "intercensal", 1997, 1999), "intercensal", boundary_year=1999),
        segment(views.population_wide(spark, sf, "intercensal", 1999, 2000), "intercensal", boundary_year=2000),
        segment(views.population_wide(spark, sf, "latest", 2000, listed[-1]), "latest"),
    ]
    forecast = view(spark, sf, "forecast_facts").withColumnsRenamed(
        {"group_id": "pop_group_dim_id", "amount": "population"}
    )
    return population.population_trends(
        segments, view(spark, sf, "jurisdictions"), forecast, forecast_after=1996
    )


_HOUSING_COUNTS = " UNION ALL ".join(
    f"""
    SELECT CAST(level AS DOUBLE) AS level, CAST(y AS BIGINT) AS year, {_PLACE_NAME},
           '{name}' AS unit_type, CAST(sum(CASE WHEN year = y AND {condition} THEN 1 ELSE 0 END) AS DOUBLE) AS estimate
    FROM {{place_levels}}, (SELECT unnest(range({FIRST_YEAR}, {LAST_YEAR + 1})) AS y) yy
    WHERE county IN ({_HOME}) GROUP BY ALL
    """
    for name, condition in (
        ("Housing Units", "TRUE"),
        ("Single-Family", "priority = '1-URGENT'"),
        ("Multi-Family", "priority IN ('2-HIGH', '3-MEDIUM')"),
        ("Mobile Home", "priority IN ('4-NOT SPECIFIED', '5-LOW')"),
    )
)


@registered(
    trend(_observed(_HOUSING_COUNTS, "unit_type", "unit_type"))
    + " UNION ALL "
    + trend(_forecast("group_id = 7", "Housing Units", "Annual", keep_first=True))
)
def housing_trends(spark, sf):
    forecast = (
        view(spark, sf, "forecast_facts")
        .filter("group_id = 7")
        .select(F.col("data_year").alias("Year"), F.lit(None).cast("double").alias("Observed"), F.col("amount").alias("Forecast"))
    )
    return population.housing_trends(
        views.housing_wide(spark, sf), view(spark, sf, "jurisdictions"), forecast
    )


# --- near transit and jobs ----------------------------------------------------------


def _near_series(levels: str, metrics: dict[str, str], level_label: str) -> str:
    """Level and change rows with shares, from one row per year and variable."""
    lags = ", ".join(
        f"{c} - lag({c}) OVER (PARTITION BY variable ORDER BY year) AS d_{c}" for c in metrics
    )
    rows = " UNION ALL ".join(
        f"SELECT year, variable, '{m}' AS metric, '{g}' AS grouping, CAST({c} AS DOUBLE) AS estimate FROM l "
        f"WHERE {c} IS NOT NULL AND variable IS NOT NULL"
        for col, m in metrics.items()
        for g, c in ((level_label, col), ("Change", f"d_{col}"))
    )
    return f"""
        WITH l0 AS ({levels}), l AS (SELECT *, {lags} FROM l0), s0 AS ({rows})
        SELECT make_date(year, 4, 1) AS date, 'Region' AS geography, 'Region' AS geography_type, variable, grouping, metric,
               estimate, estimate / NULLIF(sum(estimate) OVER (PARTITION BY year, metric, grouping), 0) AS s FROM s0
    """


_NEAR_POPULATION = _near_series(
    """
    SELECT estimate_year AS year, hct_station_area_vision_2050 AS variable,
           CAST(trunc(sum(total_pop)) AS BIGINT) AS pop, CAST(trunc(sum(housing_units)) AS BIGINT) AS units
    FROM {parcel_facts} f LEFT JOIN {parcel_dims} d ON f.parcel_dim_id = d.parcel_dim_id
    WHERE estimate_year < 1999 OR ofm_vintage = (SELECT max(ofm_vintage) FROM {parcel_facts})
    GROUP BY 1, 2
    """,
    {"pop": "Population near HCT", "units": "Housing Units near HCT"},
    "Annual",
)
_STATION_LEVELS = """
    WITH w AS (SELECT data_year, max(CASE geo WHEN 'Inside HCT Area' THEN total_emp END) AS i,
                      max(CASE geo WHEN 'Region' THEN total_emp END) AS r FROM {station_jobs} WHERE data_year >= 1996 GROUP BY 1)
    SELECT data_year AS year, 'in station area' AS variable, i AS jobs FROM w
    UNION ALL SELECT data_year, 'not in station area', r - i FROM w
"""
_NEAR_JOBS = trend(_near_series(_STATION_LEVELS, {"jobs": "Jobs near HCT"}, "Total"), share="s")
_COVERED = (
    trend(f"""
        SELECT date, geography, geography_type, 'Observed' AS variable, grouping, 'Covered Employment' AS metric, sum(estimate) AS estimate
        FROM ({_near_series(_STATION_LEVELS, {"jobs": "Jobs near HCT"}, "Total")}) n GROUP BY ALL
    """)
    + " UNION ALL "
    + trend(_forecast("group_id = 7 AND data_year >= 1997", "Covered Employment", "Total"))
)


@registered(trend(_NEAR_POPULATION, share="s"))
def near_transit_population(spark, sf):
    return near_transit.near_transit_population(
        view(spark, sf, "parcel_facts"), view(spark, sf, "parcel_dims"), vintage_from=1999
    )


@registered(trend(_NEAR_POPULATION, share="s"))
def near_transit_population_bucketed(spark, sf):
    """From tables laid out for the join, in which parcels of many facts are split."""
    tables = ("near_transit_facts", "near_transit_parcels")
    buckets.write_pair(view(spark, sf, "parcel_facts"), view(spark, sf, "parcel_dims"), "parcel_dim_id", tables, buckets=16)
    return near_transit.near_transit_population(*[spark.table(t) for t in tables], vintage_from=1999, bucketed=True)


@registered(_NEAR_JOBS)
def near_transit_jobs(spark, sf):
    return near_transit.near_transit_jobs(view(spark, sf, "station_jobs"), start_year=1996)


def _jobs_forecast(spark, sf):
    return view(spark, sf, "forecast_facts").withColumnsRenamed(
        {"group_id": "employment_sector_dim_id", "amount": "jobs"}
    )


@registered(_COVERED)
def covered_employment(spark, sf):
    return jobs.covered_employment(
        view(spark, sf, "station_jobs"), _jobs_forecast(spark, sf), forecast_base_yr=1998, first_year=1996, sector=7
    )


_JOB_YEAR, _JOB_MONTH = 2001, 10
_MONTHLY_JOBS = trend(f"""
    WITH long AS (
        SELECT a.area AS geography, trim(i.industry) AS variable, d.date, j.estimate
        FROM (SELECT DISTINCT area, industry FROM {{jobs_by_industry}}) i
        JOIN (SELECT DISTINCT area FROM {{jobs_by_industry}}) a ON a.area = i.area
        CROSS JOIN (SELECT CAST(unnest(generate_series(TIMESTAMP '{FIRST_YEAR}-01-01', TIMESTAMP '{LAST_YEAR}-12-01', INTERVAL 1 MONTH)) AS DATE) AS date) d
        LEFT JOIN {{jobs_by_industry}} j ON j.area = i.area AND j.industry = i.industry AND j.date = d.date
    ),
    areas AS (
        SELECT geography, CASE WHEN geography = 'Bremerton MSA' THEN replace(variable, 'Mining, Logging, and Construction', 'Construction') ELSE variable END AS variable,
               date, estimate FROM long
        UNION ALL
        SELECT geography, 'Other Services', date,
               sum(CASE WHEN variable = 'Private Service Providing' THEN estimate END)
               - CASE WHEN count(CASE WHEN variable <> 'Private Service Providing' THEN estimate END)
                           = sum(CASE WHEN variable <> 'Private Service Providing' THEN 1 ELSE 0 END)
                      THEN sum(CASE WHEN variable <> 'Private Service Providing' THEN estimate END) END
        FROM long WHERE geography = 'Bremerton MSA'
             AND variable IN ('Private Service Providing', 'Information', 'Financial Activities', 'Leisure and Hospitality')
        GROUP BY geography, date
    ),
    every AS (
        SELECT * FROM areas
        UNION ALL
        SELECT 'Region', variable, date, CASE WHEN count(estimate) = count(*) THEN sum(estimate) END
        FROM areas WHERE geography <> 'Washington State' GROUP BY variable, date
    ),
    periods AS (
        SELECT geography, variable, date, 'Monthly' AS grouping, estimate FROM every
        UNION ALL
        SELECT geography, variable, make_date(year(date), {_JOB_MONTH}, 1), 'YTD', CASE WHEN count(estimate) = count(*) THEN sum(estimate) END
        FROM every GROUP BY geography, variable, year(date)
        UNION ALL
        SELECT geography, variable, make_date(year(date), 12, 1), 'Annual', CASE WHEN count(estimate) = count(*) THEN sum(estimate) END
        FROM every WHERE year(date) < {_JOB_YEAR} GROUP BY geography, variable, year(date)
    )
    SELECT *, CASE geography WHEN 'Washington State' THEN 'State' WHEN 'Region' THEN 'Region' ELSE 'MSA' END AS geography_type,
           'Wage and Salary Employment' AS metric FROM periods
""")


@registered(_MONTHLY_JOBS)
def monthly_jobs(spark, sf):
    return jobs.monthly_jobs(views.jobs_wide(spark, sf), yr=_JOB_YEAR, mo=_JOB_MONTH)


@registered(f"{_MONTHLY_JOBS} UNION ALL {_NEAR_JOBS} UNION ALL {_COVERED.replace('data_year >= 1997', 'data_year >= 1999')}")
def jobs_trends(spark, sf):
    forecast = _jobs_forecast(spark, sf).withColumn(
        "employment_sector_dim_id", F.col("employment_sector_dim_id") + 1
    )
    return jobs.jobs_trends(
        views.jobs_wide(spark, sf), view(spark, sf, "station_jobs"), forecast,
        yr=_JOB_YEAR, mo=_JOB_MONTH, start_year=1996, forecast_base_yr=2000,
    )


# --- airport ------------------------------------------------------------------------

_AS_OF = dt.date(2001, 8, 20)  # newest published month: June 2001
_AIRPORT_ROWS = """
    SELECT CASE WHEN variable LIKE '%Domestic%' THEN 'Domestic' WHEN variable LIKE '%International%' THEN 'International'
                ELSE 'Total' END AS variable,
           CASE WHEN variable ILIKE '%passenger%' THEN 'Passengers' ELSE 'Cargo' END AS metric, estimate,
           make_date(CAST(substring(month_key, 3, 4) AS BIGINT), CAST(substring(month_key, 1, 2) AS BIGINT), 1) AS date
    FROM {airport_rows} WHERE variable <> 'Other Operations'
"""
_AIRPORT_MONTHLY = trend(f"""
    WITH m AS (SELECT * FROM ({_AIRPORT_ROWS}) a WHERE date BETWEEN DATE '1996-01-01' AND DATE '2001-06-01')
    SELECT variable, metric, date, 'Monthly' AS grouping, estimate FROM m
    UNION ALL
    SELECT variable, metric, make_date(year(date), 12, 1), 'Annual', sum(estimate) FROM m WHERE year(date) < 2001 GROUP BY 1, 2, 3
    UNION ALL
    SELECT variable, metric, make_date(year(date), 6, 1), 'YTD', sum(estimate) FROM m WHERE month(date) <= 6 GROUP BY 1, 2, 3
""", geography="'Seattle-Tacoma International Airport'", geography_type="'Region'")


def _national(metric: str, estimate: str) -> str:
    return trend(
        f"SELECT geography, {estimate} AS estimate, make_date(CAST(file_key AS BIGINT), 12, 1) AS date "
        "FROM {airport_national} WHERE file_key >= '1996'",
        geography_type="'Metro Airports'", variable="'Total'", grouping="'Annual'", metric=f"'{metric}'",
    )


_PASSENGERS = _national("Passengers", "estimate")
_CARGO = _national("Cargo", "round_even(estimate * 0.00045359, 0)")


@registered(_AIRPORT_MONTHLY)
def airport_monthly(spark, sf):
    return airport.airport_monthly(view(spark, sf, "airport_rows"), _AS_OF, yr1=1996)


@registered(_PASSENGERS)
def airport_national_passengers(spark, sf):
    return airport.airport_national(view(spark, sf, "airport_national"), "passengers", yr1=1996)


@registered(_CARGO)
def airport_national_cargo(spark, sf):
    return airport.airport_national(view(spark, sf, "airport_national"), "cargo", yr1=1996)


@registered(f"{_AIRPORT_MONTHLY} UNION ALL {_PASSENGERS} UNION ALL {_CARGO}")
def airport_trends(spark, sf):
    national = view(spark, sf, "airport_national")
    return airport.airport_trends(view(spark, sf, "airport_rows"), national, national, _AS_OF, yr1=1996)
