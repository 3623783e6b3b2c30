"""Indicators on small published-style tables, one case per rule of each domain."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendloom.plans import airport, census, jobs, near_transit, population, transit, vehicles
from trendloom.sources.lookups import ACS_TOPICS, acs_lookup


def month(y, m):
    return dt.date(y, m, 1)


# --- vehicles -----------------------------------------------------------------------

TITLES = (
    "transaction_month string, new_or_used string, transaction_type string, electrification_level string, "
    "make string, county string, tract string, transactions double"
)


@pytest.fixture(scope="module")
def titles(spark):
    new = ("New", "Original Title")
    return spark.createDataFrame(
        [
            ("1/1/2020", *new, "BEV (Battery Electric Vehicle)", "A", "King", "1", 1.0),
            ("01/01/2020", *new, "BEV (Battery Electric Vehicle)", "B", "King", "1", 2.0),
            ("1/1/2020", *new, "HEV (Hybrid Electric Vehicle) - Level Unknown", "A", "King", "1", 4.0),
            ("1/1/2020", *new, "Mild HEV (Hybrid Electric Vehicle)", "A", "King", None, 8.0),
            ("1/1/2020", *new, "Strong HEV (Hybrid Electric Vehicle)", "A", "Pierce", "2", 16.0),
            ("1/1/2020", *new, "PHEV (Plug-in Hybrid Electric Vehicle)", "A", "Pierce", "2", 0.0),
            ("1/1/2020", *new, "ICE (Internal Combustion Engine)", "A", None, "2", 32.0),
            ("2/1/2020", *new, "Steam", "A", "King", "3", None),
            ("12/1/2020", "Used", "Original Title", "BEV (Battery Electric Vehicle)", "A", "King", "1", 64.0),
            ("3/1/2021", "New", "Transfer Title", "BEV (Battery Electric Vehicle)", "A", "King", "1", 128.0),
        ],
        TITLES,
    )


def test_title_transactions(titles, rows):
    got = vehicles.title_transactions(titles)
    assert rows(got, "date", "geography", "geography_type", "variable", "estimate", "share") == sorted(
        [
            (month(2020, 1), None, None, "Internal Combustion Engine", 32.0, 1.0),
            (month(2020, 1), "King", "County", "Battery Electric Vehicle", 3.0, 0.2),
            (month(2020, 1), "King", "County", "Hybrid Electric Vehicle", 12.0, 0.8),
            (month(2020, 1), "Pierce", "County", "Hybrid Electric Vehicle", 16.0, 1.0),
            (month(2020, 1), "Pierce", "County", "Plug-in Hybrid Electric Vehicle", 0.0, 0.0),
            (month(2020, 1), "Region", "Region", "Battery Electric Vehicle", 3.0, 3 / 63),
            (month(2020, 1), "Region", "Region", "Hybrid Electric Vehicle", 28.0, 28 / 63),
            (month(2020, 1), "Region", "Region", "Internal Combustion Engine", 32.0, 32 / 63),
            (month(2020, 1), "Region", "Region", "Plug-in Hybrid Electric Vehicle", 0.0, 0.0),
            (month(2020, 2), "King", "County", "Steam", None, None),
            (month(2020, 2), "Region", "Region", "Steam", None, None),
        ],
        key=lambda r: [(v is not None, str(type(v)), v) for v in r],
    )
    assert rows(got.select("grouping", "metric").distinct()) == [("New", "vehicle-registrations")]


def test_makes_use_all_titles_and_the_newest_month_of_the_year(titles, rows):
    got = vehicles.titles_by_make(titles)
    assert rows(got, "date", "grouping", "estimate", "share") == [
        (month(2020, 12), "A", 65.0, 65 / 67), (month(2020, 12), "B", 2.0, 2 / 67), (month(2021, 3), "A", 128.0, 1.0)]


def test_tracts_drop_unknown_tract_and_count(titles, rows):
    got = vehicles.titles_by_tract(titles)
    assert rows(got, "date", "geography", "variable", "estimate", "share") == [
        (month(2020, 12), "1", "Battery Electric Vehicle", 3.0, 3 / 7),
        (month(2020, 12), "1", "Hybrid Electric Vehicle", 4.0, 4 / 7),
        (month(2020, 12), "2", "Hybrid Electric Vehicle", 16.0, 16 / 48),
        (month(2020, 12), "2", "Internal Combustion Engine", 32.0, 32 / 48),
        (month(2020, 12), "2", "Plug-in Hybrid Electric Vehicle", 0.0, 0.0),
    ]


def test_cube_stands_in_for_titles(titles, rows):
    cube = vehicles.title_cube(titles)
    assert rows(vehicles.title_transactions(cube)) == rows(vehicles.title_transactions(titles))
    assert rows(vehicles.titles_by_make(cube, vehicles.ENGINES)) == rows(vehicles.titles_by_make(titles, vehicles.ENGINES))


def test_registrations(spark, rows):
    schema = (
        "date timestamp, state string, county string, battery_electric_vehicles_bevs_ string, "
        "plug_in_hybrid_electric_vehicles_phevs_ string, electric_vehicle_ev_total string, "
        "non_electric_vehicles string, total_vehicles string"
    )
    day = dt.datetime(2022, 3, 31)
    df = spark.createDataFrame(
        [
            (day, "WA", "King", "1", "2", "3", "7", "10"),
            (day, "WA", "Pierce", "1", "x", "1", "9", "10"),
            (day, "WA", "Clark", "1", "1", "2", "8", "10"),
            (day, "OR", "King", "1", "1", "2", "8", "10"),
        ],
        schema,
    )
    got = vehicles.registrations_by_fuel(df)
    assert got.count() == 15
    region = got.filter("geography = 'Region'")
    assert rows(region, "variable", "geography_type", "estimate", "share") == [
        ("Battery Electric", "Region", 2.0, 0.1), ("Internal Combustion", "Region", 16.0, 0.8),
        ("Plug-In Hybrid", "Region", None, None), ("Total Electric Vehicles", "Region", 4.0, 0.2),
        ("Total Vehicles", "Region", 20.0, 1.0)]


# --- transit ------------------------------------------------------------------------


def transit_frame(spark, months, cells):
    columns = ["agency_id", "agency", "mode", "tos", "metric", *months]
    schema = ", ".join(f"`{c}` {'double' if '/' in c else 'string'}" for c in columns)
    return spark.createDataFrame(cells, schema)


AGENCIES = [("1", "Seattle", "Metro"), ("1", "Spokane", "Metro"), ("00002", "Spokane", "East"), ("4", "Seattle", "Ferry")]


def test_transit(spark, rows):
    agencies = spark.createDataFrame(AGENCIES, "NTDID string, MPO_AREA string, AGENCY_NAME string")
    wide = transit_frame(
        spark,
        ["11/2020", "12/2020", "1/2021"],
        [
            ("1", "m", "DR", "DO", "UPT", 1.0, 2.0, 4.0),
            ("1", "m", "DR", "ZZ", "UPT", 8.0, None, None),
            ("1", "m", "MB", "DO", "UPT", 16.0, 0.0, 32.0),
            ("1", "m", "MB", "DO", "VRH", 3.0, None, 0.0),
            ("00002", "e", "MB", "DO", "UPT", 64.0, None, None),
            ("00003", "unlisted", "MB", "DO", "UPT", 1000.0, None, None),
        ],
    )
    got = transit.transit_trends(wide, agencies)
    boardings = got.filter("metric = 'Boardings'")
    # The newest boardings month is January 2021: 2020 is complete, to date means January.
    assert rows(boardings, "date", "geography", "geography_type", "variable", "grouping", "estimate") == [
        (month(2020, 12), "Metro", "Transit Operator", "All Transit Modes", "Annual", 27.0),
        (month(2020, 12), "Metro", "Transit Operator", "Bus", "Annual", 16.0),
        (month(2020, 12), "Metro", "Transit Operator", "Demand Response", "Annual", 3.0),
        (month(2020, 12), "Region", "Region", "All Transit Modes", "Annual", 27.0),
        (month(2020, 12), "Region", "Region", "Bus", "Annual", 16.0),
        (month(2020, 12), "Region", "Region", "Demand Response", "Annual", 3.0),
        (month(2020, 12), "Seattle", "Metro Areas", "All Transit Modes", "Annual", 27.0),
        (month(2020, 12), "Spokane", "Metro Areas", "All Transit Modes", "Annual", 91.0),
        (month(2021, 1), "Metro", "Transit Operator", "All Transit Modes", "YTD", 36.0),
        (month(2021, 1), "Metro", "Transit Operator", "Bus", "YTD", 32.0),
        (month(2021, 1), "Metro", "Transit Operator", "Demand Response", "YTD", 4.0),
        (month(2021, 1), "Region", "Region", "All Transit Modes", "YTD", 36.0),
        (month(2021, 1), "Region", "Region", "Bus", "YTD", 32.0),
        (month(2021, 1), "Region", "Region", "Demand Response", "YTD", 4.0),
        (month(2021, 1), "Seattle", "Metro Areas", "All Transit Modes", "YTD", 36.0),
        (month(2021, 1), "Spokane", "Metro Areas", "All Transit Modes", "YTD", 36.0),
    ]
    # No positive hours in January 2021, so no ratio there; 16 / 3 and 27 / 3 in 2020.
    ratio = got.filter("metric = 'Boardings-per-Hour' AND geography = 'Region'")
    assert rows(ratio, "date", "variable", "estimate") == [
        (month(2020, 12), "All Transit Modes", 9.0), (month(2020, 12), "Bus", 5.33)]


def test_transit_sheets_may_end_in_different_months(spark, rows):
    agencies = spark.createDataFrame(AGENCIES, "NTDID string, MPO_AREA string, AGENCY_NAME string")
    wide = transit_frame(
        spark,
        ["12/2019", "11/2020", "12/2020"],
        [("4", "f", "FB", "DO", "UPT", 1.0, 2.0, 4.0), ("4", "f", "FB", "DO", "VRM", 1.0, 2.0, None)],
    )
    got = transit.transit_trends(wide, agencies).filter("geography = 'Seattle'")
    assert rows(got, "metric", "grouping", "date", "estimate") == [
        ("Boardings", "Annual", month(2019, 12), 1.0), ("Boardings", "Annual", month(2020, 12), 6.0),
        ("Boardings", "YTD", month(2019, 12), 1.0), ("Boardings", "YTD", month(2020, 12), 6.0),
        ("Revenue-Miles", "Annual", month(2019, 12), 1.0),
        ("Revenue-Miles", "YTD", month(2020, 11), 2.0)]


# --- census -------------------------------------------------------------------------


def test_built_in_topics():
    sizes = {t: len(labels) for t, labels in ACS_TOPICS.items()}
    assert sizes == {
        "commute-modes": 10, "commute-times": 13, "departure-time": 15, "race-ethnicity": 9,
        "housing-tenure": 3, "educational-attainment": 33, "age": 47, "income": 17,
    }
    names = {t: len({label for _, label in labels}) for t, labels in ACS_TOPICS.items()}
    assert names == {
        "commute-modes": 8, "commute-times": 6, "departure-time": 7, "race-ethnicity": 9,
        "housing-tenure": 3, "educational-attainment": 9, "age": 5, "income": 7,
    }


def test_lookup_codes_are_unique(spark):
    lookup = acs_lookup(spark)
    assert lookup.select("variable").distinct().count() == lookup.count() == 147


def test_acs(spark, rows):
    acs = spark.createDataFrame(
        [
            ("King", "B25003_001", 10.0, 3.0, "County", 2021),
            ("King", "B25003_002", 4.0, 1.0, "County", 2021),
            ("King", "B25003_003", None, 1.0, "County", 2021),
            ("King", "B25003_009", 5.0, 1.0, "County", 2021),
            ("King", "B25003_001", 99.0, 1.0, "County", 2016),
            ("Algona", "B25003_002", 0.0, 2.0, "City", 2021),
            ("Burley", "B25003_002", 1.0, 2.0, "CDP", 2021),
        ],
        "name string, variable string, estimate double, moe double, census_geography string, year int",
    )
    metro = spark.createDataFrame(
        [("53033", "B25003_001", 6.0, 3.0, 2021), ("53035", "B25003_001", 2.0, 4.0, 2021),
         ("53035", "B25003_002", 2.0, None, 2021), ("41001", "B25003_001", 7.0, 4.0, 2021)],
        "GEOID string, variable string, estimate double, moe double, year int",
    )
    counties = spark.createDataFrame(
        [("Seattle", "53", "33"), ("Seattle", "53", "35"), ("Boise", "16", "1")],
        "MPO_AREA string, STATE_FIPS string, COUNTY_FIPS string",
    )
    got = census.acs_indicator(acs, metro, counties, [2021], "housing-tenure")
    assert rows(got, "geography_type", "geography", "variable", "estimate", "share", "moe") == [
        ("City", "Algona", "Own", 0.0, None, 2.0),
        ("County", "King", "Own", 4.0, 0.4, 1.0),
        ("County", "King", "Rent", None, None, None),
        ("County", "King", "Total", 10.0, 1.0, 3.0),
        ("Metro Areas", "Boise", None, None, None, None),
        ("Metro Areas", "Seattle", "Own", 2.0, 0.25, None),
        ("Metro Areas", "Seattle", "Total", 8.0, 1.0, 5.0),
    ]
    assert rows(got.select("year", "date", "grouping", "metric").distinct()) == [
        ("2021", month(2021, 12), "All", "housing-tenure")]


def test_acs_topic_with_its_own_labels(spark, rows):
    acs = spark.createDataFrame(
        [("K", "B99_001", 4.0, 3.0, "Region", 2020), ("K", "B99_002", 1.0, 4.0, "Region", 2020)],
        "name string, variable string, estimate double, moe double, census_geography string, year int",
    )
    metro = spark.createDataFrame([], "GEOID string, variable string, estimate double, moe double, year int")
    counties = spark.createDataFrame([], "MPO_AREA string, STATE_FIPS string, COUNTY_FIPS string")
    labels = spark.createDataFrame(
        [("pets", "B99_001", "Total"), ("pets", "B99_002", "Dogs")], "topic string, variable string, simple_label string")
    got = census.acs_indicator(acs, metro, counties, [2020], "pets", labels)
    assert rows(got, "metric", "variable", "share") == [("pets", "Dogs", 0.25), ("pets", "Total", 1.0)]


def test_acs_zero_total_counts_only_the_largest_margin(spark):
    acs = spark.createDataFrame(
        [("K", "B08301_016", 0.0, 3.0, "County", 2021), ("K", "B08301_020", 0.0, 4.0, "County", 2021)],
        "name string, variable string, estimate double, moe double, census_geography string, year int",
    )
    metro = spark.createDataFrame([], "GEOID string, variable string, estimate double, moe double, year int")
    counties = spark.createDataFrame([], "MPO_AREA string, STATE_FIPS string, COUNTY_FIPS string")
    got = census.acs_indicator(acs, metro, counties, [2021]).collect()
    assert [(r.variable, r.estimate, r.moe) for r in got] == [("Other", 0.0, 4.0)]


# --- population and housing ---------------------------------------------------------

NO_FORECAST = "pop_group_dim_id int, data_year int, population double"


def test_population(spark, rows):
    old = spark.createDataFrame(
        [
            ("1", "King", "", "j", "0", "100", "110", "120"),
            ("2", "King", "Unincorporated", "j", "0", "30", "30", "x"),
            ("3", "King", "Incorporated", "j", "0", "70", "80", "90"),
            ("4", "King", "Milton (part)", "j", "0", "7", "8", "9"),
            ("4", "Pierce", "Milton (part)", "j", "0", "3", "3", "3"),
            ("4", "King", "Beaux Arts", "j", "0", "1", "1", "1"),
            ("4", "Pierce", "Du Pont", "j", "0", "2", "2", "2"),
            ("4", "Clark", "Vancouver", "j", "0", "500", "500", "500"),
        ],
        "Filter string, `County.Name` string, `City.Name` string, Jurisdiction string, `Place.Code.x` string, "
        "`1998.Total.Population.a` string, `1999.Total.Population.a` string, `2000.Total.Population.a` string",
    )
    latest = spark.createDataFrame(
        [("1", "1", "King", "King County ", "130"), ("2", "1", "Pierce", "Pierce County", "70"), ("3", "4", "King", "Milton", "11")],
        "Line string, Filter string, County string, Jurisdiction string, `2000.Population.Estimate` string",
    )
    jurisdictions = spark.createDataFrame(
        [("Milton", "CitiesTowns", 1), ("Milton", "CitiesTowns", 0), ("Beau Arts Village", "Metro", 0), ("Uninc. King", "Uninc", 0)],
        "juris_name string, regional_geography string, airport_affected int",
    )
    forecast = spark.createDataFrame(
        [(7, 2010, 1.0), (7, 2011, 2.0), (7, 2012, 5.0), (6, 2012, 9.0)], NO_FORECAST)
    segments = [
        population.population_segment(old, "1990s", boundary_year=2000),
        population.population_segment(latest, "latest"),
    ]
    got = population.population_trends(segments, jurisdictions, forecast)
    annual = got.filter("grouping = 'Annual' AND variable <> 'Forecast' OR variable IS NULL AND grouping = 'Annual'")
    assert rows(annual, "geography", "geography_type", "variable", "year", "estimate") == sorted(
        [
            ("DuPont", "City", None, "1998", 2.0), ("DuPont", "City", None, "1999", 2.0),
            ("Beaux Arts Village", "City", "Metropolitan Cities", "1998", 1.0),
            ("Beaux Arts Village", "City", "Metropolitan Cities", "1999", 1.0),
            ("King", "County", "Total", "1998", 100.0), ("King", "County", "Total", "1999", 110.0), ("King", "County", "Total", "2000", 130.0),
            ("King", "County", "Unincorporated", "1998", 30.0), ("King", "County", "Unincorporated", "1999", 30.0),
            ("King", "County", "Incorporated", "1998", 70.0), ("King", "County", "Incorporated", "1999", 80.0),
            ("Milton", "City", "Cities & Towns", "1998", 10.0), ("Milton", "City", "Cities & Towns", "1999", 11.0), ("Milton", "City", "Cities & Towns", "2000", 11.0),
            ("Pierce", "County", "Total", "2000", 70.0),
            ("Region", "Region", "Total", "1998", 100.0), ("Region", "Region", "Total", "1999", 110.0), ("Region", "Region", "Total", "2000", 200.0),
            ("Region", "Region", "Unincorporated", "1998", 30.0), ("Region", "Region", "Unincorporated", "1999", 30.0),
            ("Region", "Region", "Incorporated", "1998", 70.0), ("Region", "Region", "Incorporated", "1999", 80.0),
        ],
        key=lambda r: [(v is not None, str(type(v)), v) for v in r],
    )
    changes = got.filter("grouping = 'Change' AND geography IN ('Milton', 'Pierce', 'Region') AND variable <> 'Forecast'")
    assert rows(changes, "geography", "variable", "year", "estimate") == [
        ("Milton", "Cities & Towns", "1999", 1.0), ("Milton", "Cities & Towns", "2000", 0.0),
        ("Pierce", "Total", "2000", None),
        ("Region", "Incorporated", "1999", 10.0), ("Region", "Total", "1999", 10.0), ("Region", "Total", "2000", 90.0),
        ("Region", "Unincorporated", "1999", 0.0)]
    future = got.filter("variable = 'Forecast'")
    assert rows(future, "date", "grouping", "metric", "estimate") == [
        (month(2012, 4), "Annual", "Population", 5.0), (month(2012, 4), "Change", "Population", 3.0)]


def test_non_numeric_cell_poisons_its_place_and_region(spark, rows):
    wide = spark.createDataFrame(
        [("1", "King", "King County", "n/a"), ("1", "Pierce", "Pierce County", "5")],
        "Filter string, County string, Jurisdiction string, `2021.Population.Estimate` string",
    )
    jurisdictions = spark.createDataFrame([], "juris_name string, regional_geography string")
    segment = population.population_segment(wide, "latest")
    got = population.population_trends([segment], jurisdictions, spark.createDataFrame([], NO_FORECAST))
    assert rows(got, "geography", "estimate") == [("King", None), ("Pierce", 5.0), ("Region", None)]


def test_housing(spark, rows):
    wide = spark.createDataFrame(
        [("1", "1", "King", "King County", "9", "5", "4", "6"), ("2", "4", "King", "Milton (part)", "9", "1", "2", "2"),
         ("3", "4", "Pierce", "Milton (part)", "9", "1", "0", "3"), ("4", "1", "Clark", "Clark County", "9", "1", "1", "1")],
        "Line string, Filter string, County string, Jurisdiction string, `1980.Census.Total.Housing.Units` string, "
        "`1990.Census.Total.Housing.Units` string, `1990.Census.One.Unit.Housing.Units` string, "
        "`1991.Postcensal.Total.Housing.Units` string",
    )
    jurisdictions = spark.createDataFrame([("Milton", "Core")], "juris_name string, regional_geography string")
    forecast = spark.createDataFrame(
        [(2020, 7.0, None), (2021, None, 8.0), (2022, None, 9.5)], "Year int, Observed double, Forecast double")
    got = population.housing_trends(wide, jurisdictions, forecast)
    assert rows(got.filter("geography = 'Milton'"), "metric", "year", "grouping", "variable", "estimate") == [
        ("Housing Units", "1990", "Annual", "Core Cities", 2.0), ("Housing Units", "1991", "Annual", "Core Cities", 5.0),
        ("Housing Units", "1991", "Change", "Core Cities", 3.0), ("Single-Family", "1990", "Annual", "Core Cities", 2.0)]
    assert rows(got.filter("variable = 'Forecast'"), "year", "grouping", "estimate") == [
        ("2021", "Annual", 8.0), ("2022", "Annual", 9.5), ("2022", "Change", 1.5)]


# --- near transit, jobs -------------------------------------------------------------


def test_near_transit_population(spark, rows):
    facts = spark.createDataFrame(
        [
            (1, 2019, 10.6, 5.0, 2020), (1, 2020, 99.0, 9.0, 2021), (1, 2020, 12.0, 6.0, 2022),
            (2, 2019, 30.0, 5.0, 2020), (2, 2020, 28.0, 5.0, 2022), (3, 2020, 7.0, 7.0, 2022),
        ],
        "parcel_dim_id long, estimate_year int, total_pop double, housing_units double, ofm_vintage int",
    )
    parcels = spark.createDataFrame([(1, "in station area"), (2, "not in station area")], "parcel_dim_id long, hct_station_area_vision_2050 string")
    got = near_transit.near_transit_population(facts, parcels)
    assert rows(got, "metric", "grouping", "year", "variable", "estimate", "share") == sorted([
        ("Housing Units near HCT", "Annual", "2019", "in station area", 5.0, 0.5),
        ("Housing Units near HCT", "Annual", "2019", "not in station area", 5.0, 0.5),
        ("Housing Units near HCT", "Annual", "2020", "in station area", 6.0, 6 / 11),
        ("Housing Units near HCT", "Annual", "2020", "not in station area", 5.0, 5 / 11),
        ("Housing Units near HCT", "Change", "2020", "in station area", 1.0, 1.0),
        ("Housing Units near HCT", "Change", "2020", "not in station area", 0.0, 0.0),
        ("Population near HCT", "Annual", "2019", "in station area", 10.0, 0.25),
        ("Population near HCT", "Annual", "2019", "not in station area", 30.0, 0.75),
        ("Population near HCT", "Annual", "2020", "in station area", 12.0, 0.3),
        ("Population near HCT", "Annual", "2020", "not in station area", 28.0, 0.7),
        # The changes cancel out, so they have no share.
        ("Population near HCT", "Change", "2020", "in station area", 2.0, None),
        ("Population near HCT", "Change", "2020", "not in station area", -2.0, None),
    ], key=lambda r: [(v is not None, str(type(v)), v) for v in r])


@pytest.fixture(scope="module")
def station_jobs(spark):
    return spark.createDataFrame(
        [(2009, "Region", 1.0), (2010, "Inside HCT Area", 4.0), (2010, "Region", 10.0), (2010, "Outside HCT Area", 77.0),
         (2011, "Inside HCT Area", 6.0), (2011, "Region", 12.0), (2012, "Region", 15.0)],
        "data_year int, geo string, total_emp double",
    )


def test_near_transit_jobs(station_jobs, rows):
    got = near_transit.near_transit_jobs(station_jobs)
    assert rows(got, "grouping", "year", "variable", "estimate", "share") == [
        ("Change", "2011", "in station area", 2.0, 1.0), ("Change", "2011", "not in station area", 0.0, 0.0),
        ("Total", "2010", "in station area", 4.0, 0.4), ("Total", "2010", "not in station area", 6.0, 0.6),
        ("Total", "2011", "in station area", 6.0, 0.5), ("Total", "2011", "not in station area", 6.0, 0.5)]


def test_covered_employment(spark, station_jobs, rows):
    forecast = spark.createDataFrame(
        [(8, 2016, 1.0), (8, 2017, 5.0), (8, 2018, 7.0), (1, 2018, 99.0)], "employment_sector_dim_id int, data_year int, jobs double")
    got = jobs.covered_employment(station_jobs, forecast)
    assert rows(got, "variable", "year", "grouping", "estimate") == [
        ("Forecast", "2018", "Change", 2.0), ("Forecast", "2018", "Total", 7.0),
        ("Observed", "2010", "Total", 10.0), ("Observed", "2011", "Change", 2.0), ("Observed", "2011", "Total", 12.0)]


def job_sheets(spark):
    # Serials: December 2018, January and February 2019.
    return spark.createDataFrame(
        [
            ("1", "Construction", "Washington State", 100.0, 100.0, 100.0),
            ("1", " Construction", "Seattle MSA", 10.0, 20.0, 40.0),
            ("1", "Other Services ", "Seattle MSA", 1.0, 2.0, None),
            ("1", "Mining, Logging, and Construction", "Bremerton MSA", 3.0, 3.0, 3.0),
            ("2", "Private Service Providing", "Bremerton MSA", 50.0, 60.0, 70.0),
            ("3", "Information", "Bremerton MSA", 20.0, 20.0, 20.0),
            ("4", "Leisure and Hospitality", "Bremerton MSA", 25.0, 25.0, 25.0),
            ("5", "Other Services", "Bremerton MSA", 7.0, 7.0, 7.0),
        ],
        "`NAICS CELL` string, `NAICS INDUSTRY` string, area string, `43435` double, `43466` double, `43497` double",
    )


def test_monthly_jobs(spark, rows):
    got = jobs.monthly_jobs(job_sheets(spark), yr=2019, mo=2)
    services = got.filter("variable = 'Other Services' AND grouping = 'Monthly'")
    assert rows(services, "geography", "geography_type", "date", "estimate") == [
        ("Bremerton MSA", "MSA", month(2018, 12), 5.0), ("Bremerton MSA", "MSA", month(2019, 1), 15.0),
        ("Bremerton MSA", "MSA", month(2019, 2), 25.0),
        ("Region", "Region", month(2018, 12), 6.0), ("Region", "Region", month(2019, 1), 17.0),
        ("Region", "Region", month(2019, 2), None),
        ("Seattle MSA", "MSA", month(2018, 12), 1.0), ("Seattle MSA", "MSA", month(2019, 1), 2.0),
        ("Seattle MSA", "MSA", month(2019, 2), None)]
    building = got.filter("variable = 'Construction' AND grouping <> 'Monthly'")
    # Past years count whole in the year-to-date rows, and 2019 is not complete.
    assert rows(building, "geography", "grouping", "date", "estimate") == [
        ("Bremerton MSA", "Annual", month(2018, 12), 3.0), ("Bremerton MSA", "YTD", month(2018, 2), 3.0),
        ("Bremerton MSA", "YTD", month(2019, 2), 6.0),
        ("Region", "Annual", month(2018, 12), 13.0), ("Region", "YTD", month(2018, 2), 13.0), ("Region", "YTD", month(2019, 2), 66.0),
        ("Seattle MSA", "Annual", month(2018, 12), 10.0), ("Seattle MSA", "YTD", month(2018, 2), 10.0), ("Seattle MSA", "YTD", month(2019, 2), 60.0),
        ("Washington State", "Annual", month(2018, 12), 100.0), ("Washington State", "YTD", month(2018, 2), 100.0),
        ("Washington State", "YTD", month(2019, 2), 200.0)]


def test_monthly_jobs_in_december_and_with_month_filter(spark, rows):
    december = jobs.monthly_jobs(job_sheets(spark), yr=2019, mo=12)
    assert rows(december.filter("grouping = 'Annual'").select("year").distinct()) == [("2018",), ("2019",)]
    filtered = jobs.monthly_jobs(job_sheets(spark), yr=2019, mo=2, filter_months=True)
    assert rows(filtered.filter("grouping = 'YTD'").select("year").distinct()) == [("2019",)]


# --- airport ------------------------------------------------------------------------


def airport_rows(spark):
    keys = [(y, m) for y in (2021, 2022) for m in range(1, 13)] + [(2020, 12), (2023, 1)]
    cells = [("Subtotal - Domestic Passengers", "1", f"{m:02d}{y}") for y, m in keys]
    cells += [("CARGO GRAND TOTAL", "2", "012022"), ("Subtotal - International Air Freight", None, "012022"), ("Landings", "5", "012022")]
    return spark.createDataFrame(cells, "variable string, estimate string, month_key string")


@pytest.mark.parametrize(
    "as_of, newest, annual, ytd",
    [
        (dt.date(2023, 1, 9), month(2022, 11), ["2021"], [("2021", month(2021, 11), 11.0), ("2022", month(2022, 11), 11.0)]),
        (dt.date(2023, 2, 9), month(2022, 12), ["2021", "2022"], [("2021", month(2021, 12), 12.0), ("2022", month(2022, 12), 12.0)]),
        (dt.date(2023, 3, 9), month(2023, 1), ["2021", "2022"],
         [("2021", month(2021, 1), 1.0), ("2022", month(2022, 1), 1.0), ("2023", month(2023, 1), 1.0)]),
    ],
)
def test_airport_monthly(spark, rows, as_of, newest, annual, ytd):
    got = airport.airport_monthly(airport_rows(spark), as_of, yr1=2021).filter("metric = 'Passengers'")
    assert got.filter("grouping = 'Monthly'").agg(F.max("date")).first()[0] == newest
    assert rows(got.filter("grouping = 'Annual'"), "year", "estimate") == [(y, 12.0) for y in annual]
    assert rows(got.filter("grouping = 'YTD'"), "year", "date", "estimate") == ytd
    assert rows(got.select("variable", "geography", "geography_type").distinct()) == [
        ("Domestic", "Seattle-Tacoma International Airport", "Region")]


def test_airport_cargo_total(spark, rows):
    got = airport.airport_monthly(airport_rows(spark), dt.date(2023, 3, 9), yr1=2021).filter("metric = 'Cargo'")
    assert rows(got.filter("grouping = 'Monthly'"), "variable", "date", "estimate") == [("Total", month(2022, 1), 2.0)]


def test_missing_airport_months(spark, rows):
    got = airport.missing_airport_months(airport_rows(spark), dt.date(2023, 5, 1), yr1=2020)
    assert rows(got, "month_key") == sorted([(f"{m:02d}2020",) for m in range(1, 12)] + [("022023",), ("032023",)])


def test_airport_national(spark, rows):
    df = spark.createDataFrame(
        [("SEA", "5511.585", "2019"), (None, "1", "2019"), ("PDX", None, "2019"), ("PDX", "4409250", "2020"), ("OLD", "9", "2018")],
        "geography string, estimate string, file_key string",
    )
    cargo = airport.airport_national(df, "cargo")
    assert rows(cargo, "date", "geography", "metric", "estimate") == [
        (month(2019, 12), "SEA", "Cargo", round(5511.585 * 0.00045359)), (month(2020, 12), "PDX", "Cargo", 2000.0)]
    people = airport.airport_national(df)
    assert rows(people, "geography", "metric", "estimate") == [("PDX", "Passengers", 4409250.0), ("SEA", "Passengers", 5511.585)]
