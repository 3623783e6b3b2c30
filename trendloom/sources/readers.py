"""Readers. All are lazy; none infers a schema by scanning the data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendloom.functions.nulls import as_col, to_number
from trendloom.functions.text import pad_left
from trendloom.sources import landed

# Landed header to column name.
TITLE_HEADERS = {
    "Transaction Month and Year": "transaction_month",
    "New or Used Vehicle": "new_or_used",
    "Transaction Type": "transaction_type",
    "Electrification Level": "electrification_level",
    "Make": "make",
    "County": "county",
    "2020 GEOID": "tract",
    "Transaction Count": "transactions",
}
REGISTRATION_SCHEMA = (
    "date timestamp, state string, county string, vehicle_primary_use string, "
    "battery_electric_vehicles_bevs_ string, plug_in_hybrid_electric_vehicles_phevs_ string, "
    "electric_vehicle_ev_total string, non_electric_vehicles string, total_vehicles string, "
    "percent_electric_vehicles string"
)
TRANSIT_IDS = {"NTD.ID": "agency_id", "Agency": "agency", "Mode": "mode", "TOS": "tos"}
TRANSIT_UNUSED = ("Legacy.NTD.ID", "Status", "Reporter.Type", "UACE.CD", "UZA.Name", "3.Mode")


def read_wide(spark: SparkSession, path: str, header: int | Sequence[str] = 1) -> DataFrame:
    """A CSV as text columns under its own header names; a doubled quote in a quoted field is one quote.

    ``header`` is the number of the header's line, or names of which that line holds all; then, or if the files of a
    folder or glob have different headers, they are read by ``read_landed``, each by its own.
    """
    if header == 1 and len({layout.header for layout in landed.layouts(spark, path)}) <= 1:
        return spark.read.csv(path, header=True, escape='"', enforceSchema=False)
    return landed.read_landed(spark, path, header)


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """Vehicle title transactions; the tract code stays text."""
    wide = read_wide(spark, path)
    named = wide.select(*[as_col(h).alias(n) for h, n in TITLE_HEADERS.items()])
    return named.withColumn("transactions", to_number("transactions"))


def titles_set_aside(spark: SparkSession, path: str) -> landed.Landed:
    """Vehicle title transactions like ``read_titles``, and the malformed lines, which are not among the rows."""
    return landed.set_aside(spark, path, TITLE_HEADERS, ["transactions"])


def read_registrations(spark: SparkSession, path: str) -> DataFrame:
    """Open-data registration records landed as JSON lines."""
    return spark.read.schema(REGISTRATION_SCHEMA).json(path)


def registrations_set_aside(spark: SparkSession, path: str) -> landed.Landed:
    """Registration records like ``read_registrations``, and the lines that are no such record, which are not among the rows."""
    lines = spark.read.text(path).filter(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))
    parsed = F.from_json("value", f"{REGISTRATION_SCHEMA}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    judged = lines.withColumn("record", parsed)
    bad = F.col("record._bad").isNotNull()
    malformed = judged.filter(bad).select("file", F.col("value").alias("line"), F.lit("no record").alias("reason"))
    return landed.Landed(judged.filter(~bad).select("record.*").drop("_bad"), malformed)


def read_lookup(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """A census label list (variable, simple_label, label) as one topic."""
    return read_wide(spark, path).select(F.lit(topic).alias("topic"), "variable", "simple_label")


def read_counties(spark: SparkSession, path: str) -> DataFrame:
    """County to metro area list; codes stay text and may be unpadded."""
    return read_wide(spark, path)


def read_agencies(spark: SparkSession, path: str) -> DataFrame:
    """Transit operator to metro area list with padded codes."""
    return read_wide(spark, path).withColumns({c: pad_left(c, 5) for c in ("NTDID", "UACE")})


def read_housing_forecast(spark: SparkSession, path: str) -> DataFrame:
    """Yearly housing units with an observed and a forecast column, either may be blank."""
    wide = read_wide(spark, path)
    return wide.select(
        F.col("Year").try_cast("int").alias("Year"),
        to_number("Observed").alias("Observed"),
        to_number("Forecast").alias("Forecast"),
    )


def read_acs(spark: SparkSession, path: str, tables: Iterable[str], years: Iterable[int]) -> DataFrame:
    """Census estimates landed by ``acs_table`` and ``year``; other folders are not read."""
    landed = spark.read.parquet(path)
    return landed.filter(F.col("acs_table").isin(*tables) & F.col("year").isin(*years))


def read_acs_by_lookup(spark: SparkSession, path: str, lookup: DataFrame) -> DataFrame:
    """Census estimates of the tables that ``lookup`` (variable, ...) names, landed by ``acs_table`` and ``year``.

    The names are found while the query runs: if the lookup is small enough to broadcast, Spark prunes the
    folders by it (dynamic partition pruning) before it opens a file; otherwise the rows are joined.
    """
    tables = lookup.select(F.substring_index("variable", "_", 1).alias("acs_table")).distinct()
    return spark.read.parquet(path).join(tables, "acs_table", "left_semi")


def read_sheets(
    spark: SparkSession, paths: Mapping[str, str], tag: str = "sheet", header: int | Sequence[str] = 1
) -> DataFrame:
    """Sheets landed as one CSV (or folder) each, tagged with the sheet name; columns may differ. One scan reads them all."""
    tags = landed.file_tags(spark, paths)
    return landed.read_landed(spark, list(paths.values()), header, tags, tag)


def read_transit(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Monthly transit sheets with tidy id names; month columns keep their header."""
    wide = read_sheets(spark, paths, "metric").drop(*TRANSIT_UNUSED)
    return wide.withColumnsRenamed(TRANSIT_IDS)


def file_key(start: int, length: int, prefix: str = "") -> Column:
    """Part of the name of the file a row was read from, counted from 1."""
    return F.concat(F.lit(prefix), F.substring("_metadata.file_name", start, length))


def read_by_filename(
    spark: SparkSession,
    path: str,
    positions: Sequence[int],
    names: Sequence[str],
    key_start: int,
    key_length: int,
    prefix: str = "",
    header: int | Sequence[str] = 1,
) -> DataFrame:
    """Many files in one read: columns picked by position, a key taken from the file name.

    Positions and key start count from 1, as in the publishers' layouts; a position counts in each file's own header.
    """
    key = F.concat(F.lit(prefix), F.substring("name", key_start, key_length))
    return landed.read_positions(spark, path, positions, names, key, header)


def read_table(spark: SparkSession, name: str, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """A warehouse table: from the catalog, or over JDBC when options are given.

    For a large JDBC table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` so that executors read it in parallel.
    """
    if jdbc is None:
        return spark.table(name)
    return spark.read.format("jdbc").options(**jdbc).option("dbtable", name).load()
