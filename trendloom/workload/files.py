"""Queries over landed files: the tables' rows are written as the publishers' files and read back by the readers."""

from __future__ import annotations

import csv
import datetime as dt
import io
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendloom.operators import periods
from trendloom.plans import airport, census, population, transit
from trendloom.session import stage, stage_path
from trendloom.sources import landed, readers
from trendloom.sources.lookups import ACS_TOPICS
from trendloom.workload import plans, views
from trendloom.workload.views import table, view

QUERIES: dict = {}
CHECKS: dict[str, str] = {}

#: Lines of a landed file, about.
FILE_LINES = 1 << 19


def registered(check: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        CHECKS[fn.__name__] = check
        return fn

    return add


def _line(cells: Sequence[str]) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(cells)
    return out.getvalue()


def _lines(df: DataFrame, key: Column, above: Sequence[str] = (), header: Sequence[str] | None = None) -> DataFrame:
    """key, place and line: rows as CSV, and for each key the lines above and the header before them."""
    body = df.select(key.alias("key"), F.lit(0).alias("place"), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("line"))
    first = [*above, _line(header or df.columns)]
    tops = F.array(*[F.struct(F.lit(i - len(first)).alias("place"), F.lit(t).alias("line")) for i, t in enumerate(first)])
    return body.union(body.select("key").distinct().select("key", F.inline(tops)))


def _land(spark: SparkSession, lines: DataFrame, name: str) -> str:
    """Text files of about ``FILE_LINES`` lines, with the key in their names; the folder they are in.

    A key with more lines gets several files, each with the lines above the header and the header, so no task holds a whole key. Lines are
    dealt by their place in the staged files, which equal lines do not share and a repeated task finds again.
    """
    path, staged = stage_path(spark), stage(lines)
    counts = stage(staged.filter("place = 0").groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    files = counts.select(F.col("key").alias("of"), F.ceil(F.col("n") / FILE_LINES).cast("int").alias("files"))
    tasks = -(-(counts.agg(F.sum("n")).first()[0] or 1) // FILE_LINES)
    placed = staged.select("*", F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("row"))
    part = F.when(F.col("place") < 0, F.sequence(F.lit(0), F.col("files") - 1)).otherwise(F.array(F.pmod("row", "files").cast("int")))
    # One row per key, of which the driver renames the files below.
    dealt = placed.join(F.broadcast(files), F.col("key").eqNullSafe(F.col("of"))).select("key", "place", "line", F.explode(part).alias("part"))
    sorted_ = dealt.repartition(tasks, "key", "part").sortWithinPartitions("key", "part", "place")
    sorted_.select("key", "part", "line").write.partitionBy("key", "part").text(path + "/parts")
    hadoop = spark._jvm.org.apache.hadoop.fs
    parts = hadoop.Path(path + "/parts")
    system = parts.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(path + "/files"))
    stem, dot, kind = name.rpartition(".")
    for status in system.globStatus(hadoop.Path(path + "/parts/key=*/part=*/part-*")):
        folder = status.getPath().getParent()
        number, key = folder.getName().removeprefix("part="), folder.getParent().getName().removeprefix("key=")
        file = stem.format(key) + ("" if number == "0" else f"-{number}") + dot + kind
        system.rename(status.getPath(), hadoop.Path(f"{path}/files/{file}"))
    return path + "/files"


@registered(plans.CHECKS["population_trends"])
def population_from_files(spark, sf):
    """The four vintages from one file each; the newest has its header at line 5, found by its names."""
    listed = views.years(spark, sf, "orders")
    vintages = [
        ("1990s", listed[0], 1997, 1997, []),
        ("intercensal", 1997, 1999, 1999, []),
        ("intercensal", 1999, 2000, 2000, ["Intercensal Estimates"]),
        ("latest", 2000, listed[-1], None, ["Office of Financial Management", "", "Estimates of April 1", "Filter,,,"]),
    ]
    segments = []
    for i, (layout, first, last, boundary, above) in enumerate(vintages):
        wide = views.population_wide(spark, sf, layout, first, last)
        path = _land(spark, _lines(wide, F.lit(f"v{i}"), above), "population-{}.csv")
        names = ["Filter", "County" if layout == "latest" else "County.Name"]
        segments.append(population.population_segment(readers.read_wide(spark, path, names), layout, boundary_year=boundary))
    forecast = view(spark, sf, "forecast_facts").withColumnsRenamed({"group_id": "pop_group_dim_id", "amount": "population"})
    return population.population_trends(segments, view(spark, sf, "jurisdictions"), forecast, forecast_after=1996)


@registered(plans.CHECKS["housing_trends"])
def housing_from_files(spark, sf):
    """Housing units from a file with its header at line 4, the forecast from another."""
    wide = _land(spark, _lines(views.housing_wide(spark, sf), F.lit("units"), ["Housing Units", ",,,", "April 1"]), "housing-{}.csv")
    facts = view(spark, sf, "forecast_facts").filter("group_id = 7")
    rows = facts.select(F.col("data_year").alias("Year"), F.lit(None).cast("string").alias("Observed"), F.col("amount").alias("Forecast"))
    forecast = _land(spark, _lines(rows, F.lit("housing")), "regional-{}.csv")
    return population.housing_trends(
        readers.read_wide(spark, wide, 4), view(spark, sf, "jurisdictions"), readers.read_housing_forecast(spark, forecast)
    )


@registered(plans.CHECKS["airport_national_passengers"])
def airport_national_files(spark, sf):
    """Yearly files of two layouts: from 1999 on with other names, one more column and a title line."""
    rows = view(spark, sf, "airport_national")
    early = ["Rank", "RO", "ST", "Locid", "Airport Name", "City", "S/L", "Hub", "CY Enplanements"]
    late = [*early[:5], "Metro Area", *early[6:8], "Boarded", "% Change"]
    empty = F.lit("x, y")

    def cells(columns: list[str]) -> DataFrame:
        found = {6: F.col("geography"), 9: F.col("estimate")}
        return rows.filter((F.col("file_key") >= "1999") == (columns is late)).select(
            F.col("file_key").alias("key"), *[found.get(i + 1, empty).alias(f"c{i}") for i in range(len(columns))]
        )

    lines = [
        _lines(cells(columns), F.col("key"), above, ["key", *columns])
        for columns, above in ((early, []), (late, ["Enplanements at All Airports"]))
    ]
    path = _land(spark, lines[0].union(lines[1]), "cy{}-enplanements.csv")
    # The key's own column comes first, so places are one further on.
    national = readers.read_by_filename(spark, path, [7, 10], ["geography", "estimate"], 3, 4, header=["Rank", "Hub"])
    return airport.airport_national(national, "passengers", yr1=1996)


def _airport_months(spark, sf) -> str:
    """One file a month with its header at line 4, as the airport publishes them."""
    rows = view(spark, sf, "airport_rows").select("variable", F.lit(None).cast("string").alias("unused"), "estimate", F.col("month_key").alias("key"))
    lines = _lines(rows, F.col("key"), ["Sea-Tac", "", "Activity"], ["Category", "", "Estimate", "key"])
    return _land(spark, lines, "traf-ops-{}.csv")


@registered(plans.CHECKS["airport_monthly"])
def airport_month_files(spark, sf):
    """Columns 1 and 3 of every month's file, the month from its name."""
    rows = readers.read_by_filename(spark, _airport_months(spark, sf), [1, 3], ["variable", "estimate"], 10, 6, header=4)
    return airport.airport_monthly(rows.withColumnRenamed("file_key", "month_key"), plans._AS_OF, yr1=1996)


@registered("""
    WITH e AS (SELECT min(date_trunc('month', o_orderdate)) AS first, max(date_trunc('month', o_orderdate)) AS last FROM {orders}),
    s AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 MONTH)) AS DATE) AS date FROM e)
    SELECT date, lpad(CAST(month(date) AS STRING), 2, '0') || CAST(year(date) AS STRING) AS month_key FROM s
    WHERE month(date) = 3 AND year(date) % 2 = 1 OR date NOT IN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM {orders})
""")
def missing_month_files(spark, sf):
    """Orders landed by month, without March of odd years: the listing of files shows what is missing."""
    orders = table(spark, sf, "orders")
    day = F.col("o_orderdate")
    kept = orders.filter((F.month(day) != 3) | (F.year(day) % 2 == 0)).select("o_orderkey", F.date_format(day, "MMyyyy").alias("key"))
    path = _land(spark, _lines(kept, F.col("key")), "orders-{}.csv")
    first, last = orders.agg(F.min(F.trunc(day, "month")), F.max(F.trunc(day, "month"))).first()
    if first is None:
        first, last = dt.date(1970, 1, 1), dt.date(1969, 12, 31)
    return landed.missing_month_files(spark, path, periods.expected_months(spark, first, last), 8, 6).select("date", "month_key")


@registered(plans.CHECKS["acs_indicator"])
def acs_from_files(spark, sf):
    """Labels and counties, with unpadded codes, from files."""
    labels = spark.createDataFrame([(*row, f"{row[1]}: all") for row in ACS_TOPICS["commute-modes"]], "variable string, simple_label string, label string")
    lookup = readers.read_lookup(spark, _land(spark, _lines(labels, F.lit("modes")), "commute-{}.csv"), "commute-modes")
    counties = readers.read_counties(spark, _land(spark, _lines(view(spark, sf, "acs_counties"), F.lit("counties")), "{}.csv"))
    cells, metro = view(spark, sf, "acs_estimates"), view(spark, sf, "acs_metro")
    return census.acs_indicator(cells, metro, counties, views.years(spark, sf, "lineitem"), lookup=lookup)


@registered(plans.CHECKS["transit_trends"])
def transit_from_files(spark, sf):
    """Three sheets in one scan, and the operators' list with unpadded codes."""
    wide = views.transit_wide(spark, sf)
    names = {n: header for header, n in readers.TRANSIT_IDS.items()}
    wide = wide.select(F.col("metric").alias("key"), *[F.col(f"`{c}`").alias(names.get(c, c)) for c in wide.columns if c != "metric"])
    path = _land(spark, _lines(wide, F.col("key")), "{}.csv")
    agencies = view(spark, sf, "agencies").select("NTDID", F.lit("80389").alias("UACE"), "MPO_AREA", "AGENCY_NAME")
    operators = readers.read_agencies(spark, _land(spark, _lines(agencies, F.lit("agency")), "transit-{}.csv"))
    sheets = readers.read_transit(spark, {m: f"{path}/{m}*.csv" for m in ("UPT", "VRM", "VRH")})
    return transit.transit_trends(sheets.drop("key"), operators, home_area="ASIA")


@registered("""
    SELECT 'rows' AS kind, county AS name, CAST(count(*) AS BIGINT) AS n, sum(transactions) AS quantity FROM {titles} GROUP BY county
    UNION ALL SELECT 'set aside', 'number of cells', CAST(count(*) AS BIGINT), NULL FROM {supplier}
    UNION ALL SELECT 'set aside', 'no number: transactions', CAST(count(*) AS BIGINT), NULL FROM {customer}
""")
def csv_titles_set_aside(spark, sf):
    """Title files of two orders of columns, with lines cut short, lines too long and counts that are no numbers."""
    headers = {name: header for header, name in readers.TITLE_HEADERS.items()}
    titles = view(spark, sf, "titles")
    shuffled = sorted(titles.columns)
    old = F.col("transaction_month").rlike("199[0-9]$")
    parts = [
        _lines(titles.filter(old).select(*shuffled), F.lit("old"), header=[headers[c] for c in shuffled]),
        _lines(titles.filter(~old), F.lit("new"), header=[headers[c] for c in titles.columns]),
        table(spark, sf, "supplier").select(
            F.lit("new"), F.lit(0), F.when(F.col("s_suppkey") % 2 == 0, "1/1/2001,New").otherwise("1/1/2001,New,Original Title,BEV,A,King,1,2,3")
        ),
        table(spark, sf, "customer").select(F.lit("new"), F.lit(0), F.concat(F.lit("1/1/2001,New,Original Title,BEV,A,King,1,n"), "c_custkey")),
    ]
    found = readers.titles_set_aside(spark, _land(spark, parts[0].union(parts[1]).union(parts[2]).union(parts[3]), "titles-{}.csv"))
    quarantine = stage_path(spark)
    landed.write_quarantine(found, quarantine)
    aside = spark.read.schema(found.malformed.schema).parquet(quarantine)
    kept = found.rows.groupBy("county").agg(F.count("*").alias("n"), F.sum("transactions").alias("quantity"))
    return union_all(
        kept.select(F.lit("rows").alias("kind"), F.col("county").alias("name"), "n", "quantity"),
        aside.groupBy("reason").agg(F.count("*").alias("n")).select(
            F.lit("set aside").alias("kind"), F.col("reason").alias("name"), "n", F.lit(None).cast("double").alias("quantity")
        ),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, by column name."""
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


@registered("""
    SELECT 'rows' AS kind, county AS name, CAST(count(*) AS BIGINT) AS n FROM {registrations} GROUP BY county
    UNION ALL SELECT 'set aside', 'no record', CAST(count(*) AS BIGINT) FROM {supplier}
""")
def json_registrations_set_aside(spark, sf):
    """JSON lines with lines that are cut off."""
    path = stage_path(spark)
    good = view(spark, sf, "registrations").select(F.to_json(F.struct("*")).alias("line"))
    cut = table(spark, sf, "supplier").select(F.concat(F.lit('{"state": "WA", "county": "'), "s_name").alias("line"))
    good.union(cut).write.text(path)
    found = readers.registrations_set_aside(spark, path)
    return union_all(
        found.rows.groupBy("county").agg(F.count("*").alias("n")).select(F.lit("rows").alias("kind"), F.col("county").alias("name"), "n"),
        found.malformed.groupBy("reason").agg(F.count("*").alias("n")).select(F.lit("set aside").alias("kind"), F.col("reason").alias("name"), "n"),
    )
