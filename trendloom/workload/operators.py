"""One query per reusable operator, each with the SQL that checks it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendloom.functions import dates, nulls, numbers, text
from trendloom.operators import aggregate, joins, periods, reshape, series
from trendloom.plans import airport, census, population, transit
from trendloom.schema import conform, union_trends
from trendloom.session import shared_folder
from trendloom.sources import readers, sink
from trendloom.sources.lookups import acs_lookup
from trendloom.workload.views import FIRST_YEAR, LAST_YEAR, query, table, view, years

CENTS = "decimal(18,2)"

# The null-aware sum, spelled out for the SQL checks.
NA_SUM = "CASE WHEN count({0}) = count(*) THEN sum({0}) END"

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def registered(check: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if check is not None:
            CHECKS[fn.__name__] = check
        return fn

    return add


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of this application in the shared folder."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}"


def _double(df: DataFrame) -> DataFrame:
    return df.withColumn("estimate", F.col("estimate").cast("double"))


def _order_years(spark, sf, *more) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), F.col("o_totalprice").cast(CENTS).alias("price"), *more
    )


# --- sums, roll-ups -----------------------------------------------------------------


@registered(f"""
    SELECT CAST(year(l_shipdate) AS BIGINT) AS year, l_returnflag,
           {NA_SUM.format("l_quantity")} AS quantity,
           {NA_SUM.format("CASE WHEN l_quantity < 50 OR l_tax > 0 THEN l_quantity END")} AS poisoned
    FROM {{lineitem}} GROUP BY 1, 2
""")
def sum_by_keys(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("bigint").alias("year"),
        "l_returnflag",
        F.col("l_quantity").alias("quantity"),
        F.when((F.col("l_quantity") < 50) | (F.col("l_tax") > 0), F.col("l_quantity")).alias("poisoned"),
    )
    return aggregate.sum_by(rows, ["year", "l_returnflag"], "quantity", "poisoned")


@registered("""
    SELECT l_linestatus, sum(l_quantity) AS l_quantity, CAST(sum(l_linenumber) AS DOUBLE) AS l_linenumber
    FROM {lineitem} GROUP BY l_linestatus
""")
def sum_rest(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_linestatus", "l_quantity", F.col("l_linenumber").cast("double")
    )
    return aggregate.sum_rest(rows, ["l_linestatus"])


@registered("""
    SELECT l_returnflag, CAST(trunc(sum(l_quantity + 0.25)) AS BIGINT) AS quantity
    FROM {lineitem} GROUP BY l_returnflag
""")
def whole_number_sum(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_quantity") + F.lit(0.25)).alias("quantity")
    )
    return aggregate.sum_whole(rows, ["l_returnflag"], "quantity")


_NATION_PRICES = """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, r_name, n_name AS geography,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS estimate
    FROM {orders} JOIN {customer} ON o_custkey = c_custkey
         JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    GROUP BY 1, 2, 3
"""


@registered(f"""
    WITH p AS ({_NATION_PRICES})
    SELECT date, r_name, geography, CAST(estimate AS DOUBLE) AS estimate FROM p
    UNION ALL
    SELECT date, r_name, 'Region' AS geography, CAST(sum(estimate) AS DOUBLE) AS estimate
    FROM p WHERE geography <> 'NATION_3' GROUP BY date, r_name
""")
def region_rollup(spark, sf):
    prices = query(spark, sf, _NATION_PRICES)
    members = nulls.not_in("geography", ["NATION_3"])
    rolled = aggregate.region_rollup(prices, ["date", "r_name"], members=members)
    return _double(rolled)


@registered("""
    WITH b AS (
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, r_name, n_name, o_orderpriority
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
    )
    SELECT 'total' AS level, date, NULL AS r_name, NULL AS n_name, NULL AS o_orderpriority,
           CAST(count(*) AS BIGINT) AS estimate FROM b GROUP BY date
    UNION ALL
    SELECT 'region', date, r_name, NULL, NULL, count(*) FROM b GROUP BY date, r_name
    UNION ALL
    SELECT 'region priority', date, r_name, NULL, o_orderpriority, count(*) FROM b GROUP BY date, r_name, o_orderpriority
    UNION ALL
    SELECT 'nation', date, r_name, n_name, NULL, count(*) FROM b GROUP BY date, r_name, n_name
    UNION ALL
    SELECT 'nation priority', date, r_name, n_name, o_orderpriority, count(*) FROM b GROUP BY date, r_name, n_name, o_orderpriority
""")
def multilevel_rollup(spark, sf):
    counts = query(spark, sf, """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, r_name, n_name, o_orderpriority,
               count(*) AS estimate
        FROM {orders} JOIN {customer} ON o_custkey = c_custkey
             JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3, 4
    """)
    return aggregate.grouped_levels(
        counts,
        ["date"],
        {
            "total": [],
            "region": ["r_name"],
            "region priority": ["r_name", "o_orderpriority"],
            "nation": ["r_name", "n_name"],
            "nation priority": ["r_name", "n_name", "o_orderpriority"],
        },
    )


# --- shares and series --------------------------------------------------------------


@registered("""
    WITH g AS (SELECT l_returnflag, l_linestatus, sum(l_quantity) AS estimate FROM {lineitem} GROUP BY 1, 2)
    SELECT l_returnflag, l_linestatus, estimate,
           estimate / NULLIF(sum(estimate) OVER (PARTITION BY l_returnflag), 0) AS share FROM g
""")
def share_of_total(spark, sf):
    rows = table(spark, sf, "lineitem").withColumnRenamed("l_quantity", "estimate")
    grouped = aggregate.sum_by(rows, ["l_returnflag", "l_linestatus"])
    return series.share_of_total(grouped, ["l_returnflag"])


@registered("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
           l_quantity / NULLIF(sum(l_quantity) OVER (PARTITION BY l_returnflag), 0) AS share
    FROM {lineitem}
""")
def share_of_total_rows(spark, sf):
    """Every line item's share of its return flag: groups of a third of all rows."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_quantity"
    )
    return series.share_of_total(rows, ["l_returnflag"], "l_quantity", staged=True).drop("l_returnflag")


@registered("""
    WITH g AS (
        SELECT CAST(year(o_orderdate) AS BIGINT) AS year, o_orderpriority AS label, count(*) AS n FROM {orders} GROUP BY 1, 2
        UNION ALL
        SELECT CAST(year(o_orderdate) AS BIGINT), 'Total', count(*) FROM {orders}
        WHERE o_orderstatus <> 'P' GROUP BY 1
    )
    SELECT g.year, label, CAST(g.n AS BIGINT) AS estimate, g.n / NULLIF(t.n, 0) AS share
    FROM g LEFT JOIN (SELECT year, n FROM g WHERE label = 'Total') t ON g.year = t.year
""")
def share_of_label(spark, sf):
    orders = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    parts = orders.groupBy("year", F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("estimate"))
    total = orders.filter("o_orderstatus <> 'P'").groupBy("year").agg(F.count("*").alias("estimate"))
    both = parts.unionByName(total.withColumn("label", F.lit("Total")))
    return series.share_of_label(both, ["year"], "label")


@registered("""
    WITH w AS (
        SELECT CAST(year(o_orderdate) AS BIGINT) AS year,
               CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) AS f,
               CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) AS o,
               CAST(count(*) AS DOUBLE) AS a
        FROM {orders} GROUP BY 1
    )
    SELECT year, 'Filled' AS variable, f AS estimate, f / NULLIF(a, 0) AS share FROM w
    UNION ALL SELECT year, 'Open', o, o / NULLIF(a, 0) FROM w
    UNION ALL SELECT year, 'All', a, 1.0 FROM w
""")
def wide_shares(spark, sf):
    wide = (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").cast("bigint").alias("year"))
        .agg(
            F.count_if(F.col("o_orderstatus") == "F").alias("f"),
            F.count_if(F.col("o_orderstatus") == "O").alias("o"),
            F.count("*").alias("a"),
        )
    )
    return series.wide_shares(wide, ["year"], {"f": "Filled", "o": "Open", "a": "All"}, "a")


_YEAR_TOTALS = """
    SELECT o_orderpriority, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(count(*) AS DOUBLE) AS estimate
    FROM {orders} GROUP BY 1, 2
"""


@registered(f"""
    SELECT o_orderpriority, year, estimate,
           estimate - lag(estimate) OVER (PARTITION BY o_orderpriority ORDER BY year) AS change
    FROM ({_YEAR_TOTALS}) t
""")
def lag_change(spark, sf):
    return series.lag_change(query(spark, sf, _YEAR_TOTALS), ["o_orderpriority"], "year")


@registered(f"""
    WITH t AS (SELECT *, estimate - lag(estimate) OVER (PARTITION BY o_orderpriority ORDER BY year) AS d
               FROM ({_YEAR_TOTALS}) y)
    SELECT o_orderpriority, year, 'Orders' AS metric, 'Annual' AS grouping, estimate FROM t
    UNION ALL
    SELECT o_orderpriority, year, 'Orders', 'Change', d FROM t WHERE d IS NOT NULL
""")
def level_and_change(spark, sf):
    return series.level_and_change(
        query(spark, sf, _YEAR_TOTALS), ["o_orderpriority"], "year", {"estimate": "Orders"}
    )


_FORECAST = """
    SELECT year(o_orderdate) AS y, CAST(count(*) AS DOUBLE) AS n FROM {orders} GROUP BY 1
"""
_FORECAST_CHECK = f"""
    WITH t AS (SELECT y, n, n - lag(n) OVER (ORDER BY y) AS d FROM ({_FORECAST}) f)
    SELECT CAST(y AS STRING) AS year, make_date(y, 4, 1) AS date, 'Region' AS geography,
           'Region' AS geography_type, 'Forecast' AS variable, 'Annual' AS grouping, 'Orders' AS metric,
           n AS estimate, CAST(NULL AS DOUBLE) AS share, CAST(NULL AS DOUBLE) AS moe FROM t %s
    UNION ALL
    SELECT CAST(y AS STRING), make_date(y, 4, 1), 'Region', 'Region', 'Forecast', 'Change', 'Orders', d, NULL, NULL
    FROM t WHERE d IS NOT NULL
"""


@registered(_FORECAST_CHECK % "WHERE d IS NOT NULL")
def forecast_series(spark, sf):
    return conform(series.forecast_series(query(spark, sf, _FORECAST), "y", "n", "Orders"))


@registered(_FORECAST_CHECK % "")
def forecast_series_keep_first(spark, sf):
    return conform(series.forecast_series(query(spark, sf, _FORECAST), "y", "n", "Orders", drop_first=False))


# --- periods ------------------------------------------------------------------------

_ORDER_MONTHS = """
    SELECT o_orderpriority AS variable, CAST(o_orderdate AS DATE) AS date,
           CAST(o_totalprice AS DECIMAL(18,2)) AS estimate FROM {orders}
"""
_ANNUAL = """
    SELECT variable, CAST(year(date) AS STRING) AS year, CAST(sum(estimate) AS DOUBLE) AS estimate,
           'Annual' AS grouping, make_date(year(date), 12, 1) AS date
    FROM m WHERE year(date) <= (SELECT CASE month(max(date)) WHEN 12 THEN year(max(date)) ELSE year(max(date)) - 1 END FROM m)
    GROUP BY variable, year(date)
"""
_YTD = """
    SELECT variable, CAST(year(date) AS STRING) AS year, CAST(sum(estimate) AS DOUBLE) AS estimate,
           'YTD' AS grouping, make_date(year(date), (SELECT month(max(date)) FROM m), 1) AS date
    FROM m WHERE {condition} GROUP BY variable, year(date)
"""
_TO_CUTOFF = "month(date) <= (SELECT month(max(date)) FROM m)"


@registered(f"WITH m AS ({_ORDER_MONTHS}) {_ANNUAL}")
def annual_complete_years(spark, sf):
    return _double(periods.annual_summary(query(spark, sf, _ORDER_MONTHS), ["variable"]))


@registered(f"WITH m AS ({_ORDER_MONTHS}) {_YTD.format(condition=_TO_CUTOFF)}")
def ytd(spark, sf):
    return _double(periods.ytd_summary(query(spark, sf, _ORDER_MONTHS), ["variable"]))


@registered(f"WITH m AS ({_ORDER_MONTHS}) {_YTD.format(condition='TRUE')}")
def ytd_unfiltered(spark, sf):
    return _double(
        periods.ytd_summary(query(spark, sf, _ORDER_MONTHS), ["variable"], filter_months=False)
    )


@registered(
    f"WITH m AS ({_ORDER_MONTHS}) {_ANNUAL} "
    f"UNION ALL {_YTD.format(condition=_TO_CUTOFF)}"
)
def annual_and_ytd(spark, sf):
    months = query(spark, sf, _ORDER_MONTHS)
    newest = months.agg(F.max("date").alias("newest"))
    both = periods.period_summary(
        months,
        ["variable"],
        complete_through=newest.select(dates.last_complete_year("newest")).scalar(),
        cutoff_month=newest.select(F.month("newest")).scalar(),
    )
    return _double(both)


@registered("""
    WITH b AS (SELECT c_mktsegment AS grouping, CAST(o_orderdate AS DATE) AS d
               FROM {orders} JOIN {customer} ON o_custkey = c_custkey),
         m AS (SELECT year(d) AS y, max(month(d)) AS mm FROM b GROUP BY 1),
         g AS (SELECT year(d) AS y, grouping, CAST(count(*) AS BIGINT) AS estimate FROM b GROUP BY 1, 2)
    SELECT CAST(g.y AS BIGINT) AS year, grouping, estimate, make_date(g.y, m.mm, 1) AS date
    FROM g LEFT JOIN m ON g.y = m.y
""")
def latest_month_stamp(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    segments = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("grouping"))
    counts = (
        joins.lookup_join(orders, segments, "o_custkey", "c_custkey")
        .filter(F.col("grouping").isNotNull())
        .groupBy(F.year("date").alias("year"), "grouping")
        .agg(F.count("*").alias("estimate"))
    )
    stamped = periods.stamp_latest_month(counts, periods.latest_month_by_year(orders))
    return stamped.withColumn("year", F.col("year").cast("bigint"))


@registered("""
    WITH v AS (SELECT max(l_linenumber) AS newest FROM {lineitem})
    SELECT CAST(year(l_shipdate) AS BIGINT) AS year, CAST(count(*) AS BIGINT) AS n, sum(l_quantity) AS quantity
    FROM {lineitem} CROSS JOIN v
    WHERE year(l_shipdate) < 1998 OR l_linenumber = newest GROUP BY 1
""")
def latest_vintage(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("bigint").alias("year"), "l_linenumber", F.lit(1).cast("bigint").alias("n"), F.col("l_quantity").alias("quantity")
    )
    return aggregate.latest_vintage_sums(rows, [], "year", "l_linenumber", 1998, "n", "quantity")


@registered(f"""
    WITH s AS (
        SELECT CAST(unnest(generate_series(TIMESTAMP '{FIRST_YEAR}-01-01', TIMESTAMP '{LAST_YEAR}-12-01', INTERVAL 1 MONTH)) AS DATE) AS date
    )
    SELECT date, lpad(CAST(month(date) AS STRING), 2, '0') || CAST(year(date) AS STRING) AS month_key
    FROM s WHERE date NOT IN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM {{orders}})
""")
def expected_months(spark, sf):
    first, last = dt.date(FIRST_YEAR, 1, 1), dt.date(LAST_YEAR, 12, 1)
    return periods.missing_months(table(spark, sf, "orders"), first, last, "o_orderdate")


@registered("""
    WITH s AS (
        SELECT CAST(unnest(generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS DATE) AS date
    ), k AS (
        SELECT date, lpad(CAST(month(date) AS STRING), 2, '0') || CAST(year(date) AS STRING) AS month_key FROM s
    )
    SELECT date, month_key FROM k WHERE month_key NOT IN (SELECT month_key FROM {airport_rows})
""")
def airport_missing_months(spark, sf):
    return airport.missing_airport_months(view(spark, sf, "airport_rows"), dt.date(2002, 2, 10), yr1=1996)


# --- reshape ------------------------------------------------------------------------

_MEASURES = """
    SELECT l_orderkey, l_linenumber, 'l_quantity' AS measure, l_quantity AS estimate FROM {lineitem} %s
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM {lineitem} %s
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'discount', NULLIF(l_discount, 0) FROM {lineitem} %s
"""


def _measures(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
    )


@registered(_MEASURES.replace("%s", ""))
def melt(spark, sf):
    return reshape.melt(_measures(spark, sf), ["l_orderkey", "l_linenumber"], name_to="measure")


@registered(_MEASURES % ("", "", "WHERE l_discount <> 0"))
def melt_dropna(spark, sf):
    return reshape.melt(
        _measures(spark, sf), ["l_orderkey", "l_linenumber"], name_to="measure", drop_null=True
    )


@registered("""
    SELECT p_brand, variable, year, sum(q) AS estimate FROM (
        SELECT p_brand, 'Quantity' AS variable, year(l_shipdate) AS y, CAST(year(l_shipdate) AS STRING) AS year, l_quantity AS q
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
    ) t GROUP BY p_brand, variable, year
""")
def melt_headers(spark, sf):
    listed = list(years(spark, sf, "lineitem"))
    wide = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("l_year", F.year("l_shipdate"))
        .groupBy("p_brand")
        .pivot("l_year", listed)
        .agg(F.sum("l_quantity"))
    )
    wide = wide.withColumnsRenamed({str(y): f"{y}.Total.Quantity" for y in listed})
    return reshape.melt_headers(
        wide,
        ["p_brand"],
        reshape.columns_containing(wide, "quantity"),
        lambda h: {"variable": h.split(".")[2], "year": h.split(".")[0]},
        drop_null=True,
    )


@registered("""
    SELECT CAST(ts AS DATE) AS day, CAST(NULLIF(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END), 0) AS BIGINT) AS click,
           CAST(NULLIF(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END), 0) AS BIGINT) AS view
    FROM {events} GROUP BY 1
""")
def pivot_metrics(spark, sf):
    """Two rows a cell, so that a cell that kept only one of them would show."""
    twice = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day"), "event_type", (F.col("user_id") % 2).alias("half"))
    return reshape.spread(twice.agg(F.count("*").alias("n")), ["day"], "event_type", ["click", "view"], "n")


def _daily_events(spark, sf) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(F.count("*").alias("n"))
    )


@registered("""
    WITH d AS (SELECT CAST(ts AS DATE) AS day, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS c,
                      sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS v FROM {events} GROUP BY 1)
    SELECT day, CASE WHEN v > 0 AND c > 0 THEN round_even(c / v, 2) END AS ratio FROM d
""")
def guarded_ratio(spark, sf):
    wide = reshape.spread(_daily_events(spark, sf), ["day"], "event_type", ["purchase", "view"], "n")
    return wide.select("day", numbers.guarded_ratio("purchase", "view").alias("ratio"))


@registered("""
    SELECT CAST(year(o_orderdate) AS BIGINT) AS year,
           CAST(count(*) AS BIGINT) AS region_orders,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS inside,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS BIGINT) AS outside
    FROM {orders} GROUP BY 1
""")
def complement_category(spark, sf):
    wide = (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").cast("bigint").alias("year"))
        .agg(F.count("*").alias("region_orders"), F.count_if(F.col("o_orderstatus") == "F").alias("inside"))
    )
    return series.complement(wide, "region_orders", "inside", "outside")


@registered("""
    WITH r AS (
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, o_orderpriority AS label, count(*) AS n
        FROM {orders} GROUP BY 1, 2
        UNION ALL
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE), 'All', count(*) FROM {orders} GROUP BY 1
    )
    SELECT date, 'Other' AS label,
           CAST(sum(CASE WHEN label = 'All' THEN n END) - sum(CASE WHEN label IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN n END) AS BIGINT) AS estimate
    FROM r GROUP BY date
""")
def residual_category(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.trunc("o_orderdate", "month").alias("date"), F.col("o_orderpriority").alias("label")
    )
    parts = orders.groupBy("date", "label").agg(F.count("*").alias("estimate"))
    total = orders.groupBy("date").agg(F.count("*").alias("estimate")).withColumn("label", F.lit("All"))
    return aggregate.residual_category(
        parts.unionByName(total), ["date"], "label", "All", ["1-URGENT", "2-HIGH", "3-MEDIUM"], "Other"
    )


# --- margins of error ---------------------------------------------------------------

_MOE_ROWS = """
    SELECT s_nationkey, l_linenumber,
           CASE WHEN l_linenumber = 7 AND l_quantity = 1 THEN NULL WHEN l_discount = 0 THEN 0.0 ELSE l_quantity END AS estimate,
           round(l_tax * 100) AS moe
    FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
"""


@registered(f"""
    SELECT s_nationkey, l_linenumber, CASE WHEN NOT bool_or(estimate IS NULL) THEN sum(estimate) END AS estimate,
           CASE WHEN bool_or(estimate IS NULL) THEN NULL WHEN sum(estimate) = 0 THEN max(moe)
                ELSE sqrt(sum(moe * moe)) END AS moe
    FROM ({_MOE_ROWS}) t GROUP BY 1, 2
""")
def moe_sum_total(spark, sf):
    return aggregate.moe_sum(query(spark, sf, _MOE_ROWS), ["s_nationkey", "l_linenumber"])


@registered(f"""
    SELECT s_nationkey, l_linenumber, CASE WHEN NOT bool_or(estimate IS NULL) THEN sum(estimate) END AS estimate,
           CASE WHEN NOT bool_or(estimate IS NULL) THEN sqrt(coalesce(sum(CASE WHEN estimate <> 0 THEN moe * moe END), 0)
                + coalesce(max(CASE WHEN estimate = 0 THEN moe END) * max(CASE WHEN estimate = 0 THEN moe END), 0)) END AS moe
    FROM ({_MOE_ROWS}) t GROUP BY 1, 2
""")
def moe_sum_per_row(spark, sf):
    return aggregate.moe_sum(
        query(spark, sf, _MOE_ROWS), ["s_nationkey", "l_linenumber"], mode="per_row"
    )


# Every brand but the last carries a label.
_BRAND_LABELS = {
    f"Brand#{number}": label
    for label, first, last in (("Total", 1, 1), ("Low", 2, 9), ("Mid", 10, 17), ("High", 18, 24))
    for number in range(first, last + 1)
}


@registered(f"""
    WITH l(variable, label) AS (VALUES {", ".join(f"('{b}', '{l}')" for b, l in _BRAND_LABELS.items())})
    SELECT l_returnflag, label, sum(l_quantity) AS estimate, sqrt(sum(round(l_tax * 100) * round(l_tax * 100))) AS moe
    FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey JOIN l ON p_brand = variable GROUP BY 1, 2
""")
def label_and_consolidate(spark, sf):
    lookup = F.broadcast(spark.createDataFrame(list(_BRAND_LABELS.items()), "variable string, simple_label string"))
    cells = query(spark, sf, """
        SELECT l_returnflag, p_brand AS variable, l_quantity AS estimate, round(l_tax * 100) AS moe
        FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
    """)
    return census.label_and_consolidate(cells, lookup, ["l_returnflag"])


# --- recoding -----------------------------------------------------------------------


@registered("""
    SELECT o_orderkey,
           replace(replace(replace(o_orderpriority, '1-', 'first '), 'first URGENT', 'Urgent'), 'NOT SPECIFIED', 'NONE') AS chained
    FROM {orders}
""")
def recode_chain(spark, sf):
    steps = [("1-", "first "), ("first URGENT", "Urgent"), ("NOT SPECIFIED", "NONE")]
    return table(spark, sf, "orders").select(
        "o_orderkey", text.recode_chain("o_orderpriority", steps).alias("chained")
    )


@registered("""
    SELECT p_partkey,
           CASE p_type WHEN 'ECONOMY' THEN 'Low' WHEN 'PROMO' THEN 'Sale' END AS mapped,
           CASE WHEN p_name LIKE '%red%' THEN 'Red' WHEN p_name LIKE '%ring%' THEN 'Ring' END AS contained,
           CASE WHEN strpos(p_name, 'r') > 0
                THEN substring(p_name, 1, strpos(p_name, 'r') - 1) || 'RR' || substring(p_name, strpos(p_name, 'r') + 1)
                ELSE p_name END AS first_replaced,
           replace(p_name, 'r', '') AS removed,
           trim(' ' || p_name || '  ') AS trimmed,
           upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) AS titled,
           CASE WHEN p_type IN ('SMALL', 'LARGE') THEN FALSE ELSE TRUE END AS outside
    FROM {part}
""")
def case_recode(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        text.recode_map("p_type", {"ECONOMY": "Low", "PROMO": "Sale"}).alias("mapped"),
        text.case_contains("p_name", [("red", "Red"), ("ring", "Ring")]).alias("contained"),
        text.replace_first("p_name", "r", "RR").alias("first_replaced"),
        text.remove_all("p_name", "r").alias("removed"),
        text.trim_blank(F.concat(F.lit(" \t"), F.col("p_name"), F.lit("  "))).alias("trimmed"),
        F.initcap("p_type").alias("titled"),
        nulls.not_in("p_type", ["SMALL", "LARGE"]).alias("outside"),
    )


@registered("""
    WITH m AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'DR' ELSE p_type END AS mode,
                      CASE WHEN p_size <= 10 THEN 'DO' WHEN p_size <= 20 THEN 'PT' WHEN p_size <= 30 THEN 'TN'
                           WHEN p_size <= 40 THEN 'TX' ELSE 'ZZ' END AS tos FROM {part})
    SELECT p_partkey, CASE WHEN mode = 'DR' AND tos <> 'ZZ' THEN mode || '-' || tos ELSE mode END AS mode FROM m
""")
def mode_split(spark, sf):
    size = F.col("p_size")
    tos = F.when(size <= 10, "DO").when(size <= 20, "PT").when(size <= 30, "TN").when(size <= 40, "TX").otherwise("ZZ")
    modes = table(spark, sf, "part").select(
        "p_partkey",
        F.when(F.col("p_type") == "ECONOMY", "DR").otherwise(F.col("p_type")).alias("mode"),
        tos.alias("tos"),
    )
    return modes.select("p_partkey", transit.split_demand_response().alias("mode"))


@registered("""
    SELECT n_nationkey, lpad(CAST(n_regionkey AS STRING), 2, '0') || lpad(CAST(n_nationkey AS STRING), 3, '0') AS geoid
    FROM {nation}
""")
def geoid(spark, sf):
    return table(spark, sf, "nation").select("n_nationkey", text.geoid("n_regionkey", "n_nationkey").alias("geoid"))


@registered("""
    SELECT c_custkey, CASE WHEN length(CAST(c_custkey AS STRING)) >= 3 THEN CAST(c_custkey AS STRING)
                           ELSE lpad(CAST(c_custkey AS STRING), 3, '0') END AS code
    FROM {customer}
""")
def pad_codes(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.pad_left("c_custkey", 3).alias("code"))


@registered("""
    SELECT l_orderkey, l_linenumber,
           CAST(DATE '1899-12-30' + CAST(l_orderkey % 20000 AS INTEGER) AS DATE) AS date
    FROM {lineitem}
""")
def excel_serial(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        dates.excel_date((F.col("l_orderkey") % 20000).cast("string")).alias("date"),
    )


@registered("""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ymd, CAST(o_orderdate AS DATE) AS mdy,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS my, CAST(NULL AS DATE) AS bad,
           make_date(year(o_orderdate), 12, 1) AS december, CAST('5' || CAST(year(o_orderdate) AS STRING) AS DOUBLE) AS number,
           CAST(NULL AS DOUBLE) AS bad_number
    FROM {orders}
""")
def parse_dates(spark, sf):
    d, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    y, m, day = F.year(d).cast("string"), F.month(d).cast("string"), F.day(d).cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.parse_ymd(F.concat_ws("-", y, m, day)).alias("ymd"),
        dates.parse_mdy(F.concat_ws("/", m, day, y)).alias("mdy"),
        dates.parse_my(F.concat_ws("/", m, y)).alias("my"),
        dates.parse_ymd(priority).alias("bad"),
        dates.stamp(F.year(d), 12).alias("december"),
        nulls.to_number(F.concat(F.lit("5"), y)).alias("number"),
        nulls.to_number(priority).alias("bad_number"),
    )


@registered("""
    SELECT l_orderkey, l_linenumber, round_even(l_quantity * 1000 * 0.00045359, 0) AS tons FROM {lineitem}
""")
def lbs_to_tons(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.pounds_to_tons(F.col("l_quantity") * 1000).alias("tons")
    )


# --- joins and sets -----------------------------------------------------------------


@registered("""
    SELECT s_suppkey, s_name, n_name FROM {supplier}
    LEFT JOIN (SELECT * FROM {nation} WHERE n_regionkey <> 2) n ON s_nationkey = n_nationkey
""")
def lookup_join(spark, sf):
    nations = table(spark, sf, "nation").filter("n_regionkey <> 2").select("n_nationkey", "n_name")
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return joins.lookup_join(suppliers, nations, "s_nationkey", "n_nationkey").drop("s_nationkey")


@registered("""
    WITH a AS (SELECT NTDID AS id, MPO_AREA AS area FROM {agencies})
    SELECT area, CAST(count(*) AS BIGINT) AS n, sum(l_quantity) AS quantity
    FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey LEFT JOIN a ON CAST(s_nationkey AS STRING) = id
    GROUP BY area
""")
def many_to_many_join(spark, sf):
    by_supplier = (
        table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))
    )
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("id"))
    areas = view(spark, sf, "agencies").select("NTDID", F.col("MPO_AREA").alias("area"))
    by_nation = (
        by_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("id").agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"))
    )
    return (
        joins.lookup_join(by_nation, areas, "id", "NTDID")
        .groupBy("area").agg(F.sum("n").alias("n"), F.sum("quantity").alias("quantity"))
    )


@registered("""
    SELECT r_name, s_n, CAST(s_bal AS DOUBLE) AS s_bal FROM {region} LEFT JOIN (
        SELECT n_regionkey, CAST(count(*) AS BIGINT) AS s_n, sum(CAST(s_acctbal AS DECIMAL(18,2))) AS s_bal
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey WHERE n_regionkey <> 1 GROUP BY n_regionkey
    ) s ON r_regionkey = n_regionkey
""")
def dim_left_join(spark, sf):
    totals = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation").filter("n_regionkey <> 1"), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey")
        .agg(F.count("*").alias("s_n"), F.sum(F.col("s_acctbal").cast(CENTS)).cast("double").alias("s_bal"))
    )
    regions = table(spark, sf, "region").select("r_name", "r_regionkey")
    return joins.lookup_join(regions, totals, "r_regionkey", "n_regionkey").drop("r_regionkey")


@registered("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM {lineitem}
    WHERE l_partkey IN (SELECT p_partkey FROM {part} WHERE p_type = 'PROMO')
""")
def semi_filter(spark, sf):
    wanted = table(spark, sf, "part").filter("p_type = 'PROMO'")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return joins.keep_known(rows, wanted, "l_partkey", "p_partkey")


@registered("""
    SELECT event_id, value, NULLIF(event_type, 'error') AS event_type FROM {events}
    WHERE event_type <> 'error' AND value IS NOT NULL AND value > 0
""")
def drop_null_positive(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "value", F.nullif("event_type", F.lit("error")).alias("event_type")
    )
    return rows.dropna("any").filter(F.col("value") > 0)


@registered("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM {lineitem}")
def distinct_rows(spark, sf):
    return table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@registered("""
    SELECT CAST(year(d) AS STRING) AS year, d AS date, 'Orders' AS geography, 'Table' AS geography_type, variable,
           'All' AS grouping, 'rows' AS metric, CAST(n AS DOUBLE) AS estimate, share, CAST(NULL AS DOUBLE) AS moe
    FROM (
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, o_orderstatus AS variable, count(*) AS n, CAST(0.5 AS DOUBLE) AS share
        FROM {orders} GROUP BY 1, 2
        UNION ALL
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE), l_linestatus, count(*), NULL FROM {lineitem} GROUP BY 1, 2
    ) t
""")
def union_conform(spark, sf):
    orders = (
        table(spark, sf, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("date"), F.col("o_orderstatus").alias("variable"))
        .agg(F.count("*").alias("estimate"))
        .withColumn("share", F.lit(0.5))
    )
    lines = (
        table(spark, sf, "lineitem")
        .groupBy(F.trunc("l_shipdate", "month").alias("date"), F.col("l_linestatus").alias("variable"))
        .agg(F.count("*").alias("estimate"))
    )
    return conform(
        union_trends(orders, lines), geography="Orders", geography_type="Table", grouping="All", metric="rows"
    )


# --- vintages and hierarchy ---------------------------------------------------------


@registered("""
    SELECT o_orderpriority AS place, CAST(year(o_orderdate) AS STRING) AS year,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS estimate
    FROM {orders} GROUP BY 1, 2
""")
def vintage_union(spark, sf):
    """Two vintages that both hold 1998; the newer one owns it."""
    rows = (
        _order_years(spark, sf, F.col("o_orderpriority").alias("place"))
        .withColumnsRenamed({"price": "estimate"})
        .withColumn("year", F.col("year").cast("string"))
    )
    older, newer = rows.filter("year <= '1998'"), rows.filter("year >= '1998'")
    merged = population.vintage_union(older.filter("year <> '1998'"), newer, keys=["place", "year"])
    return _double(merged)


_PLACES = """
    SELECT CAST(level AS DOUBLE) AS level, year,
           CASE level WHEN 1 THEN county || ' County' WHEN 4 THEN replace(place, ' (part)', '')
                      ELSE place || ' ' || county || ' County' END AS place,
           CAST(count(*) AS DOUBLE) AS estimate
    FROM {place_levels} GROUP BY 1, 2, 3
"""
HIERARCHY_CHECK = """
    r AS (
        SELECT level, year, CASE level WHEN 2 THEN 'Unincorporated Region' WHEN 3 THEN 'Incorporated Region' ELSE 'Region' END AS place,
               CASE WHEN count(estimate) = count(*) THEN sum(estimate) END AS estimate
        FROM p WHERE level <= 3 GROUP BY level, year
        UNION ALL SELECT level, year, place, estimate FROM p
    ),
    j AS (
        SELECT DISTINCT juris_name,
               CASE regional_geography WHEN 'Metro' THEN 'Metropolitan Cities' WHEN 'Core' THEN 'Core Cities'
                    WHEN 'HCT' THEN 'High Capacity Transit Community' ELSE 'Cities & Towns' END AS class
        FROM {jurisdictions}
    )
"""
HIERARCHY_COLUMNS = """
    CASE WHEN level = 4 THEN place
         ELSE replace(replace(replace(place, 'Incorporated ', ''), 'Unincorporated ', ''), ' County', '') END AS geography,
    CASE WHEN level = 4 THEN 'City' WHEN place LIKE '%Region%' THEN 'Region' WHEN place LIKE '%County%' THEN 'County' END AS geography_type,
    CASE level WHEN 1 THEN 'Total' WHEN 2 THEN 'Unincorporated' WHEN 3 THEN 'Incorporated' ELSE class END AS variable
"""


@registered(f"""
    WITH p AS ({_PLACES}), {HIERARCHY_CHECK}
    SELECT CAST(year AS BIGINT) AS year, estimate, {HIERARCHY_COLUMNS} FROM r LEFT JOIN j ON place = juris_name
""")
def geography_hierarchy(spark, sf):
    places = query(spark, sf, _PLACES).withColumn("year", F.col("year").cast("bigint"))
    jurisdictions = population.clean_jurisdictions(view(spark, sf, "jurisdictions"))
    return population.geography_hierarchy(population.with_region_levels(places, ["year"]), jurisdictions)


# --- sources and sink: a written copy read back through the reader -------------------

_TITLES_CHECK = """
    SELECT transaction_month, new_or_used, transaction_type, electrification_level, make, county, tract,
           transactions FROM {titles}
"""


@registered(_TITLES_CHECK)
def csv_titles(spark, sf):
    path = _scratch(spark, "titles")
    headers = {name: header for header, name in readers.TITLE_HEADERS.items()}
    view(spark, sf, "titles").withColumnsRenamed(headers).write.mode("overwrite").csv(path, header=True)
    return readers.read_titles(spark, path)


@registered("""
    SELECT CAST(date AS DATE) AS date, state, county, CAST(count(*) AS BIGINT) AS n,
           sum(CAST(total_vehicles AS DOUBLE)) AS total
    FROM {registrations} GROUP BY 1, 2, 3
""")
def json_registrations(spark, sf):
    path = _scratch(spark, "registrations")
    view(spark, sf, "registrations").write.mode("overwrite").json(path)
    return (
        readers.read_registrations(spark, path)
        .groupBy(F.to_date("date").alias("date"), "state", "county")
        .agg(F.count("*").alias("n"), F.sum(nulls.to_number("total_vehicles")).alias("total"))
    )


@registered("SELECT o_orderkey, o_orderpriority, 'orders' AS file_key FROM {orders}")
def filename_tag(spark, sf):
    """Rows tagged with the first letters of the file they were read from."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", readers.file_key(1, 6).alias("file_key")
    )


@registered("""
    SELECT variable, CAST(sum(estimate) AS DOUBLE) AS estimate, CAST(count(*) AS BIGINT) AS n FROM {acs_estimates}
    WHERE year IN (1996, 1999) AND substring(variable, 1, 6) IN ('B08301', 'B25003') GROUP BY variable
""")
def partitioned_acs(spark, sf):
    path = _scratch(spark, "acs")
    cells = view(spark, sf, "acs_estimates").withColumn("acs_table", F.substring("variable", 1, 6))
    cells.write.mode("overwrite").partitionBy("acs_table", "year").parquet(path)
    return (
        readers.read_acs(spark, path, ["B08301", "B25003"], [1996, 1999])
        .groupBy("variable").agg(F.sum("estimate").alias("estimate"), F.count("*").alias("n"))
    )


@registered("""
    SELECT variable, CAST(sum(estimate) AS DOUBLE) AS estimate, CAST(count(*) AS BIGINT) AS n FROM {acs_estimates}
    WHERE substring(variable, 1, 6) IN ('B25003', 'B01001') GROUP BY variable
""")
def acs_by_lookup(spark, sf):
    """The tables to read are those that the lookup's topics name, found while the query runs."""
    path, labels = _scratch(spark, "acs-by-lookup"), _scratch(spark, "acs-labels")
    cells = view(spark, sf, "acs_estimates").withColumn("acs_table", F.substring("variable", 1, 6))
    cells.write.mode("overwrite").partitionBy("acs_table", "year").parquet(path)
    acs_lookup(spark).write.mode("overwrite").parquet(labels)
    lookup = spark.read.parquet(labels).filter(F.col("topic").isin("housing-tenure", "age"))
    return (
        readers.read_acs_by_lookup(spark, path, lookup)
        .groupBy("variable").agg(F.sum("estimate").alias("estimate"), F.count("*").alias("n"))
    )


@registered("""
    SELECT sheet, code, estimate FROM (
        SELECT 'nation' AS sheet, n_name AS code, CAST(n_regionkey AS STRING) AS estimate FROM {nation}
        UNION ALL SELECT 'supplier', s_name, NULL FROM {supplier}
    ) t
""")
def sheet_union(spark, sf):
    """Sheets with different columns, one folder each."""
    nation, supplier = _scratch(spark, "sheet-nation"), _scratch(spark, "sheet-supplier")
    table(spark, sf, "nation").select(F.col("n_name").alias("code"), F.col("n_regionkey").alias("estimate")).write.mode(
        "overwrite").csv(nation, header=True)
    table(spark, sf, "supplier").select(F.col("s_name").alias("code")).write.mode("overwrite").csv(supplier, header=True)
    return readers.read_sheets(spark, {"nation": nation, "supplier": supplier}).select("sheet", "code", "estimate")


@registered("""
    SELECT CAST(year(o_orderdate) AS STRING) AS year, make_date(year(o_orderdate), 12, 1) AS date, 'Region' AS geography,
           'Region' AS geography_type, o_orderpriority AS variable, 'Annual' AS grouping, o_orderstatus AS metric,
           CAST(count(*) AS DOUBLE) AS estimate, CAST(NULL AS DOUBLE) AS share, CAST(NULL AS DOUBLE) AS moe
    FROM {orders} GROUP BY o_orderdate IS NULL, year(o_orderdate), o_orderpriority, o_orderstatus
""")
def trend_sink(spark, sf):
    path = _scratch(spark, "trends")
    counts = (
        table(spark, sf, "orders")
        .groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("variable"), F.col("o_orderstatus").alias("metric"))
        .agg(F.count("*").alias("estimate"))
        .withColumns({"date": dates.stamp("year", 12), "geography": F.lit("Region"), "geography_type": F.lit("Region"), "grouping": F.lit("Annual")})
    )
    sink.write_trends(counts, path)
    return sink.read_trends(spark, path)


@registered("SELECT p_partkey, p_type, p_size FROM {part}")
def catalog_table(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("warehouse_part")
    return readers.read_table(spark, "warehouse_part").select("p_partkey", "p_type", "p_size")
